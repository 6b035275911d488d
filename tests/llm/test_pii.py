"""Personal data against Python's regular expressions; disclosure against its formula; no Python in the plan."""

import math
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from drawlake.llm import native, pii
from tests.llm.util import EDGE_ROWS, docs, prose

#: As stated by the contract.
BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in BASE:
        for m in re.finditer(pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                    "card": lambda: 13 <= len(d) <= 19 and luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]():
                out.append((kind, m.start(), m.end(), m.group()))
    return out


def check(spark, rows):
    got = pii.find(docs(spark, rows)).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in got), key=str) == \
        sorted(((i, base(t or "")) for i, t in rows), key=str)


CASES = ["a.b@c.de, x@y.z.w- q@@r.s a@b.c.@d.e", "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.255 1..2.3.4 0.0.0.0 1.2.3.0300",
         "4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111 5500005555555559x", "+1 (555) 555-0100. +44 20 7946 0958 +1 +12 +(3) +1-2-3-4-5-6-7-8-9",
         "日本 a@b.co é +49 30 901820 漢", "x@y.com1.2.3.4 4111111111111111@z.org", "a@b.c" + "-" * 5, "%+-@x.y"]


def test_base_spans(spark):
    check(spark, EDGE_ROWS + [(100 + k, t) for k, t in enumerate(CASES)])


def test_very_long_runs(spark):
    check(spark, [(1, "1" * 60_000), (2, "a" * 200_000 + " b@c.de"), (3, "1." * 30_000), (4, "+1" + "-" * 50_000 + "2"),
                  (5, "a@b.co " * 3_000), (6, "a@b" + ".c" * 20_000)])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("ab1234567890@.+-() %\né"), max_size=60), min_size=1, max_size=60))
def test_any_text(spark, texts):
    check(spark, list(enumerate(texts)))


def test_running(spark):
    f = spark.createDataFrame([([k % 7 for k in range(n)],) for n in (0, 1, 5, 256, 257, 1000)], "a array<long>")
    for r in f.select("a", native.running(F.col("a")).alias("r"), native.running(F.col("a"), lambda x, y: F.greatest(x, y)).alias("m")).collect():
        assert r.r == [sum(r.a[:k]) for k in range(len(r.a))]
        assert r.m == [max([0, *r.a[:k]]) for k in range(len(r.a))]


def leaking(n=60):
    """Documents in which a name and "from" stand beside one address, often and nowhere else."""
    rows = []
    for k in range(n):
        text = prose(k, 40)
        if k % 10 == 0:
            text += " Zebulon writes from zeb@mail.example about " + prose(k + 500, 5)
        elif k % 7 == 0:
            text += f" common words u{k}@mail.example"
        if k % 3 == 0:
            text += " writes about things"
        rows.append((k, text))
    return rows


def test_disclosing_terms(spark):
    rows = leaking()
    n_t = Counter(t for _, text in rows for t in set(re.findall(r"\w+", text.lower())))
    share = lambda t, e, together: math.log(len(rows) * together / (n_t[t] * e)) / math.log(len(rows) / e)
    assert share("zebulon", 6, 6) == share("from", 6, 6) == 1 and share("writes", 6, 6) < 0.95
    got = {r.doc_id: r for r in pii.find(docs(spark, rows)).collect()}
    for i, text in rows:
        words = {text[s.start:s.end] for s in got[i].added}
        assert words == ({"Zebulon", "from"} if i % 10 == 0 else set()), (i, words)
    plain = pii.find(docs(spark, rows), support=7).collect()
    assert not any(r.added for r in plain)


def test_rare_entities(spark):
    """A name beside a card of two documents, and one beside many single addresses of a domain."""
    rows = [(k, prose(k, 12)) for k in range(1200)]
    rows[7] = (7, "Quillfeather pays by 4111 1111 1111 1111 " + prose(7, 12))
    rows[8] = (8, "Quillfeather again: 4111 1111 1111 1111 " + prose(8, 12))
    for k in range(100, 108):
        rows[k] = (k, f"Umbrellaworks: u{k}@umbrella.example " + prose(k, 12))
    got = {r.doc_id: {rows[r.doc_id][1][s.start:s.end] for s in r.added} for r in pii.find(docs(spark, rows)).collect()}
    assert got[7] == got[8] == {"Quillfeather"}
    assert all(got[k] == {"Umbrellaworks"} for k in range(100, 108))
    assert not any(w for i, w in got.items() if i not in (7, 8) and not 100 <= i < 108)


def test_whole_documents(spark):
    """A name in the salutation, far from the address at the end, and each of its repeats."""
    rows = [(k, prose(k, 40)) for k in range(60)]
    for k in range(0, 60, 10):
        rows[k] = (k, f"Dear Zebulon, {prose(k, 40)} Zebulon {prose(k, 40)} zeb@mail.example")
    assert all(len(t) - t.index("Zebulon", 20) > 100 for i, t in rows if i % 10 == 0)
    got = {r.doc_id: [rows[r.doc_id][1][s.start:s.end] for s in r.added] for r in pii.find(docs(spark, rows)).collect()}
    assert all(got[i] == (["Dear", "Zebulon", "Zebulon"] if i % 10 == 0 else []) for i, _ in rows)


def test_copies_are_no_evidence(spark):
    """A text in many copies tells what one of it tells; a term marked in one copy is marked in all."""
    rows = leaking()
    once = {i: sorted(map(tuple, r)) for i, r in added(spark, rows).items()}
    copied = rows + [(1000 + 100 * c + i, t) for c in range(3) for i, t in rows[:40]]
    many = added(spark, copied)
    assert {i: sorted(map(tuple, many[i])) for i, _ in rows} == once
    assert all(many[1000 + 100 * c + i] == many[i] for c in range(3) for i in range(40))
    alone = [(k, prose(k, 30)) for k in range(80)] + [(100 + k, "Xylomancer and a hash 9f8e7d6c write to q@rare.example") for k in range(20)]
    assert not any(added(spark, alone).values())


def added(spark, rows):
    return {r.doc_id: list(r.added) for r in pii.find(docs(spark, rows)).collect()}


def test_pairs_stay_linear_in_a_hot_domain(spark):
    """One domain in half of the texts and a telling word in a quarter of those: spans, not texts times words."""
    n = 2_000
    rows = [(k, f"{prose(k, 6)} Name{k % 250}word k{k}@hot.example" if k % 2 else prose(k, 8)) for k in range(n)]
    frame = pii.find(docs(spark, rows))
    frame.collect()
    words = sum(len(set(re.findall(r"\w{4,}", t.lower()))) for k, t in rows if k % 2)
    made, todo = 0, [frame._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        todo += [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        todo += [node.children().apply(k) for k in range(node.children().size())]
        if "Join" in name:
            made = max(made, node.metrics().apply("numOutputRows").value())
    assert made <= 3 * words


def test_sanitise(spark):
    frame = docs(spark, leaking() + [(900, "call +1 555 555 0100 or 1.2.3.4"), (901, "nothing"), (902, None)], extra=False)
    found = pii.find(frame)
    out = {r.doc_id: r.clean for r in found.join(frame, "doc_id").select(
        "doc_id", pii.sanitise(F.coalesce("text", F.lit("")), F.col("base"), F.col("added")).alias("clean")).collect()}
    assert out[0].endswith(" [TERM] writes [TERM] [EMAIL] about " + prose(500, 5) + " writes about things")
    assert out[900] == "call [PHONE] or [IP]" and out[901] == "nothing" and out[902] == ""


def test_empty_and_native(spark, capsys):
    assert pii.find(docs(spark, [])).count() == 0
    pii.find(docs(spark, leaking())).explain()
    assert not re.search("Python|Pandas|Arrow", capsys.readouterr().out)
