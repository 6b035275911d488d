"""Personal data: pattern spans, and terms that disclose them by corpus co-occurrence.

In DataFrame functions alone. The protected entities are the values that the
patterns find (a certain e-mail address, card number, ...). A term beside an
entity discloses it as far as it tells the entity's presence: with document
frequencies n over N documents, the share of the entity's information

    PMI(term; entity) / IC(entity) = log(N n(t, e) / (n(t) n(e))) / log(N / n(e))

is 1 when the term never occurs without the entity and 0 when both are
independent. Small counts are discounted: n(t, e) / n(t) enters by its lower
confidence bound, and the coincidence must be unlikely among all terms tried.
A value seen too rarely to tell anything about is also looked at as one of its
group (domain, network, issuer, area). Counts are of whole different texts, and
every occurrence of a term above the threshold becomes a span of the kind
``term`` in each document that holds its entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import prepare, write_and_reread
from drawlake.llm.native import let, matches, running

#: The kinds in their order, and their patterns. Possessive repeats and the looks
#: behind change no match; they keep long runs of the same characters from being tried again
#: and again, and the matcher from nesting once per character.
KINDS = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot match.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
TERM_PATTERN = r"[\p{L}\p{M}\p{N}]+"
#: Square of the normal quantile of the lower bound's confidence (80 %, one-sided).
Z2 = 0.8416 ** 2

SPAN = "struct<kind:string,start:bigint,end:bigint,value:string>"


def _luhn(value: Column) -> Column:
    digits = F.filter(F.split(F.reverse(F.regexp_replace(value, "[^0-9]", "")), ""), lambda d: d != "")

    def total(ds: Column) -> Column:
        weighed = F.transform(ds, lambda d, k: let(d.cast("int") * F.when(k % 2 == 1, 2).otherwise(1),
                                                   lambda v: F.when(v > 9, v - 9).otherwise(v)))
        return (F.size(ds).between(13, 19)) & (F.aggregate(weighed, F.lit(0), lambda a, v: a + v) % 10 == 0)

    return let(digits, total)


def _valid(kind: str, value: Column) -> Column:
    n_digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    if kind == "ip":
        return F.forall(F.split(value, r"\."),
                        lambda p: p.rlike(r"^0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?$"))
    if kind == "card":
        return F.when(n_digits.between(13, 19), _luhn(value)).otherwise(F.lit(False))
    if kind == "phone":
        return n_digits.between(9, 15)
    return F.lit(True)


def base_spans(text: Column) -> Column:
    """array<struct<kind, start, end, value>> of valid matches, by kind as listed, then start."""
    def of(kind: str) -> Column:
        found = F.transform(F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["value"])),
                            lambda m: F.struct(F.lit(kind).alias("kind"), m["start"].alias("start"),
                                               m["end"].alias("end"), m["value"].alias("value")))
        likely = text.rlike("[0-9]") if HINTS[kind] is None else F.contains(text, F.lit(HINTS[kind]))
        return F.when(likely, found).otherwise(F.array().cast(f"array<{SPAN}>"))

    return F.concat(*map(of, KINDS))


def _terms(text: Column, shortest: int) -> Column:
    """Hashes of the different terms of a whole text."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{M}\p{N}]+"), lambda w: F.length(w) >= shortest)
    return F.array_distinct(F.transform(words, lambda w: F.xxhash64(w)))


def _entities(span: Column) -> Column:
    """Keys of what a span mentions: its value, and the group that the value belongs to."""
    value = F.lower(span["value"])
    digits = F.regexp_replace(value, "[^0-9]", "")
    group = (F.when(span["kind"] == "email", F.substring_index(value, "@", -1))
             .when(span["kind"] == "ip", F.substring_index(value, ".", 3))
             .when(span["kind"] == "card", F.substring(digits, 1, 6)).otherwise(F.substring(digits, 1, 4)))
    return F.array(F.xxhash64(span["kind"], value), F.xxhash64(span["kind"], F.lit("group"), group))


def _least_share(n_te: Column, n_t: Column, n_e: Column, n_docs: Column) -> Column:
    """Share of the entity's information that the term tells, with Wilson's lower bound of n_te / n_t."""
    p = n_te / n_t
    low = (p + Z2 / (2 * n_t) - F.sqrt(Z2 * (p * (1 - p) / n_t + Z2 / (4 * n_t * n_t)))) / (1 + Z2 / n_t)
    info = F.log(n_docs / n_e)
    return F.when((info > 0) & (low > 0), 1 + F.log(low) / info)


def _evidence(n_te: Column, n_t: Column, n_e: Column, n_docs: Column) -> Column:
    """Minus the log of the chance (Chernoff's bound) that so many of the term's other documents hold
    the entity too. The first one is why the pair is looked at at all, and so no evidence."""
    k, n, q = n_te - 1, n_t - 1, n_e / n_docs
    missed = F.when(n > k, (n - k) * F.log((n - k) / (n * (1 - q)))).otherwise(0.0)
    return F.when((q < 1) & (k > n * q), k * F.log(k / (n * q)) + missed).otherwise(0.0)


def find(docs: DataFrame, threshold: float = 0.95, support: int = 1, shortest: int = 4, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """``doc_id, base`` and ``added``: the spans of every whole text, one row per input row.

    ``base`` holds the pattern spans with their values, ``added`` the spans of
    terms of at least ``shortest`` characters whose disclosure of an entity in
    the same document, or of its group, surely exceeds ``threshold``: by the lower bound of
    its estimate, and with fewer than one such coincidence expected among the
    terms of that entity's documents. Every occurrence counts that is not inside
    a pattern span, however far from the entity. ``support`` can ask for more documents that hold
    both. Sorted by start and without repeats. Frequencies count all different
    texts, whole: copies of a text say nothing new, so they are one text, and
    what is marked in one is marked in all. A term seen with an entity in a
    single text tells no more than any other word used once, so a value of one
    text is covered by its group alone.

    Null or empty text: no spans. Null and repeated ids stay rows of their own.
    Extra columns are ignored. Empty table: empty result.
    """
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    # Spans are written once, with the texts that hold an entity and no others.
    copy = F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit("again"), "text").alias("b"))
    seen = docs.select("doc_id", "text", copy.alias("copy"), let(base_spans(F.col("text")), lambda s: s).alias("base"))
    found = write_and_reread(seen.select("doc_id", "copy", "base", F.when(F.size("base") > 0, F.col("text")).alias("text")),
                             "mentions")
    # Copies of a text are one text, here and in all counts.
    held = write_and_reread(found.where(F.size("base") > 0).select("copy", "base", "text").dropDuplicates(["copy"])
                            .withColumn("terms", _terms(F.col("text"), shortest)), "held")
    holds = held.select("copy", F.explode(F.array_distinct(F.flatten(F.transform("base", _entities)))).alias("entity"),
                        F.size("terms").alias("tried"))
    # Terms tried per entity: those of its texts, repeats included. An entity of one text
    # has no pair with evidence, and a pair of one text only has none either.
    entities = (holds.groupBy("entity").agg(F.count("*").alias("n_e"), F.sum("tried").alias("tried"))
                .where(F.col("n_e") >= max(2, support)))
    holds = write_and_reread(holds.select("copy", "entity").join(entities.select("entity"), "entity"), "holds")
    occurring = held.select("copy", F.explode("terms").alias("term"))
    together = (holds.join(occurring, "copy").groupBy("entity", "term")
                .agg(F.count("*").alias("n_te")).where(F.col("n_te") >= max(2, support)).join(entities, "entity"))
    together = write_and_reread(together, "together")
    # Number of texts of every term of the corpus: summed per task before it is dealt out by term.
    frequency = (docs.select(copy.alias("copy"), "text").dropDuplicates(["copy"]).select(F.explode(_terms(F.col("text"), shortest)).alias("term"))
                 .groupBy("term").agg(F.count("*").alias("n_t")))
    n_docs = F.lit(float(found.select("copy").distinct().count()))
    counts = F.col("n_te"), F.greatest("n_t", "n_te"), F.col("n_e"), n_docs
    telling = write_and_reread(together.join(frequency, "term").where(
        (_least_share(*counts) > threshold) & (_evidence(*counts) > F.log("tried"))).select("entity", "term"), "telling")
    # From the terms of a text to those that tell one of its own entities: never more rows than terms times entities of a text.
    told = (occurring.join(telling.select("term").distinct(), "term", "left_semi").join(holds, "copy")
            .join(telling, ["entity", "term"], "left_semi").select("copy", "term").distinct())
    outside = lambda m: ~F.exists("base", lambda s: (s["start"] <= m["start"]) & (m["end"] <= s["end"]))
    places = (held.join(told.select("copy").distinct(), "copy", "left_semi")
              .select("copy", F.explode(F.filter(matches(F.col("text"), TERM_PATTERN), outside)).alias("m"))
              .select("copy", F.xxhash64(F.lower("m.value")).alias("term"), F.struct("m.start", "m.end").alias("place")))
    spans = places.join(told, ["copy", "term"]).groupBy("copy").agg(F.sort_array(F.collect_set("place")).alias("added"))
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    rows = found.select("doc_id", "copy", "base")
    return (rows.where(F.size("base") > 0).join(spans, "copy", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))
            .unionByName(rows.where(F.size("base") == 0).select("doc_id", "base", none.alias("added"))))


def sanitise(text: Column, base: Column, added: Column) -> Column:
    """The text with every base span replaced by ``[KIND]`` and every added one by ``[TERM]``.

    Where spans overlap, the later one only covers what the earlier left open.
    """
    every = F.concat(
        F.transform(base, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.upper(s["kind"]).alias("kind"))),
        F.transform(added, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit("TERM").alias("kind"))))

    def rebuilt(spans: Column) -> Column:
        covered = running(F.transform(spans, lambda s: s["end"]), lambda a, b: F.greatest(a, b))

        def cut(done: Column) -> Column:
            pieces = F.transform(spans, lambda s, k: let(F.element_at(done, k + 1), lambda d: F.when(
                s["end"] <= d, F.lit("")).otherwise(F.concat(
                    F.substring(text, (d + 1).cast("int"), F.greatest(s["start"] - d, F.lit(0).cast("long")).cast("int")),
                    F.lit("["), s["kind"], F.lit("]")))))
            last = F.greatest(F.element_at(done, -1), F.element_at(spans, -1)["end"])
            return F.concat(F.array_join(pieces, ""), F.substring(text, (last + 1).cast("int"), F.length(text)))

        return F.when(F.size(spans) == 0, text).otherwise(let(covered, cut))

    return let(F.sort_array(every), rebuilt)
