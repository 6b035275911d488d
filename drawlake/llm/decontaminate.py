"""Benchmark decontamination: one Aho-Corasick automaton over the benchmark's word windows.

Test questions and answers are normalised to lower-case words between single
spaces; every run of ``window`` consecutive words of an item is a pattern (an
item of fewer words is one pattern as a whole). A document is normalised the
same way and scanned once; each occurrence is mapped back to word numbers and
from there to code points of the original text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import id_and_text, prepare, write_and_reread
from drawlake.llm.plain_words import PLAIN_WORD, plain_words

#: Bound of one automaton: characters of all its patterns (each at most one node of about 40 bytes).
MAX_NODES = 4_000_000

_HIT = pa.list_(pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
_FOUND = "row long, doc_id long, n_words long, hits array<struct<word:int,start:int,end:int>>, items array<string>"

_LAST: dict[str, object] = {}


def _per_worker(key: str, make: Callable[[], object]) -> object:
    """``make()``, remembered by the worker until another key is asked for."""
    if key not in _LAST:
        _LAST.clear()
        _LAST[key] = make()
    return _LAST[key]


def windows_of(words: list[bytes], size: int) -> set[str]:
    """Patterns of one item: its runs of ``size`` words, between spaces (one character per byte)."""
    return {f" {b' '.join(words[k:k + size]).decode('latin-1')} "
            for k in range(max(1, len(words) - size + 1))} if words else set()


def _patterns(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """``pattern, items``: every distinct window with the ids of the items that hold it."""
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("binary").alias("text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
                found = sorted(windows_of(plain_words(text), window))
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([item] * len(found), pa.string())],
                                                 names=["pattern", "item"])

    return (rows.where("text is not null").mapInArrow(cut, "pattern string, item string").distinct()
            .groupBy("pattern").agg(F.collect_list("item").alias("items")))


def _automaton(patterns: list[tuple[str, list[str]]]):
    import ahocorasick
    out = ahocorasick.Automaton()
    for pattern, items in patterns:
        out.add_word(pattern, (pattern.count(" ") - 1, items))
    out.make_automaton()
    return out


def occurrences(automaton, text: bytes) -> tuple[int, list[dict], list[str]]:
    """Number of words, the words inside any occurrence (with code points), and the items met."""
    words = plain_words(text)
    line = b" " + b" ".join(words) + b" "
    ends, sizes, items = [], [], set()
    for end, (size, own) in automaton.iter(line.decode("latin-1")):
        ends.append(end)
        sizes.append(size)
        items.update(own)
    if not ends:
        return len(words), [], []
    after = np.searchsorted(np.flatnonzero(np.frombuffer(line, np.uint8) == 32), ends)  # number of the word that follows
    change = np.zeros(len(words) + 1, dtype=np.int64)
    np.add.at(change, after - np.array(sizes), 1)
    np.add.at(change, after, -1)
    inside = set(np.flatnonzero(np.cumsum(change[:-1])).tolist())
    hits = [{"word": k, "start": m.start(), "end": m.end()}
            for k, m in enumerate(PLAIN_WORD.finditer(text.decode("utf-8", "replace"))) if k in inside]
    return len(words), hits, sorted(items)


def _scan(rows: DataFrame, patterns: list[tuple[str, list[str]]], only_hits: bool) -> DataFrame:
    spark = rows.sparkSession
    sent, key = spark.sparkContext.broadcast(patterns), uuid.uuid4().hex

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _per_worker(key, lambda: _automaton(sent.value)) if sent.value else None
        for batch in batches:
            out = []
            for row, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")), strict=True):
                n, hits, items = occurrences(automaton, text) if automaton else (len(plain_words(text)), [], [])
                if hits or not only_hits:
                    out.append((row, doc_id, n, hits, items))
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()),
                 pa.array(cols[3], _HIT), pa.array(cols[4], pa.list_(pa.string()))],
                names=["row", "doc_id", "n_words", "hits", "items"])

    return rows.mapInArrow(scan, _FOUND)


def find(docs: DataFrame, items: DataFrame, window: int = 10, max_nodes: int = MAX_NODES, id_col: str = "doc_id",
         text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, hits, items`` of every whole document, one row per input row.

    ``hits`` lists the words inside any occurrence of an item's window, by word
    number, with start and end in code points of the original text;
    ``items`` lists the ids (as strings, sorted) of the items with an
    occurring window.

    The patterns are counted before they are sent to the tasks. Up to
    ``max_nodes`` characters they make one automaton and every text is scanned
    once. A larger benchmark is dealt by hash of the window into as many
    automata as needed, each within that bound; the documents are then written
    once with row numbers and scanned once per automaton, and the findings
    (not the texts) are brought together by row.

    Null or empty text: no words. An item without words, or a null one, never
    occurs; a null item id marks words but is not listed; several items of one
    id count once. Null or repeated ``doc_id``: each row is a document of its
    own. An empty benchmark finds nothing. Extra columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    rows = id_and_text(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    patterns = write_and_reread(_patterns(items, window, item_id_col, item_text_col), "windows")
    weight = F.length("pattern") + 8 * F.size("items")
    parts = max(1, -(-(patterns.agg(F.sum(weight)).first()[0] or 0) // max_nodes))
    part = F.pmod(F.xxhash64("pattern"), F.lit(parts))

    def own(k: int) -> list[tuple[str, list[str]]]:
        return [(r["pattern"], r["items"]) for r in patterns.where(part == k).collect()]  # at most about max_nodes

    if parts == 1:
        return _scan(rows.withColumn("row", F.lit(0).cast("long")), own(0), False).drop("row")
    rows = write_and_reread(rows.withColumn("row", F.monotonically_increasing_id()), "texts")
    found = [write_and_reread(_scan(rows, own(k), k > 0), "found") for k in range(parts)]
    both = found[0]
    for more in found[1:]:
        both = both.unionByName(more)
    return (both.groupBy("row").agg(F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("hits")))).alias("hits"),
                                    F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
            .drop("row"))


def hit_spans(hits: Column) -> Column:
    """array<struct<start, end>>: neighbouring hit words as one span (native)."""
    first = F.filter(hits, lambda h, k: (k == 0) | (F.get(hits, k - 1)["word"] != h["word"] - 1))
    last = F.filter(hits, lambda h, k: F.coalesce(F.get(hits, k + 1)["word"] != h["word"] + 1, F.lit(True)))
    return F.zip_with(first, last, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))
