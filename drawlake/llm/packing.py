"""Best-fit packing of tokenised documents into fixed-capacity sequences.

Two operators: :func:`token_pieces` turns documents into pieces of at most
``max_tokens`` ids, :func:`pack_best_fit` assigns items with several demands
(tokens, documents, attention cost) to bins by vector best-fit.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.llm.common import broadcast_file, id_and_text, kept_by_worker, prepare, write_and_reread

#: Bound of each of a worker's two memos: of words between spaces and of pre-tokens.
MEMO_WORDS = 400_000

#: Fixed value: the vocabulary's pre-token pattern, restricted to lower-case ASCII.
_ASCII_PRE_TOKEN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")
#: Characters up to U+00FF that are neither white space nor letter, number or control.
_MARKS = "".join(c for c in map(chr, range(256)) if c.isprintable() and not c.isalnum() and not c.isspace())


def _byte_letters() -> dict[int, int]:
    """Byte-level alphabet: bytes that are no visible Latin-1 character stand as the code points from 256 on."""
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or b >= 174)]
    return {b: 256 + k for k, b in enumerate(hidden)}


_BYTE_LETTERS = _byte_letters()


class _Memo(dict):
    """Remembered results of a function, started afresh beyond the bound."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        got = self.make(key)
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[key] = got
        return got


class _WordEncoder:
    """Ids (as little-endian unsigned 32-bit bytes) of the words between a text's spaces.

    The vocabulary lower-cases, drops white space and never joins ids across
    it, so a word has the same ids wherever it stands. New words are cut into
    pre-tokens - a run of Latin-1 letters and the marks behind it at once,
    printable ASCII by the pattern above, others by the tokenizer's own
    normaliser and pre-tokenizer - and each new pre-token goes through the
    tokenizer's model once. (Latin-1 needs no normalising, and lower-cases
    character by character.)

    The tokenizer matches its added tokens, special ones too, in the raw text
    unless ``encode_special_tokens`` is set; a text that may hold one goes
    through the tokenizer as a whole.
    """

    def __init__(self, tokenizer, encode_special_tokens: bool = False):
        tokenizer.encode_special_tokens = encode_special_tokens
        self.whole = tokenizer.encode
        self.normalise = tokenizer.normalizer.normalize_str
        self.pre_tokens = tokenizer.pre_tokenizer.pre_tokenize_str
        self.model = tokenizer.model
        self.words, self.pieces = _Memo(self._word), _Memo(self._piece)
        added = [t.content for t in tokenizer.get_added_tokens_decoder().values()
                 if not (t.special and encode_special_tokens)]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE).search if added else lambda text: None

    def _piece(self, piece: str) -> bytes:
        return array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        ascii_only = word.isascii()
        if ascii_only or max(word) < "\u0100":
            low = word.lower()
            core = low.rstrip(_MARKS)
            if core.isalpha() or not core:
                marks, own = low[len(core):], core
                if not ascii_only:
                    own, marks = (x.encode().decode("latin-1").translate(_BYTE_LETTERS) for x in (core, marks))
                return (self.pieces[own] if own else b"") + (self.pieces[marks] if marks else b"")
            if ascii_only and word.isprintable():
                return b"".join(map(self.pieces.__getitem__, _ASCII_PRE_TOKEN.findall(low)))
        return b"".join([self.pieces[piece] for piece, _ in self.pre_tokens(self.normalise(word))])

    def encode(self, text: str) -> bytes:
        if self.added(text):
            return array("I", self.whole(text, add_special_tokens=False).ids).tobytes()
        if text.isascii():
            text = text.lower()
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))


def _worker_encoder(key: tuple, vocab) -> _WordEncoder:
    """The worker's encoder of a vocabulary, kept from task to task."""
    def make() -> _WordEncoder:
        from tokenizers import Tokenizer
        return _WordEncoder(Tokenizer.from_str(vocab.value.decode()), key[-1])

    return kept_by_worker(("words", *key), make)


def token_pieces(docs: DataFrame, vocab_path: str, max_tokens: int = 4096, end_id: int = 1,
                 id_col: str = "doc_id", text_col: str = "text", encode_special_tokens: bool = False) -> DataFrame:
    """Token ids of every whole document, cut into pieces of at most ``max_tokens``.

    Returns ``doc_id, piece, start, length, ids`` (``ids``: binary of
    little-endian unsigned 32-bit ids); the document's ids are its text's ids
    and then ``end_id``. Only documents longer than ``max_tokens`` are cut.
    Every distinct word is encoded once per worker, up to the memos' bound
    (see :class:`_WordEncoder`).

    The ids are the library's: the strings of the vocabulary's added tokens in
    a text become their ids, unless ``encode_special_tokens`` (as the library
    calls it) makes ordinary text of special ones.

    Null or empty text: one piece holding only ``end_id``. Null or repeated
    ``doc_id``: each row is a document of its own. Extra columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    vocab = broadcast_file(spark, vocab_path)
    step = 4 * max_tokens
    end = int(end_id).to_bytes(4, "little")

    key = (vocab_path, zlib.crc32(vocab.value), encode_special_tokens)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(key, vocab)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out: list[tuple] = []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = encoder.encode(text) + end
                    out.extend((doc_id, k, at // 4, min(step, len(ids) - at) // 4, ids[at:at + step])
                               for k, at in enumerate(range(0, len(ids), step)))
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()),
                     pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.binary())],
                    names=["doc_id", "piece", "start", "length", "ids"])

    return id_and_text(docs, id_col, text_col).mapInArrow(
        pieces, "doc_id long, piece int, start long, length long, ids binary")


def best_fit_bins(demand: np.ndarray, capacity: np.ndarray, weights: np.ndarray, rule: str = "norm") -> np.ndarray:
    """Bin number of each item (rows of ``demand``), by vector best-fit decreasing.

    Items go in the order of falling weighted demand. Among the open bins whose
    residual covers the item in every dimension, ``rule='norm'`` takes the one
    with the smallest weighted norm of what would remain and ``rule='dot'`` the
    one whose residual has the largest weighted dot product with the demand;
    the lower bin number wins ties. An item that fits nowhere opens a bin.
    """
    if rule not in ("norm", "dot"):
        raise ValueError("rule must be 'norm' or 'dot'")
    n, dims = demand.shape
    if (demand > capacity).any():
        raise ValueError("an item is larger than a whole bin")
    share = demand / capacity
    order = np.lexsort((np.arange(n), -(share * weights).sum(axis=1)))
    least = np.minimum.accumulate(demand[order][::-1], axis=0)[::-1]  # of the items still to come
    bins = np.empty(n, dtype=np.int64)
    residual = np.empty((dims, 1024), dtype=np.int64)
    number = np.empty(1024, dtype=np.int64)
    open_bins = made = 0
    for k, item in enumerate(order):
        d = demand[item]
        if k % 512 == 0 and open_bins:  # forget bins that no later item fits
            keep = np.flatnonzero((residual[:, :open_bins] >= least[k][:, None]).all(axis=0))
            residual[:, :len(keep)] = residual[:, keep]
            number[:len(keep)] = number[keep]
            open_bins = len(keep)
        fits = np.flatnonzero((residual[:, :open_bins] >= d[:, None]).all(axis=0))
        if len(fits) == 0:
            if open_bins == residual.shape[1]:
                residual = np.concatenate([residual, np.empty_like(residual)], axis=1)
                number = np.concatenate([number, np.empty_like(number)])
            residual[:, open_bins] = capacity - d
            number[open_bins] = made
            bins[item] = made
            open_bins += 1
            made += 1
            continue
        left = residual[:, fits] / capacity[:, None]
        if rule == "norm":
            best = fits[np.argmin((weights[:, None] * (left - share[item][:, None]) ** 2).sum(axis=0))]
        else:
            best = fits[np.argmax((weights * share[item]) @ left)]
        residual[:, best] -= d
        bins[item] = number[best]
    return bins


def pack_best_fit(items: DataFrame, max_tokens: int = 4096, max_documents: int | None = None,
                  max_attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.05),
                  rule: str = "norm", group_rows: int = 16_384, length_col: str = "length") -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to items of at most ``max_tokens`` each.

    Every bin has three capacities: tokens, documents (default: as many as
    there are tokens) and attention cost, the sum of squared lengths (default:
    ``max_tokens`` squared, that of one full piece). Items that fill a bin
    alone never need a choice and are not shuffled; the others are dealt by a
    hash of their row number into groups of about ``group_rows`` items, each
    packed by :func:`best_fit_bins`. Every group sees the same mix of lengths,
    so what is lost against one global packing is under one bin a group, and
    no group grows with the data, whatever the keys.

    The items are written once to the shared folder, which fixes row numbers
    and spares a second tokenisation. A null or non-positive length raises.
    Empty input: empty output. Repeated rows are items of their own. Columns
    named ``sequence_id`` or ``offset`` are replaced.
    """
    spark = items.sparkSession
    prepare(spark)
    documents = max_documents or max_tokens
    attention = max_attention or max_tokens * max_tokens
    items = write_and_reread(items.drop("sequence_id", "offset"), "pack")
    names = items.columns
    size = F.col(length_col).cast("long")
    row, group = "__pack_row", "__pack_group"
    while row in names or group in names:
        row, group = row + "_", group + "_"
    seen = items.agg(F.sum(F.when(size < max_tokens, 1).otherwise(0)).alias("part"),
                     F.min(size).alias("least"), F.max(size).alias("most"),
                     F.max(size.isNull().cast("int")).alias("void")).first()
    if seen["void"] or (seen["least"] is not None and (seen["least"] < 1 or seen["most"] > max_tokens)):
        raise ValueError(f"lengths must lie between 1 and {max_tokens}")
    if seen["most"] is not None and seen["most"] ** 2 > attention:
        raise ValueError("one item alone exceeds the attention capacity")
    numbered = items.withColumn(row, F.monotonically_increasing_id())
    alone = (numbered.where(size == max_tokens)
             .withColumn("sequence_id", -F.col(row) - 1).withColumn("offset", F.lit(0).cast("long"))
             .drop(row))
    groups = max(1, -(-(seen["part"] or 0) // group_rows))
    capacity = np.array([max_tokens, documents, attention], dtype=np.int64)
    weight = np.array(weights, dtype=float)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(row, ignore_index=True)
        length = pdf[length_col].to_numpy(dtype=np.int64)
        bins = best_fit_bins(np.stack([length, np.ones_like(length), length * length], axis=1), capacity, weight, rule)
        pdf["sequence_id"] = pdf[group].to_numpy(dtype=np.int64) * (1 << 32) + bins
        pdf["offset"] = pd.Series(length).groupby(bins).cumsum() - length
        return pdf[[*names, "sequence_id", "offset"]]

    packed = (numbered.where(size < max_tokens)
              .withColumn(group, F.pmod(F.xxhash64(row), F.lit(groups)))
              .groupBy(group).applyInPandas(pack, _with_placing(items)))
    return packed.unionByName(alone)


def _with_placing(items: DataFrame):
    from pyspark.sql.types import LongType, StructField, StructType
    return StructType([*items.schema.fields, StructField("sequence_id", LongType()), StructField("offset", LongType())])
