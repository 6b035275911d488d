"""Byte-level BPE: encode every distinct word of the corpus once, decode by the token-byte table.

Shape of :func:`encode`:

1. Input tasks cut their documents into blocks of some megabytes, split them
   into pre-tokens and keep, per block, the distinct words, and the positions
   as numbers into them. One row per (block, word bucket) goes to the bucket's
   task, so a word that is everywhere travels once per block and no bucket is hot.
2. A bucket's task meets every word of the corpus that hashes to it, encodes
   each distinct one once and answers every block that asked.
3. Answers and positions meet by block, where ids are laid out by position.

Words and positions come from two scans of the same input partitions, which
costs less than keeping the positions on disk in between. A block's key is a
digest of its content and place; should a scan ever cut its blocks differently
from the other, those blocks find no answer and encode their words themselves.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.types import BinaryType, StructField, StructType

from drawlake.llm.common import broadcast_file, id_and_text, kept_by_worker, partitions, prepare

#: A block ends after so many characters or documents.
BLOCK_CHARS, BLOCK_DOCS = 5_000_000, 4_096
#: More distinct words than this in one bucket's task and its memo starts afresh (words are then encoded again).
MEMO_WORDS = 2_000_000
#: Word buckets are as many as shuffle partitions, up to this number.
MAX_BUCKETS = 4_096

_BESIDE_SPACE = re.compile(r"\s\s")
_SINGLE_SPACE = re.compile(r"(?<=\S) (?=\S)")


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Token bytes to rank, from lines of base64 token and rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed value; wide integers go byte plane by byte plane, which compresses better."""
    import zstandard
    parts = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        parts.append(np.array([a.dtype.itemsize, len(a)], dtype="<u8").tobytes())
        parts.append(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes())
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def _unpack(data: bytes) -> list[np.ndarray]:
    import zstandard
    raw, at, out = zstandard.ZstdDecompressor().decompress(data), 0, []
    while at < len(raw):
        width, n = map(int, np.frombuffer(raw, "<u8", 2, at))
        at += 16
        planes = np.frombuffer(raw, np.uint8, width * n, at).reshape(width, n)
        out.append(np.ascontiguousarray(planes.T).reshape(-1).view(f"<u{width}"))
        at += width * n
    return out


def _ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of the runs ``starts[i] .. starts[i] + lengths[i]``, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)


def _split_words(words: bytes, lengths: np.ndarray) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [words[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)] if ends else []


def _numbers() -> defaultdict:
    """Keys to numbers in the order of first use."""
    return defaultdict(count().__next__)


class _Block:
    """Pre-tokens of some documents: distinct words, and each document's words as numbers.

    A text is cut at its single spaces first: a space between two characters
    that are not white space always begins a pre-token, and what follows such a
    piece never changes the pre-tokens in it. Documents keep piece numbers; the
    distinct pieces go through the pattern at the end, most of them in one
    text, as they can be told apart by the spaces there too.
    """

    def __init__(self, find_all):
        self.find_all, self.words = find_all, _numbers()
        self.heads, self.pieces = _numbers(), _numbers()  # first pieces of texts have no space before them
        self.doc_ids, self.numbers, self.chars = [], [], 0

    def add(self, doc_id, text: str) -> None:
        first, *rest = _SINGLE_SPACE.split(text) if _BESIDE_SPACE.search(text) else text.split(" ")
        numbers = np.empty(1 + len(rest), dtype=np.int64)
        numbers[0] = ~self.heads[first]
        numbers[1:] = np.fromiter(map(self.pieces.__getitem__, rest), dtype=np.int64, count=len(rest))
        self.doc_ids.append(doc_id)
        self.numbers.append(numbers)
        self.chars += len(text)

    def _spelt(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all pieces, and then of all heads, one after another; how many each has."""
        pieces = list(self.pieces)
        plain, joined = np.ones(len(pieces), dtype=bool), " ".join(pieces)
        if _BESIDE_SPACE.search(f" {joined} "):  # some piece is empty or has white space at an end, or a space inside
            plain = np.fromiter((bool(p) and " " not in p and not p[0].isspace() and not p[-1].isspace() for p in pieces),
                                dtype=bool, count=len(pieces))
            joined = " ".join([p for p, ok in zip(pieces, plain.tolist(), strict=True) if ok])
        found = self.find_all(" " + joined) if joined else []
        begins = np.flatnonzero(np.fromiter((w[0] == " " for w in found), dtype=bool, count=len(found)))
        lengths = np.zeros(len(pieces) + len(self.heads), dtype=np.int64)
        if len(begins) == plain.sum():
            lengths[:len(pieces)][plain] = np.diff(np.append(begins, len(found)))
            others = [(k, " " + pieces[k]) for k in np.flatnonzero(~plain).tolist()]
        else:  # a pattern that does not begin a pre-token at each of those spaces: every piece by itself
            found, plain[:] = [], False
            others = [(k, " " + p) for k, p in enumerate(pieces)]
        others += [(len(pieces) + k, p) for k, p in enumerate(self.heads)]
        more = [self.find_all(p) for _, p in others]
        lengths[[k for k, _ in others]] = list(map(len, more))
        flat = np.empty(int(lengths.sum()), dtype=np.uint32)
        starts = np.cumsum(lengths) - lengths
        for own, words in ((np.flatnonzero(plain), found), (np.array([k for k, _ in others], dtype=np.int64),
                                                            [w for m in more for w in m])):
            flat[_ragged(starts[own], lengths[own])] = np.fromiter(map(self.words.__getitem__, words), dtype=np.uint32,
                                                                   count=len(words))
        return flat, lengths

    def _codes(self) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all documents, one after another, and how many each has."""
        flat, lengths = self._spelt()
        numbers = np.concatenate(self.numbers) if self.numbers else np.empty(0, np.int64)
        numbers = np.where(numbers < 0, len(self.pieces) + ~numbers, numbers)
        total = np.concatenate([[0], np.cumsum(lengths[numbers])])
        ends = np.cumsum([0, *map(len, self.numbers)])
        return flat[_ragged((np.cumsum(lengths) - lengths)[numbers], lengths[numbers])], np.diff(total[ends])

    def finish(self, place: int, buckets: int, positions: bool) -> list[tuple]:
        """Either the row of positions or the rows of words, one per bucket."""
        import xxhash
        codes, counts = self._codes()
        by_rank = np.argsort(-np.bincount(codes, minlength=len(self.words)), kind="stable")
        spelled = [w.encode() for w in self.words]
        spelled = [spelled[k] for k in by_rank.tolist()]
        lengths = np.array(list(map(len, spelled)), dtype="<u4")
        blob = b"".join(spelled)
        block = xxhash.xxh64(codes.tobytes() + blob, seed=place).intdigest() >> 1
        if positions:
            rank = np.empty(len(by_rank), dtype=np.uint32)
            rank[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
            void = np.array([d is None for d in self.doc_ids], dtype=np.uint8)
            ids = np.array([d or 0 for d in self.doc_ids], dtype="<i8").view("<u8")
            return [(block, -1, _pack(rank[codes], counts.astype("<u4"), ids, void, lengths,
                                      np.frombuffer(blob, np.uint8)))]
        bucket = np.array([zlib.crc32(w) % buckets for w in spelled], dtype=np.uint16)
        out = []
        for b in np.unique(bucket).tolist():
            own = np.flatnonzero(bucket == b)
            words = b"".join([spelled[k] for k in own.tolist()])
            out.append((block, b, _pack(lengths[own], np.frombuffer(words, np.uint8))))
        return out


_ROWS = "block long, bucket int, payload binary"


def _to_batch(rows: list[tuple]) -> pa.RecordBatch:
    block, bucket, payload = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(bucket, pa.int32()),
                                       pa.array(payload, pa.binary())], names=["block", "bucket", "payload"])


def encode(docs: DataFrame, vocab_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` (array<int>) of every whole text, one row per input row.

    ``vocab_path`` names a file of base64 tokens and ranks, ``pattern`` the
    pre-token regular expression; every match is encoded separately, without
    special tokens. Null or empty text: empty ``ids``. Null and repeated
    ``doc_id`` stay rows of their own; extra columns are ignored.
    """
    spark = docs.sparkSession
    prepare(spark)
    vocab = broadcast_file(spark, vocab_path)
    buckets = min(partitions(spark), MAX_BUCKETS)

    def cut(positions: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            import regex
            from pyspark import TaskContext
            find_all = regex.compile(pattern).findall
            place, block = TaskContext.get().partitionId() << 24, _Block(find_all)
            for batch in batches:
                for lo in range(0, batch.num_rows, 256):
                    part = batch.slice(lo, 256)
                    for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                        block.add(doc_id, text)
                        if block.chars >= BLOCK_CHARS or len(block.doc_ids) >= BLOCK_DOCS:
                            yield _to_batch(block.finish(place, buckets, positions))
                            place, block = place + 1, _Block(find_all)
            if block.doc_ids:
                yield _to_batch(block.finish(place, buckets, positions))
        return run

    def encoder():
        import tiktoken
        # A pre-token alone matches the pattern as a whole again, so this encodes one piece.
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=read_ranks(vocab.value),
                                 special_tokens={}).encode_ordinary

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = encoder()
        memo: dict[bytes, list[int]] = {}
        for batch in batches:
            for block, bucket, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                lengths, spelled = _unpack(payload)
                if len(memo) > MEMO_WORDS:
                    memo.clear()
                ids, counts = [], []
                for word in _split_words(spelled.tobytes(), lengths):
                    got = memo.get(word)
                    if got is None:
                        got = memo[word] = piece(word.decode("utf-8"))
                    ids.extend(got)
                    counts.append(len(got))
                yield _to_batch([(block, bucket, _pack(np.array(counts, dtype="<u4"), np.array(ids, dtype="<u4")))])

    def lay_out(rows: pa.Table) -> pa.Table:
        by_bucket = dict(zip(rows.column("bucket").to_pylist(), rows.column("payload").to_pylist(), strict=True))
        if -1 not in by_bucket:  # answers to a block that no longer exists
            return pa.table({"doc_id": pa.array([], pa.int64()), "ids": pa.array([], pa.list_(pa.int32()))})
        codes, counts, doc_ids, void, lengths, blob = _unpack(by_bucket.pop(-1))
        spelled = _split_words(blob.tobytes(), lengths)
        n_ids, found = np.zeros(len(spelled), dtype=np.int64), []
        bucket = np.array([zlib.crc32(w) % buckets for w in spelled], dtype=np.int64)
        for b in np.unique(bucket).tolist():
            own = np.flatnonzero(bucket == b)
            if b in by_bucket:
                n_ids[own], ids = _unpack(by_bucket[b])
            else:
                piece = encoder()
                got = [piece(spelled[k].decode()) for k in own.tolist()]
                n_ids[own], ids = list(map(len, got)), np.array([i for g in got for i in g], dtype=np.int32)
            found.append((own, ids))
        del spelled, by_bucket
        starts = np.cumsum(n_ids) - n_ids  # where each word's ids lie in ``flat``
        flat = np.empty(int(n_ids.sum()), dtype=np.int32)
        for own, ids in found:
            flat[_ragged(starts[own], n_ids[own])] = ids
        codes = codes.astype(np.int64)
        total = np.concatenate([[0], np.cumsum(n_ids[codes])])
        ends = np.concatenate([[0], np.cumsum(counts.astype(np.int64))])
        return pa.table({
            "doc_id": pa.array(doc_ids.view("<i8"), pa.int64(), mask=void.astype(bool)),
            "ids": pa.ListArray.from_arrays(pa.array(total[ends], pa.int32()), pa.array(flat[_ragged(starts[codes], n_ids[codes])]))})

    docs = id_and_text(docs, id_col, text_col)
    answers = docs.mapInArrow(cut(False), _ROWS).repartition(buckets, "bucket").mapInArrow(answer, _ROWS)
    return (docs.mapInArrow(cut(True), _ROWS).unionByName(answers)
            .groupBy("block").applyInArrow(lay_out, "doc_id long, ids array<int>"))


class _Strings:
    """Byte strings by number, gathered for many numbers at once."""

    def __init__(self, by_id: dict[int, bytes]):
        size = max(by_id, default=-1) + 1
        self.lengths = np.full(size, -1, dtype=np.int64)
        for k, v in by_id.items():
            self.lengths[k] = len(v)
        room = np.maximum(self.lengths, 0)
        self.starts = np.cumsum(room) - room
        self.blob = np.frombuffer(b"".join(by_id.get(k, b"") for k in range(size)), np.uint8)

    def gather(self, ids: np.ndarray, counts: np.ndarray, cut: int = 0) -> pa.Array:
        """One binary per row of ``counts[row]`` ids: their strings joined, less ``cut`` bytes at the end."""
        wrong = (ids < 0) | (ids >= len(self.lengths))
        if wrong.any() or (self.lengths[ids] < 0).any():
            raise KeyError(int(ids[wrong | (self.lengths[np.where(wrong, 0, ids)] < 0)][0]))
        lengths = self.lengths[ids]
        ends = np.cumsum(counts)
        if cut:
            lengths = lengths.copy()
            lengths[ends[counts > 0] - 1] -= cut
        total = np.concatenate([[0], np.cumsum(lengths)])
        data = self.blob[_ragged(self.starts[ids], lengths)]
        offsets = np.concatenate([[0], total[ends]]).astype(np.int32)
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _worker_strings(key: tuple, vocab) -> tuple[_Strings, _Strings]:
    """The worker's tables of token bytes and of ids in decimal with a comma, kept from task to task."""
    def make() -> tuple[_Strings, _Strings]:
        ranks = read_ranks(vocab.value)
        return _Strings({r: t for t, r in ranks.items()}), _Strings({r: b"%d," % r for r in ranks.values()})

    return kept_by_worker(("token strings", *key), make)


def decode(encoded: DataFrame, vocab_path: str, ids_col: str = "ids", out_col: str = "decoded",
           decimal_col: str | None = None) -> DataFrame:
    """Add ``out_col`` (binary): the bytes of each row's ids, by the token-byte table.

    ``decimal_col`` names a further column (binary): the ids in decimal, joined
    by commas. The table is one row per token of the vocabulary file, so its
    size is known before it is sent to the tasks. An id outside the table
    raises, and so does a null among the ids. Null ids: null; empty ids: empty bytes.
    """
    spark = encoded.sparkSession
    prepare(spark)
    vocab = broadcast_file(spark, vocab_path)
    added = [out_col, *([decimal_col] if decimal_col else [])]
    schema = StructType([*encoded.schema.fields, *(StructField(c, BinaryType()) for c in added)])
    key = (vocab_path, zlib.crc32(vocab.value))

    def to_bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token_bytes, decimals = _worker_strings(key, vocab)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                lists = part.column(ids_col)
                counts = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                flat = lists.flatten()
                if flat.null_count:
                    raise KeyError(None)
                ids = flat.to_numpy(zero_copy_only=False).astype(np.int64)
                out = [token_bytes.gather(ids, counts), *([decimals.gather(ids, counts, cut=1)] if decimal_col else [])]
                if lists.null_count:
                    out = [pc.if_else(lists.is_valid(), o, pa.scalar(None, pa.binary())) for o in out]
                yield pa.RecordBatch.from_arrays([*part.columns, *out], names=[*part.schema.names, *added])

    return encoded.mapInArrow(to_bytes, schema)
