"""A draw history kept in order while batches arrive: numbers and window features.

Layout of a history folder (log and commits as in :mod:`drawlake.sources.snapshots`)::

    data/<id>/_segment=<i>/part-*.parquet   draws, sorted, never changed
    features/<id>/_piece=<j>/part-*.parquet windows of one data file, by place in it
    manifests/<id>/                         one row per data file: rows, least and greatest key, its windows
    _log/<number>.json                      one entry per snapshot

The data files cover ranges of the order key that do not meet, and no row stores
its number: a draw's number is the rows of all files before its own plus its
place in the file. A late draw therefore renumbers everything after it by a new
sum over the manifest; only the file it falls into is written again. Windows are
stored by place too, and depend on the ``reach`` draws before alone, so a batch
computes those of the files it wrote and of the files right after them, with the
last ``reach`` draws before each as the only further rows read.

What passes through the driver is one row per data file.
"""

from __future__ import annotations

import json
import uuid
from bisect import bisect_right
from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.operators.features import LAGS, WINDOW, start_index
from drawlake.operators.windows import CHUNK, domain_rows, window_arrays
from drawlake.schemas import DEFAULT_POOLS, Pool
from drawlake.session import ship_package, write_and_reread
from drawlake.sources.snapshots import (
    FILE_ROWS, CommitConflict, Snapshot, _entry, _join, _latest, _manifest, _publish,
)
from drawlake.sources.snapshots import _commit as commit_entry

_SEGMENT, _PIECE, _TIE, _FILE, _AT = "_segment", "_piece", "_tie", "_file", "_at"
_ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DecimalType, T.DateType, T.StringType, T.BooleanType)
_WINDOWS = "_at long, lagged array<double>, frequency array<int>, recency array<int>"


def rank(values: Iterable) -> tuple:
    """A key that sorts as Spark sorts: null first."""
    return tuple((v is not None, v) for v in values)


def _key(order_cols: Sequence[str], columns: Sequence[str]):
    """The order key: the order columns, then a hash of the whole row."""
    return F.struct(*order_cols, F.xxhash64(*columns).alias(_TIE))


def _settings(pools: Sequence[Pool], window: int, lags: int) -> dict:
    return {"pools": [[p.name, list(p.columns), p.lo, p.hi] for p in pools], "window": window, "lags": lags}


def _check(schema: T.StructType, order_cols: Sequence[str], pools: Sequence[Pool]) -> None:
    for c in order_cols:
        if not isinstance(schema[c].dataType, _ORDERED):
            raise ValueError(f"{c}: order by whole numbers, decimals, dates, booleans or text")
    taken = {_SEGMENT, _PIECE, _TIE, _FILE, _AT, "seq"} & set(schema.names)
    if taken:
        raise ValueError(f"column names in use: {sorted(taken)}")
    missing = {c for p in pools for c in p.columns} - set(schema.names)
    if missing:
        raise ValueError(f"missing number columns: {sorted(missing)}")


def _segments(spark: SparkSession, path: str, entry: Snapshot | None) -> list[dict]:
    """The data files in order, each with the number of rows before it."""
    if entry is None:
        return []
    return _in_order([r.asDict() for r in _manifest(spark, path, entry).collect()])


def _in_order(segments: list[dict]) -> list[dict]:
    out, before = [], 0
    for s in sorted(segments, key=lambda s: rank(s["lo"])):
        out.append({**s, "before": before})
        before += s["rows"]
    return out


def _placed(batch: DataFrame, segments: list[dict], order_cols: Sequence[str], file_rows: int) -> DataFrame:
    """The batch with the place of the data file that each row falls into.

    A row beyond the last file begins a new one, unless the last is less than
    half full. Each row is looked up among the files' least keys, which travel
    with the task: one per data file.
    """
    if not segments:
        return batch.withColumn(_SEGMENT, F.lit(0))
    key_cols = [*order_cols, _TIE]
    lows = [rank(s["lo"]) for s in segments]
    end = rank(segments[-1]["hi"])
    beyond = len(segments) - (1 if segments[-1]["rows"] < file_rows / 2 else 0)
    names = [*batch.columns, _TIE, _SEGMENT]

    def place(parts):
        for part in parts:
            at = []
            for key in map(rank, zip(*[part.column(c).to_pylist() for c in key_cols])):
                at.append(beyond if key > end else max(bisect_right(lows, key) - 1, 0))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(at, pa.int32())], names=names)

    tied = batch.withColumn(_TIE, F.xxhash64(*batch.columns))
    schema = T.StructType([*[T.StructField(f.name, f.dataType) for f in tied.schema.fields], T.StructField(_SEGMENT, T.IntegerType())])
    # Written: its rows are counted, sampled for range bounds and sorted.
    return write_and_reread(tied.mapInArrow(place, schema).drop(_TIE), "placed")


def _file_name(parts: int):
    """The last parts of the path of the file that a row was read from."""
    return F.substring_index(F.col("_metadata.file_path"), "/", -parts)


def _rows_of(spark: SparkSession, path: str, schema: T.StructType, wanted: list[tuple], names: str) -> DataFrame:
    """Rows of some data files with their place (``_at``) and the values that ``wanted`` has for each file name."""
    values = spark.createDataFrame(wanted, f"{_FILE} string, {names}")
    if not wanted:
        return spark.createDataFrame([], schema).withColumn(_AT, F.lit(0).cast("long")).crossJoin(values.drop(_FILE))
    read = spark.read.schema(schema).parquet(*[_join(path, w[0]) for w in wanted])
    return (read.select("*", _file_name(4).alias(_FILE), F.col("_metadata.row_index").alias(_AT))
                .join(values, _FILE).drop(_FILE))


def _write_draws(rows: DataFrame, path: str, order_cols: Sequence[str], parts: int) -> list[dict]:
    """Write rows that name their segment as sorted files of one segment each; returns their manifest rows."""
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    columns = [c for c in rows.columns if c != _SEGMENT]
    order = [_SEGMENT, *order_cols, F.xxhash64(*columns)]
    (rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
         .write.partitionBy(_SEGMENT).parquet(_join(path, "data", folder)))
    schema = T.StructType([f for f in rows.schema.fields if f.name != _SEGMENT])
    written = spark.read.schema(schema).parquet(_join(path, "data", folder))
    # Files are sorted, so the least and the greatest key stand at their ends.
    placed = written.select("*", _file_name(4).alias("file"), F.col("_metadata.row_index").alias(_AT))
    sizes = placed.groupBy("file").agg(F.count("*").alias("rows"))
    ends = placed.join(F.broadcast(sizes), "file").where((F.col(_AT) == 0) | (F.col(_AT) == F.col("rows") - 1))  # sizes: one row per file
    files = (ends.select("file", "rows", _key(order_cols, columns).alias("key"))
             .groupBy("file", "rows").agg(F.min("key").alias("lo"), F.max("key").alias("hi")))
    return [r.asDict() for r in files.collect()]


def _stale(segments: list[dict], new: set[str], reach: int) -> list[bool]:
    """Which files need new windows: the new ones and those that begin within ``reach`` draws after one."""
    out, since = [], reach
    for s in segments:
        since = 0 if s["file"] in new else since
        out.append(since < reach or s["file"] in new)
        since += 0 if s["file"] in new else s["rows"]
    return out


def _write_windows(spark: SparkSession, path: str, schema: T.StructType, segments: list[dict], new: set[str],
                   pools: Sequence[Pool], window: int, lags: int, chunk: int) -> list[dict]:
    """Compute the windows of stale files; returns the segments with their folders."""
    reach, folder = max(window, lags, 1), uuid.uuid4().hex
    stale = _stale(segments, new, reach)
    if not any(stale):
        return segments
    wanted, ahead = [], 0  # from the back: how many draws the next stale file still needs before it
    for i in reversed(range(len(segments))):
        s = segments[i]
        if stale[i]:
            wanted.append((s["file"], s["before"], i, 0))
            ahead = reach
        elif ahead:
            wanted.append((s["file"], s["before"], -1, max(s["rows"] - ahead, 0)))
            ahead = max(ahead - s["rows"], 0)
    rows = _rows_of(spark, path, schema, wanted, f"before long, {_PIECE} int, first long").where(F.col(_AT) >= F.col("first"))
    numbered = rows.withColumn("seq", F.col("before") + F.col(_AT) + 1)
    arrays = window_arrays(numbered, window, pools, "seq", lags=lags, keep=[_PIECE, _AT], chunk=chunk)
    (arrays.where(F.col(_PIECE) >= 0).select(_PIECE, _AT, "lagged", "frequency", "recency")
           .write.partitionBy(_PIECE).parquet(_join(path, "features", folder)))
    return [{**s, "features": f"features/{folder}/{_PIECE}={i}"} if stale[i] else s for i, s in enumerate(segments)]


def append_draws(path: str, batch: DataFrame, order_cols: Sequence[str], pools: Sequence[Pool] = DEFAULT_POOLS,
                 window: int = WINDOW, lags: int = LAGS, writer: tuple[str, int] | None = None, attempts: int = 5,
                 file_rows: int = FILE_ROWS, chunk: int = CHUNK, before_commit: Callable[[], None] | None = None) -> int:
    """Add draws, late ones included, and commit the history as its next snapshot; returns its number.

    Every split of the draws into batches gives the same numbers and windows as
    one batch of all. Rows with equal order columns are ordered by a hash of
    the row; null order values come first; equal rows stay, and keep together
    in one file. The first batch fixes columns, order, pools, window and lags; another
    choice later raises ``ValueError``. ``writer``, ``attempts`` and
    ``before_commit`` are those of :func:`drawlake.sources.snapshots.merge_into`.
    """
    spark = batch.sparkSession
    _check(batch.schema, order_cols, pools)
    ship_package(spark)
    pinned = write_and_reread(batch, "draws")
    name, number_of_batch = writer or (None, None)
    settings = _settings(pools, window, lags)
    for _ in range(attempts):
        entry = _latest(spark, path)
        done = entry.writers.get(name) if entry and writer else None
        if done and number_of_batch <= done[0]:
            return done[1]
        schema = T.StructType.fromJson(json.loads(entry.schema)) if entry else pinned.schema
        if entry and (entry.keys != list(order_cols) or entry.settings != settings):
            raise ValueError(f"the history has order {entry.keys} and {entry.settings}")
        if {f.name: f.dataType for f in schema.fields} != {f.name: f.dataType for f in pinned.schema.fields}:
            raise ValueError(f"the history has columns {schema.simpleString()}")
        segments = _segments(spark, path, entry)
        placed = _placed(pinned.select(*schema.names), segments, order_cols, file_rows)
        arrived = {r[0]: r[1] for r in placed.groupBy(_SEGMENT).count().collect()}
        touched = [(s["file"], i) for i, s in enumerate(segments) if i in arrived]
        new = []
        if arrived:
            rows = sum(arrived.values()) + sum(segments[i]["rows"] for _, i in touched)
            old = _rows_of(spark, path, schema, touched, f"{_SEGMENT} int").select(*schema.names, _SEGMENT)
            new = _write_draws(old.unionByName(placed) if touched else placed, path, order_cols, max(1, -(-rows // file_rows)))
        kept = [s for i, s in enumerate(segments) if i not in arrived]
        whole = _in_order([*kept, *[{**s, "features": None} for s in new]])
        whole = _write_windows(spark, path, schema, whole, {s["file"] for s in new}, pools, window, lags, chunk)
        key_type = T.StructType([*[schema[c] for c in order_cols], T.StructField(_TIE, T.LongType())])
        shape = (T.StructType().add("file", "string").add("rows", "long").add("lo", key_type).add("hi", key_type)
                 .add("features", "string"))
        manifest, files = _publish(spark, path, spark.createDataFrame([tuple(s[f] for f in shape.names) for s in whole], shape))
        number, writers = (entry.number + 1 if entry else 1), dict(entry.writers) if entry else {}
        if writer:
            writers[name] = [number_of_batch, number]
        if before_commit:
            before_commit()
        if commit_entry(spark, path, Snapshot(number, manifest, schema.json(), list(order_cols), writers, len(touched), files, settings)):
            return number
    raise CommitConflict(f"{path}: other writers committed first {attempts} times")


def _opened(spark: SparkSession, path: str, number: int | None) -> tuple[Snapshot, T.StructType, list[dict]]:
    entry = _latest(spark, path) if number is None else _entry(spark, path, number)
    if entry is None:
        raise FileNotFoundError(f"{path} has no snapshot")
    return entry, T.StructType.fromJson(json.loads(entry.schema)), _segments(spark, path, entry)


def read_history(spark: SparkSession, path: str, number: int | None = None, first: int = 1, last: int | None = None) -> DataFrame:
    """The draws of a snapshot (default: the newest) with ``seq`` 1..N, as ``global_sequence`` numbers them.

    Of the numbers ``first`` to ``last`` only the files that hold them are read.
    """
    _, schema, segments = _opened(spark, path, number)
    wanted = [(s["file"], s["before"]) for s in segments
              if s["before"] + s["rows"] >= first and (last is None or s["before"] < last)]
    rows = _rows_of(spark, path, schema, wanted, "_before long").withColumn("seq", F.col("_before") + F.col(_AT) + 1)
    known = F.col("seq") >= first
    return rows.where(known if last is None else known & (F.col("seq") <= last)).select("seq", *schema.names)


def read_windows(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Stored windows of all draws: ``seq, lagged, frequency, recency``, as ``window_arrays`` computes them."""
    _, _, segments = _opened(spark, path, number)
    values = spark.createDataFrame([(s["features"], s["before"]) for s in segments], "_folder string, _before long")
    if not segments:
        return spark.createDataFrame([], _WINDOWS.replace("_at", "seq"))
    read = spark.read.schema(_WINDOWS).parquet(*[_join(path, s["features"]) for s in segments])
    folder = F.substring_index(_file_name(4), "/", 3)
    return (read.select("*", folder.alias("_folder")).join(values, "_folder")
                .select((F.col("_before") + F.col(_AT) + 1).alias("seq"), "lagged", "frequency", "recency"))


def stored_window_stats(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """Frequency and recency of every number before each draw with full history, from the stored windows.

    The rows of :func:`drawlake.operators.features.window_stats` in ``holdout`` mode.
    """
    entry, _, _ = _opened(spark, path, number)
    pools = [Pool(name, tuple(columns), lo, hi) for name, columns, lo, hi in entry.settings["pools"]]
    first = start_index(entry.settings["lags"], entry.settings["window"])
    return (domain_rows(read_windows(spark, path, number).where(F.col("seq") >= first), ["seq"], pools, ["frequency", "recency"])
            .withColumn("frequency", F.col("frequency").cast("long")))
