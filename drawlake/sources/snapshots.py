"""A table of files with snapshots: merges rewrite only the files that hold a merged key.

Layout of a table folder::

    data/<id>/part-*.parquet     files, clustered by the table's keys, never changed
    manifests/<id>/              one row per file of a snapshot: name, rows, least and greatest key
    _log/<number>.json           one entry per snapshot: its manifest, schema, keys, last batch of every writer

A merge picks files in two steps: those whose key range meets the range of some
part of the source (from the manifest alone), and of these the ones that hold a
source key (a scan of their key columns). Only those are read whole, merged and
written again; the new manifest names the other files unchanged. A snapshot
exists once its log entry does, and the entry is put in place by a rename that
fails if another writer took the number: that writer's snapshot stands, and the
merge starts again on top of it. (A rename is such a test on HDFS and local
disks; an object store needs a committer with conditional puts.)
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.operators.merge import dedupe_latest, upsert
from drawlake.session import partitions, path_exists, write_and_reread

_LOG = "_log"
#: Rows of a data file, and the most parts of a source whose key ranges go into a filter.
FILE_ROWS, MOST_RANGES = 1_000_000, 1_000


class CommitConflict(RuntimeError):
    """Other writers took the next snapshot number at every attempt; nothing was committed."""


@dataclass(frozen=True)
class Snapshot:
    """One log entry."""

    number: int
    manifest: str
    schema: str
    keys: list[str]
    writers: dict[str, list[int]] = field(default_factory=dict)  # name -> [last batch, its snapshot]
    rewritten: int = 0
    files: int = 0
    settings: dict = field(default_factory=dict)  # fixed choices of a table that keeps more than rows


def _join(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts)


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _numbers(spark: SparkSession, table_path: str) -> list[int]:
    """Committed snapshot numbers, ascending. Any error but an absent folder is raised: an
    unreadable log must not look like an empty table."""
    log = _join(table_path, _LOG)
    if not path_exists(spark, log):
        return []
    fs, p = _fs(spark, log)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _entry(spark: SparkSession, table_path: str, number: int) -> Snapshot:
    line = spark.read.text(_join(table_path, _LOG, f"{number:020d}.json")).first()[0]
    return Snapshot(**json.loads(line))


def _latest(spark: SparkSession, table_path: str) -> Snapshot | None:
    numbers = _numbers(spark, table_path)
    return _entry(spark, table_path, numbers[-1]) if numbers else None


def _commit(spark: SparkSession, table_path: str, entry: Snapshot) -> bool:
    """Put the log entry in place; False if its number is taken."""
    jvm = spark._jvm
    fs, final = _fs(spark, _join(table_path, _LOG, f"{entry.number:020d}.json"))
    draft = jvm.org.apache.hadoop.fs.Path(_join(table_path, _LOG, f".{uuid.uuid4().hex}"))
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(entry.__dict__).encode()))
    out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(final), no_options)
    except Py4JJavaError as e:
        fs.delete(draft, False)
        if "FileAlreadyExists" not in e.java_exception.getClass().getName():
            raise
        return False
    return True


def _key(keys: Sequence[str]) -> Column:
    """The key as a struct; null if a part of it is null (such rows never match)."""
    known = F.lit(True)
    for k in keys:
        known = known & F.col(k).isNotNull()
    return F.when(known, F.struct(*[F.col(k) for k in keys]))


def _manifest(spark: SparkSession, table_path: str, entry: Snapshot) -> DataFrame:
    return spark.read.parquet(_join(table_path, "manifests", entry.manifest))


def _write_files(df: DataFrame, table_path: str, keys: Sequence[str], rows: int, file_rows: int) -> DataFrame:
    """Write rows as files clustered by key; returns their manifest rows.

    A hash of all columns continues the key, so a key that very many rows share is split too.
    """
    spark, folder = df.sparkSession, uuid.uuid4().hex
    rest = F.xxhash64(*df.columns)
    (df.repartitionByRange(max(1, -(-rows // file_rows)), *keys, rest).sortWithinPartitions(*keys, rest)
       .write.parquet(_join(table_path, "data", folder)))
    written = spark.read.schema(df.schema).parquet(_join(table_path, "data", folder))
    return (written.select(F.concat(F.lit(f"data/{folder}/"), F.col("_metadata.file_name")).alias("file"), _key(keys).alias("key"))
            .groupBy("file").agg(F.count("*").alias("rows"), F.min("key").alias("lo"), F.max("key").alias("hi")))


def _publish(spark: SparkSession, table_path: str, manifest: DataFrame) -> tuple[str, int]:
    name = uuid.uuid4().hex
    path = _join(table_path, "manifests", name)
    manifest.coalesce(1).write.parquet(path)  # one row per data file
    return name, spark.read.parquet(path).count()


def _read_files(spark: SparkSession, table_path: str, schema: T.StructType, files: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*[_join(table_path, f) for f in files]) if files else spark.createDataFrame([], schema)


def latest_snapshot_id(spark: SparkSession, table_path: str) -> int | None:
    """Newest committed snapshot number, or None."""
    numbers = _numbers(spark, table_path)
    return numbers[-1] if numbers else None


def snapshot_files(spark: SparkSession, table_path: str, number: int | None = None) -> list[str]:
    """Names of a snapshot's data files (default: the newest snapshot)."""
    entry = _latest(spark, table_path) if number is None else _entry(spark, table_path, number)
    return [] if entry is None else [r[0] for r in _manifest(spark, table_path, entry).select("file").collect()]


def read_latest(spark: SparkSession, table_path: str, schema: T.StructType | None = None) -> DataFrame | None:
    """The newest committed snapshot (an empty frame, or None without a schema, when nothing is committed)."""
    entry = _latest(spark, table_path)
    if entry is None:
        return None if schema is None else spark.createDataFrame([], schema)
    return read_snapshot(spark, table_path, entry.number)


def read_snapshot(spark: SparkSession, table_path: str, number: int) -> DataFrame:
    """The rows of a snapshot that has not expired."""
    entry = _entry(spark, table_path, number)
    return _read_files(spark, table_path, T.StructType.fromJson(json.loads(entry.schema)), snapshot_files(spark, table_path, number))


def create_table(table_path: str, rows: DataFrame, keys: Sequence[str], file_rows: int = FILE_ROWS) -> int:
    """Write all rows, as they are, as the first snapshot; raises if the table exists."""
    spark = rows.sparkSession
    if _numbers(spark, table_path):
        raise CommitConflict(f"{table_path} has snapshots already")
    manifest, files = _publish(spark, table_path, _write_files(rows, table_path, keys, rows.count(), file_rows))
    entry = Snapshot(1, manifest, rows.schema.json(), list(keys), {}, 0, files)
    if not _commit(spark, table_path, entry):
        raise CommitConflict(f"{table_path} has snapshots already")
    return 1


def _ranges(source: DataFrame, keys: Sequence[str]) -> list[tuple]:
    """Least and greatest key of every part of a source that was written by key ranges."""
    return [(r["lo"], r["hi"]) for r in source.select(_key(keys).alias("k"), F.col("_metadata.file_name").alias("f"))
            .where("k is not null").groupBy("f").agg(F.min("k").alias("lo"), F.max("k").alias("hi")).collect()]


def _touched(spark: SparkSession, table_path: str, entry: Snapshot, schema: T.StructType, source: DataFrame,
             keys: Sequence[str]) -> list[str]:
    """The data files that hold a key of the source."""
    literal = lambda row: F.struct(*[F.lit(row[k]).cast(schema[k].dataType).alias(k) for k in keys])
    ranges = [F.struct(literal(lo).alias("lo"), literal(hi).alias("hi")) for lo, hi in _ranges(source, keys)]
    if not ranges:
        return []
    near = _manifest(spark, table_path, entry).where(
        F.exists(F.array(*ranges), lambda r: (F.col("lo") <= r["hi"]) & (F.col("hi") >= r["lo"]))).select("file")
    folder = {r[0].rsplit("/", 1)[1]: r[0] for r in near.collect()}
    found = (_read_files(spark, table_path, schema, list(folder.values()))
             .select(*keys, F.col("_metadata.file_name").alias("__file")) if folder else None)
    if found is None:
        return []
    # A semi-join by hash: a file is as wide as its keys here, and only its name is kept.
    names = found.join(source.select(*keys).distinct(), list(keys), "left_semi").select("__file").distinct().collect()
    return [folder[r[0]] for r in names]


def merge_into(table_path: str, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None,
               order_col: str | None = None, writer: tuple[str, int] | None = None, attempts: int = 5,
               file_rows: int = FILE_ROWS, before_commit: Callable[[], None] | None = None) -> int:
    """Upsert ``source`` into the newest snapshot and commit the result as the next one; returns its number.

    ``writer`` names a stream and its batch (numbers that only grow): a batch
    that is in the log is not merged again. The first merge creates the table,
    with the last of several source rows per key, as every later merge has it.
    The source is read once. When another writer commits first, the merge is
    done again on top of that, up to ``attempts`` times; then
    :class:`CommitConflict` is raised. Files of a merge that never reached the
    log are not part of any snapshot. ``before_commit`` runs ahead of every
    attempt to commit.
    """
    spark = source.sparkSession
    wanted = [*dict.fromkeys([*source.columns])]
    parts = min(partitions(spark), MOST_RANGES)
    source = write_and_reread(source.select(*wanted).repartitionByRange(parts, *keys, F.xxhash64(*wanted)), "source")
    n_source = source.count()
    name, batch = writer or (None, None)
    for _ in range(attempts):
        entry = _latest(spark, table_path)
        done = entry.writers.get(name) if entry and writer else None
        if done and batch <= done[0]:
            return done[1]
        if entry is None:
            known = _key(keys).isNotNull()
            merged = dedupe_latest(source.where(known), keys, order_col).select(*wanted).unionByName(source.where(~known))
            schema, kept, touched, rows, number = merged.schema, None, [], n_source, 1
        else:
            schema, number = T.StructType.fromJson(json.loads(entry.schema)), entry.number + 1
            touched = _touched(spark, table_path, entry, schema, source, keys)
            manifest = _manifest(spark, table_path, entry)
            kept = manifest.where(~F.col("file").isin(touched)) if touched else manifest
            rows = n_source + (manifest.where(F.col("file").isin(touched)).agg(F.sum("rows")).first()[0] if touched else 0)
            merged = upsert(_read_files(spark, table_path, schema, touched), source, keys, update_cols, order_col)
        new = _write_files(merged, table_path, keys, rows, file_rows)
        manifest, files = _publish(spark, table_path, new if kept is None else kept.unionByName(new))
        writers = dict(entry.writers) if entry else {}
        if writer:
            writers[name] = [batch, number]
        if before_commit:
            before_commit()
        if _commit(spark, table_path, Snapshot(number, manifest, schema.json(), list(keys), writers, len(touched), files)):
            return number
    raise CommitConflict(f"{table_path}: other writers committed first {attempts} times")


def _named(spark: SparkSession, manifests: list[str]) -> DataFrame:
    """Paths that manifests name: data files, and what a table keeps beside each."""
    rows = spark.read.parquet(*manifests)
    paths = [c for c in ("file", "features", "prints") if c in rows.columns]
    return rows.select(F.explode(F.array_compact(F.array(*paths))).alias("file"))


def expire_snapshots(spark: SparkSession, table_path: str, keep: int = 2) -> int:
    """Forget all but the newest ``keep`` snapshots and delete the files that only the others name; returns how many.

    Log entries go first, so a reader never finds an entry without its files.
    """
    numbers = _numbers(spark, table_path)
    old, live = numbers[:-keep] if keep > 0 else [], numbers[-keep:]
    if keep < 1:
        raise ValueError("keep at least the newest snapshot")
    if not old:
        return 0
    entries = [_entry(spark, table_path, n) for n in old]
    live_manifests = [_join(table_path, "manifests", _entry(spark, table_path, n).manifest) for n in live]
    gone = (_named(spark, [_join(table_path, "manifests", e.manifest) for e in entries]).distinct()
            .join(_named(spark, live_manifests), "file", "left_anti"))
    files = [r[0] for r in gone.collect()]
    for path in [*[_join(_LOG, f"{n:020d}.json") for n in old], *files, *[_join("manifests", e.manifest) for e in entries]]:
        fs, p = _fs(spark, _join(table_path, path))
        fs.delete(p, True)
    return len(files)
