"""A growing table that knows whether its keys are unique without reading itself again.

Layout of a table folder (log and commits as in :mod:`drawlake.sources.snapshots`)::

    data/<id>/part-*.parquet     the rows of a batch
    prints/<id>/part-*.parquet   different 64-bit hashes of the keys of each data file
    repeated/<id>/part-*.parquet keys that a snapshot holds more than once
    manifests/<id>/              one row per data file: rows, its prints

A batch is reduced to its keys with their counts. Keys that are known to repeat
need no further look; the hashes of the others are compared with the prints
(eight bytes a key, no rows). Where hashes meet, the key columns of just those
files are read and the keys compared themselves, so equal hashes of different
keys do no harm. A key that repeats is in ``repeated`` from then on: however
often it occurs, it never makes files be read again.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from drawlake.session import write_and_reread
from drawlake.sources.snapshots import CommitConflict, Snapshot, _fs, _join, _latest, _manifest, _publish, _read_files
from drawlake.sources.snapshots import _commit as commit_entry


class UniqueViolation(RuntimeError):
    """The batch would give a key a second row; nothing was committed."""


def _print(keys: Sequence[str]):
    return F.xxhash64(*keys).alias("fp")


def _without(counted: DataFrame, known: DataFrame | None, keys: Sequence[str]) -> DataFrame:
    """Counted keys that are not among the known ones (null meets null)."""
    if known is None:
        return counted
    marked = counted.withColumn("_known", F.lit(0)).unionByName(known.select(*keys, F.lit(0).cast("long").alias("n"), F.lit(1).alias("_known")))
    return marked.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("_known").alias("_known")).where("_known = 0").drop("_known")


def _repeated(spark: SparkSession, path: str, entry: Snapshot, keys: Sequence[str]) -> DataFrame | None:
    name = entry.settings.get("repeated")
    if name is None:
        return None
    schema = T.StructType.fromJson(json.loads(entry.schema))
    return spark.read.schema(T.StructType([schema[k] for k in keys])).parquet(_join(path, "repeated", name))


def _meeting(spark: SparkSession, path: str, entry: Snapshot, schema: T.StructType, batch_keys: DataFrame, keys: Sequence[str]):
    """Keys of stored files whose hash is one of the batch's, with counts, and how many files were read for it."""
    prints = [r[0] for r in _manifest(spark, path, entry).select("prints").distinct().collect()]
    if not prints:
        return None, 0
    stored = spark.read.schema("fp long, file string").parquet(*[_join(path, p) for p in prints])
    wanted = batch_keys.select(_print(keys)).distinct()
    met = write_and_reread(stored.join(wanted, "fp", "left_semi"), "met")
    files = [r[0] for r in met.select("file").distinct().collect()]
    if not files:
        return None, 0
    old = _read_files(spark, path, schema, files).select(*keys, _print(keys)).join(met.select("fp").distinct(), "fp", "left_semi")
    return old.groupBy(*keys).agg(F.count("*").alias("n")), len(files)


def append_unique(path: str, batch: DataFrame, keys: Sequence[str], on_violation: str = "report",
                  writer: tuple[str, int] | None = None, attempts: int = 5,
                  before_commit: Callable[[], None] | None = None) -> int:
    """Add a batch and bring the record of repeated keys up to date; returns the snapshot's number.

    ``on_violation``: ``report`` adds the rows whatever their keys;
    ``reject`` raises :class:`UniqueViolation` when a key of the batch occurs
    twice in it or is in the table already, and commits nothing. The key
    columns are fixed by the first batch. ``writer``, ``attempts`` and
    ``before_commit`` are those of ``merge_into``: a batch tried again is added once.
    """
    if on_violation not in ("report", "reject"):
        raise ValueError("on_violation must be 'report' or 'reject'")
    spark = batch.sparkSession
    name, number_of_batch = writer or (None, None)
    folder = uuid.uuid4().hex
    written = counted = None
    for _ in range(attempts):
        entry = _latest(spark, path)
        done = entry.writers.get(name) if entry and writer else None
        if done and number_of_batch <= done[0]:
            return done[1]
        schema = T.StructType.fromJson(json.loads(entry.schema)) if entry else batch.schema
        if entry and entry.keys != list(keys):
            raise ValueError(f"the table has the key {entry.keys}")
        if {f.name: f.dataType for f in schema.fields} != {f.name: f.dataType for f in batch.schema.fields}:
            raise ValueError(f"the table has columns {schema.simpleString()}")
        if written is None:
            batch.select(*schema.names).write.parquet(_join(path, "data", folder))
            written = spark.read.schema(schema).parquet(_join(path, "data", folder))
            counted = write_and_reread(written.groupBy(*keys).agg(F.count("*").alias("n")), "keys")
            file = F.concat(F.lit(f"data/{folder}/"), F.col("_metadata.file_name")).alias("file")
            (written.select(_print(keys), file).distinct().sortWithinPartitions("fp")
                    .write.parquet(_join(path, "prints", folder)))
            files = written.select(file).groupBy("file").agg(F.count("*").alias("rows")).withColumn("prints", F.lit(f"prints/{folder}"))
        known = _repeated(spark, path, entry, keys) if entry else None
        fresh = _without(counted, known, keys)
        if on_violation == "reject" and known is not None and fresh.count() < counted.count():
            _refuse(spark, path, folder, keys)
        old, looked = _meeting(spark, path, entry, schema, fresh, keys) if entry else (None, 0)
        of_batch = fresh.withColumn("here", F.lit(True))
        both = of_batch if old is None else of_batch.unionByName(old.withColumn("here", F.lit(False)))
        again = both.groupBy(*keys).agg(F.sum("n").alias("n"), F.max("here").alias("here")).where("here and n > 1").select(*keys)
        if on_violation == "reject" and not again.isEmpty():
            _refuse(spark, path, folder, keys)
        repeated = uuid.uuid4().hex
        (again if known is None else known.unionByName(again)).write.parquet(_join(path, "repeated", repeated))
        manifest, n_files = _publish(spark, path, files if entry is None else _manifest(spark, path, entry).unionByName(files))
        number, writers = (entry.number + 1 if entry else 1), dict(entry.writers) if entry else {}
        if writer:
            writers[name] = [number_of_batch, number]
        if before_commit:
            before_commit()
        if commit_entry(spark, path, Snapshot(number, manifest, schema.json(), list(keys), writers, 0, n_files,
                                              {"repeated": repeated, "files_looked_at": looked})):
            return number
    raise CommitConflict(f"{path}: other writers committed first {attempts} times")


def _refuse(spark: SparkSession, path: str, folder: str, keys: Sequence[str]):
    for part in ("data", "prints"):
        fs, p = _fs(spark, _join(path, part, folder))
        fs.delete(p, True)
    raise UniqueViolation(f"a key {list(keys)} of the batch is not new")


def repeated_keys(spark: SparkSession, path: str) -> DataFrame:
    """The keys that the newest snapshot holds more than once, from the record alone."""
    entry = _latest(spark, path)
    if entry is None:
        raise FileNotFoundError(f"{path} has no snapshot")
    return _repeated(spark, path, entry, entry.keys)


def unique_report(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The row of ``check_constraints`` for the table's key, from the record alone."""
    keys = ",".join(_latest(spark, path).keys)
    return repeated_keys(spark, path).agg(F.count("*").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit("unique").alias("rule"), F.lit(keys).alias("columns"), "violations")
