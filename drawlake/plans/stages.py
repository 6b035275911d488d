"""Named stages of a job that a rerun takes up where the last run ended, published by one commit.

Layout of a job folder and of the runs beside it::

    <folder>-runs/<fingerprint>/<stage>/      what a stage wrote
    <folder>-runs/<fingerprint>/<stage>.json  put there when the stage has ended, with its notes
    <folder>/_log/<number>.json               one entry per publication: which run, which folders

A run's fingerprint covers the content of its inputs (an order-free digest, one
scan each) and its parameters. The same inputs and parameters find their ended
stages again; any change begins a new run. Until a run publishes, readers see
the one before, whole; a stage that was cut off has no ``.json`` and is done again.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from drawlake.session import path_exists
from drawlake.sources.snapshots import CommitConflict, Snapshot, _commit, _entry, _fs, _join, _latest, _numbers


def content_digest(df: DataFrame) -> str:
    """Digest of a frame's columns and rows, whatever their order and partitioning."""
    columns = sorted(df.columns)
    text = F.to_json(F.struct(*columns))
    summed = [F.sum(F.xxhash64(F.lit(salt), text).cast("decimal(38,0)")).alias(f"s{salt}") for salt in (1, 2)]
    row = df.agg(F.count(F.lit(1)).alias("n"), *summed).first()
    types = [(c, df.schema[c].dataType.simpleString()) for c in columns]
    return hashlib.sha256(json.dumps([types, [str(v) for v in row]]).encode()).hexdigest()


def _runs(folder: str) -> str:
    return folder.rstrip("/") + "-runs"


class Run:
    """The stages of one run of a job."""

    def __init__(self, spark: SparkSession, folder: str, inputs: Mapping[str, DataFrame | None], parameters: Mapping[str, object],
                 after_stage: Callable[[str], None] | None = None):
        known = {name: content_digest(df) for name, df in sorted(inputs.items()) if df is not None}
        text = json.dumps([known, dict(sorted(parameters.items()))], sort_keys=True, default=str)
        self.spark, self.folder, self.after_stage = spark, folder, after_stage
        self.name = hashlib.sha256(text.encode()).hexdigest()[:32]
        self.outputs: dict[str, str] = {}
        self.done: list[str] = []  # stages that this run found ended

    def _path(self, stage: str) -> str:
        return _join(_runs(self.folder), self.name, stage)

    def notes(self, stage: str) -> dict | None:
        """What a stage noted when it ended; None if it has not."""
        path = self._path(stage) + ".json"
        return json.loads(self.spark.read.text(path).first()[0]) if path_exists(self.spark, path) else None

    def stage(self, stage: str, work: Callable[[str], dict | None]) -> dict:
        """Do the work of a stage, which gets the folder to write to, unless it has ended; returns its notes."""
        notes = self.notes(stage)
        if notes is not None:
            self.done.append(stage)
            return notes
        fs, folder = _fs(self.spark, self._path(stage))
        fs.delete(folder, True)  # remains of a run that was cut off
        notes = work(self._path(stage)) or {}
        _, end = _fs(self.spark, self._path(stage) + ".json")
        out = fs.create(end, True)
        out.write(bytearray(json.dumps(notes).encode()))
        out.close()
        if self.after_stage:
            self.after_stage(stage)
        return notes

    def table(self, stage: str, build: Callable[[], DataFrame], output: bool = True) -> DataFrame:
        """A stage that writes one frame as Parquet; returns the written frame."""
        def work(path: str) -> dict:
            df = build()
            df.write.parquet(path)
            return {"schema": df.schema.json()}

        self.stage(stage, work)
        if output:
            self.outputs[stage] = self._path(stage)
        return self.spark.read.parquet(self._path(stage))

    def publish(self) -> int:
        """Make this run's outputs the job's newest, all at once; returns the publication's number."""
        for _ in range(5):
            last = _latest(self.spark, self.folder)
            if last and last.manifest == self.name:
                return last.number
            entry = Snapshot(last.number + 1 if last else 1, self.name, "", [], {}, 0, len(self.outputs), {"outputs": self.outputs})
            if _commit(self.spark, self.folder, entry):
                return entry.number
        raise CommitConflict(f"{self.folder}: other runs published first")


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """Output names of a job and the folders that its newest publication names; empty if there is none."""
    last = _latest(spark, folder)
    return dict(last.settings["outputs"]) if last else {}


def drop_runs(spark: SparkSession, folder: str, keep: int = 1) -> int:
    """Delete all runs but those of the newest ``keep`` publications, unpublished ones too; returns how many.

    Not while a run is under way. Log entries of deleted runs go first.
    """
    if keep < 1:
        raise ValueError("keep at least the newest publication")
    numbers = _numbers(spark, folder)
    kept = {_entry(spark, folder, n).manifest for n in numbers[-keep:]}
    for n in numbers[:-keep]:
        fs, p = _fs(spark, _join(folder, "_log", f"{n:020d}.json"))
        fs.delete(p, False)
    fs, runs = _fs(spark, _runs(folder))
    old = [s.getPath() for s in fs.listStatus(runs) if s.getPath().getName() not in kept] if fs.exists(runs) else []
    for p in old:
        fs.delete(p, True)
    return len(old)
