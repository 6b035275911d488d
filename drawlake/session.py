"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, app: str = "drawlake",
                shuffle_partitions: int | None = None,
                extra: dict[str, str] | None = None) -> SparkSession:
    """Build (or reuse) a session with AQE on, UTC time and no web UI.

    ``master`` and ``shuffle_partitions`` are only applied when given, so on a
    cluster the submit-time settings stay in charge.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(_DEFAULTS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting names a folder every executor can reach and is
    left alone; without it a cluster run raises, since a folder of the driver's
    machine would lose rows. Only a local master gets a scratch folder.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    path = tempfile.mkdtemp(prefix="drawlake-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


_SCRATCH: list[str] = []


def write_and_reread(df, name: str = "stage"):
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint folder.

    One job writes the rows (a plain ``checkpoint()`` runs the plan a second
    time to save it); later scans read only the columns they need, and the
    files outlive any executor. They go when the driver ends, or with
    :func:`drop_scratch`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder, deleted like those of :func:`write_and_reread`."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/drawlake-{name}-{uuid.uuid4().hex}"
    if not _SCRATCH:
        atexit.register(_drop_at_exit, spark)
    _SCRATCH.append(path)
    return path


def partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system that it belongs to."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def drop_scratch(spark: SparkSession) -> int:
    """Delete the folders that :func:`write_and_reread` wrote; returns how many.

    Call it when no DataFrame that was built on them is needed any more.
    """
    n = 0
    while _SCRATCH:
        p = spark._jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        n += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return n


def _drop_at_exit(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # still running
        drop_scratch(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``drawlake`` importable in the Python workers (once per application).

    Only operators that run Python inside tasks need it (the HTML page
    parser). The package's .py files are zipped on the driver and handed to
    ``SparkContext.addPyFile``, the same as ``--py-files`` at submit time; it
    is harmless when the package is already installed on the workers.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    import drawlake
    pkg_dir = os.path.dirname(os.path.abspath(drawlake.__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="drawlake-pyfiles-"), "drawlake.zip")
    with zipfile.ZipFile(out, "w") as z:
        for root, _, files in os.walk(pkg_dir):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    sc.addPyFile(out)
    _SHIPPED.add(sc.applicationId)
