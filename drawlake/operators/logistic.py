"""Weighted logistic regressions of many labels by Newton steps, one scan of the rows per step.

All labels share a scan: a task adds up, for every label, gradient and loss of
its rows. The weighted Gram matrices, which cost ``features`` times more, come
from the first scan for the rates alone (there a row's weight depends on its
class only, so one matrix of all rows and one of each label's positives give
them all). They serve all later steps of a label whose steps shrink fast; a
label whose steps do not gets its matrix anew in the next scan, at its own
coefficients. Every scan reads every row, and the gradient that must vanish is
always that of all rows. The sums of tasks are added in groups of bounded size,
and systems of (features + 1) unknowns are solved on the driver.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.operators.windows import list_column
from drawlake.session import ship_package, write_and_reread

#: Rows of a block; partial sums added by one task.
BLOCK, FAN_IN = 4096, 64
#: Scans without new Gram matrices that a label may be away from its optimum.
PATIENCE = 5


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _design(part: pa.RecordBatch, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Standardised features and a column of ones."""
    x = part.column("features").flatten().to_numpy().reshape(part.num_rows, len(mean))
    return np.concatenate([(x - mean) / scale, np.ones((part.num_rows, 1))], axis=1)


def packed(values: np.ndarray) -> pa.Array:
    """The rows of a matrix as bytes, in the smallest type that holds all of them exactly."""
    for kind in (np.int8, np.int16, np.float32):
        with np.errstate(invalid="ignore", over="ignore"):
            small = values.astype(kind)
        if (small == values).all():
            break
    else:
        small = values.astype(np.float64)
    width = small.shape[1] * small.itemsize
    offsets = pa.py_buffer((np.arange(len(small) + 1) * width).astype(np.int32))
    return pa.Array.from_buffers(pa.binary(), len(small), [None, offsets, pa.py_buffer(np.ascontiguousarray(small).tobytes())])


def unpacked(column: pa.Array, width: int) -> np.ndarray:
    """The matrix of :func:`packed` rows, which may be of several types."""
    places = np.int64 if pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], places)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
    sizes, out = np.diff(offsets), np.empty((len(column), width))
    for size in np.unique(sizes):
        rows = sizes == size
        kind = {1: np.int8, 2: np.int16, 4: np.float32, 8: np.float64}[size // width]
        out[rows] = (data if rows.all() else data[np.repeat(rows, sizes)]).view(kind).reshape(-1, width)
    return out


def first_sums(x: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Gram matrix of one block of rows, then those of each label's positives."""
    return [x.T @ x, *[(own := x[y[:, j] > 0]).T @ own for j in range(y.shape[1])]]


def step_sums(x: np.ndarray, y: np.ndarray, beta: np.ndarray, pos_weight: np.ndarray, asked: np.ndarray) -> list[np.ndarray]:
    """Per label: gradient and loss of one block of rows; per asked label its weighted Gram matrix."""
    z = x @ beta.T
    w = np.where(y > 0, pos_weight, 1.0)
    e = np.exp(-np.abs(z))
    p = np.where(z >= 0, 1.0, e) / (1 + e)
    loss = (w * (np.maximum(z, 0) + np.log(1 + e) - y * z)).sum(axis=0)
    gram = [(x * (w[:, j] * p[:, j] * (1 - p[:, j]))[:, None]).T @ x for j in asked]
    return [(w * (p - y)).T @ x, loss, *gram]


@dataclass(frozen=True)
class MultiLogistic:
    """Coefficients per label (standardised features, then the intercept), and how many scans made new Gram matrices."""

    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    scans: int

    def probabilities(self, rows: DataFrame) -> DataFrame:
        """``rows`` (``seq``, ``features`` and more) with ``probability``, an array with one entry per label."""
        ship_package(rows.sparkSession)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for lo in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(lo, BLOCK)
                    p = sigmoid(_design(part, self.mean, self.scale) @ self.beta.T)
                    yield pa.RecordBatch.from_arrays([*part.columns, list_column(p)],
                                                     names=[*part.schema.names, "probability"])

        from pyspark.sql.types import ArrayType, DoubleType, StructField, StructType
        return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField("probability", ArrayType(DoubleType()))]))


def _summed(rows: DataFrame, tasks: int) -> list[bytes]:
    """One block of sums per part, added in rounds of at most about ``FAN_IN`` blocks a task."""
    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(b, np.float64) for b in sorted(group.column("sums").to_pylist()))
        return pa.table({"part": group.column("part").slice(0, 1), "task": pa.array([group.column("task")[0].as_py()], pa.int64()),
                         "sums": pa.array([np.asarray(total).tobytes()], pa.binary())})

    schema = "part int, task long, sums binary"
    while tasks > FAN_IN:
        tasks = math.ceil(tasks / FAN_IN)
        rows = rows.withColumn("task", F.pmod("task", F.lit(tasks))).groupBy("part", "task").applyInArrow(add, schema)
    rows = rows.withColumn("task", F.lit(0).cast("long")).groupBy("part").applyInArrow(add, schema)
    return [r["sums"] for r in sorted(rows.collect(), key=lambda r: r["part"])]


def _scan(rows: DataFrame, tasks: int, block_sums: Callable[[pa.RecordBatch], list[np.ndarray]]) -> list[np.ndarray]:
    """Sums over all rows of what ``block_sums`` gives for a block; every part is added up by itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        total = None
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                new = block_sums(batch.slice(lo, BLOCK))
                total = new if total is None else [a + b for a, b in zip(total, new, strict=True)]
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(len(total)), pa.int32()), pa.array([TaskContext.get().partitionId()] * len(total), pa.int64()),
                 pa.array([np.ascontiguousarray(t).tobytes() for t in total], pa.binary())], names=["part", "task", "sums"])

    return [np.frombuffer(b) for b in _summed(rows.mapInArrow(run, "part int, task long, sums binary"), tasks)]


def fit(train: DataFrame, pos_weight: list[float], reg_param: float = 1e-4, max_scans: int = 12,
        tolerance: float = 1e-9) -> MultiLogistic:
    """Fit every label of ``train`` (``features``: array<double> without nulls, ``y``: array of 0/1).

    Minimises, per label, the mean over rows of the cross entropy, with
    positives weighted by ``pos_weight``, plus ``reg_param / 2`` times the
    squared coefficients of the standardised features (not the intercept). The
    small ridge makes the solution unique although frequencies of a pool add
    up to a constant. A step that raises a label's loss is halved. Stops when
    no coefficient moves by more than ``tolerance``, or after ``max_scans``
    scans with new Gram matrices for some label. Needs at least one row.
    """
    spark = train.sparkSession
    ship_package(spark)
    first = np.array(train.select("features").first()[0], dtype=float)
    width, labels = len(first), len(pos_weight)
    d = width + 1

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("features").flatten().to_numpy().reshape(-1, width)
                y = batch.column("y").flatten().to_numpy().reshape(-1, labels)
                yield pa.RecordBatch.from_arrays([packed(x), packed(y)], names=["x", "y"])

    rows = write_and_reread(train.select("features", "y").mapInArrow(pack, "x binary, y binary"), "packed")
    tasks = rows.rdd.getNumPartitions()

    def moments(part: pa.RecordBatch) -> list[np.ndarray]:
        # About a row of the table: without large sums that cancel, and exactly 0 for a constant.
        x = unpacked(part.column("x"), width) - first
        return [np.concatenate([[len(x)], x.sum(axis=0), (x * x).sum(axis=0)])]

    total = _scan(rows, tasks, moments)[0]
    n = total[0]
    off = total[1:d] / n
    std = np.sqrt(np.maximum(total[d:] / n - off * off, 0))
    mean, scale = first + off, np.where(std > 0, std, 1.0)
    weight = np.array(pos_weight, dtype=float)
    ridge = np.append(np.full(width, reg_param * n), 0.0)

    def design(part: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        x = unpacked(part.column("x"), width)
        return np.concatenate([(x - mean) / scale, np.ones((len(x), 1))], axis=1), unpacked(part.column("y"), labels)

    # At the rates every row of a class has one weight, so the plain Gram matrices give all sums.
    plain = np.stack(_scan(rows, tasks, lambda part: first_sums(*design(part)))).reshape(labels + 1, d, d)
    positives, hits = plain[1:], plain[1:, -1, -1]
    # A rate of 0 or 1 has no finite intercept; half a row keeps it so.
    pos, neg = weight * np.maximum(hits, 0.5), np.maximum(n - hits, 0.5)
    rate = pos / (pos + neg)
    beta = np.zeros((labels, d))
    beta[:, -1] = np.log(pos / neg)
    gram = (rate * (1 - rate))[:, None, None] * (plain[0] + (weight - 1)[:, None, None] * positives)
    gradient = rate[:, None] * plain[0, -1] + ((weight * (rate - 1)) - rate)[:, None] * positives[:, -1]
    loss = -(weight * hits * np.log(rate) + (n - hits) * np.log1p(-rate))

    def sums_at(beta: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        sent = spark.sparkContext.broadcast(beta)

        def block_sums(part: pa.RecordBatch) -> list[np.ndarray]:
            x, y = design(part)
            return step_sums(x, y, sent.value, weight, asked)

        gradient, loss, *gram = _scan(rows, tasks, block_sums)
        return (gradient.reshape(labels, d) + beta * ridge, loss + 0.5 * (beta ** 2 * ridge).sum(axis=1),
                np.array(gram).reshape(len(asked), d, d))

    def newton(j: int) -> np.ndarray:
        return -np.linalg.solve(gram[j] + np.diag(ridge), gradient[j])

    step = np.stack([newton(j) for j in range(labels)])
    beta = beta + step
    size, asked, scans = np.abs(step).max(axis=1), np.array([], dtype=int), 0
    while size.max() >= tolerance and scans < max_scans:
        gradient, new_loss, new_gram = sums_at(beta, asked)
        gram[asked] = new_gram
        scans += len(asked) > 0
        worse = new_loss > loss + 1e-9 * np.abs(loss)
        loss = np.where(worse, loss, new_loss)
        full = np.stack([newton(j) for j in range(labels)])
        # A raised loss: half of the last step is taken back (and counts as the last step); otherwise a full new one.
        beta = np.where(worse[:, None], beta - step / 2, beta + full)
        step = np.where(worse[:, None], step / 2, full)
        last, size = size, np.abs(step).max(axis=1)
        # Steps that shrink by this factor reach the tolerance in so many more scans.
        with np.errstate(divide="ignore", invalid="ignore"):
            more = np.where(size < tolerance, 0, np.where(size < last, np.log(tolerance / size) / np.log(size / last), np.inf))
        asked = np.flatnonzero(worse | (more > PATIENCE))
    return MultiLogistic(mean, scale, beta, scans)
