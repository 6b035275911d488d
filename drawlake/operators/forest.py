"""Random forests of many labels in one job.

Features are binned once, at thresholds between all of their values. Each tree
draws its bootstrap by hashes of the rows, as many draws as there are rows. The
binned table goes to a fixed number of tasks, each of which grows its share of
the trees of all labels, level by level, from counts per (node, feature, bin).
Counts are whole numbers and the hashes name every choice, so the forest does
not depend on partitions, row order or retries.
"""

from __future__ import annotations

import math
import tempfile
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawlake.session import ship_package, write_and_reread

#: Split points of a feature are at most so many.
MOST_BINS = 64
#: Nodes of so many rows are counted one by one, smaller ones together, up to so many rows.
LARGE, TOGETHER = 8_192, 8_192
#: Rows that are packed together on their way to the tasks.
BLOCK = 4_096
#: A task's bins stay in memory up to so many bytes; beyond it they are mapped from a file without a name.
IN_MEMORY = 256 << 20


def mixed(*numbers) -> np.ndarray:
    """64-bit hash of whole numbers or arrays of them (each step is splitmix64's finish)."""
    h = np.uint64(0)
    with np.errstate(over="ignore"):
        for x in numbers:
            h = (h ^ np.asarray(x).astype(np.uint64)) + np.uint64(0x9E3779B97F4A7C15)
            h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            h = h ^ (h >> np.uint64(31))
    return h


def node_features(seed: int, tree: int, label: int, nodes: np.ndarray, width: int, take: int) -> np.ndarray:
    """The ``take`` features that each node may split on (ascending): those with the smallest hashes."""
    h = mixed(seed, tree, label, nodes[:, None], np.arange(width)[None, :])
    if take >= width:
        return np.tile(np.arange(width), (len(nodes), 1))
    return np.sort(np.argpartition(h, take, axis=1)[:, :take], axis=1)


def split_points(values: np.ndarray, most: int = MOST_BINS) -> np.ndarray:
    """Thresholds of one feature: midpoints of neighbouring values, thinned by rank when there are too many."""
    return middles(*np.unique(values, return_counts=True), most)


def middles(u: np.ndarray, n: np.ndarray, most: int = MOST_BINS) -> np.ndarray:
    """The same of the distinct values in order and how often each of them comes."""
    middle = (u[:-1] + u[1:]) / 2
    if len(middle) >= most:
        rank = np.cumsum(n)
        middle = np.unique(middle[np.searchsorted(rank[:-1], np.arange(1, most) * rank[-1] / most).clip(max=len(middle) - 1)])
    return middle


def all_split_points(rows: DataFrame, width: int) -> list[np.ndarray]:
    """:func:`split_points` of every feature over all rows.

    Each batch of rows counts its distinct values, and the counts are added up
    before a feature's values, no more than there are distinct ones, meet in one task.
    """
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m = batch.column("features").flatten().to_numpy().reshape(batch.num_rows, width)
            found = [np.unique(m[:, k], return_counts=True) for k in range(width)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(np.arange(width, dtype=np.int32), [len(u) for u, _ in found])),
                 pa.array(np.concatenate([u for u, _ in found])), pa.array(np.concatenate([n for _, n in found]))],
                names=["feature", "value", "rows"])

    def thinned(group: pa.Table) -> pa.Table:
        group = group.sort_by("value")
        points = middles(group.column("value").to_numpy(), group.column("rows").to_numpy())
        return pa.table({"feature": group.column("feature").slice(0, 1), "points": pa.array([points.tolist()], pa.list_(pa.float64()))})

    per = (rows.select("features").mapInArrow(counted, "feature int, value double, rows long")
           .groupBy("feature", "value").agg(F.sum("rows").alias("rows")))
    of = {r.feature: np.array(r.points, dtype=float)
          for r in per.groupBy("feature").applyInArrow(thinned, "feature int, points array<double>").collect()}
    return [of.get(k, np.empty(0)) for k in range(width)]


def _impurity(pos, neg):
    """Weighted Gini impurity times the weight, of weighted counts; NaN without rows."""
    return 2 * pos * neg / (pos + neg)


def _counts(columns: np.ndarray, y: np.ndarray, times: np.ndarray, rows: np.ndarray, place: np.ndarray, features: np.ndarray,
            size: int) -> tuple[np.ndarray, np.ndarray]:
    """Draws and positive ones by (node, its feature, bin), of rows that stand node by node."""
    k, take = features.shape
    cells = k * take * size
    key = (np.arange(k * take).reshape(k, take) * size).take(place, axis=0)
    at = (features * columns.shape[1]).take(place, axis=0)
    at += rows[:, None]
    key += columns.reshape(-1).take(at)
    drawn, hit = times.take(rows), np.flatnonzero(y.take(rows))
    every = np.bincount(key.reshape(-1), np.repeat(drawn, take), cells)
    positive = np.bincount(key.take(hit, axis=0).reshape(-1), np.repeat(drawn[hit], take), cells)
    return every.reshape(k, take, size), positive.reshape(k, take, size)


def _counts_of_one(columns: np.ndarray, y: np.ndarray, times: np.ndarray, rows: np.ndarray, features: np.ndarray,
                   size: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`_counts` of one node of many rows, by (times drawn, target, bin) of each feature."""
    most = int(times.max()) + 1
    table, kind = np.zeros((len(features), most * 2 * size), dtype=np.int64), np.min_scalar_type(most * 2 * size)
    for lo in range(0, len(rows), 1 << 16):
        part = rows[lo:lo + (1 << 16)]
        own = (times.take(part) * kind.type(2) + y.take(part)) * kind.type(size)
        for k, f in enumerate(features):
            table[k] += np.bincount(own + columns[f].take(part), minlength=most * 2 * size)
    by_target = np.einsum("t,ftyb->fyb", np.arange(most), table.reshape(len(features), most, 2, size)).astype(float)
    return by_target.sum(axis=1)[None], by_target[None, :, 1]


def _best(every: np.ndarray, positive: np.ndarray, n: np.ndarray, p: np.ndarray, features: np.ndarray,
          weights: tuple[float, float]) -> tuple[np.ndarray, ...]:
    """Of each node: feature (-1: none improves) and last left bin of the best split, draws and positives on the left."""
    wp, wn = weights
    left_n, left_p = every.cumsum(axis=2)[:, :, :-1], positive.cumsum(axis=2)[:, :, :-1]
    right_n, right_p = n[:, None, None] - left_n, p[:, None, None] - left_p
    with np.errstate(invalid="ignore", divide="ignore"):
        cost = _impurity(wp * left_p, wn * (left_n - left_p)) + _impurity(wp * right_p, wn * (right_n - right_p))
    cost[(left_n == 0) | (right_n == 0)] = np.inf
    flat, node = cost.reshape(len(n), -1), np.arange(len(n))
    at = flat.argmin(axis=1)  # the first of equals: the smaller feature, then the smaller bin
    better = flat[node, at] < _impurity(wp * p, wn * (n - p)) * (1 - 1e-12)
    slot, edge = at // cost.shape[2], at % cost.shape[2]
    return np.where(better, features[node, slot], -1), np.where(better, edge, -1), left_n[node, slot, edge], left_p[node, slot, edge]


def _runs(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Nodes to count at once: each large one alone, neighbouring small ones up to ``TOGETHER`` rows."""
    begin = held = 0
    for k, rows in enumerate(sizes.tolist()):
        if k > begin and held + rows > TOGETHER:
            yield begin, k
            begin, held = k, 0
        held += rows
    if len(sizes):
        yield begin, len(sizes)


def grow(bins: np.ndarray, y: np.ndarray, weights: tuple[float, float], seed: int, tree: int, label: int,
         max_depth: int, take: int, times: np.ndarray | None = None, size: int = 256) -> list[tuple]:
    """Nodes of one tree as ``(node, feature, last bin of the left side, share of positives)``.

    The root is node 1 and the children of k are 2k and 2k + 1; a leaf has
    feature -1. A node is split at the feature and bin with the lowest weighted
    Gini impurity (ties: the smaller feature, then the smaller bin), if that is
    an improvement. ``times`` tells how often the tree drew each row (default:
    once); bins are below ``size``. A matrix stored by columns is not copied.
    """
    wp, wn = weights
    columns, out = np.ascontiguousarray(bins.T), []
    times = np.ones(len(y), dtype=np.uint8) if times is None else times
    rows = np.flatnonzero(times)  # those of the nodes that may be split, node by node
    names, n, p = np.array([1]), times.sum(dtype=float, keepdims=True), times[y > 0].sum(dtype=float, keepdims=True)
    sizes = np.array([len(rows)])
    for depth in range(max_depth + 1):
        if not len(names):
            break
        feature, edge = np.full(len(names), -1), np.full(len(names), -1)
        at = np.flatnonzero((p > 0) & (p < n)) if depth < max_depth and size > 1 else np.empty(0, dtype=np.int64)
        features = node_features(seed, tree, label, names[at], len(columns), take)
        below_n, below_p = np.zeros((len(names), 2)), np.zeros((len(names), 2))
        ends, kept, kept_sizes = np.append(0, np.cumsum(sizes)), [], []
        for lo, hi in _runs(sizes) if len(at) else ():
            own, of, alone = rows[ends[lo]:ends[hi]], at[lo:hi], hi - lo == 1 and sizes[lo] >= LARGE
            place = None if alone else np.repeat(np.arange(hi - lo), sizes[lo:hi])
            every, positive = (_counts_of_one(columns, y, times, own, features[lo], size) if alone
                               else _counts(columns, y, times, own, place, features[lo:hi], size))
            feature[of], edge[of], left_n, left_p = _best(every, positive, n[of], p[of], features[lo:hi], weights)
            below_n[of], below_p[of] = np.stack([left_n, n[of] - left_n], axis=1), np.stack([left_p, p[of] - left_p], axis=1)
            if depth + 1 == max_depth:
                continue
            # Children that may be split; the rows of others are not needed any more.
            going = ((feature[of] >= 0)[:, None] & (below_p[of] > 0) & (below_p[of] < below_n[of])).reshape(-1)
            if alone:
                right = columns[feature[at[lo]]].take(own) > edge[at[lo]]
                parts = [own[side] for side, go in zip((~right, right), going, strict=True) if go]
                kept += parts
                kept_sizes.append(np.array([len(part) for part in parts], dtype=np.int64))
                continue
            side = place * 2 + (columns.reshape(-1).take((feature[of] * columns.shape[1]).take(place) + own) > edge[of].take(place))
            if not going.all():
                stay = np.flatnonzero(going.take(side))
                own, side = own.take(stay), side.take(stay)
            kept.append(own.take(np.argsort(side.astype(np.uint16), kind="stable")))
            kept_sizes.append(np.bincount(side, minlength=2 * (hi - lo))[going])
        out += list(zip(names.tolist(), feature.tolist(), edge.tolist(), (wp * p / (wp * p + wn * (n - p))).tolist(), strict=True))
        split = feature >= 0
        names, n, p = (names[split][:, None] * 2 + [0, 1]).reshape(-1), below_n[split].reshape(-1), below_p[split].reshape(-1)
        rows, sizes = (np.concatenate(kept), np.concatenate(kept_sizes)) if kept else (rows[:0], sizes[:0])
    return out


def predict(nodes: list[tuple], bins: np.ndarray) -> float:
    """Share of positives in the leaf that a row of bins falls into."""
    by = {k: rest for k, *rest in nodes}
    k = 1
    while by[k][0] >= 0:
        k = 2 * k + int(bins[by[k][0]] > by[k][1])
    return by[k][2]


def poisson_steps(rate: float) -> list[float]:
    """Cumulative Poisson probabilities up to all but 10^-12."""
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while total < 1 - 1e-12 and k < 10 * rate + 60:
        total += term
        out.append(min(total, 1.0))
        k += 1
        term *= rate / k
    return out


def tree_draws(row_col: str, trees: int, share: float, seed: int) -> Column:
    """array<int>: the trees that drew a row, one entry for each time.

    Each tree holds a row a Poisson number of times with mean ``share``, which
    is what sampling with replacement gives. All trees together hold it a
    Poisson number of times with mean ``trees * share``, and each of those goes
    to a tree of its own choice: the same distribution, without a draw per tree.
    """
    if trees * share > 500:
        raise ValueError("trees times the drawn share must stay under 500")
    uniform = F.pmod(F.xxhash64(F.lit(seed), F.lit("times"), row_col), F.lit(2 ** 53)).cast("double") / float(2 ** 53)
    steps = F.split(F.lit(",".join(map(repr, poisson_steps(trees * share)))), ",").cast("array<double>")
    times = F.size(F.filter(steps, lambda c: c <= uniform))
    return F.transform(F.when(times > 0, F.sequence(F.lit(1), times)).otherwise(F.array().cast("array<int>")),
                       lambda k: F.pmod(F.xxhash64(F.lit(seed), F.lit("tree"), row_col, k), F.lit(trees)).cast("int"))


def drawn_trees(rows: DataFrame, row_col: str, trees: int, share: float, seed: int) -> DataFrame:
    """Every row once for each time that a tree drew it (column ``tree``)."""
    return rows.withColumn("tree", F.explode(tree_draws(row_col, trees, share, seed)))


def forest_probabilities(train: DataFrame, asked: DataFrame, weights: list[tuple[float, float]], num_trees: int = 100,
                         seed: int = 42, max_depth: int = 10, max_samples: int | None = None, take: int | None = None,
                         bootstrap: bool = True) -> DataFrame:
    """``seq, label, probability``: mean share of positives over a forest per label.

    ``train`` has ``seq``, ``features`` (array<double> without nulls) and ``y``
    (array of 0/1, one per label); ``asked`` the few rows to predict (``seq``,
    ``features``). ``weights`` gives the weight of a positive and of a negative
    row of each label. A tree draws about as many rows as there are, or
    ``max_samples`` if that is given; without ``bootstrap`` it sees every row
    once. ``take`` is the number of features that a node may use (default: the
    root of their number).

    The trees of all labels are dealt to twice as many tasks as there are
    cores, so the table is moved once per task, packed, and not once per tree.
    A task holds a byte per feature of a row, in a file if those are many, and
    a few numbers per row of the tree that it grows.
    """
    spark = train.sparkSession
    ship_package(spark)
    wanted = asked.select("seq", "features").toArrow()
    width, labels = len(wanted.column("features")[0]) if wanted.num_rows else 0, len(weights)
    points = all_split_points(train, width)
    size = max(map(len, points), default=0) + 1
    take = take or max(1, math.isqrt(width))
    total = train.count()
    share = 1.0 if max_samples is None else min(1.0, max_samples / max(total, 1))

    def binned(m: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(points[k], m[:, k], side="left") for k in range(width)]).astype(np.uint8)

    ask_seq = wanted.column("seq").to_pylist()
    ask_bins = binned(wanted.column("features").combine_chunks().flatten().to_numpy().reshape(-1, width)).T

    def block(batch: pa.RecordBatch) -> list[pa.Array]:
        n = batch.num_rows
        bins = binned(batch.column("features").flatten().to_numpy().reshape(n, width))
        y = np.packbits(batch.column("y").flatten().to_numpy().reshape(n, labels).astype(np.uint8).T, axis=1)
        row = np.repeat(np.arange(n), batch.column("trees").value_lengths().to_numpy())
        drawn = batch.column("trees").flatten().to_numpy().astype(np.int64) * n + row
        times = np.bincount(drawn, minlength=num_trees * n).astype(np.uint8).reshape(num_trees, n)
        return [pa.array([n], pa.int32()), pa.array([zlib.compress(bins.tobytes())], pa.binary()),
                pa.array([zlib.compress(y.tobytes())], pa.binary()), pa.array([[zlib.compress(t) for t in times]], pa.list_(pa.binary()))]

    def to_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BLOCK):
                yield pa.RecordBatch.from_arrays(block(batch.slice(lo, BLOCK)), names=["rows", "bins", "y", "times"])

    units = num_trees * labels
    tasks = min(units, 2 * spark.sparkContext.defaultParallelism)
    own_trees = F.slice("times", F.expr(f"int(task * {units}L div {tasks} div {labels}) + 1"),
                        F.expr(f"int(((task + 1) * {units}L div {tasks} - 1) div {labels} - task * {units}L div {tasks} div {labels}) + 1"))
    drawn = (tree_draws("seq", num_trees, share, seed) if bootstrap else F.sequence(F.lit(0), F.lit(num_trees - 1)))
    blocks = (train.select("features", "y", drawn.alias("trees"))
              .mapInArrow(to_blocks, "rows int, bins binary, y binary, times array<binary>")
              .withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
              .select("task", "rows", "bins", "y", own_trees.alias("times")).repartitionById(tasks, "task"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at, ys, drawn, in_memory = None, 0, [], [], width * total <= IN_MEMORY
        columns = (np.empty((width, total), np.uint8) if in_memory
                   else np.memmap(tempfile.TemporaryFile(), np.uint8, "w+", shape=(width, total)))
        for batch in batches:
            for own in batch.to_pylist():
                task, n = own["task"], own["rows"]
                columns[:, at:at + n] = np.frombuffer(zlib.decompress(own["bins"]), np.uint8).reshape(width, n)
                ys.append((n, np.frombuffer(zlib.decompress(own["y"]), np.uint8).reshape(labels, -1)))
                drawn.append(own["times"])
                at += n
        if task is None:
            return
        first, tree, out = task * units // tasks, -1, []
        for unit in range(first, (task + 1) * units // tasks):
            if unit // labels != tree:
                tree = unit // labels
                times = np.concatenate([np.frombuffer(zlib.decompress(t[tree - first // labels]), np.uint8) for t in drawn])
                # Only the rows that it drew, rows far apart beside each other: equal bins in a row are slower to count.
                rows = np.concatenate([np.flatnonzero(times[k::64]) * 64 + k for k in range(64)]) if in_memory else None
                bins, times = (columns.take(rows, axis=1), times[rows]) if in_memory else (columns, times)
            if times.any():
                y = np.concatenate([np.unpackbits(bits[unit % labels], count=n) for n, bits in ys])
                nodes = grow(bins.T, y[rows] if in_memory else y, weights[unit % labels], seed, tree, unit % labels, max_depth, take, times, size)
                out += [(s, unit % labels, tree, predict(nodes, b)) for s, b in zip(ask_seq, ask_bins, strict=True)]
        seq, label, tree, p = zip(*out, strict=True) if out else ((), (), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(seq, pa.int64()), pa.array(label, pa.int32()), pa.array(tree, pa.int32()),
                                          pa.array(p, pa.float64())], names=["seq", "label", "tree", "p"])

    per_tree = write_and_reread(blocks.mapInArrow(fit, "seq long, label int, tree int, p double"), "forest")
    shares = F.transform(F.array_sort(F.collect_list(F.struct("tree", "p"))), lambda t: t["p"])  # added in the order of the trees
    return (per_tree.groupBy("seq", "label").agg(shares.alias("p"))
            .select("seq", "label", (F.aggregate("p", F.lit(0.0), lambda a, x: a + x) / F.size("p")).alias("probability")))
