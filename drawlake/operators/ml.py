"""Multi-label models over sliding features.

The feature table is written once and read by a handful of jobs that serve all
labels together: one aggregate for the class weights, one for the scaler, and
the fit itself (:mod:`drawlake.operators.forest`, :mod:`drawlake.operators.logistic`).
Only per-label constants, sums of bounded size and the row to predict reach the
driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawlake.operators import logistic
from drawlake.operators.forest import forest_probabilities
from drawlake.operators.windows import domain_rows
from drawlake.schemas import DEFAULT_POOLS, Pool
from drawlake.session import write_and_reread


def targets_long(features: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS,
                 seq_col: str = "seq") -> DataFrame:
    """``seq, pool, number, present`` from the ``y_<pool>`` arrays of known draws (one pass)."""
    known = features.where(F.col(f"y_{pools[0].name}").isNotNull())
    present = F.concat(*[F.col(f"y_{p.name}") for p in pools]).alias("present")
    return domain_rows(known.select(seq_col, present), [seq_col], pools, ["present"])


def class_weights(targets: DataFrame) -> DataFrame:
    """Per label: positives, rows, balanced weights n/(2 n_c) (O45) and the pool's
    positive-class weight (cells - positives) / positives (O44)."""
    per = targets.groupBy("pool", "number").agg(F.sum("present").cast("long").alias("positives"),
                                                F.count(F.lit(1)).alias("total_rows"))
    pool_w = F.try_divide((F.sum("total_rows").over(_by_pool()) - F.sum("positives").over(_by_pool()))
                          .cast("double"), F.sum("positives").over(_by_pool()).cast("double"))
    return per.select(
        "pool", "number", "positives", "total_rows",
        F.try_divide(F.col("total_rows").cast("double"), F.col("positives") * 2.0).alias("weight_pos"),
        F.try_divide(F.col("total_rows").cast("double"),
                     (F.col("total_rows") - F.col("positives")) * 2.0).alias("weight_neg"),
        pool_w.alias("pool_pos_weight"))


def _by_pool():
    from pyspark.sql import Window
    return Window.partitionBy("pool")


def split_last(features: DataFrame, mode: str = "holdout", seq_col: str = "seq",
               y_col: str = "y_main") -> tuple[DataFrame, DataFrame]:
    """(train, predict) rows (O66): the row of the highest sequence number is predicted.

    ``holdout``: that is the last known draw, predicted from earlier ones (the
    reference behaviour). ``next``: it is the extra unseen row, and every known
    draw trains.
    """
    if mode not in ("holdout", "next"):
        raise ValueError("mode must be 'holdout' or 'next'")
    last = features.select(F.max(seq_col)).scalar()
    return (features.where((F.col(seq_col) < last) & F.col(y_col).isNotNull()),
            features.where(F.col(seq_col) == last))


def _labels(train: DataFrame, pools: Sequence[Pool], weighting: str):
    w = class_weights(targets_long(train, pools)).collect()  # one row per label
    by = {(r["pool"], r["number"]): r for r in w}
    labels = []
    for p in pools:
        for n in range(p.lo, p.hi + 1):
            r = by.get((p.name, n))
            if weighting == "balanced":
                wp, wn = (r["weight_pos"] or 1.0, r["weight_neg"] or 1.0) if r else (1.0, 1.0)
            else:  # positive weight for the pool, negatives 1
                wp, wn = ((r["pool_pos_weight"] or 1.0) if r else 1.0), 1.0
            prior = float(r["positives"] / r["total_rows"]) if r and r["total_rows"] else 0.0
            labels.append((p.name, n, n - p.lo, float(wp), float(wn), prior))
    return labels


def _written(features: DataFrame, pools: Sequence[Pool], missing: float) -> DataFrame:
    """``seq, features, y_<pool>...`` written once; a null lag counts as ``missing``."""
    filled = F.transform("features", lambda x: F.coalesce(x.cast("double"), F.lit(float(missing))))
    return write_and_reread(features.select(F.col("seq").cast("long").alias("seq"), filled.alias("features"),
                                            *[f"y_{p.name}" for p in pools]), "features")


def _targets(labels: list[tuple]):
    """The chosen labels' 0/1 targets as one array."""
    return F.array(*[F.col(f"y_{pool}")[idx].cast("double") for pool, _, idx, *_ in labels]).alias("y")


def _with_rates(scores: DataFrame, asked: DataFrame, fitted: list[tuple], labels: list[tuple]) -> DataFrame:
    """Names for the fitted labels' numbers, and the plain rate for labels with one class."""
    spark = scores.sparkSession
    names = spark.createDataFrame([(k, pool, n) for k, (pool, n, *_) in enumerate(fitted)], "label int, pool string, number int")
    one_class = asked.select("seq", F.inline(F.array(*[
        F.struct(F.lit(pool).alias("pool"), F.lit(n).alias("number"), F.lit(rate).alias("probability"))
        for pool, n, _, _, _, rate in labels if rate in (0.0, 1.0)]))) if len(fitted) < len(labels) else None
    out = scores.join(F.broadcast(names), "label").select("seq", "pool", "number", "probability")  # one row per label
    return out if one_class is None else out.unionByName(one_class)


def fit_multilabel_forest(features: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS, mode: str = "holdout",
                          num_trees: int = 100, seed: int = 42, max_depth: int = 10, max_samples: int | None = None,
                          missing: float = 0.0, take: int | None = None, bootstrap: bool = True) -> DataFrame:
    """A random forest per label with balanced class weights.

    Returns ``seq, pool, number, probability`` for the predicted row. Every
    tree draws as many draws as there are, with replacement, from all of them
    (about ``max_samples``, if that is given); class weights, rates and split
    points count all draws. A null lag number counts as ``missing``; a label
    with one class gets its rate. Trees do not
    change with the scale of a feature, so none is scaled. Trees end at
    ``max_depth``, and a split must improve, so probabilities are comparable
    with, but not bit-equal to, those of a library that grows trees fully.
    """
    rows = _written(features, pools, missing)
    train, predict = split_last(rows, mode, y_col=f"y_{pools[0].name}")
    labels = _labels(train, pools, "balanced")
    fitted = [label for label in labels if label[-1] not in (0.0, 1.0)]
    if not fitted:
        return _with_rates(features.sparkSession.createDataFrame([], "seq long, label int, probability double"), predict, fitted, labels)
    scores = forest_probabilities(train.select("seq", "features", _targets(fitted)), predict.select("seq", "features"),
                                  [(wp, wn) for _, _, _, wp, wn, _ in fitted], num_trees, seed, max_depth, max_samples, take, bootstrap)
    return _with_rates(scores, predict, fitted, labels)


def logistic_model(features: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS, mode: str = "holdout", reg_param: float = 1e-4,
                   max_scans: int = 12, missing: float = 0.0) -> tuple[logistic.MultiLogistic | None, DataFrame, DataFrame, list, list]:
    """The fitted model, its training rows (``seq, features, y``), the row to predict, the fitted labels and all labels."""
    rows = _written(features, pools, missing)
    train, predict = split_last(rows, mode, y_col=f"y_{pools[0].name}")
    labels = _labels(train, pools, "pos_weight")
    fitted = [label for label in labels if label[-1] not in (0.0, 1.0)]
    train = train.select("seq", "features", _targets(fitted))
    model = logistic.fit(train, [wp for _, _, _, wp, _, _ in fitted], reg_param, max_scans) if fitted else None
    return model, train, predict, fitted, labels


def fit_multilabel_logistic(features: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS, mode: str = "holdout",
                            reg_param: float = 1e-4, max_scans: int = 12, missing: float = 0.0) -> DataFrame:
    """A weighted logistic regression per label on standardised features, all labels in one scan per Newton step:
    positives weigh the pool's (cells - positives) / positives, a one-layer net with that cross entropy (O64, O67).
    Every draw trains; output, ``missing`` and one-class labels as in the forest."""
    model, _, predict, fitted, labels = logistic_model(features, pools, mode, reg_param, max_scans, missing)
    if model is None:
        return _with_rates(features.sparkSession.createDataFrame([], "seq long, label int, probability double"), predict, fitted, labels)
    scores = model.probabilities(predict.select("seq", "features")).select("seq", F.posexplode("probability").alias("label", "probability"))
    return _with_rates(scores, predict, fitted, labels)


def logistic_balance(features: DataFrame, pools: Sequence[Pool] = DEFAULT_POOLS, mode: str = "holdout",
                     reg_param: float = 1e-4) -> DataFrame:
    """``pool, number, predicted_weight``: per label, the sum over the training rows of weight times probability.

    The intercept is not penalised, so at the optimum this equals the weight
    of the positives; it does so only if the fit has converged on every row.
    """
    model, train, _, fitted, _ = logistic_model(features, pools, mode, reg_param)
    weight = F.get(F.array(*[F.lit(wp) for _, _, _, wp, _, _ in fitted]), F.col("label"))
    cells = model.probabilities(train).select(F.posexplode(F.arrays_zip("probability", "y")).alias("label", "cell"))
    sums = (cells.select("label", (F.col("cell.probability") * F.when(F.col("cell.y") == 1.0, weight).otherwise(1.0)).alias("w"))
            .groupBy("label").agg(F.sum("w").alias("predicted_weight")))
    names = train.sparkSession.createDataFrame([(k, pool, n) for k, (pool, n, *_) in enumerate(fitted)], "label int, pool string, number int")
    return sums.join(F.broadcast(names), "label").select("pool", "number", "predicted_weight")
