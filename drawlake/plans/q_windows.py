"""Order-dependent queries: sequence windows, lags, window stats, targets."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawlake.operators.features import (
    lag_long, multi_hot_long, next_features, sliding_features, start_index, window_stats,
)
from drawlake.operators.ml import class_weights, fit_multilabel_forest, fit_multilabel_logistic, logistic_balance
from drawlake.operators.picks import backtest_window_picks, pick_top_k
from drawlake.operators.reshape import indicator_counts
from drawlake.operators.rolling import rolling_frequency
from drawlake.plans.catalog import register
from drawlake.plans.derived import DERIVED_ORDER, load_draws, sequenced_draws, with_draws
from drawlake.schemas import STAR
from drawlake.session import scratch_path, write_and_reread
from drawlake.streaming.history import append_draws, read_history, stored_window_stats

_STAR_GRID = """
sgrid AS (
  SELECT sd.seq, sd.draw_date, CAST(r.range AS INTEGER) AS number,
         (SELECT count(*) FROM lg WHERE lg.seq = sd.seq AND lg.pool = 'star'
             AND lg.number = CAST(r.range AS INTEGER)) AS c
  FROM sd, range(1, 13) r)
"""


@register("rolling_star_frequency", with_draws("""
SELECT seq, draw_date, number, frequency FROM (
  SELECT seq, draw_date, number,
         CAST(sum(c) OVER (PARTITION BY number ORDER BY seq
                           ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS BIGINT) AS frequency
  FROM sgrid)
WHERE seq >= 50
""", _STAR_GRID))
def rolling_star_frequency(spark, sf_dir):
    return rolling_frequency(sequenced_draws(spark, sf_dir), STAR, 50)


@register("rolling_star_frequency_chunked", with_draws("""
SELECT seq, draw_date, number, frequency FROM (
  SELECT seq, draw_date, number,
         CAST(sum(c) OVER (PARTITION BY number ORDER BY seq
                           ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS BIGINT) AS frequency
  FROM sgrid)
WHERE seq >= 50
""", _STAR_GRID))
def rolling_star_frequency_chunked(spark, sf_dir):
    """The same rolling frequency with smaller chunks: the result does not depend on them."""
    return rolling_frequency(sequenced_draws(spark, sf_dir), STAR, 50, chunk=1000)


@register("star_indicator_counts", with_draws("SELECT seq, number, c AS cnt FROM sgrid", _STAR_GRID))
def star_indicator_counts(spark, sf_dir):
    """How often each star stands in each draw, zeros included."""
    return indicator_counts(sequenced_draws(spark, sf_dir), "seq", STAR, unique_key=True)


@register("lag_features", with_draws("""
SELECT t.seq, CAST(k.range AS INTEGER) AS lag, l.pool, l.position, l.number
FROM sd t, range(1, 6) k, lg l
WHERE t.seq >= 21 AND l.seq = t.seq - k.range
"""))
def lag_features(spark, sf_dir):
    return lag_long(sequenced_draws(spark, sf_dir))


_WIN_GRID = """
wgrid AS (
  SELECT sd.seq, dom.pool, dom.number, coalesce(h.c, 0) AS c
  FROM sd CROSS JOIN dom
  LEFT JOIN (SELECT seq, pool, number, count(*) AS c FROM lg GROUP BY 1, 2, 3) h
    ON h.seq = sd.seq AND h.pool = dom.pool AND h.number = dom.number),
wstat AS (
  SELECT seq, pool, number,
         CAST(coalesce(sum(c) OVER w, 0) AS BIGINT) AS frequency,
         CAST(coalesce(seq - max(CASE WHEN c > 0 THEN seq END) OVER w - 1, 21) AS INTEGER) AS recency
  FROM wgrid
  WINDOW w AS (PARTITION BY pool, number ORDER BY seq ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING))
"""


@register("window_frequency", with_draws("""
SELECT seq, pool, number, frequency FROM wstat WHERE seq >= 21
""", _WIN_GRID))
def window_frequency(spark, sf_dir):
    return window_stats(sequenced_draws(spark, sf_dir)).select("seq", "pool", "number", "frequency")


@register("window_recency", with_draws("""
SELECT seq, pool, number, recency FROM wstat WHERE seq >= 21
""", _WIN_GRID))
def window_recency(spark, sf_dir):
    return window_stats(sequenced_draws(spark, sf_dir)).select("seq", "pool", "number", "recency")


def _batched_history(spark, sf_dir):
    """All derived draws, added in three batches that each bring draws of every year."""
    draws = write_and_reread(load_draws(spark, sf_dir), "derived")
    path = scratch_path(spark, "history")
    batch = F.pmod(F.xxhash64("draw_number"), F.lit(100))
    for part in (batch < 60, batch.between(60, 97), batch > 97):
        append_draws(path, draws.where(part), DERIVED_ORDER)
    return path


@register("batched_sequence", with_draws("SELECT seq, draw_number, draw_date, part, ball_1, lucky_star_1 FROM sd"))
def batched_sequence(spark, sf_dir):
    """Numbers of draws that arrive in batches, late ones among them."""
    return read_history(spark, _batched_history(spark, sf_dir)).select(
        "seq", "draw_number", "draw_date", "part", "ball_1", "lucky_star_1")


@register("batched_windows", with_draws("""
SELECT seq, pool, number, frequency, recency FROM wstat WHERE seq >= 21
""", _WIN_GRID))
def batched_windows(spark, sf_dir):
    """Window frequency and recency, kept up to date while draws arrive in batches."""
    return stored_window_stats(spark, _batched_history(spark, sf_dir))


@register("multi_hot", with_draws("""
SELECT sd.seq, dom.pool, dom.number,
       CASE WHEN EXISTS (SELECT 1 FROM lg WHERE lg.seq = sd.seq AND lg.pool = dom.pool
                         AND lg.number = dom.number) THEN 1 ELSE 0 END AS present
FROM sd CROSS JOIN dom
"""))
def multi_hot(spark, sf_dir):
    return multi_hot_long(sequenced_draws(spark, sf_dir))


_FEATURE_SQL = """
fl AS (
  SELECT t.seq, (CAST(k.range AS INTEGER) - 1) * 7
           + CASE l.pool WHEN 'main' THEN l.position ELSE 5 + l.position END - 1 AS idx,
         CAST(l.number AS DOUBLE) AS value
  FROM sd t, range(1, 6) k, lng l
  WHERE t.seq >= 21 AND l.seq = t.seq - k.range),
fs AS (
  SELECT seq, 35 + (CASE pool WHEN 'main' THEN number - 1 ELSE 50 + number - 1 END) * 2 AS idx,
         CAST(frequency AS DOUBLE) AS value FROM wstat WHERE seq >= 21
  UNION ALL
  SELECT seq, 35 + (CASE pool WHEN 'main' THEN number - 1 ELSE 50 + number - 1 END) * 2 + 1,
         CAST(recency AS DOUBLE) FROM wstat WHERE seq >= 21)
"""


@register("feature_vector", with_draws("""
SELECT seq, CAST(idx AS INTEGER) AS idx, value FROM fl
UNION ALL SELECT seq, CAST(idx AS INTEGER), value FROM fs
""", _WIN_GRID, _FEATURE_SQL))
def feature_vector(spark, sf_dir):
    f = sliding_features(sequenced_draws(spark, sf_dir))
    return f.select("seq", F.posexplode("features").alias("idx", "value"))


@register("feature_targets", with_draws("""
SELECT sd.seq, dom.pool, dom.number,
       CASE WHEN EXISTS (SELECT 1 FROM lg WHERE lg.seq = sd.seq AND lg.pool = dom.pool
                         AND lg.number = dom.number) THEN 1 ELSE 0 END AS present
FROM sd CROSS JOIN dom WHERE sd.seq >= 21
"""))
def feature_targets(spark, sf_dir):
    return multi_hot_long(sequenced_draws(spark, sf_dir)).where(F.col("seq") >= start_index())


@register("class_weights", with_draws("""
SELECT pool, number, positives, total_rows,
       total_rows / (2.0 * positives) AS weight_pos,
       total_rows / (2.0 * (total_rows - positives)) AS weight_neg,
       (sum(total_rows) OVER (PARTITION BY pool) - sum(positives) OVER (PARTITION BY pool)) * 1.0
         / sum(positives) OVER (PARTITION BY pool) AS pool_pos_weight
FROM (
  SELECT dom.pool, dom.number,
         CAST(count(DISTINCT CASE WHEN lg.seq IS NOT NULL THEN sd.seq END) AS BIGINT) AS positives,
         CAST((SELECT count(*) FROM sd WHERE seq >= 21) AS BIGINT) AS total_rows
  FROM sd CROSS JOIN dom
  LEFT JOIN lg ON lg.seq = sd.seq AND lg.pool = dom.pool AND lg.number = dom.number
  WHERE sd.seq >= 21
  GROUP BY dom.pool, dom.number)
"""))
def class_weights_q(spark, sf_dir):
    """Balanced per-label weights and the pool positive weight over the training targets."""
    sd = sequenced_draws(spark, sf_dir)
    return class_weights(multi_hot_long(sd).where(F.col("seq") >= start_index()))


_BACKTEST_SQL = """
picks AS (
  SELECT seq, pool, number FROM (
    SELECT seq, pool, number,
           row_number() OVER (PARTITION BY seq, pool ORDER BY frequency DESC, number) AS r
    FROM wstat WHERE seq >= 21)
  WHERE r <= CASE pool WHEN 'main' THEN 5 ELSE 2 END)
"""


@register("backtest_hot_picks", with_draws("""
SELECT sd.seq,
       CAST(count(DISTINCT CASE WHEN p.pool = 'main' AND l.number IS NOT NULL THEN p.number END) AS INTEGER) AS main_matches,
       CAST(count(DISTINCT CASE WHEN p.pool = 'star' AND l.number IS NOT NULL THEN p.number END) AS INTEGER) AS star_matches
FROM sd JOIN picks p ON p.seq = sd.seq
LEFT JOIN lg l ON l.seq = p.seq AND l.pool = p.pool AND l.number = p.number
WHERE sd.seq >= 21
GROUP BY sd.seq
""", _WIN_GRID, _BACKTEST_SQL))
def backtest_hot_picks(spark, sf_dir):
    """Back-test: each draw's 5 + 2 hottest numbers of the previous 20 draws, scored
    against that draw (O57 per draw, O63)."""
    return backtest_window_picks(sequenced_draws(spark, sf_dir), "frequency")


@register("forest_scores")
def forest_scores(spark, sf_dir):
    """Per-label random-forest probability for the held-out last draw."""
    return fit_multilabel_forest(sliding_features(sequenced_draws(spark, sf_dir)))


@register("logistic_scores")
def logistic_scores(spark, sf_dir):
    """Per-label weighted logistic probability for the held-out last draw."""
    return fit_multilabel_logistic(sliding_features(sequenced_draws(spark, sf_dir)))


@register("logistic_shape", """
SELECT 'main' AS pool, CAST(50 AS BIGINT) AS labels, true AS in_range, CAST(1 AS BIGINT) AS draws
UNION ALL SELECT 'star', 12, true, 1
""")
def logistic_shape(spark, sf_dir):
    """Shape of the model scores: one probability in [0, 1] per label, for one draw."""
    p = F.col("probability")
    return logistic_scores(spark, sf_dir).groupBy("pool").agg(
        F.countDistinct("number").alias("labels"), F.every(p.between(0.0, 1.0)).alias("in_range"),
        F.countDistinct("seq").alias("draws"))


@register("logistic_balance", with_draws("""
SELECT pool, number, round(positives * ((sum(total_rows) OVER (PARTITION BY pool) - sum(positives) OVER (PARTITION BY pool)) * 1.0
         / sum(positives) OVER (PARTITION BY pool)), 2) AS predicted_weight
FROM (
  SELECT dom.pool, dom.number, count(DISTINCT CASE WHEN lg.seq IS NOT NULL THEN sd.seq END) AS positives,
         (SELECT count(*) - 1 FROM sd WHERE seq >= 21) AS total_rows
  FROM sd CROSS JOIN dom
  LEFT JOIN lg ON lg.seq = sd.seq AND lg.pool = dom.pool AND lg.number = dom.number
  WHERE sd.seq >= 21 AND sd.seq < (SELECT max(seq) FROM sd)
  GROUP BY dom.pool, dom.number)
"""))
def logistic_balance_q(spark, sf_dir):
    """Weight that the fitted model predicts for each label over all training rows (O67): at the optimum
    the weight of the positives, which SQL can count."""
    return logistic_balance(sliding_features(sequenced_draws(spark, sf_dir))).withColumn(
        "predicted_weight", F.round("predicted_weight", 2))


@register("ml_picks")
def ml_picks(spark, sf_dir):
    """Top 5 + 2 labels by forest probability for the next, unseen draw (O59, D3 next mode)."""
    scores = fit_multilabel_forest(sliding_features(sequenced_draws(spark, sf_dir), mode="next"),
                                   mode="next")
    return pick_top_k(scores, "probability")


@register("next_draw_features", with_draws("""
SELECT seq, CAST(idx AS INTEGER) AS idx, value FROM fl
UNION ALL SELECT seq, CAST(idx AS INTEGER), value FROM fs
""", """
nx AS (SELECT max(seq) + 1 AS t FROM sd)""", """
fl AS (
  SELECT nx.t AS seq, (CAST(k.range AS INTEGER) - 1) * 7
           + CASE l.pool WHEN 'main' THEN l.position ELSE 5 + l.position END - 1 AS idx,
         CAST(l.number AS DOUBLE) AS value
  FROM nx, range(1, 6) k, lng l WHERE l.seq = nx.t - k.range)""", """
st AS (
  SELECT dom.pool, dom.number, count(l.seq) AS f, max(l.seq) AS ms
  FROM dom CROSS JOIN nx
  LEFT JOIN lg l ON l.pool = dom.pool AND l.number = dom.number AND l.seq BETWEEN nx.t - 20 AND nx.t - 1
  GROUP BY dom.pool, dom.number)""", """
fs AS (
  SELECT nx.t AS seq, 35 + (CASE pool WHEN 'main' THEN number - 1 ELSE 50 + number - 1 END) * 2 AS idx,
         CAST(f AS DOUBLE) AS value FROM st, nx
  UNION ALL
  SELECT nx.t, 35 + (CASE pool WHEN 'main' THEN number - 1 ELSE 50 + number - 1 END) * 2 + 1,
         CAST(coalesce(nx.t - ms - 1, 21) AS DOUBLE) FROM st, nx)"""))
def next_draw_features(spark, sf_dir):
    """Feature vector of the unseen next draw from the latest 20 known draws (O52, D3 next mode)."""
    f = next_features(sequenced_draws(spark, sf_dir))
    return f.select("seq", F.posexplode("features").alias("idx", "value"))
