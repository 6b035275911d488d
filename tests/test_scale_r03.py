"""What a query does per row: no work twice, no model from a part of the rows, nothing that only grows slower by a cap."""

import contextlib
import io
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from drawlake.llm import quality
from drawlake.operators import logistic as L
from drawlake.operators.features import multi_hot_long, sliding_features, window_stats
from drawlake.operators.picks import backtest_window_picks, random_tickets
from drawlake.operators.sequence import global_sequence
from drawlake.sources import html as H
from drawlake.streaming import history
from tests.conftest import draws_df, random_draws


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_weak_labels_share_one_gram_matrix(spark):
    """One matrix of all rows and one of each label's positives give every step of labels near their rates."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 4))
    y = (rng.random((600, 3)) < 0.3 + 0.05 * (x[:, :3] > 0)).astype(float)
    model = L.fit(spark.createDataFrame([(x[k].tolist(), y[k].tolist()) for k in range(600)], "features array<double>, y array<double>"),
                  [2.0, 1.0, 3.0])
    assert model.scans == 0
    z = np.concatenate([(x - x.mean(axis=0)) / x.std(axis=0), np.ones((600, 1))], axis=1)
    ridge = np.array([0.06] * 4 + [0.0])
    for j, weight in enumerate((2.0, 1.0, 3.0)):
        p = 1 / (1 + np.exp(-z @ model.beta[j]))
        assert np.abs(z.T @ (np.where(y[:, j] == 1, weight, 1.0) * (p - y[:, j])) + ridge * model.beta[j]).max() < 1e-6


@pytest.mark.parametrize("values", [[[1, -5], [100, 0]], [[1000, 2], [0, 7]], [[0.5, 2.25], [1e5, -1]], [[0.1, 1e300], [2, 3]]])
def test_packed_rows_come_back_exactly(values):
    column = L.packed(np.array(values, dtype=float))
    assert L.unpacked(column, 2).tolist() == values
    assert L.unpacked(column.slice(1), 2).tolist() == values[1:]


def test_quality_counts_all_labelled_documents(spark):
    """More trusted documents than a sample held: all are trusted, so both multinomials are one."""
    frame = spark.range(12_000).select(F.col("id").alias("doc_id"), F.lit("one two three").alias("text"))
    model = quality.fit(frame, frame.select("doc_id", F.lit(1).alias("quality")), buckets=64)
    assert set(model.log_ratio) == {0.0}


def test_class_quantiles_are_exact(spark):
    rnd = random.Random(2)
    rows = [(k % 3 % 2, rnd.choice([rnd.random(), 0.25]), k) for k in range(700)]
    got = quality.class_quantiles(spark.createDataFrame(rows, "quality int, score double, doc_id long"), {1: 0.005, 0: 0.5})
    for k, q in ((1, 0.005), (0, 0.5)):
        assert got[k] == pytest.approx(np.quantile([s for c, s, _ in rows if c == k], q), abs=1e-12)


PIECES = ['<div class="table-responsive">', "<table>", "<thead>", "<tr>", "<th>Draw Date", "<th>Jackpot</th>", "<th>Winners", "<tbody>", "<td>", "</td>",
          "</tr>", "</table>", "</div>", "<p>", "<br>", "&pound;5", "&amp", "&lt;b&gt;", '<span class="ball-euromillions" id="x">7</span>', "\n",
          '<SPAN CLASS="ball-euromillions-lucky-star">3</SPAN>', "<ul><li>q<li>r</ul>", "</td >", "<script>", "<!-- c -->", '<a href="x&amp;y">', "<img/>", "< b"]


def flat(node):
    out = [(node.tag, dict(node.attrs))]
    for c in node.children:
        if isinstance(c, str) and isinstance(out[-1], str):
            out[-1] += c
        else:
            out.append(c if isinstance(c, str) else flat(c))
    return out


def test_plain_pages_are_read_as_the_library_reads_them():
    rnd, plain = random.Random(4), 0
    for k in range(3000):
        page = "".join(rnd.choice(PIECES if k % 2 else PIECES[:23]) for _ in range(rnd.randint(0, 40)))
        quick, slow = H._TreeBuilder(), H._TreeBuilder()
        if H._fed_plain(quick, page):
            slow.feed(page)
            slow.close()
            assert flat(quick.root) == flat(slow.root)
            plain += 1
    assert 1500 <= plain < 3000


def test_pages_are_built_once(spark):
    pages = spark.range(50).groupBy(F.col("id").alias("page_id")).agg(F.concat_ws("", F.collect_list(F.lit("<p>x"))).alias("html"))
    found = H.html_table_rows(pages)
    assert plan(found).count("collect_list(") <= 2 and "Union" not in plan(found)
    assert found.where("_reason = 'no results table'").count() == 50


def test_windows_and_cells_without_expressions_per_cell(spark):
    sd = global_sequence(draws_df(spark, random_draws(40)), ["draw_date", "draw_number"])
    for df in (window_stats(sd, include_current=True), sliding_features(sd), multi_hot_long(sd), backtest_window_picks(sd)):
        assert "lambdafunction" not in plan(df) and "Pandas" not in plan(df)


def test_tickets_are_sorted_without_an_expression_per_comparison(spark):
    assert "array_sort(" not in plan(random_tickets(spark.range(5).withColumnRenamed("id", "ticket_id"))).replace("sort_array(", "")


def test_first_batch_is_placed_without_python(spark):
    batch = draws_df(spark, random_draws(10))
    assert "Arrow" not in plan(history._placed(batch, [], ["draw_date", "draw_number"], 100))
