import pytest
from pyspark.sql import functions as F

from drawlake.operators.reconcile import QualityGateError
from drawlake.plans.job import JobConfig, run_draw_job
from drawlake.sources.html import (
    MAIN_SPAN_CLASS, STAR_SPAN_CLASS, html_table_rows, nav_links, page_manifest, parse_draw_table,
    scraped_rows_to_draws,
)
from drawlake.sources.files import read_scraped
from drawlake.streaming.incremental import latest_snapshot_id, read_latest, start_incremental_upsert
from tests.conftest import draws_df, random_draws


def _row(date, balls, stars, jackpot="£1,000", winners="0"):
    b = "".join(f'<span class="{MAIN_SPAN_CLASS}">{x}</span>' for x in balls)
    s = "".join(f'<span class="{STAR_SPAN_CLASS}">{x}</span>' for x in stars)
    return f"<tr><td>{date}</td><td>{b}{s}</td><td>{jackpot}</td><td>{winners}</td></tr>"


HEAD = "<thead><tr><th> Draw Date </th><th>Numbers</th><th>Jackpot</th><th>Winners</th></tr></thead>"
GOOD = ('<html><body><div class="table-responsive"><table>' + HEAD + "<tbody>"
        + _row("3 Mar 2031", [2, 4, 8, 16, 32], [1, 12])
        + _row("27 Feb 2031", [11, 12, 13, 14, 15], [6, 7], "£2,000", "1")
        + "<tr><td>24 Feb 2031</td><td>no numbers</td><td>x</td><td>0</td></tr>"
        + "<tr><td>short</td></tr>"
        + _row("20 Feb 2031", [1, 2, 3, 4, 5, 6, 7], [1])
        + "</tbody></table></div></body></html>")
NO_TABLE = "<html><body><p>nothing</p></body></html>"
NO_HEADER = '<div class="table-responsive"><table><tbody>' + _row("1 Jan 2020", [1, 2, 3, 4, 5], [1, 2]) + "</tbody></table></div>"
MISSING_COL = ('<div class="table-responsive"><table><thead><tr><th>Draw Date</th><th>Jackpot</th></tr></thead>'
               "<tbody></tbody></table></div>")


def test_parse_draw_table_cases():
    reason, rows = parse_draw_table(GOOD)
    assert reason is None and len(rows) == 5
    assert rows[0]["balls"] == ["2", "4", "8", "16", "32"] and rows[0]["stars"] == ["1", "12"]
    assert rows[4]["reason"] == "expected 5 + 2 numbers, found 7 + 1" and len(rows[4]["balls"]) == 7
    assert rows[2]["reason"] == "no numbers" and rows[3]["reason"] == "short row"
    assert parse_draw_table(NO_TABLE)[0] == "no results table"
    assert parse_draw_table(NO_HEADER)[0] == "no table header"
    assert parse_draw_table(MISSING_COL)[0].startswith("missing header")


def test_html_table_rows_job(spark):
    pages = spark.createDataFrame([(1, "u1", GOOD), (2, "u2", NO_TABLE), (3, "u3", None)],
                                  "page_id long, url string, html string")
    rows = html_table_rows(pages).collect()
    good = [r for r in rows if r._reason is None]
    assert len(good) == 2 and {r.page_id for r in rows} == {1, 2, 3}
    draws = scraped_rows_to_draws(html_table_rows(pages)).orderBy("draw_date").collect()
    assert [str(d.draw_date) for d in draws] == ["2031-02-27", "2031-03-03"] and draws[1].lucky_star_2 == "12"


def test_left_out_end_tags():
    cells = "<tr><td>3 Mar 2031<td>" + "".join(
        f'<span class="{MAIN_SPAN_CLASS}">{n}</span>' for n in (1, 2, 3, 4, 5)) + "".join(
        f'<span class="{STAR_SPAN_CLASS}">{n}</span>' for n in (1, 2)) + "<td>x<td>0"
    page = '<p>a<p>b<div class="table-responsive"><table><thead><tr><th>Draw Date<th>N<th>Jackpot<th>Winners<tbody>' + cells * 2
    reason, rows = parse_draw_table(page)
    assert reason is None and [(r["reason"], r["draw_date"], r["balls"], r["winners"]) for r in rows] == \
        [(None, "3 Mar 2031", ["1", "2", "3", "4", "5"], "0")] * 2


def test_deep_pages_do_not_fail_the_job(spark):
    deep = GOOD.replace("<table>", "<p>" * 3000 + "<b>" * 3000 + "<table>", 1)
    nested = '<div class="table-responsive">' + "<div>" * 5000 + "x"
    pages = spark.createDataFrame([(1, deep), (2, nested), (3, GOOD)], "page_id long, html string")
    rows = html_table_rows(pages).collect()
    assert {r.page_id for r in rows} == {1, 2, 3}
    assert len([r for r in rows if r.page_id == 3 and r._reason is None]) == 2
    assert [r._reason for r in rows if r.page_id == 2] == ["no results table"]


def test_nav_links_and_manifest(spark):
    pages = spark.createDataFrame([
        (1, "https://a.example.com/x?y=1", '<ul><li><a href="/p">p</a></li><li><a href="/q">q</a></li></ul>'),
        (2, "https://a.example.com/draw-history/year/2004/", "<p/>")], "page_id long, url string, html string")
    links = sorted((r.page_id, r.link_idx, r.href) for r in nav_links(pages).collect())
    assert links == [(1, 0, "/p"), (1, 1, "/q")]
    m = page_manifest(pages, [2004, 2005, 2006]).collect()
    assert sorted(r.year for r in m) == [2005, 2006]
    assert all(r.url.startswith("https://a.example.com/draw-history/year/") for r in m)


def test_draw_job_end_to_end(spark, tmp_path):
    rows = random_draws(120, unique_dates=True)
    target = draws_df(spark, rows[:100]).withColumn("jackpot", F.lit("old")).withColumn("winners", F.lit(0))
    updates = draws_df(spark, rows[90:]).withColumn("jackpot", F.lit("new"))
    copy = draws_df(spark, rows[:100])
    cfg = JobConfig(output_dir=str(tmp_path / "out"), target=target, updates=updates,
                    reference_copy=copy, strategy="most_overdue", export_format="json",
                    gate_limits={"left_only": 100, "right_only": 100, "duplicate": 0, "mismatched": 0})
    res = run_draw_job(spark, cfg)
    assert res["gate"]["passed"] and res["summary"]["left_only"] == 20
    hist = spark.read.parquet(res["outputs"]["draw_history"])
    assert hist.count() == 120
    # further columns survive the merge, and numbers follow the date
    assert {(r.jackpot, r.winners, r["count"]) for r in hist.groupBy("jackpot", "winners").count().collect()} == \
        {("old", 0, 90), ("new", 0, 10), ("new", None, 20)}
    byday = [r.draw_number for r in hist.orderBy("draw_date").collect()]
    assert byday == list(range(1, 121))
    assert spark.read.json(res["outputs"]["export"]).count() == 120
    picks = spark.read.parquet(res["outputs"]["picks"]).collect()
    assert sorted(r.pool for r in picks) == ["main"] * 5 + ["star"] * 2
    with pytest.raises(ValueError):
        JobConfig(output_dir="x", target=target, strategy="astrology").validate()


def test_failed_gate_publishes_nothing(spark, tmp_path):
    rows = random_draws(40, unique_dates=True)
    cfg = JobConfig(output_dir=str(tmp_path / "out"), target=draws_df(spark, rows), reference_copy=draws_df(spark, rows[:30]))
    with pytest.raises(QualityGateError):
        run_draw_job(spark, cfg)
    assert not (tmp_path / "out").exists()


def test_scraped_csv_to_picks(spark, tmp_path):
    lines = ["draw_date,ball_1,ball_2,ball_3,ball_4,ball_5,lucky_star_1,lucky_star_2,jackpot,winners"]
    lines += [",".join([r[1], *map(str, r[2:]), '"£1,000"', str(i)]) for i, r in enumerate(random_draws(60, unique_dates=True))]
    (tmp_path / "s.csv").write_text("\n".join(lines))
    res = run_draw_job(spark, JobConfig(output_dir=str(tmp_path / "out"), updates=read_scraped(spark, str(tmp_path / "s.csv")),
                                        strategy="logistic"))
    hist = spark.read.parquet(res["outputs"]["draw_history"]).orderBy("draw_date").collect()
    assert [r.draw_number for r in hist] == list(range(1, 61)) and hist[5].winners == "5" and hist[5].jackpot == "£1,000"
    picks = spark.read.parquet(res["outputs"]["picks"]).collect()
    assert sorted(r.pool for r in picks) == ["main"] * 5 + ["star"] * 2 and all(0 <= r.probability <= 1 for r in picks)


def test_incremental_upsert_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "a.csv").write_text("k,v\n1,a\n2,b\n")
    table, ckpt = str(tmp_path / "table"), str(tmp_path / "ckpt")
    q = start_incremental_upsert(spark, str(src), "k int, v string", table, ckpt, ["k"],
                                 options={"header": "true"})
    q.awaitTermination(120)
    (src / "b.csv").write_text("k,v\n2,B\n3,c\n")
    q = start_incremental_upsert(spark, str(src), "k int, v string", table, ckpt, ["k"],
                                 options={"header": "true"})
    q.awaitTermination(120)
    got = {r.k: r.v for r in read_latest(spark, table).collect()}
    assert got == {1: "a", 2: "B", 3: "c"}
    # a new checkpoint reads every file again, as batch 0: its snapshot comes after the others
    (src / "c.csv").write_text("k,v\n4,d\n4,e\n")
    q = start_incremental_upsert(spark, str(src), "k int, v string", table, str(tmp_path / "other"), ["k"],
                                 options={"header": "true"})
    q.awaitTermination(120)
    assert latest_snapshot_id(spark, table) == 3
    rows = read_latest(spark, table).collect()
    assert {r.k for r in rows} == {1, 2, 3, 4} and len(rows) == 4 and {r.v for r in rows if r.k == 4} == {"e"}


def test_draw_job_weekday_filter(spark, tmp_path):
    import datetime as dt
    rows = random_draws(70, unique_dates=True)
    cfg = JobConfig(output_dir=str(tmp_path / "out"), target=draws_df(spark, rows),
                    strategy="least_frequent", weekday="tuesday")
    res = run_draw_job(spark, cfg)
    tuesdays = [r for r in rows if dt.date.fromisoformat(r[1]).weekday() == 1]
    freq = spark.read.parquet(res["outputs"]["frequency"])
    assert freq.where("pool = 'main'").groupBy().sum("frequency").first()[0] == 5 * len(tuesdays)
    picks = spark.read.parquet(res["outputs"]["picks"]).collect()
    assert sorted(r.pool for r in picks) == ["main"] * 5 + ["star"] * 2
