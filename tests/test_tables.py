import re
"""Merges, runs, reports, checks."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reelpress import schemas
from reelpress.operators import merge as M
from reelpress.operators import quality as Q
from reelpress.operators import reports as R
from reelpress.operators import runs as W


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_insert_ignore(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame(
        [(1, "a", 9), (2, "b", 5), (3, "b", 6), (4, None, 7), (5, "", 8)], "seq int, k string, v int"
    )
    once = M.insert_ignore(old, new, ["k"], ["seq"])
    assert rows(once, "v") == [("a", 1), ("b", 5), (None, 7), ("", 8)]
    again = M.insert_ignore(once, new.filter("k is not null"), ["k"], ["seq"])
    assert rows(again, "v") == rows(once, "v")
    assert M.append(old, old).count() == 2


def test_upsert_keeps_created_at(spark):
    schema = "k string, d string, v int, s string, created_at string"
    old = spark.createDataFrame([("a", "1", 1, "x", "t0"), ("z", "1", 2, None, "t0")], schema)
    new = spark.createDataFrame(
        [(1, "a", "1", 5, "y", "t1"), (2, "a", "1", 6, None, "t2"), (3, "b", "1", 7, "q", "t1")],
        "seq int, " + schema,
    )
    assert rows(M.upsert(old, new, ["k", "d"], ["seq"])) == [
        ("a", "1", 6, None, "t0"), ("b", "1", 7, "q", "t1"), ("z", "1", 2, None, "t0"),
    ]


def test_retain(spark):
    now = dt.datetime(2024, 1, 8)
    df = spark.createDataFrame(
        [("a", dt.datetime(2024, 1, 1)), ("a", dt.datetime(2023, 12, 31, 23)), ("a", None),
         ("b", now), (None, now)],
        "keyword string, created_at timestamp",
    )
    left = M.retain(df, M.recent_with_keyword(["a"], F.lit(now)))
    assert left.count() == 4 and left.filter("created_at = '2024-01-01'").count() == 0
    assert M.retain(df, F.lit(True)).count() == 0
    runs = df.withColumn("run_id", F.lit("x_pipeline_run_1"))
    kept = M.retain(runs, M.recent_run_like("%pipeline_run_%", F.lit(now)))
    assert kept.count() == 2


def test_run_log(spark):
    t = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    events = spark.createDataFrame(
        [("r1", t[0], "RUNNING", "p0", None), ("r1", t[1], "COMPLETED", None, 5),
         ("r2", t[2], "RUNNING", None, 0)],
        "run_id string, event_time timestamp, status string, path string, analyzed int",
    )
    got = {r.run_id: r for r in M.run_log(events).collect()}
    assert (got["r1"].status, got["r1"].path, got["r1"].analyzed) == ("COMPLETED", "p0", 5)
    assert (got["r1"].start_time, got["r1"].end_time) == (t[0], t[1])
    assert got["r2"].status == "RUNNING" and got["r2"].end_time is None


def test_mark_processed(spark):
    tracked = spark.createDataFrame([("s", "u1", "old")], "stock_name string, url string, processed_at string")
    done = spark.createDataFrame([("s", "u1"), ("s", "u2"), ("s", "u2"), ("t", "u1")], "stock_name string, url string")
    assert rows(M.mark_processed(tracked, done, F.lit("now"))) == [
        ("s", "u1", "old"), ("s", "u2", "now"), ("t", "u1", "now"),
    ]


def test_outcomes(spark):
    tasks = spark.createDataFrame(
        [("a", 1, "success"), ("b", 1, "success"), ("b", 2, "failed"), ("c", 1, None)],
        "run_id string, task_id int, state string",
    )
    got = {r.run_id: (r.success_rate, r.status) for r in W.run_outcomes(tasks).collect()}
    assert got == {"a": (100.0, "success"), "b": (50.0, "partial_success"), "c": (0.0, "failed")}
    assert rows(W.failed_tasks(tasks)) == [("b", 2), ("c", 1)]
    none = spark.createDataFrame([(0, 0, 0)], "successful_tasks int, failed_tasks int, total_tasks int")
    row = W.with_outcome(none).first()
    assert (row.success_rate, row.status) == (0.0, "success")


@pytest.mark.parametrize("minutes, fresh", [(59, True), (60, True), (61, False), (-30, True)])
def test_freshness(spark, minutes, fresh):
    now = dt.datetime(2024, 1, 1, 12)
    last = now - dt.timedelta(minutes=minutes)
    runs = spark.createDataFrame(
        [("p", last, "success", True), ("p", last + dt.timedelta(minutes=1), "failed", True),
         ("p", last - dt.timedelta(minutes=5), "success", True), ("q", now, "failed", True),
         ("r", last, "success", False)],
        "pipeline string, ts timestamp, state string, task boolean",
    )
    got = {r.pipeline: r.is_fresh for r in W.latest_success(runs, F.lit(now), task_ok="task").collect()}
    assert got == {"p": fresh, "r": False}


def test_nearest_success(spark):
    day = dt.datetime(2024, 1, 1)
    at = lambda m: day + dt.timedelta(minutes=m)
    runs = spark.createDataFrame(
        [(1, "k", at(60)), (2, "k", at(121)), (3, "k", at(45)), (4, "x", at(60))],
        "id int, k string, ts timestamp",
    )
    upstream = spark.createDataFrame(
        [("k", at(0)), ("k", at(30)), ("k", at(60)), ("x", at(61))], "k string, ts timestamp"
    )
    found = W.nearest_success(runs, upstream, "k", "id")
    got = {r.id: r.upstream_ts for r in found.collect()}
    assert got == {1: at(60), 2: None, 3: at(30), 4: None}


def test_nearest_success_of_one_busy_key(spark):
    rng = random.Random(4)
    day = dt.datetime(2024, 1, 1)
    moments = [day + dt.timedelta(seconds=rng.randrange(200_000)) for _ in range(1200)]
    keys = ["busy" if rng.random() < 0.9 else rng.choice(["a", None]) for _ in moments]
    rows = list(zip(range(1200), keys, moments, strict=True))
    runs = spark.createDataFrame(rows[:600], "id int, k string, ts timestamp")
    upstream = spark.createDataFrame([r[1:] for r in rows[600:700]], "k string, ts timestamp")
    got = {r.id: r.upstream_ts for r in W.nearest_success(runs, upstream, "k", "id", max_age_hours=2).collect()}
    for i, k, at in rows[:600]:
        near = max((t for _, q, t in rows[600:700] if q == k and t <= at), default=None)
        want = near if near and at - near <= dt.timedelta(hours=2) else None
        assert got[i] == want


def test_rollup_and_manifest(spark):
    stocks = spark.createDataFrame([("a",), ("b",)], "stock string")
    results = spark.createDataFrame([("a", 2, None), ("a", 3, None)], "stock string, n int, m int")
    assert rows(W.rollup_entities(stocks, results, "stock", ["n", "m"])) == [(2, 1, 5, 0)]
    articles = spark.createDataFrame(
        [("b1", 2, "p2"), ("b1", 1, None), ("b1", 3, ""), ("b1", 4, "p4")], "batch string, seq int, path string"
    )
    assert rows(W.batch_manifest(articles, "batch", "path", "seq")) == [("b1", 4, 2, 2, "p2")]
    assert rows(W.batch_paths(articles, "batch", "path")) == [("b1", "p2"), ("b1", "p4")]
    counters = W.stage_counters(articles, {"all": F.lit(True), "with_path": F.col("path") != ""})
    assert rows(counters) == [(4, 2)]


def test_reports(spark):
    articles = spark.createDataFrame([("k", "s1"), ("k", "s2"), (None, "s2")], "keyword string, source string")
    scores = spark.createDataFrame([(1,)], "x int")
    aggregates = spark.sql(
        "SELECT 'k' AS keyword, DATE'2024-01-01' AS date, CAST(0.5 AS DECIMAL(5,3)) AS average_score, 1 AS article_count"
        " UNION ALL SELECT 'k', DATE'2024-01-02', CAST(0.25 AS DECIMAL(5,3)), 4"
    )
    got = {(r.section, r.key): r.value for r in R.corpus_report(articles, scores, aggregates).collect()}
    assert got == {
        ("total", "articles"): "3", ("total", "sentiment_scores"): "1",
        ("total", "aggregate_scores"): "2", ("keyword_distribution", "k"): "2",
        ("keyword_distribution", None): "1", ("source_distribution", "s1"): "1",
        ("source_distribution", "s2"): "2", ("latest_score", "k"): "0.250",
        ("latest_article_count", "k"): "4",
    }
    assert [tuple(r) for r in R.count_by(articles, "source").collect()] == [("s2", 2), ("s1", 1)]
    df = spark.createDataFrame([(g, i) for g in "dbca" for i in range(5)], "g string, i int")
    assert rows(R.head_per_group(df, ["g"], ["i"], 2, 2)) == [("a", 0), ("a", 1), ("b", 0), ("b", 1)]
    keys = spark.createDataFrame([("raw/a",), ("raw/b",), ("done/a",)], "key string")
    assert rows(R.objects_by_stage(keys)) == [("done", 1, "done/a"), ("raw", 2, "raw/b")]
    summary = R.presence_summary(keys, keys.filter("key = 'raw/a'"), "key")
    assert rows(R.presence_totals(summary)) == [(1, 3)]


def test_checks(spark):
    df = spark.createDataFrame([("a", 1, ""), ("a", None, None), (None, 2, "x"), (None, 2, "x")], "k string, v int, p string")
    assert rows(Q.check_not_null(df, ["k", "v"])) == [("k", 2), ("v", 1)]
    assert rows(Q.check_not_blank(df, ["p"])) == [("p", 2)]
    assert rows(Q.check_unique(df, ["k"])) == [("a", 2)]
    parent = spark.createDataFrame([("b",)], "id string")
    assert rows(Q.check_foreign_key(df, "k", parent, "id")) == [("a", 2)]
    assert Q.is_empty_batch(df.filter("false")) and not Q.is_empty_batch(df)
    tracking = spark.createDataFrame(
        [("s", "u", None), ("s", "u", None), (None, "u", None)], schemas.URL_TRACKING_TABLE.schema
    )
    assert dict(rows(Q.check_table(tracking, schemas.URL_TRACKING_TABLE))) == {
        "not_null stock_name": 1, "not_null url": 0, "unique stock_name,url": 1,
    }
    assert set(schemas.RESULT_TABLES) == {
        "articles", "sentiment_scores", "aggregate_scores", "pipeline_runs", "url_tracking",
    }


def test_carried_forward_by_brute_force(spark, monkeypatch):
    """With three places to a window every level of the tree is used."""
    monkeypatch.setattr(W, "FAN", 3)
    rng = random.Random(5)
    places = {k: sorted(rng.sample(range(-13, 13), 14)) for k in ("a", "b", None)}
    rows = [(k, p, rng.choice([None, None, p * 10])) for k, found in places.items() for p in found]
    df = spark.createDataFrame(rows, "k string, place long, value long")
    want = set()
    for k, found in places.items():
        values = {p: v for key, p, v in rows if key == k}
        for p in found:
            before = [values[q] for q in found if q < p and values[q] is not None]
            want |= {(k, p, before[-1])} if before else set()
    got = W.carried_forward(df, "k", "place", "value")
    assert {tuple(r) for r in got.collect()} == want
    text = got._jdf.queryExecution().optimizedPlan().toString()
    windows = re.findall(r"windowspecdefinition\(k#\d+, _p\d", text)
    assert windows and len(windows) == text.count("windowspecdefinition(k#")
