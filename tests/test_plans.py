"""What the physical plans must and must not contain."""

import re

import pytest

from reelpress.operators import dedup as D
from reelpress.plans import article_flow as A
from reelpress.plans.catalog import CATALOG
from reelpress.plans.tables import Tables
from reelpress.sinks import files as W

FOLDER = "/root/testdata/sf0.001"
WRITES = {
    "users_from_delimited_file", "ratings_from_delimited_file", "items_from_latin1_file",
    "articles_from_json_files", "one_stock_of_a_stage", "incremental_articles",
    "deduplicated_event_stream", "factor_similar_items", "factor_co_rated_items",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n in CATALOG if n not in WRITES])
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(CATALOG[name].run(spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    for python in ("MapInPandas", "BatchEvalPython", "ArrowEvalPython"):
        assert python not in text


@pytest.mark.parametrize(
    "name",
    ["article_sentiment_records", "sentiment_by_keyword", "score_distribution_by_keyword", "sentiment_by_source"],
)
def test_scores_read_documents_once(spark, name):
    assert plan(CATALOG[name].run(spark, FOLDER)).count("documents.parquet") == 1


def test_first_per_key_limits_before_the_shuffle(spark):
    t = Tables(spark, FOLDER)
    df = t.articles.select("seq", "source", "url")
    for selected in (
        D.first_per_key(df, ["url"], ["seq"]),
        D.cap_per_key(df, ["source"], ["seq"], 2),
        D.first_per_key(df, ["url"], ["seq"], last=True),
    ):
        text = plan(selected)
        partial = text.index("Partial")
        assert "WindowGroupLimit" in text[partial - 200 : partial]
        assert text.index("Exchange hashpartitioning") < partial  # printed top down


def test_cleaning_runs_once(spark):
    text = plan(CATALOG["unique_articles"].run(spark, FOLDER))
    # whitespace, disallowed, repeats and three phrases, for title and content
    assert text.count("regexp_replace") == 12


@pytest.mark.parametrize(
    "name, table, columns",
    [
        ("mean_age_by_occupation", "customer", {"c_custkey", "c_mktsegment"}),
        ("articles_per_keyword", "documents", {"lang"}),
        ("top_rated_items", "lineitem", {"l_orderkey", "l_partkey", "l_quantity"}),
    ],
)
def test_scans_read_only_what_is_needed(spark, name, table, columns):
    text = plan(CATALOG[name].run(spark, FOLDER))
    scan = next(line for line in text.splitlines() if f"{table}.parquet" in line)
    fields = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert {f.split(":")[0] for f in fields.split(",")} == columns


def test_filters_reach_the_scan(spark):
    t = Tables(spark, FOLDER)
    text = plan(t.articles.filter("keyword = 'fr'").select("seq"))
    assert "EqualTo(lang,fr)" in text


def test_aggregates_are_partial_first(spark):
    for name in ("rating_stats_by_item", "run_outcomes", "sentiment_by_keyword"):
        assert "partial_" in plan(CATALOG[name].run(spark, FOLDER))


def test_one_exchange_for_selection_and_history(spark):
    t = Tables(spark, FOLDER)
    seen = t.delivered.select("content_hash")
    df = A.process_batch(A.prepare_articles(t.articles), seen)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        above_join = plan(df).split("LeftAnti")[1]
        batch = above_join.split("FileScan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert batch.count("Exchange") == 1


def test_bucketed_history_is_not_exchanged(spark, tmp_path):
    t = Tables(spark, FOLDER)
    name = "delivered_keys"
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    keys = t.delivered.select("content_hash")
    path = f"{tmp_path}/{name}"
    spark.sql(
        f"CREATE TABLE {name} (content_hash STRING) USING parquet"
        f" CLUSTERED BY (content_hash) SORTED BY (content_hash) INTO 8 BUCKETS LOCATION '{path}'"
    )
    W.save_bucketed(keys, name, ["content_hash"], 8)
    df = A.process_batch(A.prepare_articles(t.articles), spark.table(name))
    expected = A.process_batch(A.prepare_articles(t.articles), keys).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        assert plan(df).count("Exchange") == 1
        assert df.count() == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.sql(f"DROP TABLE {name}")
