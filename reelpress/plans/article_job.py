"""The article flow as one job: raw rows and the result tables in, the tables' next version out.

extract -> drop URLs tracked for the stock -> attach content -> clean and check length -> drop
known hashes -> score -> articles (insert, conflicts ignored), scores (append), aggregates
(upsert), URL tracking (insert), run log (append) -> report.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelpress import schemas
from reelpress.operators import merge as M
from reelpress.operators.sentiment import sentiment_by_key, sentiment_records
from reelpress.operators.sketch import unseen_urls
from reelpress.plans import article_flow as A
from reelpress.sinks.files import replace_partitions, write_parquet
from reelpress.sources.files import empty, read_parquet


#: a run's line in its log
RUN_LINE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("event_time", T.TimestampType()),
        T.StructField("status", T.StringType()),
        T.StructField("articles_extracted", T.IntegerType()),
        T.StructField("articles_analyzed", T.IntegerType()),
    ]
)


class ArticleTables(NamedTuple):
    articles: DataFrame
    scores: DataFrame
    aggregates: DataFrame
    tracking: DataFrame

    @classmethod
    def empty(cls, spark: SparkSession) -> ArticleTables:
        specs = (
            schemas.ARTICLES_TABLE, schemas.SENTIMENT_SCORES_TABLE,
            schemas.AGGREGATE_SCORES_TABLE, schemas.URL_TRACKING_TABLE,
        )
        return cls(*(empty(spark, spec.schema) for spec in specs))


def new_articles(
    raw: DataFrame,
    tracking: DataFrame,
    known: DataFrame,
    contents: DataFrame | None = None,
    order: str = "seq",
    **prepare,
) -> tuple[DataFrame, DataFrame]:
    """URLs extracted by this run, and its new articles, cleaned and once per hash.

    ``raw`` has stock_name, url, title and content, ``known`` the content_hash of all articles.
    """
    extracted = unseen_urls(raw, tracking, order=[order])
    full = extracted if contents is None else A.attach_content(extracted, contents)
    return extracted, A.process_batch(A.prepare_articles(full, **prepare), known, order)


def next_tables(
    tables: ArticleTables,
    extracted: DataFrame,
    records: DataFrame,
    now: Column,
    run_date: Column,
    path: Column | None = None,
) -> ArticleTables:
    """The tables after a run with these scored records."""
    by_keyword = sentiment_by_key(records)
    where = F.lit(None).cast("string") if path is None else path
    aggregates = A.aggregate_rows(by_keyword, run_date, where, now)
    return ArticleTables(
        M.insert_ignore(tables.articles, A.article_rows(records, now), ["article_hash"], ["url"]),
        M.append(tables.scores, A.score_rows(records, now)),
        upsert_date(tables.aggregates, aggregates, run_date),
        M.mark_processed(tables.tracking, extracted, now),
    )


def upsert_date(existing: DataFrame, new: DataFrame, date: Column) -> DataFrame:
    """Upsert by keyword and date of rows of one date: rows of other dates are not joined."""
    same = F.coalesce(F.col("date") == date, F.lit(False))
    merged = M.upsert(existing.filter(same), new, ["keyword", "date"], ["created_at"])
    return existing.filter(~same).unionByName(merged)


def run_articles(
    raw: DataFrame,
    tables: ArticleTables,
    lexicon: DataFrame,
    now: Column,
    run_date: Column,
    contents: DataFrame | None = None,
    order: str = "seq",
    **prepare,
) -> ArticleTables:
    """The whole flow as one lazy plan per table."""
    known = tables.articles.select(F.col("article_hash").alias("content_hash"))
    extracted, fresh = new_articles(raw, tables.tracking, known, contents, order, **prepare)
    records = sentiment_records(fresh, lexicon, now)
    return next_tables(tables, extracted, records, now, run_date)


def run_article_job(
    spark: SparkSession,
    raw: DataFrame,
    root: str,
    version: int,
    lexicon: DataFrame,
    now: Column,
    run_date: Column,
    contents: DataFrame | None = None,
    **options,
) -> DataFrame:
    """One run over the tables below ``root``; returns its line of the run log.

    New articles are scored once and written; the tables follow from what was written, URL tracking last.
    Articles, scores and tracking grow by a directory per ``version`` (repeating a version replaces
    it), of aggregates only the dates of the run are rewritten. The line of the run log makes a version count:
    it is taken away first and written at the end, so what a failed run left behind is read by no later one, and
    its URLs come again.
    """
    root = root.rstrip("/")
    earlier = lambda name, spec: complete_rows(spark, root, name, spec.schema, version)
    articles = earlier("articles", schemas.ARTICLES_TABLE)
    tracking = earlier("url_tracking", schemas.URL_TRACKING_TABLE)
    known = articles.select(F.col("article_hash").alias("content_hash"))
    extracted, fresh = new_articles(raw, tracking, known, contents, **options)

    def written(df: DataFrame, name: str) -> DataFrame:
        path = f"{root}/{name}/version={version}"
        write_parquet(df, path)
        return spark.read.schema(df.schema).parquet(path)

    written(empty(spark, RUN_LINE), "run_events")
    records = written(sentiment_records(fresh, lexicon, now), "records")
    written(A.article_rows(records, now), "articles")
    written(A.score_rows(records, now), "scores")
    # what earlier runs of the same date scored counts too, so a date may come in several runs
    before = complete_rows(spark, root, "records", records.schema, version)
    of_date = before.filter(F.to_date("analysis_timestamp") == run_date).unionByName(records)
    place = F.lit(f"{root}/records")
    aggregates = A.aggregate_rows(sentiment_by_key(of_date), run_date, place, now)
    kept = read_parquet(spark, f"{root}/aggregates", schemas.AGGREGATE_SCORES_TABLE.schema)
    of_run = kept.filter(F.col("date") == run_date)
    merged = M.upsert(of_run, aggregates, ["keyword", "date"], ["created_at"])
    # a row of this job that no complete run accounts for is what a failed one left
    stale = (F.col("s3_sentiment_data_path") == place) & F.col("_counted").isNull()
    counted = aggregates.select("keyword", F.lit(True).alias("_counted"))
    merged = merged.join(counted, "keyword", "left").filter(~F.coalesce(stale, F.lit(False)))
    # the date read is the date replaced, so it is written beside the table first
    staged = written(merged.select(*kept.columns), "aggregates_of_runs")
    replace_partitions(staged, f"{root}/aggregates", ["date"])
    marked = extracted.select("stock_name", "url").withColumn("processed_at", now)
    done = written(marked, "url_tracking")
    log = spark.range(1).select(
        F.lit(str(version)).alias("run_id"),
        now.alias("event_time"),
        F.lit("SUCCESS").alias("status"),
        done.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar().alias("articles_extracted"),
        records.agg(F.count(F.lit(1)).cast("int").alias("n")).scalar().alias("articles_analyzed"),
    )
    return written(log, "run_events")


def complete_rows(
    spark: SparkSession, root: str, name: str, schema: T.StructType, before: int | None = None
) -> DataFrame:
    """Rows of a table's versions whose run has its line in the log, earlier ones only if asked."""
    number = T.StructField("version", T.LongType())
    rows = read_parquet(spark, f"{root}/{name}", T.StructType([*schema.fields, number]))
    if before is not None:
        rows = rows.filter(F.col("version") < before)
    log = read_parquet(spark, f"{root}/run_events", T.StructType([*RUN_LINE.fields, number]))
    whole = log.filter(F.col("status") == "SUCCESS").select("version").distinct()
    return rows.join(whole, "version", "left_semi").select(*schema.fieldNames())


def run_report(spark: SparkSession, root: str) -> DataFrame:
    """Latest state of every run of the job."""
    return M.run_log(spark.read.parquet(f"{root.rstrip('/')}/run_events").drop("version"))
