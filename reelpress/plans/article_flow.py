"""The article flow: raw rows -> prepared -> new -> scored -> result tables.

Every stage is a function of DataFrames. A chain of them is one lazy plan; write a stage out
only where something else needs it.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.functions import text as X
from reelpress.operators.dedup import cap_per_key, new_items

# ---- fixed values -----------------------------------------------------------------------
#: shortest cleaned content, in characters, that counts as an article
MIN_CONTENT = 50
# -----------------------------------------------------------------------------------------


def attach_content(raw: DataFrame, contents: DataFrame) -> DataFrame:
    """Full title and content by path. Rows without a path go; rows whose content is missing
    stay with NULLs."""
    full = contents.select(
        F.col("path").alias("s3_raw_content_path"),
        F.col("title").alias("full_title"),
        F.col("content").alias("full_content"),
    )
    return raw.filter(F.col("s3_raw_content_path") != "").join(
        full, "s3_raw_content_path", "left"
    )


def prepare_articles(
    raw: DataFrame,
    min_content: int = MIN_CONTENT,
    phrases: Iterable[str] = X.SITE_PHRASES,
    decode: bool = False,
) -> DataFrame:
    """Cleaned articles of sufficient length with hash and lengths.

    Uses ``full_title``/``full_content`` where present and not empty. The cleaning, by far the
    most costly step, runs once per row, whatever later steps read of it.
    """
    def best(full: str, short: str) -> Column:
        given = [F.col(name) for name in (full, short) if name in raw.columns]
        return X.clean_text(X.first_text(*given), phrases, decode)

    cleaned = X.compute_once(
        raw, title=best("full_title", "title"), content=best("full_content", "content")
    ).drop("full_title", "full_content")
    given = F.col("content_hash") if "content_hash" in raw.columns else F.lit(None).cast("string")
    return cleaned.filter(F.length("content") >= min_content).withColumns(
        {
            "content_hash": X.hash_or(given, F.col("title"), F.col("content")),
            "content_length": F.length("content"),
            "title_length": F.length("title"),
        }
    )


def process_batch(
    prepared: DataFrame, seen: DataFrame | None = None, order: str = "seq"
) -> DataFrame:
    """Articles whose hash is new, within the batch and, if given, against ``seen``.

    Prepared articles always have a hash, so one exchange by hash serves both steps.
    """
    if seen is None:
        return cap_per_key(prepared, ["content_hash"], [order], 1)
    return new_items(prepared, seen, ["content_hash"], [order], complete=True)


def with_processed_path(processed: DataFrame, run_time: Column) -> DataFrame:
    key = F.concat(
        F.lit("processed_articles/"),
        X.key_stamp(run_time, millis=True),
        F.lit("_"),
        F.col("content_hash"),
        F.lit(".json"),
    )
    return processed.withColumn("s3_processed_content_path", key)


def article_rows(records: DataFrame, now: Column) -> DataFrame:
    """Score records as rows of the articles table."""
    content = F.col("content") if "content" in records.columns else F.lit(None).cast("string")
    return records.select(
        F.col("article_id").alias("article_hash"),
        "keyword",
        "source",
        "title",
        "url",
        F.col("content_length").cast("int").alias("content_length"),
        "s3_raw_content_path",
        "s3_processed_content_path",
        X.sample_text(F.col("title"), content).alias("sample_content"),
        F.col("analysis_timestamp").alias("extraction_timestamp"),
        F.col("analysis_timestamp").alias("processing_timestamp"),
        now.alias("created_at"),
    )


def score_rows(records: DataFrame, now: Column) -> DataFrame:
    return records.select(
        F.col("article_id").alias("article_hash"),
        "keyword",
        "source",
        F.col("mock_sentiment_score").cast("decimal(5,3)").alias("mock_sentiment_score"),
        F.col("textblob_sentiment.polarity").cast("decimal(5,3)").alias("textblob_polarity"),
        F.col("textblob_sentiment.subjectivity")
        .cast("decimal(5,3)")
        .alias("textblob_subjectivity"),
        "analysis_timestamp",
        now.alias("created_at"),
    )


def aggregate_rows(by_keyword: DataFrame, run_date: Column, path: Column, now: Column) -> DataFrame:
    return by_keyword.select(
        "keyword",
        run_date.alias("date"),
        *(
            F.col(name).cast("decimal(5,3)").alias(name)
            for name in ("average_score", "min_score", "max_score")
        ),
        F.col("article_count").cast("int").alias("article_count"),
        path.alias("s3_sentiment_data_path"),
        now.alias("created_at"),
    )
