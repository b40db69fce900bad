"""Report queries: counts, distributions, latest rows, previews."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.functions.text import key_stage
from reelpress.operators.dedup import cap_per_key

# ---- fixed values -----------------------------------------------------------------------
LATEST_ROWS = 3
PREVIEW_GROUPS, PREVIEW_ROWS = 3, 3
# -----------------------------------------------------------------------------------------


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, n)`` for each table."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def count_by(df: DataFrame, key: str) -> DataFrame:
    """Rows per key, most frequent first, ties by key."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(key))
    )


def latest_rows(df: DataFrame, ts: str, tie: str, n: int = LATEST_ROWS) -> DataFrame:
    return df.orderBy(F.desc(ts), F.asc(tie)).limit(n)


def head(df: DataFrame, order: Sequence, n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def latest_by_max(df: DataFrame, column: str) -> DataFrame:
    """Rows that carry the greatest value of the column (a scalar subquery, no join)."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def head_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence,
    groups: int = PREVIEW_GROUPS,
    n: int = PREVIEW_ROWS,
) -> DataFrame:
    """The first ``n`` rows of each of the first ``groups`` key combinations."""
    first = df.select(*keys).distinct().orderBy(*keys).limit(groups)
    return cap_per_key(df.join(first, list(keys), "left_semi"), keys, order, n)


def objects_by_stage(inventory: DataFrame, key: str = "key") -> DataFrame:
    """Number of objects and the latest (greatest) key per stage."""
    return inventory.groupBy(key_stage(F.col(key)).alias("stage")).agg(
        F.count(F.lit(1)).alias("n"), F.max(key).alias("latest_key")
    )


def presence_summary(required: DataFrame, present: DataFrame, key: str) -> DataFrame:
    """Each required name with whether it is present."""
    found = present.select(key).distinct().withColumn("is_present", F.lit(True))
    return required.join(found, key, "left").withColumn(
        "is_present", F.coalesce("is_present", F.lit(False))
    )


def presence_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count_if("is_present").alias("present"), F.count(F.lit(1)).alias("required")
    )


def _entries(df: DataFrame, section: str, key: Column, value: Column) -> DataFrame:
    return df.select(
        F.lit(section).alias("section"), key.alias("key"), value.cast("string").alias("value")
    )


def corpus_report(articles: DataFrame, scores: DataFrame, aggregates: DataFrame) -> DataFrame:
    """The run report as ``(section, key, value)`` rows.

    Totals, the latest aggregate scores, and articles per keyword and per source. The article
    table is read once: total and both distributions come from one grouping-sets aggregate.
    """
    grouped = articles.groupingSets(
        [[], [F.col("keyword")], [F.col("source")]], F.col("keyword"), F.col("source")
    ).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().alias("gid"))
    from_articles = grouped.select(
        F.when(F.col("gid") == 3, "total")
        .when(F.col("gid") == 1, "keyword_distribution")
        .otherwise("source_distribution")
        .alias("section"),
        F.when(F.col("gid") == 3, "articles")
        .when(F.col("gid") == 1, F.col("keyword"))
        .otherwise(F.col("source"))
        .alias("key"),
        F.col("n").cast("string").alias("value"),
    )
    totals = table_counts({"sentiment_scores": scores, "aggregate_scores": aggregates})
    figures = F.array(
        *(
            F.struct(
                F.lit(section).alias("section"),
                F.col("keyword").alias("key"),
                F.col(column).cast("string").alias("value"),
            )
            for section, column in (
                ("latest_score", "average_score"),
                ("latest_article_count", "article_count"),
            )
        )
    )
    latest = latest_by_max(aggregates, "date").select(F.inline(figures))
    return (
        from_articles.unionByName(_entries(totals, "total", F.col("table_name"), F.col("n")))
        .unionByName(latest)
    )
