"""Stock and source dimensions, and their combinations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def by_name(dimension: DataFrame, name: str) -> DataFrame:
    return dimension.filter(F.col("name") == name)


def enabled(sources: DataFrame) -> DataFrame:
    return sources.filter("enabled")


def stock_source_combinations(stocks: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Every stock with every source name.

    Source names come from configuration and are carried as an array literal, so each stock
    row expands where it is: no join.
    """
    names = F.array(*(F.lit(source) for source in sources))
    return stocks.select(F.col("name").alias("stock_name"), F.explode(names).alias("source_name"))


def keyword_source_combinations(stocks: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Every keyword of every stock with every source name, in collection order."""
    names = F.array(*(F.lit(source) for source in sources))
    keywords = stocks.select(F.col("name").alias("stock_name"), F.explode("keywords").alias("keyword"))
    return keywords.select("stock_name", "keyword", F.explode(names).alias("source_name"))
