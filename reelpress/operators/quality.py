"""Checks that declared keys and required columns hold. None of them collects rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelpress.schemas import TableSpec


def check_not_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, violations)``, all columns in one pass."""
    counts = df.agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in columns))
    return counts.unpivot([], list(columns), "column_name", "violations")


def check_not_blank(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Like ``check_not_null``, with empty strings counted as missing."""
    counts = df.agg(
        *(
            F.count_if(F.col(name).isNull() | (F.col(name).cast("string") == "")).alias(name)
            for name in columns
        )
    )
    return counts.unpivot([], list(columns), "column_name", "violations")


def check_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations that occur more than once. A key with a NULL is never a repeat."""
    complete = reduce(lambda a, b: a & b, (F.col(name).isNotNull() for name in keys))
    return (
        df.filter(complete)
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def check_foreign_key(child: DataFrame, column: str, parent: DataFrame, key: str) -> DataFrame:
    """``(column, n)``: referenced values that the parent lacks, and how many rows use them.

    References are counted before the join, so a popular value crosses it as one row.
    """
    used = (
        child.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = parent.select(F.col(key).alias(column)).distinct()
    return used.join(known, column, "left_anti")


def is_empty_batch(df: DataFrame) -> bool:
    return df.isEmpty()


def check_table(
    df: DataFrame, spec: TableSpec, parents: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """``(check_name, violations)`` for everything a table specification declares."""
    checks = [
        check_not_null(df, spec.required).select(
            F.concat(F.lit("not_null "), "column_name").alias("check_name"), "violations"
        )
    ]

    def total(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("violations")).select(
            F.lit(name).alias("check_name"), "violations"
        )

    if spec.unique_key:
        repeats = check_unique(df, spec.unique_key)
        checks.append(total(repeats, "unique " + ",".join(spec.unique_key)))
    for column, (table, key) in spec.references.items():
        if parents and table in parents:
            orphans = check_foreign_key(df, column, parents[table], key)
            checks.append(total(orphans, f"references {table}"))
    return reduce(DataFrame.unionByName, checks)
