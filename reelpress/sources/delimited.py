"""Delimited text without header, always with a declared schema (nothing is inferred)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from reelpress import schemas

# ---- fixed values: file formats ---------------------------------------------------------
USERS_SEPARATOR, RATINGS_SEPARATOR, ITEMS_SEPARATOR = "|", "\t", "|"
#: Spark knows Latin-1 under this name only
LATIN1 = "ISO-8859-1"
# -----------------------------------------------------------------------------------------


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, sep: str, encoding: str = LATIN1
) -> DataFrame:
    """A schema shorter than the file reads its leading fields and keeps every row."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").csv(
        path, sep=sep, encoding=encoding, header=False
    )


def read_users(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.USERS, USERS_SEPARATOR)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    return read_delimited(spark, path, schemas.RATINGS, RATINGS_SEPARATOR)


def read_items(
    spark: SparkSession, path: str, schema: T.StructType = schemas.ITEMS
) -> DataFrame:
    return read_delimited(spark, path, schema, ITEMS_SEPARATOR)


def read_items_narrow(spark: SparkSession, path: str) -> DataFrame:
    """The five leading columns of the same file, decoded the same way."""
    return read_items(spark, path).select(*schemas.ITEMS_NARROW.fieldNames())
