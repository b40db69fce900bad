"""Parquet results, JSON documents, file listings, SQL and JDBC."""

from __future__ import annotations

import logging
import re
from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelpress import schemas

_log = logging.getLogger(__name__)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def rows(spark: SparkSession, values: Sequence, schema: T.StructType) -> DataFrame:
    """A small dimension from literal rows, with the full schema so it may also be empty."""
    return spark.createDataFrame(list(values), schema)


def _missing_path(error: AnalysisException) -> str | None:
    if error.getCondition() != "PATH_NOT_FOUND":
        return None
    return error.getMessageParameters()["path"]


def _or_empty(spark: SparkSession, schema: T.StructType, read) -> DataFrame:
    try:
        return read()
    except AnalysisException as error:
        if _missing_path(error) is None:
            raise
        return empty(spark, schema)


def _plain_path(path: str) -> str:
    """A path without scheme, host and closing slash."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def read_present(paths: Sequence[str], read) -> tuple[DataFrame | None, list[str]]:
    """``read(paths)`` without those that do not exist, and which those are.

    None if there is none at all. Missing paths are also logged.
    """
    present, missing = list(paths), []
    while present:
        try:
            return read(present), missing
        except AnalysisException as error:
            absent = _missing_path(error)
            gone = [p for p in present if absent and _plain_path(p) == _plain_path(absent)]
            if not gone:
                raise
            _log.warning("input path does not exist: %s", gone[0])
            missing += gone
            present = [p for p in present if p not in gone]
    return None, missing


def read_parquet(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """All part files of a result. With a schema, a missing path gives no rows."""
    if schema is None:
        return spark.read.parquet(path)
    return _or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(path))


def _with_corrupt(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType, lines: bool = False
) -> DataFrame:
    """JSON files of one document each, or of one per line.

    Paths that do not exist give no rows and are logged; all others are read. What is not
    JSON becomes a row of NULLs with its text in ``_corrupt_record``. A file that vanishes
    while it is read is an error.
    """
    wide = _with_corrupt(schema)
    reader = spark.read.schema(wide).options(multiLine=not lines, mode="PERMISSIVE")
    found, _ = read_present([path] if isinstance(path, str) else path, reader.json)
    return empty(spark, wide) if found is None else found


def file_key(root: str, path: Column | None = None) -> Column:
    """Key of a file below ``root``, as the writer named it (file paths come URL-encoded).

    The root counts only as the beginning of the path, whatever names recur below it; the key
    of a root that is itself a file is its name.
    """
    path = F.col("_metadata.file_path") if path is None else path
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    plain = F.regexp_replace(decoded, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")
    base = _plain_path(root)
    if not base.startswith("/"):  # relative to a working folder that only the store knows
        base = f"/{base}"
        plain = F.substr(plain, F.instr(plain, F.lit(f"{base}/")))
    below = F.startswith(plain, F.lit(f"{base}/"))
    return F.when(below, F.substr(plain, F.lit(len(base) + 2))).otherwise(
        F.substring_index(plain, "/", -1)
    )


def read_article_documents(spark: SparkSession, root: str) -> DataFrame:
    """Every document below ``root`` with its key, readable or not.

    What is not JSON has NULL fields and its text in ``_corrupt_record``.
    """
    wide = _with_corrupt(schemas.ARTICLE_CONTENT)
    keyed = T.StructType([*wide.fields, T.StructField("path", T.StringType())])

    def read():
        documents = spark.read.option("recursiveFileLookup", True).text(root, wholetext=True)
        parsed = F.from_json("value", wide, {"mode": "PERMISSIVE"})
        return documents.select(parsed.alias("d"), file_key(root).alias("path")).select(
            "d.*", "path"
        )

    return _or_empty(spark, keyed, read)


def read_article_contents(spark: SparkSession, root: str) -> DataFrame:
    """The readable article documents below ``root`` with their keys.

    ``unreadable_documents`` lists what this leaves out.
    """
    documents = read_article_documents(spark, root)
    return documents.filter(F.col("_corrupt_record").isNull()).drop("_corrupt_record")


def unreadable_documents(spark: SparkSession, root: str) -> DataFrame:
    """``(path, text)`` of the documents below ``root`` that are not JSON."""
    documents = read_article_documents(spark, root)
    return documents.filter(F.col("_corrupt_record").isNotNull()).select(
        "path", F.col("_corrupt_record").alias("text")
    )


def read_raw_batch(spark: SparkSession, path: str) -> DataFrame:
    """The articles of a raw batch document, one row each with their ``position``."""
    batch = read_json(spark, path, schemas.RAW_BATCH)
    return batch.select(F.posexplode("articles").alias("position", "article")).select(
        "position", "article.*"
    )


def read_posts_feed(spark: SparkSession, path: str) -> DataFrame:
    return read_json(spark, path, schemas.POSTS_FEED).select("posts")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages stored as one HTML file each; the path stands in for the URL."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select(F.col("path").alias("url"), F.col("content").cast("string").alias("html"))
    )


def read_stage(
    spark: SparkSession,
    root: str,
    stage: str,
    stock_name: str | None = None,
    run: str | None = None,
) -> DataFrame:
    """A stage table; naming a run or a stock reads only the directories of it.

    Without a run the rows of all runs come, each with its ``run_ts``.
    """
    df = spark.read.option("basePath", f"{root.rstrip('/')}/{stage}")
    df = df.parquet(f"{root.rstrip('/')}/{stage}{'' if run is None else f'/run_ts={run}'}")
    return df if stock_name is None else df.filter(F.col("stock_name") == stock_name)


def file_inventory(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(key, path, length, modified)`` of all non-empty files below a path.

    No content is read.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
        .load(path)
        .select(
            file_key(path).alias("key"),
            "path",
            "length",
            F.col("modificationTime").alias("modified"),
        )
    )


def under_prefix(inventory: DataFrame, prefix: str) -> DataFrame:
    return inventory.filter(F.startswith("key", F.lit(prefix)))


def object_size(inventory: DataFrame, key: str) -> DataFrame:
    """Size of one object; no row if there is none."""
    return inventory.filter(F.col("key") == key).select("key", "length")


def missing_inputs(required: DataFrame, present: DataFrame, key: str = "key") -> DataFrame:
    return required.select(key).distinct().join(present.select(key).distinct(), key, "left_anti")


def require_inputs(spark: SparkSession, inventory: DataFrame, names: Sequence[str]) -> None:
    """Raises if any of the named files is missing or empty."""
    schema = schemas.columns("key STRING")
    wanted = rows(spark, [(name,) for name in names], schema)
    absent = missing_inputs(wanted, inventory.filter(F.col("length") > 0))
    missing = [row.key for row in absent.orderBy("key").limit(len(names)).collect()]
    if missing:
        raise FileNotFoundError(f"missing or empty input files: {', '.join(missing)}")


def run_sql(
    spark: SparkSession,
    text: str,
    views: Mapping[str, DataFrame] | None = None,
    params: Mapping[str, object] | None = None,
) -> DataFrame:
    """Spark SQL over DataFrames named in braces, with ``:name`` parameters."""
    return spark.sql(text, args=dict(params or {}), **(views or {}))


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str,
    bounds: tuple[int, int],
    partitions: int,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """A relational table, read by several tasks over ranges of a numeric column."""
    low, high = bounds
    return spark.read.jdbc(
        url, table, column=partition_column, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=dict(properties or {}),
    )
