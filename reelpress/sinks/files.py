"""Writers. Each call is one Spark job; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per line, UTF-8, NULL fields written."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_stage(
    df: DataFrame, root: str, stage: str, run_stamp: str, partition_by: Sequence[str] = ()
) -> str:
    """Stage output in a directory of its own per run; running again replaces that run only.

    Rows are gathered by partition value first, so that files do not multiply by tasks.
    """
    path = f"{root.rstrip('/')}/{stage}/run_ts={run_stamp}"
    if partition_by:
        df = df.hint("rebalance", *(F.col(name) for name in partition_by))
    write_parquet(df, path, partition_by)
    return path


def append_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    df.write.mode("append").partitionBy(*partition_by).parquet(path)


def save_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int) -> None:
    """Appends to a catalogue table laid out by hash of the keys.

    Suits the log of delivered keys: a batch joined with it is exchanged to the table's
    buckets, and the history itself, however large, stays where it is.
    """
    (
        df.repartition(buckets, *keys)
        .write.mode("append")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(table)
    )


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replaces the partitions that occur in ``df`` and leaves all others alone.

    Rows are gathered by partition value first, spread over several tasks where one value has
    many rows, so the number of files stays in proportion to the data.
    """
    (
        df.hint("rebalance", *(F.col(name) for name in partition_by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def snapshots(spark: SparkSession, base: str) -> list[str]:
    """Complete snapshot directories below ``base``, oldest first."""
    base = base.rstrip("/")
    fs, pattern = _file_system(spark, f"{base}/snapshot=*/_SUCCESS")
    found = fs.globStatus(pattern)
    return sorted(str(status.getPath().getParent().toString()) for status in found or [])


def write_snapshot(df: DataFrame, base: str, version: int) -> str:
    """The next version of a table, beside the one it may have been computed from."""
    path = f"{base.rstrip('/')}/snapshot={version:010d}"
    write_parquet(df, path)
    return path


def read_snapshot(
    spark: SparkSession, base: str, schema, before: int | None = None
) -> DataFrame:
    """The latest complete version (older than ``before``, if given); empty if there is none."""
    limit = None if before is None else f"snapshot={before:010d}"
    usable = [
        path for path in snapshots(spark, base)
        if limit is None or path.rsplit("/", 1)[-1] < limit
    ]
    if not usable:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(usable[-1])


def drop_snapshots(spark: SparkSession, base: str, keep: int) -> int:
    """Deletes all but the ``keep`` latest versions and returns how many went."""
    old = snapshots(spark, base)[: -keep or None]
    for path in old:
        fs, hadoop_path = _file_system(spark, path)
        fs.delete(hadoop_path, True)
    return len(old)
