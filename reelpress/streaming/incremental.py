"""Incremental runs: the batch functions applied to whatever has arrived.

Each micro-batch owns one ``batch_id`` directory per output. Running it again after a failure
rewrites that directory and looks only at earlier ones, so results do not depend on how often
an attempt was made.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reelpress.operators.dedup import new_items
from reelpress.operators.sentiment import score_distribution, sentiment_records
from reelpress.plans.article_flow import prepare_articles
from reelpress.plans.article_job import run_article_job
from reelpress.sinks.files import read_snapshot, write_parquet, write_snapshot
from reelpress.sources.files import read_parquet


def read_new_files(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """Stream of the files below a path; ``files_per_batch`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def delivered(spark: SparkSession, table: str, keys: Sequence[str], batch_id: int) -> DataFrame:
    """Keys written by earlier batches: a column-pruned, partition-pruned read."""
    fields = [T.StructField(key, T.StringType()) for key in keys]
    schema = T.StructType([*fields, T.StructField("batch_id", T.LongType())])
    earlier = read_parquet(spark, table, schema)
    return earlier.filter(F.col("batch_id") < batch_id).select(*keys)


def deliver_new(
    batch: DataFrame, batch_id: int, table: str, keys: Sequence[str], order: str
) -> DataFrame:
    """Writes the rows of the batch with new keys and returns what was written.

    Every row must have its key, as prepared articles have.
    """
    spark = batch.sparkSession
    path = f"{table}/batch_id={batch_id}"
    seen = delivered(spark, table, keys, batch_id)
    fresh = new_items(batch, seen, keys, [order], complete=True)
    write_parquet(fresh, path)
    return spark.read.schema(fresh.schema).parquet(path)


def run_incremental(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    order: str = "seq",
    keys: Sequence[str] = ("content_hash",),
    lexicon: DataFrame | None = None,
    **prepare,
) -> None:
    """Processes everything that has arrived since the last call, then stops.

    ``out/articles`` receives new articles. With a lexicon, ``out/score_counts`` holds the
    score distribution per keyword, brought up to date by each batch.
    """
    out = out.rstrip("/")

    def step(batch: DataFrame, batch_id: int) -> None:
        prepared = prepare_articles(batch, **prepare)
        added = deliver_new(prepared, batch_id, f"{out}/articles", keys, order)
        if lexicon is not None:
            records = sentiment_records(added, lexicon, F.lit(None).cast("timestamp"))
            _add_counts(score_distribution(records), batch_id, f"{out}/score_counts")

    (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def run_article_stream(
    stream: DataFrame,
    root: str,
    checkpoint: str,
    lexicon: DataFrame,
    now: Column,
    run_date: Column,
    **options,
) -> None:
    """The whole article flow over everything that has arrived since the last call.

    Every micro-batch is a run of ``run_article_job`` with the batch's number as version: URL
    tracking, articles, scores and the run log gain that version's directory, of the aggregates
    the run's date is brought up to date.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        run_article_job(
            batch.sparkSession, batch, root, batch_id, lexicon, now, run_date, **options
        )

    (
        stream.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


COUNTS = T.StructType(
    [
        T.StructField("keyword", T.StringType()),
        T.StructField("score", T.DecimalType(5, 3)),
        T.StructField("n", T.LongType()),
    ]
)


def _add_counts(counts: DataFrame, batch_id: int, base: str) -> None:
    spark = counts.sparkSession
    before = read_snapshot(spark, base, COUNTS, before=batch_id)
    summed = before.unionByName(counts).groupBy("keyword", "score").agg(F.sum("n").alias("n"))
    write_snapshot(summed, base, batch_id)


def dedup_stream(stream: DataFrame, keys: Sequence[str], ts: str, delay: str) -> DataFrame:
    """First row per key while its watermark lasts; older keys are forgotten.

    A key comes again once ``delay`` has passed since it was seen, so the result equals the
    distinct keys only of a stream that spans less than ``delay`` or arrives in one batch.
    """
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(keys))
