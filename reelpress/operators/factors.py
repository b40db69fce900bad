"""Item similarity from a factor model: ALS item factors compared by cosine."""

from __future__ import annotations

import uuid

from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpress.operators.similarity import both_directions, co_rater_counts
from reelpress.session import use_checkpoints


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def dense_ids(df: DataFrame, column: str, out: str, buckets: int = 1024) -> DataFrame:
    """``(column, out)``: numbers from 0, without gaps, for the distinct values of a column.

    Values are numbered within hash buckets and then shifted by the sizes of the buckets
    before theirs, so no task sees more than one bucket's share of them.
    """
    values = df.select(column).where(F.col(column).isNotNull()).distinct()
    dealt = values.withColumn("_bucket", F.pmod(F.xxhash64(column), F.lit(buckets)).cast("int"))
    within = Window.partitionBy("_bucket").orderBy(column)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    # one row per bucket
    shifts = dealt.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift")
    )
    return (
        dealt.withColumn("_place", F.row_number().over(within))
        .join(shifts, "_bucket")
        .select(column, (F.col("_shift") + F.col("_place") - 1).alias(out))
    )


def item_factors(
    ratings: DataFrame,
    rank: int = 10,
    iterations: int = 10,
    regularisation: float = 0.1,
    seed: int = 42,
    user: str = "user_id",
    item: str = "movie_id",
    rating: str = "rating",
) -> DataFrame:
    """``(item, features)``. Long iterations cut their lineage in the checkpoint folder.

    The solver wants ids in the range of int, so users and items get dense numbers first. It runs what it is given
    twice, once for its log only, so the numbered ratings are written there too. Its blocks are kept on disk: a task
    that builds one holds a tenth of all ratings in several copies, and blocks kept in memory leave it no room.
    """
    folder = use_checkpoints(ratings.sparkSession)
    users = dense_ids(ratings, user, "_u")
    items = dense_ids(ratings, item, "_i").checkpoint()
    numbered = ratings.join(users, user).join(items, item).select(
        F.col("_u").cast("int").alias("_u"), F.col("_i").cast("int").alias("_i"), rating
    )
    kept = f"{folder}/numbered-{uuid.uuid4()}"
    numbered.write.parquet(kept)
    als = ALS(
        rank=rank, maxIter=iterations, regParam=regularisation, seed=seed, userCol="_u",
        itemCol="_i", ratingCol=rating, checkpointInterval=5, intermediateStorageLevel="DISK_ONLY",
    )
    found = als.fit(ratings.sparkSession.read.schema(numbered.schema).parquet(kept)).itemFactors
    return found.join(items, found["id"] == items["_i"]).select(item, "features")


def factor_similarity(
    ratings: DataFrame,
    factors: DataFrame,
    min_similarity: float,
    min_cooccurrence: int,
    user: str = "user_id",
    item: str = "movie_id",
) -> DataFrame:
    """Cosine of the factors for items rated together by enough users, in both directions.

    The pairs come from common raters, so factors are never compared all with all.
    """
    other = f"similar_{item}"
    use_checkpoints(ratings.sparkSession)
    cells = (
        ratings.select(F.col(user).alias("u"), F.col(item).alias("i"))
        .filter(F.col("u").isNotNull() & F.col("i").isNotNull())
        .distinct()
    )
    known = factors.select(F.col(item).alias("i"), F.col("features").alias("f"))
    known = known.join(dense_ids(known, "i", "n"), "i").checkpoint()
    pairs = co_rater_counts(cells, known.select("i", "n"), min_cooccurrence)
    first = known.select(F.col("i").alias(item), F.col("n").alias("m"), "f")
    second = known.select(F.col("i").alias(other), "n", F.col("f").alias("g"))
    f, g = F.col("f"), F.col("g")
    cosine = F.try_divide(_dot(f, g), F.sqrt(_dot(f, f) * _dot(g, g)))
    scored = (
        pairs.join(first, "m")
        .join(second, "n")
        .select(item, other, cosine.alias("similarity_score"), F.col("k").alias("cooccurrence_count"))
        .filter(F.col("similarity_score") >= min_similarity)
    )
    return both_directions(scored, item, other)
