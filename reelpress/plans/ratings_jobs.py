"""The four ratings reports as jobs: declared files in, result directories out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelpress.operators import ratings as R
from reelpress.operators import similarity as S
from reelpress.sinks.files import write_csv, write_parquet
from reelpress.sources import delimited as D

# ---- fixed values: input file names -----------------------------------------------------
USERS_FILE, RATINGS_FILE, ITEMS_FILE = "u.user", "u.data", "u.item"
# -----------------------------------------------------------------------------------------


class RatingsInputs:
    def __init__(self, spark: SparkSession, folder: str):
        folder = folder.rstrip("/")
        self.users = D.read_users(spark, f"{folder}/{USERS_FILE}")
        self.ratings = D.read_ratings(spark, f"{folder}/{RATINGS_FILE}")
        self.items = D.read_items(spark, f"{folder}/{ITEMS_FILE}")


def mean_age(inputs: RatingsInputs) -> DataFrame:
    return R.mean_by_group(inputs.users, ["occupation"], "age", "mean_age")


def top_items(inputs: RatingsInputs) -> DataFrame:
    return R.top_rated(inputs.ratings, inputs.items)


def top_genres(inputs: RatingsInputs, every_genre: bool = False) -> DataFrame:
    """By first genre per item or, with ``every_genre``, counting an item under each genre."""
    users = inputs.users.withColumn("age_group", R.bin_column(F.col("age")))
    genres = (
        R.unpivot_flags(inputs.items, ["movie_id"]) if every_genre else R.first_flag(inputs.items)
    )
    ranked = R.top_categories(users, inputs.ratings, genres)
    return ranked.orderBy("age_group", "occupation", "rank")


def similar(
    inputs: RatingsInputs,
    min_similarity: float = S.REPORT_MIN_SIMILARITY,
    min_cooccurrence: int = S.REPORT_MIN_COOCCURRENCE,
) -> DataFrame:
    return S.item_similarity(inputs.ratings, min_similarity, min_cooccurrence)


def run_reports(
    spark: SparkSession,
    folder: str,
    out: str,
    title: str | None = None,
    **similarity_thresholds,
) -> None:
    """Writes all reports; the similarity table is read back for the list of one title."""
    inputs, out = RatingsInputs(spark, folder), out.rstrip("/")
    write_parquet(mean_age(inputs), f"{out}/mean_age_by_occupation")
    write_parquet(top_items(inputs), f"{out}/top_rated_items")
    write_parquet(top_genres(inputs), f"{out}/top_genres")
    write_csv(spark.read.parquet(f"{out}/top_genres"), f"{out}/top_genres_csv")
    write_parquet(similar(inputs, **similarity_thresholds), f"{out}/similar_items")
    if title is not None:
        table = spark.read.parquet(f"{out}/similar_items")
        write_parquet(S.similar_items(table, inputs.items, title), f"{out}/similar_to_title")
