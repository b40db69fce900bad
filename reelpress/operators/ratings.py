"""Rating statistics: means, minimum-support rankings, top categories per segment.

Every aggregate is of the partial/final kind, so a key that holds a large share of all rows
reaches the shuffle as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpress.schemas import GENRES

# ---- fixed values: demographic bands, first match wins (bounds inclusive, None = open) ---
AGE_BANDS = [
    (20, 25, "20-25"),
    (26, 35, "25-35"),
    (36, 45, "35-45"),
    (45, None, "45 and older"),
]
AGE_DEFAULT = "Unknown"
#: support and list sizes of the standard reports
MIN_RATINGS_PER_ITEM = 35
TOP_ITEMS = 20
MIN_RATINGS_PER_CATEGORY = 5
TOP_CATEGORIES = 5
# ------------------------------------------------------------------------------------------


def mean_by_group(df: DataFrame, keys: Sequence[str], value: str, alias: str) -> DataFrame:
    """Mean of ``value`` per key combination, ordered by the keys."""
    return df.groupBy(*keys).agg(F.avg(value).alias(alias)).orderBy(*keys)


def item_stats(
    ratings: DataFrame, item: str = "movie_id", rating: str = "rating"
) -> DataFrame:
    """Mean and number of (non-NULL) ratings per item."""
    return ratings.groupBy(item).agg(
        F.avg(rating).alias("avg_rating"), F.count(rating).alias("rating_count")
    )


def row_counts(df: DataFrame, *keys: str, alias: str = "count") -> DataFrame:
    """Number of rows per key combination, NULL ratings and repeats included."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(alias))


def min_support(stats: DataFrame, column: str, at_least: int) -> DataFrame:
    return stats.filter(F.col(column) >= at_least)


def top_rated(
    ratings: DataFrame,
    items: DataFrame,
    min_count: int = MIN_RATINGS_PER_ITEM,
    n: int = TOP_ITEMS,
    item: str = "movie_id",
    title: str = "title",
) -> DataFrame:
    """The ``n`` best items by mean, then by number of ratings, then by id.

    Ratings are aggregated and filtered before the join with the catalogue, which therefore
    moves one row per supported item.
    """
    supported = min_support(item_stats(ratings, item), "rating_count", min_count)
    return (
        supported.join(items.select(item, title), item)
        .select(item, title, "avg_rating", "rating_count")
        .orderBy(F.desc("avg_rating"), F.desc("rating_count"), F.asc(item))
        .limit(n)
    )


def bin_column(
    column: Column,
    bands: Sequence[tuple] = tuple(AGE_BANDS),
    default: str = AGE_DEFAULT,
) -> Column:
    """Label of the first band that holds the value; ``default`` for the rest and for NULL."""

    def inside(low, high):
        bounds = [column >= low] if low is not None else []
        bounds += [column <= high] if high is not None else []
        condition = bounds[0]
        for bound in bounds[1:]:
            condition = condition & bound
        return condition

    (low, high, label), *rest = bands
    out = F.when(inside(low, high), label)
    for low, high, label in rest:
        out = out.when(inside(low, high), label)
    return out.otherwise(default)


def first_flag(df: DataFrame, flags: Sequence[str] = tuple(GENRES), out: str = "genre") -> DataFrame:
    """Name of the first flag that is set, one row per input row; rows without any go."""
    (head, *rest) = flags
    name = F.when(F.col(head) == 1, head)
    for flag in rest:
        name = name.when(F.col(flag) == 1, flag)
    return df.withColumn(out, name).filter(F.col(out).isNotNull())


def unpivot_flags(
    df: DataFrame,
    ids: Sequence[str],
    flags: Sequence[str] = tuple(GENRES),
    out: str = "genre",
) -> DataFrame:
    """One row per flag that is set."""
    return (
        df.unpivot(list(ids), list(flags), out, "is_set")
        .filter(F.col("is_set") == 1)
        .drop("is_set")
    )


def category_stats(
    users: DataFrame,
    ratings: DataFrame,
    item_categories: DataFrame,
    segment: Sequence[str],
    category: str = "genre",
    user: str = "user_id",
    item: str = "movie_id",
    rating: str = "rating",
) -> DataFrame:
    """Mean and count of ratings per (segment, category).

    Sums are taken per (user, category) first. Joining users afterwards moves at most one row
    per user and category, so neither a user nor a category with very many ratings makes a
    large join partition.
    """
    per_user = (
        ratings.select(user, item, rating)
        .join(item_categories.select(item, category), item)
        .groupBy(user, category)
        .agg(
            F.sum(F.col(rating).cast("double")).alias("_sum"),
            F.count(rating).alias("_count"),
        )
    )
    return (
        per_user.join(users.select(user, *segment), user)
        .groupBy(*segment, category)
        .agg(F.sum("_sum").alias("_sum"), F.sum("_count").alias("rating_count"))
        .select(
            *segment,
            category,
            F.try_divide("_sum", "rating_count").alias("avg_rating"),
            "rating_count",
        )
    )


def top_categories(
    users: DataFrame,
    ratings: DataFrame,
    item_categories: DataFrame,
    segment: Sequence[str] = ("age_group", "occupation"),
    category: str = "genre",
    min_count: int = MIN_RATINGS_PER_CATEGORY,
    top: int = TOP_CATEGORIES,
    user: str = "user_id",
    item: str = "movie_id",
    rating: str = "rating",
) -> DataFrame:
    """Best categories per segment by mean, then count. Ties share a rank and are all kept."""
    stats = min_support(
        category_stats(users, ratings, item_categories, segment, category, user, item, rating),
        "rating_count",
        min_count,
    )
    order = Window.partitionBy(*segment).orderBy(F.desc("avg_rating"), F.desc("rating_count"))
    return stats.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= top)


def rating_matrix(
    ratings: DataFrame,
    items: Sequence,
    user: str = "user_id",
    item: str = "movie_id",
    rating: str = "rating",
) -> DataFrame:
    """One row per user, one column per listed item: mean rating, 0 where there is none.

    For a short list of items that someone wants to look at; similarity works on tall rows.
    Users who rated none of the listed items are kept, as all-zero rows.
    """
    return (
        ratings.groupBy(user)
        .pivot(item, list(items))
        .agg(F.avg(rating))
        .fillna(0, [str(value) for value in items])
    )
