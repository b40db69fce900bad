import pytest
from pyspark.sql import functions as F

from reelpress.operators import ratings as R
from reelpress.schemas import GENRES


def test_bands(spark):
    ages = [19, 20, 25, 26, 35, 36, 44, 45, 46, None]
    df = spark.createDataFrame([(a,) for a in ages], "age int")
    labels = [r.b for r in df.select(R.bin_column(F.col("age")).alias("b")).collect()]
    assert labels == [
        "Unknown", "20-25", "20-25", "25-35", "25-35", "35-45", "35-45", "35-45",
        "45 and older", "Unknown",
    ]


@pytest.fixture
def items(spark):
    def row(i, *on):
        flags = [1 if g in on else 0 for g in GENRES]
        return (i, f"t{i}", 1 if "unknown" in on else 0, *flags)

    schema = "movie_id int, title string, unknown int, " + ", ".join(f"{g} int" for g in GENRES)
    rows = [row(1), row(2, "unknown"), row(3, "comedy", "romance"), row(4, "western")]
    rows.append((5, "t5", None, *[None] * len(GENRES)))
    return spark.createDataFrame(rows, schema)


def test_first_flag_and_all_flags(items):
    assert {(r.movie_id, r.genre) for r in R.first_flag(items).collect()} == {
        (3, "comedy"), (4, "western"),
    }
    assert {(r.movie_id, r.genre) for r in R.unpivot_flags(items, ["movie_id"]).collect()} == {
        (3, "comedy"), (3, "romance"), (4, "western"),
    }


def test_top_rated_support_and_ties(spark):
    rows = [(u, item, rating) for item, n, rating in
            [(1, 34, 5), (2, 35, 4), (3, 36, 4), (4, 35, 4)] for u in range(n)]
    ratings = spark.createDataFrame(rows, "user_id int, movie_id int, rating int")
    items = spark.createDataFrame([(i, f"t{i}") for i in range(1, 5)], "movie_id int, title string")
    top = R.top_rated(ratings, items).collect()
    assert [(r.movie_id, r.avg_rating, r.rating_count) for r in top] == [
        (3, 4.0, 36), (2, 4.0, 35), (4, 4.0, 35),
    ]
    assert len(R.top_rated(ratings, items, n=1).collect()) == 1


def test_rank_keeps_ties(spark):
    genres = ["a", "b", "c", "d", "e", "f", "g"]
    means = {"a": 5, "b": 4, "c": 4, "d": 3, "e": 2, "f": 2, "g": 5}
    items = spark.createDataFrame([(i, g) for i, g in enumerate(genres)], "movie_id int, genre string")
    ratings = spark.createDataFrame(
        [(u, i, means[g]) for i, g in enumerate(genres) for u in range(4 if g == "g" else 5)],
        "user_id int, movie_id int, rating int",
    )
    users = spark.createDataFrame([(u, "x", "y") for u in range(5)], "user_id int, age_group string, occupation string")
    top = R.top_categories(users, ratings, items)
    # g has too few ratings; e and f tie at rank 5
    assert {(r.genre, r["rank"]) for r in top.collect()} == {
        ("a", 1), ("b", 2), ("c", 2), ("d", 4), ("e", 5), ("f", 5),
    }


def test_matrix(spark):
    ratings = spark.createDataFrame(
        [(1, 10, 4), (1, 10, 2), (2, 20, 5), (3, 30, 1)], "user_id int, movie_id int, rating int"
    )
    got = {r.user_id: (r["10"], r["20"]) for r in R.rating_matrix(ratings, [10, 20]).collect()}
    assert got == {1: (3.0, 0.0), 2: (0.0, 5.0), 3: (0.0, 0.0)}
