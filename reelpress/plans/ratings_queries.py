"""Ratings queries: group means, rankings, segments, similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelpress.operators import ratings as R
from reelpress.operators import similarity as S
from reelpress.operators import similarity_state as SS
from reelpress.plans.registry import query
from reelpress.plans.tables import Tables
from reelpress.schemas import GENRES

#: thresholds that suit the sparse stand-in ratings
SIMILARITY, COOCCURRENCE = 0.05, 3
ONE_TITLE = (0.001, 2)
MIN_COUNT = 20


def _rounded(df, *names, digits=6):
    return df.withColumns({name: F.round(name, digits) for name in names})


_BAND = """CASE WHEN age BETWEEN 20 AND 25 THEN '20-25' WHEN age BETWEEN 26 AND 35 THEN '25-35'
     WHEN age BETWEEN 36 AND 45 THEN '35-45' WHEN age >= 45 THEN '45 and older'
     ELSE 'Unknown' END"""
_FIRST_FLAG = (
    "CASE " + " ".join(f"WHEN {name} = 1 THEN '{name}'" for name in GENRES) + " ELSE NULL END"
)
_SEGMENT_STATS = f"""
    SELECT {_BAND} AS age_group, occupation, genre, avg(rating) AS avg_rating,
           count(rating) AS rating_count
    FROM ratings JOIN users USING (user_id)
    JOIN (SELECT movie_id, {_FIRST_FLAG} AS genre FROM items) g USING (movie_id)
    WHERE genre IS NOT NULL GROUP BY 1, 2, 3"""


def banded_users(t: Tables):
    return t.users.withColumn("age_group", R.bin_column(F.col("age")))


@query(
    "E1 G1 A1",
    "SELECT occupation, avg(age) AS mean_age FROM users GROUP BY occupation",
)
def mean_age_by_occupation(t: Tables):
    return R.mean_by_group(t.users, ["occupation"], "age", "mean_age")


@query(
    "E2 A2",
    """SELECT movie_id, round(avg(rating), 6) AS avg_rating, count(rating) AS rating_count
       FROM ratings GROUP BY movie_id""",
)
def rating_stats_by_item(t: Tables):
    return _rounded(R.item_stats(t.ratings), "avg_rating")


@query(
    "E2 C1 C2 D1 G2",
    f"""SELECT movie_id, title, round(avg_rating, 6) AS avg_rating, rating_count
        FROM (SELECT movie_id, avg(rating) AS avg_rating, count(rating) AS rating_count
              FROM ratings GROUP BY movie_id HAVING count(rating) >= {MIN_COUNT}) s
        JOIN items USING (movie_id)
        ORDER BY avg_rating DESC, rating_count DESC, movie_id LIMIT 20""",
)
def top_rated_items(t: Tables):
    return _rounded(R.top_rated(t.ratings, t.items, MIN_COUNT), "avg_rating")


@query(
    "C2 D1",
    """SELECT movie_id, title, round(avg(rating), 6) AS avg_rating,
              count(rating) AS rating_count
       FROM ratings JOIN items USING (movie_id)
       GROUP BY movie_id, title HAVING count(rating) >= 35""",
)
def supported_items(t: Tables):
    stats = R.min_support(R.item_stats(t.ratings), "rating_count", R.MIN_RATINGS_PER_ITEM)
    joined = stats.join(t.items.select("movie_id", "title"), "movie_id")
    return _rounded(joined, "avg_rating")


@query("C4", f"SELECT user_id, age, {_BAND} AS age_group FROM users")
def age_bands(t: Tables):
    return banded_users(t).select("user_id", "age", "age_group")


@query(
    "C3 C7",
    f"""SELECT movie_id, title, {_FIRST_FLAG} AS genre FROM items
        WHERE {_FIRST_FLAG} IS NOT NULL""",
)
def first_genre_per_item(t: Tables):
    return R.first_flag(t.items).select("movie_id", "title", "genre")


@query(
    "C8",
    " UNION ALL ".join(
        f"SELECT movie_id, '{name}' AS genre FROM items WHERE {name} = 1" for name in GENRES
    ),
)
def all_genres_per_item(t: Tables):
    return R.unpivot_flags(t.items, ["movie_id"])


@query(
    "D2 E3",
    f"""SELECT age_group, occupation, genre, round(avg_rating, 6) AS avg_rating, rating_count
        FROM ({_SEGMENT_STATS}) s""",
)
def genre_stats_by_segment(t: Tables):
    stats = R.category_stats(
        banded_users(t), t.ratings, R.first_flag(t.items), ["age_group", "occupation"]
    )
    return _rounded(stats, "avg_rating")


@query(
    "F1 C2 D2 E3 G1",
    f"""SELECT age_group, occupation, genre, round(avg_rating, 6) AS avg_rating, rating_count,
               CAST(rank AS INT) AS rank
        FROM (SELECT *, rank() OVER (PARTITION BY age_group, occupation
                                     ORDER BY avg_rating DESC, rating_count DESC) AS rank
              FROM ({_SEGMENT_STATS}) s WHERE rating_count >= 5) r
        WHERE rank <= 5""",
)
def top_genres_by_segment(t: Tables):
    ranked = R.top_categories(banded_users(t), t.ratings, R.first_flag(t.items))
    return _rounded(ranked, "avg_rating").orderBy("age_group", "occupation", "rank")


@query(
    "E4 C2 D3",
    f"""SELECT movie_id, count(*) AS n FROM ratings GROUP BY movie_id
        HAVING count(*) >= {R.MIN_RATINGS_PER_ITEM}""",
)
def popular_item_counts(t: Tables):
    return R.min_support(
        R.row_counts(t.ratings, "movie_id", alias="n"), "n", R.MIN_RATINGS_PER_ITEM
    )


@query(
    "E6",
    "SELECT user_id, "
    + ", ".join(
        f"round(coalesce(avg(CASE WHEN genre = '{name}' THEN rating END), 0), 6) AS {name}"
        for name in GENRES
    )
    + f""" FROM ratings JOIN (SELECT movie_id, {_FIRST_FLAG} AS genre FROM items) g
          USING (movie_id) WHERE genre IS NOT NULL GROUP BY user_id""",
)
def user_genre_matrix(t: Tables):
    rated = t.ratings.join(R.first_flag(t.items).select("movie_id", "genre"), "movie_id")
    return _rounded(R.rating_matrix(rated, GENRES, item="genre"), *GENRES)


_CELLS = """cells AS (SELECT user_id, movie_id, avg(rating) AS x FROM ratings GROUP BY 1, 2)"""


def _similarity_sql(least: float, common: int) -> str:
    return f"""
    {_CELLS},
    popular AS (SELECT movie_id FROM ratings GROUP BY 1 HAVING count(*) >= {common}),
    total AS (SELECT CAST(count(DISTINCT user_id) AS DOUBLE) AS n FROM ratings),
    sums AS (SELECT movie_id, sum(x) AS sx, sum(x * x) AS sxx
             FROM cells JOIN popular USING (movie_id) GROUP BY 1),
    pairs AS (SELECT a.movie_id AS i, b.movie_id AS j, count(*) AS k, sum(a.x * b.x) AS sxy
              FROM cells a JOIN cells b ON a.user_id = b.user_id AND a.movie_id < b.movie_id
              GROUP BY 1, 2 HAVING count(*) >= {common}),
    scored AS (SELECT i, j, k,
                      (n * sxy - p.sx * q.sx)
                      / nullif(sqrt((n * p.sxx - p.sx * p.sx) * (n * q.sxx - q.sx * q.sx)), 0) AS s
               FROM pairs JOIN sums p ON p.movie_id = i JOIN sums q ON q.movie_id = j
               CROSS JOIN total),
    passed AS (SELECT i, j, k, s FROM scored WHERE s >= {least}),
    similar_pairs AS (
        SELECT i AS movie_id, j AS similar_movie_id, round(s, 6) AS similarity_score,
               k AS cooccurrence_count FROM passed
        UNION ALL SELECT j, i, round(s, 6), k FROM passed)"""


@query(
    "M2 M1 E4 E5 E7 C15 D3 D11 D12",
    f"WITH {_similarity_sql(SIMILARITY, COOCCURRENCE)} SELECT * FROM similar_pairs",
)
def similar_item_pairs(t: Tables):
    return _rounded(
        S.item_similarity(t.ratings, SIMILARITY, COOCCURRENCE), "similarity_score"
    )


@query(
    "E7 D11 E5 M2",
    f"WITH {_similarity_sql(SIMILARITY, COOCCURRENCE)} SELECT * FROM similar_pairs",
)
def similar_pairs_after_increment(t: Tables):
    """A tenth of the ratings, drawn by hash, comes later; the result is that of all ratings."""
    later = F.pmod(F.xxhash64("user_id", "movie_id", "rating"), F.lit(10)) == 0
    state = SS.after_increment(SS.initial_state(t.ratings.where(~later)), t.ratings.where(later))
    return _rounded(SS.scores(state, SIMILARITY, COOCCURRENCE), "similarity_score")


@query(
    "D11 E5",
    f"""WITH {_CELLS}
        SELECT a.movie_id AS i, b.movie_id AS j, count(*) AS k
        FROM cells a JOIN cells b ON a.user_id = b.user_id AND a.movie_id < b.movie_id
        GROUP BY 1, 2 HAVING count(*) >= {COOCCURRENCE}""",
)
def co_rated_item_pairs(t: Tables):
    cells = t.ratings.select(
        F.col("user_id").alias("u"), F.col("movie_id").alias("i"), F.lit(1.0).alias("x")
    ).distinct()
    return S.co_rated_pairs(cells, COOCCURRENCE).select("i", "j", "k")


@query(
    "G3 C16 D4",
    f"""WITH {_similarity_sql(*ONE_TITLE)}
        SELECT s.similar_movie_id, m.title, s.similarity_score, s.cooccurrence_count
        FROM similar_pairs s JOIN items m ON m.movie_id = s.similar_movie_id
        WHERE s.movie_id = (SELECT min(movie_id) FROM items WHERE title = 'small bolt')
        ORDER BY s.similarity_score DESC, s.similar_movie_id LIMIT 10""",
)
def items_similar_to_title(t: Tables):
    anchor = S.item_by_title(t.items, "small bolt")
    mine = _rounded(S.similar_to_item(t.ratings, anchor, *ONE_TITLE), "similarity_score")
    return S.most_similar(mine, t.items)
