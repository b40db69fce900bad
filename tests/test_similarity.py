import random
import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Correlation
from reelpress.operators import factors as ALS
from reelpress.operators import ratings as R
from reelpress.operators import similarity as S

SCHEMA = "user_id int, movie_id int, rating int"


def brute_force(rows, least, common):
    users = sorted({u for u, _, _ in rows})
    cells, counts = {}, {}
    for u, i, x in rows:
        cells.setdefault((u, i), []).append(x)
        counts[i] = counts.get(i, 0) + 1
    items = sorted(i for i, n in counts.items() if n >= common)
    matrix = np.array([[np.mean(cells.get((u, i), [0])) for i in items] for u in users])
    out = {}
    for a, i in enumerate(items):
        for b, j in enumerate(items):
            k = sum((u, i) in cells and (u, j) in cells for u in users)
            x, y = matrix[:, a], matrix[:, b]
            if i == j or k < common or x.std() == 0 or y.std() == 0:
                continue
            s = float(np.corrcoef(x, y)[0, 1])
            if s >= least:
                out[(i, j)] = (round(s, 9), k)
    return out


def as_dict(df):
    return {
        (r.movie_id, r.similar_movie_id): (round(r.similarity_score, 9), r.cooccurrence_count)
        for r in df.collect()
    }


def random_rows(seed, users=40, items=25):
    rng = random.Random(seed)
    rows = []
    for u in range(users):
        # a few users rate nearly everything
        share = 0.95 if u < 6 else rng.choice([0.1, 0.25, 0.4])
        for i in range(items):
            if rng.random() < share:
                rows += [(u, i, rng.randint(1, 5))] * rng.choice([1, 1, 1, 2])
    return rows


@pytest.mark.parametrize("seed, least, common", [(1, 0.05, 3), (2, 0.2, 8), (3, -1.0, 1)])
def test_equals_brute_force(spark, seed, least, common):
    rows = random_rows(seed)
    ratings = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(S.item_similarity(ratings, least, common)) == brute_force(rows, least, common)


@pytest.mark.parametrize(
    "seed, least, common, block", [(4, 0.0013, 1, 1), (5, 0.3, 1, 4), (6, 0.2, 8, 20), (8, -0.2, 3, 5)]
)
def test_blocks_change_nothing(spark, seed, least, common, block):
    rows = random_rows(seed)
    ratings = spark.createDataFrame(rows, SCHEMA)
    got = as_dict(S.item_similarity(ratings, least, common, block_items=block))
    assert got and got == brute_force(rows, least, common)


def test_an_item_of_everybody_and_a_user_of_everything(spark):
    rng = random.Random(11)
    rows = [(u, 0, rng.randint(1, 5)) for u in range(60)] + [(0, i, rng.randint(1, 5)) for i in range(1, 40)]
    rows += [(u, rng.randrange(1, 40), rng.randint(1, 5)) for u in range(60) for _ in range(4)]
    ratings = spark.createDataFrame(rows, SCHEMA)
    assert as_dict(S.item_similarity(ratings, -1.0, 2, block_items=5)) == brute_force(rows, -1.0, 2)


@pytest.mark.parametrize("common, busy, block", [(1, 0, 500), (1, 12, 4), (2, 12, 500), (3, 15, 6), (3, 10**6, 500)])
def test_busy_items_change_nothing(spark, common, busy, block):
    rows = random_rows(common + block)
    cells = {}
    for u, i, x in rows:
        cells.setdefault((u, i), []).append(x)
    cells = {key: float(np.mean(x)) for key, x in cells.items()}
    wanted = {}
    for (u, i), x in cells.items():
        for j in range(i + 1, 25):
            if (u, j) in cells:
                k, s = wanted.get((i, j), (0, 0.0))
                wanted[i, j] = (k + 1, s + x * cells[u, j])
    frame = spark.createDataFrame([(u, i, x) for (u, i), x in cells.items()], "u int, i int, x double")
    got = {(r.i, r.j): (r.k, r.sxy) for r in S.co_rated_pairs(frame, common, block, busy).collect()}
    assert got == {p: (k, pytest.approx(s)) for p, (k, s) in wanted.items() if k >= common}


def test_unknown_ratings_count_as_raters(spark):
    frame = spark.createDataFrame(
        [(1, 1, None), (1, 2, 3.0), (2, 1, 2.0), (2, 2, 4.0), (2, 3, None)], "u int, i int, x double"
    )
    for busy in (0, 100):
        got = {(r.i, r.j): (r.k, r.sxy) for r in S.co_rated_pairs(frame, 1, busy_raters=busy).collect()}
        assert got == {(1, 2): (2, 8.0), (1, 3): (1, None), (2, 3): (1, None)}
    assert [(r.i, r.j, r.k, r.sxy) for r in S.co_rated_pairs(frame, 2).collect()] == [(1, 2, 2, 8.0)]


def test_pairs_are_shuffled_as_arrays(spark):
    """Rows of pairs go through an exchange for busy items only."""
    frame = spark.createDataFrame([(u, i, 1.0) for u in range(9) for i in range(30)], "u int, i int, x double")
    df = S.co_rated_pairs(frame, 2)
    assert df.count() == 30 * 29 / 2
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not re.search(r"Exchange hashpartitioning\(i#\w+, j#", final), final


def test_ratings_are_read_once_and_never_dealt_by_item_alone(spark):
    ratings = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").selectExpr(
        "l_orderkey % 100 AS user_id", "l_partkey AS movie_id", "CAST(l_quantity AS INT) AS rating"
    )
    df = S.item_similarity(ratings, 0.05, 3)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("== Initial Plan ==")[0]
    assert "hashpartitioning(movie_id" not in final
    assert "hashpartitioning(user_id" in final and final.count("FileScan") == 1, final
    assert final.count("ReusedExchange") >= 3


@pytest.mark.parametrize("least, common", [(-1.0, 1), (0.1, 3)])
def test_one_item_from_its_raters(spark, least, common):
    rows = random_rows(12) + [(None, 3, 1), (1, None, 2)]
    ratings = spark.createDataFrame(rows, SCHEMA)
    anchor = spark.createDataFrame([(3,)], "movie_id int")
    want = {j: v for (i, j), v in brute_force(rows[:-2], least, common).items() if i == 3}
    got = S.similar_to_item(ratings, anchor, least, common)
    assert {r.similar_movie_id: (round(r.similarity_score, 9), r.cooccurrence_count) for r in got.collect()} == want
    nobody = spark.createDataFrame([(999,)], "movie_id int")
    assert S.similar_to_item(ratings, nobody, least, common).count() == 0
    items = spark.createDataFrame([(i, f"t{i}") for i in range(25)], "movie_id int, title string")
    top = S.items_like(ratings, items, "t3", 2, least, common).collect()
    assert [r.similar_movie_id for r in top] == sorted(want, key=lambda j: (-want[j][0], j))[:2]


def test_constant_rating_has_no_pair(spark):
    rows = [(u, 1, 3) for u in range(12)] + [(u, 2, u % 5 + 1) for u in range(12)]
    assert S.item_similarity(spark.createDataFrame(rows, SCHEMA), -1.0, 2).count() == 0


def test_empty_result_is_typed(spark):
    empty = spark.createDataFrame([], SCHEMA)
    df = S.item_similarity(empty)
    assert df.count() == 0 and df.columns == [
        "movie_id", "similar_movie_id", "similarity_score", "cooccurrence_count",
    ]


def test_agrees_with_correlation_matrix(spark):
    rows = random_rows(8)
    ratings = spark.createDataFrame(rows, SCHEMA)
    items = sorted({i for _, i, _ in rows})
    wide = R.rating_matrix(ratings, items)
    vectors = VectorAssembler(inputCols=[str(i) for i in items], outputCol="v").transform(wide)
    matrix = Correlation.corr(vectors, "v").head()[0].toArray()
    for (i, j), (s, _) in as_dict(S.item_similarity(ratings, 0.0, 2)).items():
        assert s == pytest.approx(matrix[items.index(i), items.index(j)], abs=1e-8)


def test_similar_items_by_title(spark):
    rows = random_rows(9)
    sims = S.item_similarity(spark.createDataFrame(rows, SCHEMA), 0.0, 2)
    items = spark.createDataFrame(
        [(i, "same" if i in (3, 4) else f"t{i}") for i in range(25)], "movie_id int, title string"
    )
    top = S.similar_items(sims, items, "same", n=4).collect()
    mine = sorted(
        ((-s, j) for (i, j), (s, _) in as_dict(sims).items() if i == 3)
    )[:4]
    assert [r.similar_movie_id for r in top] == [j for _, j in mine]
    assert S.similar_items(sims, items, "nothing like it").count() == 0


def test_dense_ids_and_wide_ids(spark):
    values = [2**40 + 7 * i for i in range(500)]
    df = spark.createDataFrame([(v,) for v in values * 2] + [(None,)], "k long")
    got = ALS.dense_ids(df, "k", "n", buckets=16).collect()
    assert sorted(r.k for r in got) == values and sorted(r.n for r in got) == list(range(500))
    rows = [(u + 2**33, i + 2**34, x) for u, i, x in random_rows(13, 10, 6)]
    wide = spark.createDataFrame(rows, "user_id long, movie_id long, rating int")
    factors = ALS.item_factors(wide, rank=2, iterations=2)
    assert {r.movie_id for r in factors.collect()} == {i for _, i, _ in rows}


def test_factor_similarity(spark):
    ratings = spark.createDataFrame(random_rows(10), SCHEMA)
    factors = ALS.item_factors(ratings, rank=3, iterations=3)
    got = {
        (r.movie_id, r.similar_movie_id): r.similarity_score
        for r in ALS.factor_similarity(ratings, factors, -1.0, 2).collect()
    }
    vectors = {r.movie_id: np.array(r.features) for r in factors.collect()}
    assert got
    for (i, j), s in got.items():
        a, b = vectors[i], vectors[j]
        assert s == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-6)
        assert got[(j, i)] == pytest.approx(s)


@pytest.mark.parametrize("least, busy, block", [(1, 10**6, 500), (3, 10**6, 500), (3, 12, 4), (2, 0, 6), (4, 15, 5)])
def test_raters_are_counted_without_ratings(spark, least, busy, block):
    cells = sorted({(u, i) for u, i, _ in random_rows(least + block)})
    raters = {i: {u for u, j in cells if j == i} for i in range(25)}
    wanted = {(i, j): len(raters[i] & raters[j]) for i in range(24) for j in range(i)}
    frame = spark.createDataFrame([(u, 1000 - i) for u, i in cells], "u int, i long")
    numbers = spark.createDataFrame([(1000 - i, i) for i in range(24)], "i long, n long")
    df = S.co_rater_counts(frame, numbers, least, block, busy)
    rows = df.collect()
    got = {(max(r.m, r.n), min(r.m, r.n)): r.k for r in rows}
    assert len(rows) == len(got)
    assert got == {p: k for p, k in wanted.items() if k >= least}


def test_factor_pairs_are_shuffled_as_numbers(spark):
    """No rating goes with an item of a pair, and ratings without a user have no pairs."""
    rows = [(u, i, 3) for u in range(5) for i in range(12)] + [(None, i, 3) for i in range(90, 99)]
    ratings = spark.createDataFrame(rows, SCHEMA)
    factors = spark.createDataFrame([(i, [1.0, i + 1.0]) for i in range(99)], "movie_id int, features array<float>")
    df = ALS.factor_similarity(ratings, factors, -1.1, 1)
    assert df.count() == 12 * 11 and {r.cooccurrence_count for r in df.collect()} == {5}
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    arrays = re.findall(r"Aggregate \[i#\w+\], \[i#\w+, sort_array\(flatten\(collect_list\((\w+)#", plan)
    assert arrays == ["js"] and "sxy" not in plan, plan


def test_ratings_are_numbered_once_for_the_solver(spark):
    ratings = spark.createDataFrame(random_rows(14, 10, 6), SCHEMA)
    seen = spark.sparkContext.accumulator(0)

    def mark(rows):
        for row in rows:
            seen.add(1)
            yield row

    counted = spark.createDataFrame(ratings.rdd.mapPartitions(mark), SCHEMA)
    ALS.item_factors(counted, rank=2, iterations=1)
    # users, items and the numbered ratings; a part of them once more for the bucket sizes
    assert seen.value <= 5 * ratings.count()


def test_the_solver_leaves_its_memory_to_tasks(spark, monkeypatch):
    """Blocks on disk, and the factors of a solver that keeps them in memory."""
    ratings = spark.createDataFrame(random_rows(15, 10, 6), SCHEMA)
    levels = []

    class Seen(ALS.ALS):
        level = None

        def fit(self, dataset):
            levels.append(self.getIntermediateStorageLevel())
            if self.level:
                self.setIntermediateStorageLevel(self.level)
            return super().fit(dataset)

    monkeypatch.setattr(ALS, "ALS", Seen)
    on_disk = {r.movie_id: r.features for r in ALS.item_factors(ratings, rank=2, iterations=2).collect()}
    assert levels == ["DISK_ONLY"]
    Seen.level = "MEMORY_AND_DISK"
    in_memory = {r.movie_id: r.features for r in ALS.item_factors(ratings, rank=2, iterations=2).collect()}
    assert on_disk.keys() == in_memory.keys()
    assert all(on_disk[i] == pytest.approx(in_memory[i], rel=1e-4) for i in on_disk)
