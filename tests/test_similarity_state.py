import random
import re

import pytest
from pyspark.sql import functions as F

from reelpress.operators import similarity as S
from reelpress.operators import similarity_state as SS

SCHEMA = "user_id long, movie_id long, rating int"


def rows_of(rng, n, users=12, items=9):
    return [
        (rng.choice([None, *range(users)]), rng.choice([None, *range(items)]), rng.choice([None, 1, 2, 3, 4, 5]))
        for _ in range(n)
    ]


def as_dict(df, keys):
    return {tuple(r[k] for k in keys): tuple(v for k, v in r.asDict().items() if k not in keys) for r in df.collect()}


@pytest.mark.parametrize("block_items", [2, 500])
def test_increments_equal_one_run(spark, block_items):
    rng = random.Random(5)
    parts = [rows_of(rng, 90), rows_of(rng, 40, users=15), [], [(3, 3, 5), (3, 3, 5), (99, 1, 2)]]
    frames = [spark.createDataFrame(p, SCHEMA) for p in parts]
    state = SS.initial_state(frames[0], block_items=block_items)
    for new in frames[1:]:
        step = SS.after_increment(state, new, block_items=block_items)
        # each version is a table of its own, as in a job
        state = SS.State(*[spark.createDataFrame(t.collect(), t.schema) for t in step])
    everything = spark.createDataFrame(sum(parts, []), SCHEMA)
    whole = SS.initial_state(everything)
    for got, wanted, keys in zip(state, whole, (["u", "i"], ["i"], ["i", "j"]), strict=True):
        a, b = as_dict(got, keys), as_dict(wanted.select(*got.columns), keys)
        assert a.keys() == b.keys()
        assert all(a[k] == pytest.approx(b[k]) for k in a)
    a = as_dict(SS.scores(state, -0.5, 2), ["movie_id", "similar_movie_id"])
    b = as_dict(S.item_similarity(everything, -0.5, 2), ["movie_id", "similar_movie_id"])
    assert a and a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k]) for k in a)


def test_pairs_of_old_cells_do_not_meet(spark):
    old = [(u, i, 3) for u in range(5) for i in range(20)]
    new = [(0, 20, 4), (0, 21, 4), (1, 0, 5), (9, 1, 1)]
    cells = SS.initial_state(spark.createDataFrame(old, SCHEMA)).cells
    mine = SS.touched_cells(cells, spark.createDataFrame(new, SCHEMA))
    pairs = SS.changed_pairs(mine, block_items=7)
    # user 0: two new items with 20 old ones and each other; user 1: one item with 19; user 9: none
    assert pairs.count() == 2 * 20 + 1 + 19
    assert pairs.agg(F.sum("k")).first()[0] == 41
    assert pairs.where("i >= j").isEmpty()


def test_pairs_of_a_state_are_dealt_once(spark):
    """By their first item: rows of pairs are dealt by both items for busy ones only, and a state is not dealt again."""
    rng = random.Random(6)
    state = SS.initial_state(spark.createDataFrame(rows_of(rng, 200), SCHEMA))
    pairs = SS.after_increment(state, spark.createDataFrame(rows_of(rng, 30), SCHEMA)).pairs
    assert len(pairs.collect()) == pairs.select("i", "j").distinct().count() == 9 * 8 / 2
    final = pairs._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert not re.search(r"Exchange hashpartitioning\(i#\w+, j#", final), final
    assert len(re.findall(r"Exchange hashpartitioning\(i#\w+, \d+\), REPARTITION_BY_NUM", final)) == 2, final


@pytest.mark.parametrize("block_items", [2, 500])
def test_busy_items_of_a_state(spark, block_items):
    rng = random.Random(7)
    rows = [rows_of(rng, 120), rows_of(rng, 50, users=15, items=12)]
    old, new = [spark.createDataFrame(part, SCHEMA) for part in rows]
    everything = as_dict(SS.initial_state(old.unionByName(new)).pairs, ["i", "j"])
    for busy in (0, 12):
        state = SS.initial_state(old, block_items=block_items, busy_raters=busy)
        got = as_dict(SS.after_increment(state, new, block_items=block_items, busy_raters=busy).pairs, ["i", "j"])
        assert got == {pair: pytest.approx(sums) for pair, sums in everything.items()}
