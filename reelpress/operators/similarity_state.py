"""Item-item similarity kept up to date: tables of sums that new ratings are added to.

The state is three tables: ``cells`` (one row per user and item: sum, number of known ratings, number of rows),
``items`` (rows, ``sx``, ``sxx``) and ``pairs`` (common raters ``k``, ``sxy``) of all co-rated pairs. An increment
recomputes the cells it touches and adds to both other tables the difference between what a touched cell gives now
and what it gave. Pairs are formed of touched cells with their user's cells only: two cells that were both there before and did
not change never meet.

The pair table holds every co-rated pair, for one below a threshold now may pass it later; thresholds apply
when scores are read (``scores``), which is ``item_similarity`` of all ratings so far. Differences are
floating-point sums, so values agree with a full run up to rounding.

A user's touched cells and all cells are cut into blocks of about ``BLOCK_ITEMS``; every two blocks are a join key of
their own. Ratings are dealt by user once, and cells added to where they lie. Pairs of a first state and of an increment
are both dealt by their first item, so a state that is not read from a table is summed with its increment where it lies.
Ratings without user or item are ignored; a null rating counts as a row and a common rater and adds
nothing to sums; an empty increment changes nothing; rows may repeat and count each time.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpress.operators import similarity as S


class State(NamedTuple):
    cells: DataFrame
    items: DataFrame
    pairs: DataFrame


def _summed(ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """One row per user and item, a user's rows in one task. As in ``similarity``, the condition at the end holds for
    every row and makes all uses share one exchange."""
    known = ratings.filter(F.col(user).isNotNull() & F.col(item).isNotNull())
    cells = (
        known.select(F.col(user).alias("u"), F.col(item).alias("i"), F.col(rating).alias("r"))
        .repartition("u")
        .groupBy("u", "i")
        .agg(
            F.coalesce(F.sum(F.col("r").cast("double")), F.lit(0.0)).alias("s"),
            F.count("r").alias("c"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    return cells.filter(F.col("n") + F.col("c") + F.abs("s") > 0)


def _value(total: str, known: str) -> Column:
    """Mean rating of a cell, 0 where no rating is known, since it adds nothing to any sum."""
    return F.coalesce(F.try_divide(F.col(total), F.col(known)), F.lit(0.0))


def initial_state(
    ratings: DataFrame, user: str = "user_id", item: str = "movie_id", rating: str = "rating",
    block_items: int = S.BLOCK_ITEMS, busy_raters: int = S.BUSY_RATERS,
) -> State:
    """The three tables of a first set of ratings."""
    cells = _summed(ratings, user, item, rating)
    x = cells.withColumn("x", _value("s", "c"))
    items = x.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum("x").alias("sx"), F.sum(F.col("x") * F.col("x")).alias("sxx")
    )
    # always true, so that all uses share one exchange
    items = items.filter(F.col("n") + F.abs("sx") + F.abs("sxx") > 0)
    pairs = S.all_pairs(x.select("u", "i", "x"), _busy(items, busy_raters), block_items)
    return State(cells, items, pairs)


def _busy(items: DataFrame, busy_raters: int) -> DataFrame:
    return items.select("i", (F.col("n") > busy_raters).alias("busy"))


def touched_cells(
    cells: DataFrame, new: DataFrame, user: str = "user_id", item: str = "movie_id", rating: str = "rating"
) -> DataFrame:
    """``(u, i, s, c, n, x_was, n_was, x)`` of all cells, old and new; ``touched`` marks those the increment changes.

    ``n_was`` is 0 for a cell that was not there.
    """
    names = ["s", "c", "n"]
    added = _summed(new, user, item, rating)
    old = cells.select("u", "i", *names, *[F.lit(0).alias(f"{name}_new") for name in names])
    more = added.select("u", "i", *[F.lit(0).alias(name) for name in names], *[F.col(name).alias(f"{name}_new") for name in names])
    # a sum of one row of each, where the cells lie
    both = old.unionByName(more).groupBy("u", "i").agg(
        *[F.sum(name).alias(f"{name}_was") for name in names], *[F.sum(f"{name}_new").alias(f"{name}_new") for name in names]
    )
    return (
        both.withColumns({name: F.col(f"{name}_was") + F.col(f"{name}_new") for name in names})
        .withColumns({"x_was": _value("s_was", "c_was"), "x": _value("s", "c"), "touched": F.col("n_new") > 0})
        .select("u", "i", "s", "c", "n", "x_was", "n_was", "x", "touched")
    )


def changed_pairs(cells: DataFrame, block_items: int = S.BLOCK_ITEMS, busy: DataFrame | None = None) -> DataFrame:
    """One row ``(i, j, k, sxy)`` per user and pair of items with a touched cell: what it adds to the pair's sums.

    Each pair of a user comes once, whether one of its cells is touched or both are. The column ``busy`` is that of
    ``i`` in the table ``busy`` of all items; without one no item is.
    """
    number = lambda rows: F.ceil(rows.over(Window.partitionBy("u")) / F.lit(block_items)).cast("int")
    sizes = {"all_blocks": number(F.count(F.lit(1))), "touched_blocks": number(F.count_if("touched"))}
    mine = cells.withColumns(sizes).where("touched_blocks > 0")
    marked = mine.withColumn("busy", F.lit(False)) if busy is None else mine.join(busy, "i")
    block = lambda blocks: F.pmod(F.xxhash64("i"), F.col(blocks)).cast("int")

    def keys(blocks: str, key: Callable[[Column], Column]) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(blocks) - 1), key)

    key = lambda first, a, b: F.struct(F.lit(first).alias("first"), a.alias("a_block"), b.alias("b_block"))
    first = keys("all_blocks", lambda b: key(True, block("touched_blocks"), b))
    second = keys("touched_blocks", lambda a: key(False, a, block("all_blocks")))
    dealt = marked.select(
        "u", "i", "x", "x_was", (F.col("n_was") > 0).alias("there"), "touched", "busy",
        F.inline(F.when(F.col("touched"), F.concat(first, second)).otherwise(second)),
    ).repartition("u", "a_block", "b_block")
    cell = F.struct("i", "x", "x_was", "there", "touched", "busy")
    side = lambda is_it, name: F.collect_list(F.when(is_it, cell)).alias(name)
    one = lambda name: F.inline(name).alias(*[f"{name}_{field}" for field in ("i", "x", "x_was", "there", "touched", "busy")])
    met = dealt.groupBy("u", "a_block", "b_block").agg(side(F.col("first"), "a"), side(~F.col("first"), "b"))
    both_there = F.expr("a_there AND b_there")
    return (
        met.select("b", one("a"))
        .select("*", one("b"))
        .where("a_i < b_i OR (a_i > b_i AND NOT b_touched)")
        .select(
            F.least("a_i", "b_i").alias("i"),
            F.greatest("a_i", "b_i").alias("j"),
            F.when(both_there, 0).otherwise(1).cast("long").alias("k"),
            (F.expr("a_x * b_x") - F.when(both_there, F.expr("a_x_was * b_x_was")).otherwise(0.0)).alias("sxy"),
            F.when(F.expr("a_i < b_i"), F.col("a_busy")).otherwise(F.col("b_busy")).alias("busy"),
        )
    )


def after_increment(
    state: State, new: DataFrame, user: str = "user_id", item: str = "movie_id", rating: str = "rating",
    block_items: int = S.BLOCK_ITEMS, busy_raters: int = S.BUSY_RATERS,
) -> State:
    """The next version of the three tables."""
    cells = touched_cells(state.cells, new, user, item, rating)
    change = cells.where("touched").groupBy("i").agg(
        F.sum(F.col("n") - F.col("n_was")).alias("n"),
        F.sum(F.col("x") - F.col("x_was")).alias("sx"),
        F.sum(F.col("x") * F.col("x") - F.col("x_was") * F.col("x_was")).alias("sxx"),
    )
    sums = ["n", "sx", "sxx"]
    items = state.items.unionByName(change).groupBy("i").agg(*[F.sum(name).alias(name) for name in sums])
    changed = changed_pairs(cells, block_items, _busy(items, busy_raters))
    few = changed.where(~F.col("busy")).drop("busy").repartition(S.pair_tasks(changed), "i")
    busy = S.busy_by_first(changed.where("busy").drop("busy"))
    pairs = S.summed_pairs(state.pairs.unionByName(few).unionByName(busy))
    return State(cells.select("u", "i", "s", "c", "n"), items, pairs)


def scores(
    state: State,
    min_similarity: float = S.MIN_SIMILARITY,
    min_cooccurrence: int = S.MIN_COOCCURRENCE,
    item: str = "movie_id",
) -> DataFrame:
    """What ``item_similarity`` gives of all ratings in the state."""
    popular = state.items.filter(F.col("n") >= min_cooccurrence)
    pairs = state.pairs.filter(F.col("k") >= min_cooccurrence)
    return S.scored_pairs(pairs, popular, S.user_count(state.cells), min_similarity, item)
