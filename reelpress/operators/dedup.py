"""First-occurrence, cross-batch and capped selection.

The ``row_number() <= k`` filters below let Spark cut every map partition down to ``k`` rows
per key before the shuffle (``WindowGroupLimit`` in the plan), so a key that holds a third of
all rows still arrives as a handful of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _any_missing(keys: Sequence[str], blank: bool = True) -> Column:
    """True where a key column is NULL or, with ``blank``, an empty string."""
    found = F.lit(False)
    for key in keys:
        found = found | F.col(key).isNull()
        if blank:
            found = found | (F.col(key).cast("string") == "")
    return found


def cap_per_key(df: DataFrame, keys: Sequence[str], order: Sequence, k: int) -> DataFrame:
    """The first ``k`` rows of every key in ``order``."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") <= k).drop("_rank")


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep_missing: bool = True,
    blank: bool = True,
    last: bool = False,
) -> DataFrame:
    """The first row (or the ``last``) of every key in arrival order.

    Rows whose key is NULL, or empty unless ``blank`` is False, cannot be compared: they all
    stay, or, with ``keep_missing=False``, all go. ``order`` must tell any two rows of the
    input apart. Each kept row without a key is made a window partition of its own, which
    spreads such rows over all tasks instead of gathering them in one.
    """
    ranked = [F.desc(name) if last else F.asc(name) for name in order]
    missing = _any_missing(keys, blank)
    if not keep_missing:
        return cap_per_key(df.filter(~missing), keys, ranked, 1)
    marked = df.withColumn("_own", F.when(missing, F.struct(*order)))
    return cap_per_key(marked, [*keys, "_own"], ranked, 1).drop("_own")


def drop_seen(new: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not in ``seen``. A NULL key is never seen.

    ``seen`` may be a log with repeats: it is reduced to one row per key on the way in, by the
    same hash partitioning the join needs anyway.
    """
    return new.join(seen.select(*keys).distinct(), list(keys), "left_anti")


def known_keys(*tables: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All keys that occur in any of the tables."""
    merged = tables[0].select(*keys)
    for table in tables[1:]:
        merged = merged.unionByName(table.select(*keys))
    return merged.distinct()


def distinct_rows(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct non-empty keys."""
    return df.select(*keys).filter(~_any_missing(keys)).distinct()


def new_items(
    batch: DataFrame,
    seen: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    complete: bool = False,
) -> DataFrame:
    """First occurrences of the batch that no earlier batch has delivered.

    In-batch repeats go first, so the join with the history sees one row per key. Where every
    row is known to have its key, say so with ``complete``: selection and join then share one
    exchange of the batch.
    """
    first = cap_per_key(batch, keys, order, 1) if complete else first_per_key(batch, keys, order)
    return drop_seen(first, seen, keys)


def with_fallback(primary: DataFrame, backup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All primary rows, plus the backup rows of keys that have no primary row."""
    return primary.unionByName(drop_seen(backup, primary, keys))
