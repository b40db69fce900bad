"""Table maintenance as pure functions: existing table and new rows in, next version out.

None of them overwrites what it reads. Write the result as a new snapshot
(``reelpress.sinks.files``), or feed it to MERGE INTO where the table format has one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelpress.operators.dedup import drop_seen, first_per_key


def rows_to_insert(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """The new rows an insert that ignores conflicts would add; the first arrival wins."""
    return drop_seen(first_per_key(new, keys, order, blank=False), existing, keys)


def insert_ignore(
    existing: DataFrame, new: DataFrame, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    added = rows_to_insert(existing, new, keys, order)
    return existing.unionByName(added.select(*existing.columns))


def append(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Plain append: repeated runs repeat their rows."""
    return existing.unionByName(new.select(*existing.columns))


def upsert(
    existing: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    keep: Sequence[str] = ("created_at",),
) -> DataFrame:
    """Insert or replace by key; the last new row per key wins.

    Columns in ``keep`` retain the existing value where the key existed. One full outer join
    does both parts, each side holding one row per key.
    """
    latest = first_per_key(new, keys, order, blank=False, last=True)
    columns = existing.columns
    old = existing.select(*keys, F.struct(*columns).alias("_old"))
    fresh = latest.select(*keys, F.struct(*columns).alias("_new"))
    merged = old.join(fresh, list(keys), "full_outer")

    def value(name: str) -> Column:
        before, after = F.col(f"_old.{name}"), F.col(f"_new.{name}")
        if name in keep:
            after = F.coalesce(before, after)
        return F.when(F.col("_new").isNotNull(), after).otherwise(before).alias(name)

    return merged.select(*(value(name) for name in columns))


def retain(df: DataFrame, delete_where: Column) -> DataFrame:
    """What a DELETE leaves: rows for which the condition is false or unknown."""
    return df.filter(~F.coalesce(delete_where, F.lit(False)))


def recent_with_keyword(
    keywords: Sequence[str], now: Column, days: int = 7, created: str = "created_at"
) -> Column:
    """Condition of the clean-up: a listed keyword, and not older than ``days`` days."""
    return F.col("keyword").isin(*keywords) & (F.col(created) >= now - _days(days))


def recent_run_like(
    pattern: str, now: Column, days: int = 7, created: str = "created_at"
) -> Column:
    return F.col("run_id").like(pattern) & (F.col(created) >= now - _days(days))


def _days(count: int) -> Column:
    return F.make_dt_interval(F.lit(count))


def run_log(events: DataFrame) -> DataFrame:
    """Latest state per run from appended events.

    Each event carries ``run_id, event_time, status`` and whatever it knows of paths and
    counts; a NULL never replaces a value reported earlier.
    """
    def latest(name: str) -> Column:
        known_at = F.when(F.col(name).isNotNull(), F.col("event_time"))
        return F.max_by(name, known_at).alias(name)

    others = [
        name for name in events.columns if name not in ("run_id", "event_time", "status")
    ]
    finished = F.when(F.col("status") != "RUNNING", F.col("event_time"))
    return events.groupBy("run_id").agg(
        F.min("event_time").alias("start_time"),
        F.max(finished).alias("end_time"),
        latest("status"),
        *(latest(name) for name in others),
    )


def mark_processed(tracked: DataFrame, extracted: DataFrame, now: Column) -> DataFrame:
    """URL tracking after a run: URLs of extracted articles are added once per stock."""
    done = (
        extracted.select("stock_name", "url").distinct().withColumn("processed_at", now)
    )
    return insert_ignore(tracked, done, ["stock_name", "url"], ["stock_name", "url"])
