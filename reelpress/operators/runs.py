"""Run bookkeeping: outcomes, freshness of upstream runs, stage counters, roll-ups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelpress.functions.text import percent

# ---- fixed values -----------------------------------------------------------------------
SUCCESS, PARTIAL, FAILED = "success", "partial_success", "failed"
UPSTREAM_MAX_AGE_HOURS = 1
# -----------------------------------------------------------------------------------------


def run_outcomes(
    tasks: DataFrame, run: str = "run_id", state: str = "state", success: str = SUCCESS
) -> DataFrame:
    """Task counts, success rate and overall status per run."""
    ok = F.coalesce(F.col(state) == success, F.lit(False))
    counted = tasks.groupBy(run).agg(
        F.count_if(ok).alias("successful_tasks"),
        F.count_if(~ok).alias("failed_tasks"),
        F.count(F.lit(1)).alias("total_tasks"),
    )
    return with_outcome(counted)


def with_outcome(counted: DataFrame) -> DataFrame:
    """Success rate and status from the three task counts (no tasks at all: rate 0)."""
    status = (
        F.when(F.col("failed_tasks") == 0, F.lit(SUCCESS))
        .when(F.col("successful_tasks") > 0, F.lit(PARTIAL))
        .otherwise(F.lit(FAILED))
    )
    return counted.withColumns(
        {
            "success_rate": percent(F.col("successful_tasks"), F.col("total_tasks")),
            "status": status,
        }
    )


def failed_tasks(
    tasks: DataFrame, run: str = "run_id", task: str = "task_id", state: str = "state"
) -> DataFrame:
    """The failed tasks, one row each (a run may have any number of them)."""
    return tasks.filter(~F.coalesce(F.col(state) == SUCCESS, F.lit(False))).select(run, task)


def latest_success(
    runs: DataFrame,
    now: Column,
    max_age_hours: int = UPSTREAM_MAX_AGE_HOURS,
    key: str = "pipeline",
    ts: str = "ts",
    state: str = "state",
    task_ok: str | None = None,
) -> DataFrame:
    """Latest successful run per key and whether it is fresh enough.

    ``task_ok`` names a boolean column that must hold on that run. A run dated after ``now``
    counts as fresh.
    """
    checked = F.coalesce(F.col(task_ok), F.lit(False)) if task_ok else F.lit(True)
    best = (
        runs.filter(F.col(state) == SUCCESS)
        .groupBy(key)
        .agg(
            F.max(ts).alias("last_success"),
            F.max(F.when(checked, F.col(ts))).alias("last_checked"),
        )
    )
    young = now - F.col("last_success") <= F.make_dt_interval(hours=F.lit(max_age_hours))
    same = F.col("last_success").eqNullSafe(F.col("last_checked"))
    return best.select(key, "last_success", (young & same).alias("is_fresh"))


def nearest_success(
    runs: DataFrame,
    upstream: DataFrame,
    key: str,
    id: str,
    ts: str = "ts",
    max_age_hours: int = UPSTREAM_MAX_AGE_HOURS,
) -> DataFrame:
    """For every run the time of the latest upstream success at or before it, if fresh enough.

    An as-of join without a range join. The time line of a key is cut into stretches of a
    thousandth of the age limit, one second at least. The latest success of each stretch is a
    partial maximum; ``carried_forward`` tells what a stretch begins with. Runs then need only the
    successes of their own stretch, so a busy key is spread over as many groups as it has stretches.
    """
    width = max(1_000_000, max_age_hours * 3600 * 1000)
    stretch = F.floor(F.unix_micros(F.col(ts).cast("timestamp")) / F.lit(width))
    none = F.lit(None).cast(runs.schema[ts].dataType)
    asked = runs.select(key, id, ts, stretch.alias("stretch"), none.alias("success_at"))
    given = upstream.select(
        key,
        F.lit(None).cast(runs.schema[id].dataType).alias(id),
        ts,
        stretch.alias("stretch"),
        F.col(ts).alias("success_at"),
    )
    both = asked.unionByName(given)
    latest = both.groupBy(F.col(key).alias("_key"), F.col("stretch").alias("_stretch")).agg(
        F.max("success_at").alias("_latest")
    )
    begins = carried_forward(latest, "_key", "_stretch", "_latest").select(
        "_key", "_stretch", F.col("carried").alias("_carried")
    )
    # at equal times the upstream row comes first
    line = (
        Window.partitionBy(key, "stretch")
        .orderBy(F.col(ts), F.col("success_at").isNull())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = both.withColumn("_within", F.last("success_at", ignorenulls=True).over(line)).filter(
        F.col("success_at").isNull()
    )
    found = seen.join(
        begins, F.col(key).eqNullSafe(F.col("_key")) & (F.col("stretch") == F.col("_stretch")), "left"
    ).withColumn("upstream_ts", F.coalesce("_within", "_carried"))
    young = F.col(ts) - F.col("upstream_ts") <= F.make_dt_interval(hours=F.lit(max_age_hours))
    return found.select(key, id, ts, F.when(young, F.col("upstream_ts")).alias("upstream_ts"))


#: places of one level of the tree of stretches that make one place of the next
FAN = 1 << 15
#: levels; FAN ** LEVELS places of a second hold every timestamp there is
LEVELS = 3


def carried_forward(df: DataFrame, key: str, place: str, value: str) -> DataFrame:
    """Rows (key, place) with ``carried``, the value of the key's last earlier place that has one.

    Places are whole numbers, one row each; rows without an earlier value go. Values are carried in a tree:
    within the next level's place first, and that place's own carried value where nothing came
    before within it. A window holds at most ``FAN`` rows, so a key with millions of places is dealt
    over all tasks; no window is partitioned by the key alone.
    """
    middle = FAN**LEVELS // 2  # in the middle of the only place of the last level
    level = df.select(key, (F.col(place) + middle).alias("_p0"), F.col(value).alias("_v"))
    tables = []
    for i in range(LEVELS):
        above = F.floor(F.col(f"_p{i}") / F.lit(FAN)).alias(f"_p{i + 1}")
        earlier = (
            Window.partitionBy(key, f"_p{i + 1}")
            .orderBy(f"_p{i}")
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        level = level.select("*", above)
        tables.append(level.withColumn(f"_c{i}", F.last("_v", ignorenulls=True).over(earlier)))
        level = level.groupBy(key, f"_p{i + 1}").agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(f"_p{i}"))).alias("_v"))
    carried = tables[-1].drop("_v")
    for i in reversed(range(LEVELS - 1)):
        over = carried.select(
            F.col(key).alias("_over"), F.col(f"_p{i + 1}").alias("_at"), F.col(f"_c{i + 1}").alias("_from")
        ).filter(F.col("_from").isNotNull())
        same = F.col(key).eqNullSafe(F.col("_over")) & (F.col(f"_p{i + 1}") == F.col("_at"))
        carried = tables[i].join(over, same, "left").select(
            key, f"_p{i}", F.coalesce(f"_c{i}", "_from").alias(f"_c{i}")
        )
    return carried.filter(F.col("_c0").isNotNull()).select(
        key, (F.col("_p0") - middle).alias(place), F.col("_c0").alias("carried")
    )


def stage_counters(df: DataFrame, stages: Mapping[str, Column]) -> DataFrame:
    """One row with the number of rows for which each stage's condition holds."""
    return df.agg(
        *(F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in stages.items())
    )


def stage_counters_by(
    df: DataFrame, keys: Sequence[str], stages: Mapping[str, Column]
) -> DataFrame:
    return df.groupBy(*keys).agg(
        *(F.count_if(F.coalesce(cond, F.lit(False))).alias(name) for name, cond in stages.items())
    )


def entities_with_results(
    entities: DataFrame, results: DataFrame, key: str, sums: Sequence[str]
) -> DataFrame:
    """Every entity with the sums of its results; ``has_result`` is False where there are none."""
    found = results.groupBy(key).agg(
        *(F.sum(name).alias(name) for name in sums), F.lit(True).alias("has_result")
    )
    joined = entities.join(found, key, "left")
    filled = {name: F.coalesce(name, F.lit(0)) for name in sums}
    return joined.withColumns({**filled, "has_result": F.coalesce("has_result", F.lit(False))})


def rollup_entities(
    entities: DataFrame, results: DataFrame, key: str, sums: Sequence[str]
) -> DataFrame:
    """One row: entities in all, entities with results, and the grand totals."""
    return entities_with_results(entities, results, key, sums).agg(
        F.count(F.lit(1)).alias("total_entities"),
        F.count_if("has_result").alias("processed_entities"),
        *(F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in sums),
    )


def batch_manifest(processed: DataFrame, batch: str, path: str, order: str) -> DataFrame:
    """Per batch: article count, paths present and missing, and the path of its first record.

    The paths themselves stay a table, see ``batch_paths``.
    """
    there = F.col(path).isNotNull() & (F.col(path) != "")
    return processed.groupBy(batch).agg(
        F.count(F.lit(1)).alias("processed_count"),
        F.count_if(there).alias("path_count"),
        F.count_if(~F.coalesce(there, F.lit(False))).alias("missing_path_count"),
        F.min_by(path, F.when(F.col(path).isNotNull(), F.col(order))).alias("first_path"),
    )


def batch_paths(processed: DataFrame, batch: str, path: str) -> DataFrame:
    """The non-empty content paths of each batch, one row each."""
    return processed.filter(F.col(path) != "").select(batch, path)
