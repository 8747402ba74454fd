"""Analysis of timed runs (one row per run with a nested array of steps)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import two_digits

# Fixed values.
PROFILES = ("sample", "medium", "full")
STEP_ORDER = ("go-producer", "python-consumer", "warehouse-loader")
DRY_RUN_STEP = "not meaningful (dry-run)"


def for_profile(runs: DataFrame, profile: str | None) -> DataFrame:
    return runs.filter(F.col("profile") == profile) if profile else runs


def slowest_step_name() -> Column:
    """Name of the longest step, the earlier one on a tie; a row-local array expression."""
    slowest = F.reduce(
        F.slice("commands", 2, F.greatest(F.size("commands"), F.lit(1))),
        F.get("commands", F.lit(0)),
        lambda best, step: F.when(step["elapsed_seconds"] > best["elapsed_seconds"], step).otherwise(best),
    )
    return F.when(F.col("dry_run"), DRY_RUN_STEP).otherwise(slowest["name"])


def throughput() -> Column:
    """Rows per second with two digits as text, ``n/a`` for a dry run or a run without time."""
    measured = ~F.col("dry_run") & (F.col("total_elapsed_seconds") > 0)
    pace = F.expr(two_digits("try_divide(cast(rows AS double), total_elapsed_seconds)"))
    return F.when(measured, pace).otherwise("n/a")


def run_table(runs: DataFrame) -> DataFrame:
    return runs.select(
        "file", "timestamp", "profile", "rows", "consumer_messages", "loader_messages", "total_elapsed_seconds",
        throughput().alias("throughput"), slowest_step_name().alias("slowest_step"),
    )


def in_order(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Runs by time and then file name, as reports list them; with ``limit`` only the first ones, which need no sort of all."""
    ordered = runs.orderBy("timestamp", "file")
    return ordered if limit is None else ordered.limit(limit)


def size_groups(runs: DataFrame) -> DataFrame:
    return runs.groupBy("rows", "consumer_messages", "loader_messages").agg(F.count(F.lit(1)).alias("run_count"))


def _step_sums(runs: DataFrame) -> DataFrame:
    steps = runs.select(F.explode("commands").alias("step")).select("step.name", "step.elapsed_seconds")
    return steps.groupBy("name").agg(F.sum("elapsed_seconds").alias("elapsed_seconds"))


def step_totals(runs: DataFrame) -> DataFrame:
    """Seconds and percent share per step; the default steps are always listed.

    The default steps join the already summed steps as zero rows, so the second aggregation works on
    one row per step name.
    """
    spark = runs.sparkSession
    defaults = spark.range(1).select(
        F.explode(F.array(*[F.lit(s) for s in STEP_ORDER])).alias("name"), F.lit(0.0).alias("elapsed_seconds")
    )
    summed = _step_sums(runs).unionByName(defaults).groupBy("name").agg(F.sum("elapsed_seconds").alias("elapsed_seconds"))
    total = summed.agg(F.sum("elapsed_seconds").alias("_total"))
    share = F.when(F.col("_total") > 0, F.col("elapsed_seconds") / F.col("_total") * 100).otherwise(0.0)
    return summed.crossJoin(F.broadcast(total)).select("name", "elapsed_seconds", share.alias("share_percent"))


def profile_averages(runs: DataFrame) -> DataFrame:
    """Per profile, listed profiles only."""
    return (
        runs.filter(F.col("profile").isin(*PROFILES))
        .groupBy("profile")
        .agg(
            F.count(F.lit(1)).alias("run_count"),
            F.count_if("dry_run").alias("dry_run_count"),
            F.avg("total_elapsed_seconds").alias("average_total_seconds"),
        )
    )


def bottleneck(runs: DataFrame) -> DataFrame:
    """Over real runs: the step with the most time, and the step that is slowest most often.

    Ties go to the default step order, then to the name (time), and to the run that comes first in
    (timestamp, file) order (frequency).
    """
    real = runs.filter(~F.col("dry_run"))
    place = F.coalesce(F.array_position(F.array(*[F.lit(s) for s in STEP_ORDER]), F.col("name")), F.lit(0))
    rank = F.when(place == 0, len(STEP_ORDER) + 1).otherwise(place)
    dominant = step_totals(real).agg(
        F.min(F.struct((-F.col("elapsed_seconds")).alias("less"), rank.alias("place"), "name"))["name"].alias("dominant_step")
    )
    frequent = (
        real.select(slowest_step_name().alias("name"), F.struct("timestamp", "file").alias("run"))
        .groupBy("name")
        .agg(F.count(F.lit(1)).alias("n"), F.min("run").alias("first_run"))
        .agg(
            F.min(F.struct((-F.col("n")).alias("less"), "first_run", "name"))["name"].alias("most_frequent_slowest"),
            F.max("n").alias("slowest_runs"),
            F.coalesce(F.sum("n"), F.lit(0)).alias("real_runs"),
        )
    )
    # both sides are global aggregates: one row each
    return dominant.crossJoin(F.broadcast(frequent)).filter("real_runs > 0")


def overview(runs: DataFrame) -> DataFrame:
    """Counts, profiles and the fastest and slowest run (first in run order on a tie)."""
    run = F.struct("timestamp", "file")

    def extreme(sign: int) -> Column:
        by = F.struct((F.col("total_elapsed_seconds") * sign).alias("t"), run.alias("run"))
        return F.min(by)["run"]["file"]

    return runs.agg(
        F.count(F.lit(1)).alias("run_count"),
        F.count_if("dry_run").alias("dry_run_count"),
        F.count_if(~F.col("dry_run")).alias("real_run_count"),
        F.array_join(F.array_sort(F.collect_set("profile")), ", ").alias("profiles_included"),
        extreme(1).alias("fastest_run"),
        extreme(-1).alias("slowest_run"),
    )


def profiles(runs: DataFrame) -> DataFrame:
    return runs.select("profile").distinct()


def total_seconds(commands: str = "commands") -> Column:
    """Sum of the step times of a run, six digits."""
    return F.round(F.aggregate(commands, F.lit(0.0), lambda total, step: total + step["elapsed_seconds"]), 6)
