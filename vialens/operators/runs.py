"""Run tracking over an append-only table of run events.

Events: run_id, step, status, total, processed, failed, error, at (time) and
event_id, which orders events of the same time. Nothing is updated in place;
the state of a run is an aggregation of its events.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vialens.functions.ratios import ratio
from vialens.operators.scale import settle

# Steps in running order, and those whose counts add up over reruns.
STEPS = ("annotate", "visualize", "evaluate")
ADDITIVE_STEPS = ("annotate", "visualize")

EVENT_SCHEMA = (
    "event_id long, run_id string, step string, status string, total long, "
    "processed long, failed long, error string, at timestamp"
)


def _order() -> Column:
    return F.struct("at", "event_id")


def _latest(column: str) -> Column:
    return F.max_by(column, _order())


def step_progress(events: DataFrame) -> DataFrame:
    """State and counts per run and step.

    Annotate and visualize add up over reruns, evaluate keeps its latest result.
    The percentage is of processed plus failed.
    """
    adds = F.col("step").isin(*ADDITIVE_STEPS)
    done = F.col("processed").isNotNull()
    latest = F.max_by(
        F.struct("processed", "failed"), F.when(done, _order())
    )
    counted = (
        events.where(F.col("step").isNotNull())
        .groupBy("run_id", "step")
        .agg(
            _latest("status").alias("status"),
            F.sum("processed").alias("_sp"),
            F.sum("failed").alias("_sf"),
            latest.alias("_last"),
        )
        .withColumn("processed", F.when(adds, F.col("_sp")).otherwise(F.col("_last.processed")))
        .withColumn("failed", F.when(adds, F.col("_sf")).otherwise(F.col("_last.failed")))
        .withColumn("processed", F.coalesce("processed", F.lit(0).cast("bigint")))
        .withColumn("failed", F.coalesce("failed", F.lit(0).cast("bigint")))
        .withColumn("total", F.col("processed") + F.col("failed"))
    )
    share = F.col("processed") / F.greatest(F.col("total"), F.lit(1)) * 100
    return counted.select(
        "run_id", "step", "status", "total", "processed", "failed", share.alias("percentage")
    )


def run_status(events: DataFrame) -> DataFrame:
    """One row per run: failed as soon as a step's latest state is failed.

    completed when every step is completed or skipped, initialized before any
    step has an event, else in_progress.
    """
    steps = (
        events.groupBy("run_id", "step")
        .agg(
            _latest("status").alias("status"),
            F.min("at").alias("created_at"),
            F.max("at").alias("updated_at"),
        )
        .withColumn("_step", F.col("step").isNotNull())
    )
    finished = F.col("status").isin("completed", "skipped")
    return (
        steps.groupBy("run_id")
        .agg(
            F.min("created_at").alias("created_at"),
            F.max("updated_at").alias("updated_at"),
            F.count_if("_step").alias("n_steps"),
            F.count_if(F.col("_step") & finished).alias("_finished"),
            F.count_if(F.col("_step") & (F.col("status") == "failed")).alias("_failed"),
        )
        .select(
            "run_id",
            F.when(F.col("n_steps") == 0, "initialized")
            .when(F.col("_failed") > 0, "failed")
            .when(F.col("_finished") == F.col("n_steps"), "completed")
            .otherwise("in_progress")
            .alias("status"),
            "created_at",
            "updated_at",
            "n_steps",
        )
    )


def run_listing(events: DataFrame) -> DataFrame:
    """Runs, newest first."""
    return run_status(events).orderBy(F.desc("created_at"), "run_id")


def recent_errors(events: DataFrame, n: int = 3) -> DataFrame:
    """The last n errors of each run, newest first."""
    newest = Window.partitionBy("run_id").orderBy(F.desc("at"), F.desc("event_id"))
    return (
        events.where(F.col("error").isNotNull())
        .withColumn("error_no", F.row_number().over(newest))
        .where(F.col("error_no") <= n)
        .select(
            "run_id", "error_no", "at", F.coalesce("step", F.lit("unknown")).alias("step"), "error"
        )
    )


def tracked_files(files: DataFrame) -> DataFrame:
    """Files of each run and step as they stand: (run_id, step, filename, ok, at).

    Annotate and visualize keep every file of every pass; evaluate keeps its
    latest pass. The list stays a table, however long it is.
    """
    adds = F.col("step").isin(*ADDITIVE_STEPS)
    last = settle(files.groupBy("run_id", "step").agg(F.max("at").alias("_last")))
    return files.join(last, ["run_id", "step"]).where(adds | (F.col("at") == F.col("_last"))).drop(
        "_last"
    )


def step_events(
    outcomes: DataFrame, run_id: str, step: str, at: Column | None = None
) -> DataFrame:
    """The closing event of a step from its outcome rows (``ok`` true or false)."""
    when = F.current_timestamp() if at is None else at
    return outcomes.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if("ok").alias("processed"),
        F.count_if(~F.col("ok")).alias("failed"),
    ).select(
        F.xxhash64(F.lit(run_id), F.lit(step), when).alias("event_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        F.lit("completed").alias("status"),
        "total",
        "processed",
        "failed",
        F.lit(None).cast("string").alias("error"),
        when.alias("at"),
    )


def step_state(
    spark, run_id: str, step: str, status: str, error: str | None = None, at: Column | None = None
) -> DataFrame:
    """An event that changes a step's state and counts nothing."""
    when = F.current_timestamp() if at is None else at
    return spark.range(1).select(
        F.xxhash64(F.lit(run_id), F.lit(step), F.lit(status), when).alias("event_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        F.lit(status).alias("status"),
        *[F.lit(None).cast("bigint").alias(c) for c in ("total", "processed", "failed")],
        F.lit(error).cast("string").alias("error"),
        when.alias("at"),
    )


def initial_events(spark, run_id: str, wanted: Sequence[str], at: Column | None = None) -> DataFrame:
    """The opening events of a run: every step, pending or skipped."""
    rows = [
        (i, run_id, s, "pending" if s in wanted else "skipped") for i, s in enumerate(STEPS)
    ]
    opened = spark.createDataFrame(rows, "event_id long, run_id string, step string, status string")
    none = {c: F.lit(None).cast("bigint") for c in ("total", "processed", "failed")}
    return opened.withColumns(none).withColumns(
        {
            "error": F.lit(None).cast("string"),
            "at": F.current_timestamp() if at is None else at,
        }
    )


def job_outcomes(results: DataFrame, by: str, ok: Column, seconds: Column | None = None) -> DataFrame:
    """Totals and success rate per component; rates are 0.0 with nothing to divide."""
    total, good = F.col("total"), F.col("succeeded")
    columns = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(ok).alias("succeeded"),
        F.count_if(~ok).alias("failed"),
    ]
    if seconds is not None:
        columns.append(F.sum(seconds).alias("seconds"))
    out = results.groupBy(by).agg(*columns).withColumn("success_rate", ratio(good, total))
    if seconds is not None:
        out = out.withColumn("per_second", ratio(total, F.col("seconds")))
    return out
