"""Annotate, visualise, evaluate: the three steps of a tracked run."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vialens.operators import annotate, attempts, evaluation, matching, runs
from vialens.operators.scale import settle
from vialens.operators.transform import keys_of, not_done, with_presence
from vialens.plans.medallion import Lake
from vialens.schemas import GENERATED_ANNOTATION
from vialens.sources import readers, writers


class FailureCeiling(RuntimeError):
    """Too large a share of a batch failed; nothing was published."""


def _append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def annotate_step(
    spark: SparkSession,
    lake: Lake,
    images: str,
    classify: annotate.ClassifyScene,
    detect: annotate.DetectObjects,
    limit: int | None = None,
    ceiling: float | None = None,
    successes: int | None = None,
    most_failures: int | None = None,
    continue_on_error: bool = False,
) -> DataFrame:
    """Annotates what has no annotation yet; returns (filename, ok, error) of this batch.

    The work list holds paths only; the files are opened by the tasks that score
    them. The batch is written before it is judged: models are not run twice for
    one image, and only a batch within the ceiling joins the annotations.
    ``limit`` caps the attempts, ``successes`` the images that succeed;
    ``most_failures`` in a row, by name, end the batch, or with
    ``continue_on_error`` only warn. The batch ends where trying one image after
    the other would.
    """
    done = lake.read_or_empty(spark, "annotations", "name string")
    files = readers.file_listing(spark, images).select("filename", "path")
    work = settle(annotate.worklist(files, done.withColumnRenamed("name", "filename"), limit))
    batch_path = lake.path("annotation_batch")

    def score(part: DataFrame) -> DataFrame:
        scored = annotate.annotate(annotate.spread(part), classify, detect)
        return scored.withColumns({"filename": F.col("name"), "ok": annotate.succeeded()})

    if successes is None and most_failures is None:
        made = score(work)
    else:
        made = attempts.in_waves(work, score, successes, most_failures, continue_on_error)
    made.select(*GENERATED_ANNOTATION.names).write.mode("overwrite").parquet(batch_path)
    batch = spark.read.parquet(batch_path)
    if ceiling is not None and not annotate.publishable(batch, ceiling):
        raise FailureCeiling(f"more than {ceiling:.0%} of the batch failed")
    _append(batch.where(annotate.succeeded()), lake.path("annotations"))
    return batch.select(
        F.col("name").alias("filename"),
        annotate.succeeded().alias("ok"),
        annotate.error_text().alias("error"),
    )


def visualize_step(
    spark: SparkSession, lake: Lake, images: DataFrame, truth: DataFrame
) -> DataFrame:
    """Overlay boxes and comparison lines of annotated images that have none yet.

    ``images``: filename of the source images; an annotation without its image
    fails. Returns (filename, ok).
    """
    drawn = lake.read_or_empty(spark, "overlay_lines", "name string")
    todo = not_done(lake.read(spark, "annotations"), drawn, "name")
    work = settle(with_presence(todo, images.withColumnRenamed("filename", "name"), flag="ok"))
    found = work.where("ok")
    shown_truth = truth.join(keys_of(found, "name"), "name", "left_semi")
    boxes = evaluation.overlay_rows(
        matching.explode_boxes(shown_truth), matching.explode_boxes(found)
    )
    # a run that stopped before its lines left boxes behind: they are not written again
    written = lake.read_or_empty(spark, "overlay_boxes", "image_id string")
    _append(not_done(boxes, written, "image_id"), lake.path("overlay_boxes"))
    # last: a line marks its image as drawn
    _append(evaluation.overlay_attributes(truth, found), lake.path("overlay_lines"))
    return work.select(F.col("name").alias("filename"), "ok")


def evaluate_step(
    spark: SparkSession,
    lake: Lake,
    truth: DataFrame,
    threshold: float = 0.5,
    mapping: dict[str, str] | None = None,
) -> DataFrame:
    """Outcomes, per-image metrics and the report; returns (filename, ok)."""
    generated = lake.read(spark, "annotations")
    status = evaluation.evaluated_files(truth, generated)
    both = keys_of(truth, "name").join(keys_of(generated, "name"), "name", "left_semi")
    gt = matching.explode_boxes(truth.join(both, "name", "left_semi"))
    pred = matching.explode_boxes(generated.join(both, "name", "left_semi"))
    rows = evaluation.outcomes(
        gt, pred, matching.greedy_match(gt, pred, threshold), mapping
    )
    rows.write.mode("overwrite").parquet(lake.path("outcomes"))
    rows = lake.read(spark, "outcomes")
    images = both.select(F.col("name").alias("image_id"))
    writers.write_table(
        evaluation.image_metrics(rows, images), lake.path("image_metrics"), partition_by=None
    )
    compared = evaluation.attribute_comparison(truth, generated)
    report = evaluation.report_rows(rows, compared, threshold, mapping, images)
    writers.write_report(report, lake.path("report"))
    return status.select(F.col("name").alias("filename"), (F.col("status") == "evaluated").alias("ok"))


def open_run(spark: SparkSession, lake: Lake, run_id: str, wanted: Sequence[str]) -> None:
    """Opens a new run. A run that exists keeps its steps: only those it had skipped open."""
    log = lake.read_or_empty(spark, "run_events", runs.EVENT_SCHEMA)
    known = runs.step_progress(log).where(F.col("run_id") == run_id).select("step", "status")
    known = {r.step: r.status for r in known.collect()}  # a row a step
    events = runs.initial_events(spark, run_id, wanted)
    if known:
        again = [s for s in wanted if known.get(s, "skipped") == "skipped"]
        events = events.where(F.col("step").isin(again))
    _append(events, lake.path("run_events"))


def start_step(spark: SparkSession, lake: Lake, run_id: str, step: str) -> None:
    """Records that a step runs, so a driver that dies leaves it running, not pending."""
    _append(runs.step_state(spark, run_id, step, "running"), lake.path("run_events"))


def close_step(lake: Lake, run_id: str, step: str, result: DataFrame) -> None:
    """Records a step's counts and which files it completed or failed."""
    _append(runs.step_events(result, run_id, step), lake.path("run_events"))
    tracked = result.select(
        F.lit(run_id).alias("run_id"),
        F.lit(step).alias("step"),
        "filename",
        "ok",
        (F.col("error") if "error" in result.columns else F.lit(None).cast("string")).alias("error"),
        F.current_timestamp().alias("at"),
    )
    _append(tracked, lake.path("run_files"))


def fail_step(spark: SparkSession, lake: Lake, run_id: str, step: str, error: str) -> None:
    _append(runs.step_state(spark, run_id, step, "failed", error), lake.path("run_events"))


def run(spark: SparkSession, lake: Lake, run_id: str, steps: dict) -> bool:
    """Runs the given steps in their fixed order; the first that raises ends the run.

    ``steps`` maps a step name to a function without arguments returning (filename, ok).
    """
    open_run(spark, lake, run_id, list(steps))
    for step in runs.STEPS:
        if step in steps:
            start_step(spark, lake, run_id, step)
            try:
                close_step(lake, run_id, step, steps[step]())
            except Exception as e:
                fail_step(spark, lake, run_id, step, f"{type(e).__name__}: {e}")
                return False
    return True
