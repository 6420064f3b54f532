import shutil
import sys
from datetime import datetime, timedelta

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from vialens.operators import annotate, runs
from vialens.plans import annotation
from vialens.plans.medallion import Lake
from vialens.sources import readers

cloudpickle.register_pickle_by_value(sys.modules[__name__])

T0 = datetime(2025, 1, 1)


def events(spark, rows):
    full = [
        (i, run, step, status, None, done, failed, error, T0 + timedelta(minutes=minute))
        for i, (run, step, status, done, failed, error, minute) in enumerate(rows)
    ]
    return spark.createDataFrame(full, runs.EVENT_SCHEMA)


@pytest.fixture(scope="module")
def log(spark):
    return events(
        spark,
        [
            ("r1", "annotate", "completed", 5, 1, None, 1),
            ("r1", "annotate", "completed", 2, 0, None, 5),
            ("r1", "evaluate", "completed", 5, 1, None, 2),
            ("r1", "evaluate", "completed", 7, 0, None, 6),
            ("r1", "visualize", "skipped", None, None, None, 0),
            ("r2", "annotate", "failed", None, None, "e1", 3),
            ("r2", "annotate", "failed", None, None, "e2", 4),
            ("r2", "annotate", "failed", None, None, "e3", 4),
            ("r2", None, None, None, None, "e4", 2),
            ("r3", "annotate", "running", None, None, None, 9),
            ("r4", None, "initialized", None, None, None, 7),
        ],
    )


def test_progress_adds_or_replaces(log):
    got = {(r.run_id, r.step): r for r in runs.step_progress(log).collect()}
    assert (got["r1", "annotate"].processed, got["r1", "annotate"].failed) == (7, 1)
    assert got["r1", "annotate"].percentage == pytest.approx(87.5)
    assert (got["r1", "evaluate"].processed, got["r1", "evaluate"].failed) == (7, 0)
    assert got["r1", "visualize"].percentage == 0.0
    assert got["r3", "annotate"].status == "running"


def test_status_and_listing(log):
    listed = [(r.run_id, r.status) for r in runs.run_listing(log).collect()]
    assert listed == [
        ("r3", "in_progress"), ("r4", "initialized"), ("r2", "failed"), ("r1", "completed"),
    ]


def test_last_three_errors(log):
    got = [(r.error_no, r.error, r.step) for r in
           runs.recent_errors(log).orderBy("error_no").collect()]
    assert got == [(1, "e3", "annotate"), (2, "e2", "annotate"), (3, "e1", "annotate")]
    plan = runs.recent_errors(log)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_tracked_files(spark):
    rows = [
        ("r", s, f, True, T0 + timedelta(minutes=m))
        for s in runs.STEPS for f, m in (("old", 1), ("new", 2))
    ]
    files = spark.createDataFrame(
        rows, "run_id string, step string, filename string, ok boolean, at timestamp"
    )
    got = sorted((r.step, r.filename) for r in runs.tracked_files(files).collect())
    assert got == [
        ("annotate", "new"), ("annotate", "old"), ("evaluate", "new"),
        ("visualize", "new"), ("visualize", "old"),
    ]


def test_rates_without_attempts(spark):
    empty = spark.createDataFrame([], "kind string, ok boolean, s double")
    assert runs.job_outcomes(empty, "kind", F.col("ok"), F.col("s")).count() == 0
    one = spark.createDataFrame([("a", True, 0.0)], "kind string, ok boolean, s double")
    row = runs.job_outcomes(one, "kind", F.col("ok"), F.col("s")).head()
    assert (row.success_rate, row.per_second) == (1.0, 0.0)


def classify(name, content):
    if name.startswith("boom"):
        raise RuntimeError("model down")
    if name.startswith("dark"):
        return dict.fromkeys(("weather", "timeofday", "scene"), "unknown")
    return {"weather": "clear", "scene": content.decode()}


def detect(content):
    if content == b"none":
        return []
    return [{"id": "1", "category": "car", "box2d": {"x1": 0.0, "y1": 0.0, "x2": 9.0, "y2": 9.0}}]


def test_annotation_statuses(spark):
    work = spark.createDataFrame(
        [("a.jpg", b"city"), ("boom.jpg", b"city"), ("dark.jpg", b"none"), ("boom2.jpg", b"none")],
        "filename string, content binary",
    )
    out = annotate.annotate(work, classify, detect).cache()
    got = {r.name: r for r in out.collect()}
    assert got["a.jpg"].attributes.asDict() == {
        "weather": "clear", "timeofday": "unknown", "scene": "city",
    }
    assert tuple(got["boom.jpg"].processing_status) == ("error", "success")
    assert tuple(got["dark.jpg"].processing_status) == ("failed", "failed")
    kept = {r.name for r in out.where(annotate.succeeded()).collect()}
    assert kept == {"a.jpg", "boom.jpg"}
    assert annotate.failure_rate(out).head().failure_rate == 0.5
    assert annotate.publishable(out, 0.5) and not annotate.publishable(out, 0.4)
    parts = runs.job_outcomes(
        annotate.component_outcomes(out), "component", F.col("outcome") == "success"
    )
    assert {r.component: r.succeeded for r in parts.collect()} == {
        "scene_classification": 1, "object_detection": 2,
    }


def test_tasks_open_the_files(spark, tmp_path):
    (tmp_path / "a b%20é.jpg").write_text("city")
    listed = readers.file_listing(spark, str(tmp_path)).select("filename", "path")
    gone = spark.createDataFrame([("gone.jpg", f"file:{tmp_path}/gone.jpg")], listed.schema)
    work = annotate.spread(listed.union(gone), 1)
    got = {r.name: r for r in annotate.annotate(work, classify, detect).collect()}
    assert got["a b%20é.jpg"].attributes.scene == "city"
    assert tuple(got["gone.jpg"].processing_status) == ("error", "error")


def test_worklist_limit_and_force(spark):
    files = spark.createDataFrame([(f"{c}.jpg",) for c in "dcba"] + [("x.txt",)], "filename string")
    done = spark.createDataFrame([("a.jpg",), ("a.jpg",)], "filename string")
    names = lambda df: [r.filename for r in df.collect()]
    assert names(annotate.worklist(files, done, limit=2)) == ["b.jpg", "c.jpg"]
    assert sorted(names(annotate.worklist(files, done, force=True))) == [
        "a.jpg", "b.jpg", "c.jpg", "d.jpg",
    ]


def test_tracked_run(spark, tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    for name, content in (("a.jpg", "city"), ("b.png", "city"), ("boom.jpg", "none"), ("n.txt", "")):
        (images / name).write_text(content)
    lake = Lake(str(tmp_path / "lake"))
    truth = spark.createDataFrame(
        [("a.jpg", ("Clear", "day", "city"),
          [("7", "Car", (0.0, 0.0, 9.0, 9.0)), ("8", "dog", (50.0, 50.0, 60.0, 60.0))])],
        "name string, attributes struct<weather:string,timeofday:string,scene:string>, "
        "labels array<struct<id:string,category:string,"
        "box2d:struct<x1:double,y1:double,x2:double,y2:double>>>",
    )
    listing = spark.createDataFrame([("a.jpg",)], "filename string")
    steps = {
        "annotate": lambda: annotation.annotate_step(spark, lake, str(images), classify, detect),
        "visualize": lambda: annotation.visualize_step(spark, lake, listing, truth),
        "evaluate": lambda: annotation.evaluate_step(spark, lake, truth),
    }
    assert annotation.run(spark, lake, "r1", steps)
    assert annotation.run(spark, lake, "r2", {"annotate": steps["annotate"]})
    log = lake.read(spark, "run_events")
    got = {(r.run_id, r.step): (r.status, r.processed, r.failed) for r in
           runs.step_progress(log).collect()}
    assert got["r1", "annotate"] == ("completed", 2, 1)
    assert got["r1", "visualize"] == ("completed", 1, 1)
    assert got["r1", "evaluate"] == ("completed", 1, 1)
    assert got["r2", "annotate"] == ("completed", 0, 1)  # a and b are done already
    assert got["r2", "evaluate"][0] == "skipped"
    metrics = lake.read(spark, "image_metrics").collect()
    assert [(r.image_id, r.tp, r.fp, r.fn) for r in metrics] == [("a.jpg", 1, 0, 1)]
    assert lake.read(spark, "overlay_boxes").count() == 3
    shutil.rmtree(tmp_path / "lake" / "overlay_lines")  # as if stopped after the boxes
    steps["visualize"]()
    assert lake.read(spark, "overlay_boxes").count() == 3
    report = spark.read.json(lake.path("report"))
    assert report.where("section = 'per_class_metrics'").count() == 2

    # a step that runs later leaves the others of its run as they are
    assert annotation.run(spark, lake, "r2", {"evaluate": steps["evaluate"]})
    later = {(r.run_id, r.step): (r.status, r.processed) for r in
             runs.step_progress(lake.read(spark, "run_events")).collect()}
    assert later["r2", "annotate"] == ("completed", 0)
    assert later["r2", "evaluate"] == ("completed", 1)
    assert later["r2", "visualize"][0] == "skipped"
    states = lake.read(spark, "run_events").where("run_id = 'r1' AND step = 'annotate'")
    assert [r.status for r in states.orderBy("at").collect()] == ["pending", "running", "completed"]

    def broken():
        raise ValueError("no truth")

    assert not annotation.run(spark, lake, "r3", {"evaluate": broken})
    log = lake.read(spark, "run_events")
    status = {r.run_id: r.status for r in runs.run_status(log).collect()}
    assert status == {"r1": "completed", "r2": "completed", "r3": "failed"}
    assert runs.recent_errors(log).head().error == "ValueError: no truth"


def test_errors_keep_their_text(spark):
    work = spark.createDataFrame([("a.jpg", b"city"), ("boom.jpg", None)], "filename string, content binary")
    out = annotate.annotate(work, classify, detect).withColumn("error", annotate.error_text())
    got = {r.name: r.error for r in out.collect()}
    assert got["a.jpg"] is None
    assert got["boom.jpg"].startswith("scene_classification: RuntimeError: model down; object_detection: FileNotFoundError")


def _folder(tmp_path, outcomes):
    """Images by name; those that fail hold nothing to find."""
    images = tmp_path / "images"
    images.mkdir()
    for i, ok in enumerate(outcomes):
        (images / f"i{i:02d}.jpg").write_text("city" if ok else "none")
    return str(images)


def only_found(name, content):
    return {} if content == b"none" else classify(name, content)


def test_annotates_until_enough_succeed(spark, tmp_path):
    images = _folder(tmp_path, [1, 0, 0, 1, 1, 0, 1, 1])
    lake = Lake(str(tmp_path / "lake"))
    step = lambda: sorted(map(tuple, annotation.annotate_step(spark, lake, images, only_found, detect, successes=3).select("filename", "ok").collect()))
    assert step() == [(f"i{i:02d}.jpg", ok) for i, ok in enumerate([True, False, False, True, True])]
    assert lake.read(spark, "annotations").count() == 3
    # the next run takes what is left, failures included, until three more succeed or none is left
    assert step() == [("i01.jpg", False), ("i02.jpg", False), ("i05.jpg", False), ("i06.jpg", True), ("i07.jpg", True)]
    assert lake.read(spark, "annotations").count() == 5


def test_failures_in_a_row_end_the_batch(spark, tmp_path):
    images = _folder(tmp_path, [1, 0, 1, 0, 0, 1, 1])
    for go_on, n in ((False, 5), (True, 7)):
        lake = Lake(str(tmp_path / f"lake{n}"))
        batch = annotation.annotate_step(spark, lake, images, only_found, detect, most_failures=2, continue_on_error=go_on)
        assert batch.count() == n


def test_nothing_is_published_above_the_ceiling(spark, tmp_path):
    images = tmp_path / "images"
    images.mkdir()
    (images / "boom.jpg").write_text("none")
    lake = Lake(str(tmp_path / "lake"))
    with pytest.raises(annotation.FailureCeiling):
        annotation.annotate_step(spark, lake, str(images), classify, detect, ceiling=0.5)
    assert not (tmp_path / "lake" / "annotations").exists()
