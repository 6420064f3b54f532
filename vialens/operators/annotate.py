"""Incremental annotation: pick what is left to do, score it, keep what worked."""

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.operators.transform import image_files, not_done
from vialens.sources.readers import read_bytes
from vialens.schemas import GENERATED_ANNOTATION, SCENE_ATTRIBUTES

COMPONENTS = ("scene_classification", "object_detection")

ClassifyScene = Callable[[str, bytes], dict]
DetectObjects = Callable[[bytes], list]


def worklist(
    files: DataFrame, annotated: DataFrame, limit: int | None = None, force: bool = False
) -> DataFrame:
    """Image files without an annotation yet, by name; ``limit`` caps one run's work."""
    todo = not_done(image_files(files), annotated, "filename", force)
    return todo if limit is None else todo.orderBy("filename").limit(limit)


def _one(
    name: str, load: Callable[[], bytes], classify: ClassifyScene, detect: DetectObjects
) -> dict:
    attributes = dict.fromkeys(SCENE_ATTRIBUTES, "unknown")
    errors = dict.fromkeys(COMPONENTS)
    content = None
    try:
        content = load()
        found = classify(name, content)
        known = bool(found) and any(v != "unknown" for v in found.values())
        if known:
            attributes.update({k: found[k] for k in SCENE_ATTRIBUTES if k in found})
        scene = "success" if known else "failed"
    except Exception as e:
        scene = "error"
        errors["scene_classification"] = f"{type(e).__name__}: {e}"
    labels = []
    try:
        if content is None:
            raise FileNotFoundError(name)
        labels = detect(content) or []
        objects = "success" if labels else "failed"
    except Exception as e:
        objects = "error"
        errors["object_detection"] = f"{type(e).__name__}: {e}"
    return {
        "name": name,
        "attributes": attributes,
        "labels": labels,
        "processing_status": {"scene_classification": scene, "object_detection": objects},
        "processing_errors": errors,
    }


def annotate(
    work: DataFrame,
    classify: ClassifyScene,
    detect: DetectObjects,
    read: Callable[[str], bytes] = read_bytes,
) -> DataFrame:
    """Runs the caller's two models over (filename, path) or (filename, content) rows.

    Given paths, the tasks open the files themselves, so image bytes are never
    joined or shuffled. A model that raises marks its own component ``error``,
    what it raised is in ``processing_errors``, and the image goes on; a file
    that cannot be read is an error of both.
    """
    source = "content" if "content" in work.columns else "path"

    def loader(value) -> Callable[[], bytes]:
        return (lambda: value) if source == "content" else (lambda: read(value))

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame(
                [
                    _one(n, loader(v), classify, detect)
                    for n, v in zip(batch["filename"], batch[source])
                ],
                columns=GENERATED_ANNOTATION.names,
            )

    return work.select("filename", source).mapInPandas(score, GENERATED_ANNOTATION)


def spread(work: DataFrame, per_task: int = 64) -> DataFrame:
    """``work`` in tasks of about ``per_task`` rows: a row is small, scoring its image is not."""
    return work.repartition(max(1, -(-work.count() // per_task)))


def _status(component: str) -> Column:
    return F.col(f"processing_status.{component}")


def succeeded() -> Column:
    """An annotation is kept when either component worked."""
    return (_status("scene_classification") == "success") | (
        _status("object_detection") == "success"
    )


def component_outcomes(annotations: DataFrame) -> DataFrame:
    """(component, outcome) rows, two per annotation."""
    parts = F.array(
        *[
            F.struct(F.lit(c).alias("component"), _status(c).alias("outcome"))
            for c in COMPONENTS
        ]
    )
    return annotations.select(F.col("name"), F.inline(parts))


def error_text() -> Column:
    """What the components of an annotation that raised have said; NULL if none did."""
    parts = [F.when(F.col(f"processing_errors.{c}").isNotNull(), F.concat_ws(" ", F.lit(f"{c}:"), F.col(f"processing_errors.{c}"))) for c in COMPONENTS]
    return F.nullif(F.concat_ws("; ", *parts), F.lit(""))


def failure_rate(annotations: DataFrame) -> DataFrame:
    """One row: attempts, failures and their share, for the check before publishing."""
    return annotations.agg(
        F.count(F.lit(1)).alias("attempts"), F.count_if(~succeeded()).alias("failures")
    ).withColumn(
        "failure_rate",
        F.when(F.col("attempts") > 0, F.col("failures") / F.col("attempts")).otherwise(0.0),
    )


def publishable(annotations: DataFrame, ceiling: float = 0.5) -> bool:
    """Whether the batch stays within the failure ceiling.

    A rate over the finished batch; ``attempts`` has the limit of failures in a row.
    """
    return failure_rate(annotations).head()["failure_rate"] <= ceiling
