"""Metrics over matched and unmatched boxes.

Everything after the matching reads one table of outcomes: a row per match and
a row per box left over. Each metric is one aggregation of it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.ratios import f1, precision, ratio, recall
from vialens.operators.matching import greedy_match, unmatched, with_index
from vialens.operators.transform import with_presence
from vialens.schemas import EVALUATION_CATEGORIES, SCENE_ATTRIBUTES

# Thresholds of the sweep as twentieths: 0.5, 0.55, ... 0.95
SWEEP = range(10, 20)


def evaluation_category(category: Column, mapping: dict[str, str] | None = None) -> Column:
    """Lower-cased, then mapped; unmapped names stay as they are."""
    table = EVALUATION_CATEGORIES if mapping is None else mapping
    low = F.lower(category)
    if not table:
        return low
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.coalesce(known[low], low)


def evaluated_files(
    truth: DataFrame, predicted: DataFrame, key: str = "name", file: str | None = None
) -> DataFrame:
    """Every prediction with its status: ``evaluated``, or ``failed`` without ground truth.

    An unreadable prediction has no name of its own; with ``file``, the column
    that holds its file's name, it goes by that.
    """
    name = F.col(key) if file is None else F.coalesce(key, file)
    found = with_presence(predicted.select(key, name.alias("_shown")), truth, key, "_ok")
    return found.select(
        F.col("_shown").alias(key), F.when(F.col("_ok"), "evaluated").otherwise("failed").alias("status")
    )


def outcomes(
    gt: DataFrame,
    pred: DataFrame,
    matches: DataFrame | None = None,
    mapping: dict[str, str] | None = None,
    threshold: float = 0.5,
) -> DataFrame:
    """image_id, kind (match, gt, pred), iou, ids, raw and evaluation categories.

    A box that is left over counts under its own category. The box tables
    should hold only images present on both sides (see evaluated_files).
    """
    matches = greedy_match(gt, pred, threshold) if matches is None else matches
    none = F.lit(None).cast("string")
    matched = matches.select(
        "image_id",
        F.lit("match").alias("kind"),
        "iou",
        "gt_id",
        "pred_id",
        "gt_category",
        "pred_category",
    )
    only_gt = unmatched(gt, matches, "g").select(
        "image_id",
        F.lit("gt").alias("kind"),
        F.lit(None).cast("double").alias("iou"),
        F.col("label_id").alias("gt_id"),
        none.alias("pred_id"),
        F.col("category").alias("gt_category"),
        none.alias("pred_category"),
    )
    only_pred = unmatched(pred, matches, "p").select(
        "image_id",
        F.lit("pred").alias("kind"),
        F.lit(None).cast("double").alias("iou"),
        none.alias("gt_id"),
        F.col("label_id").alias("pred_id"),
        none.alias("gt_category"),
        F.col("category").alias("pred_category"),
    )
    return (
        matched.unionByName(only_gt)
        .unionByName(only_pred)
        .withColumn("gt_class", evaluation_category(F.col("gt_category"), mapping))
        .withColumn("pred_class", evaluation_category(F.col("pred_category"), mapping))
        .withColumn("category_match", F.col("gt_class") == F.col("pred_class"))
    )


# The kinds of outcome, as predicates.


def _match() -> Column:
    return F.col("kind") == "match"


def _right() -> Column:
    return _match() & F.col("category_match")


def _wrong() -> Column:
    return _match() & ~F.col("category_match")


def _only_gt() -> Column:
    return F.col("kind") == "gt"


def _only_pred() -> Column:
    return F.col("kind") == "pred"


def _scores(df: DataFrame) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return df.withColumn("precision", precision(tp, fp)).withColumn("recall", recall(tp, fn)).withColumn(
        "f1", f1(F.col("precision"), F.col("recall"))
    )


def _with_images(rows: DataFrame, images: DataFrame | None) -> DataFrame:
    """``rows`` and one of kind ``image`` for every evaluated image, boxes or not."""
    if images is None:
        return rows
    named = images.select("image_id").dropna().distinct().withColumn("kind", F.lit("image"))
    return rows.unionByName(named, allowMissingColumns=True)


def image_metrics(rows: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """Per image. A match of the wrong category is a false positive, not a false negative.

    ``images`` (image_id) are the images evaluated; those without any box have
    a row of zeros.
    """
    return _scores(
        _with_images(rows, images).groupBy("image_id").agg(
            F.count_if(_right()).alias("tp"),
            F.count_if(_only_pred() | _wrong()).alias("fp"),
            F.count_if(_only_gt()).alias("fn"),
            F.count_if(_match() | _only_gt()).alias("total_gt"),
            F.count_if(_match() | _only_pred()).alias("total_pred"),
        )
    )


def _sweep_counts() -> list[Column]:
    """tp, fp and fn at every threshold of the sweep, as aggregates of the outcomes."""
    at, counts = F.col("iou"), []
    for k in SWEEP:
        t = F.lit(k / 20)
        counts += [
            F.count_if(_right() & (at >= t)).alias(f"tp{k}"),
            F.count_if(_only_pred() | (_wrong() & (at >= t))).alias(f"fp{k}"),
            F.count_if(_only_gt() | (_match() & (at < t))).alias(f"fn{k}"),
        ]
    return counts


def threshold_sweep(rows: DataFrame) -> DataFrame:
    """Precision, recall and F1 at ten IoU thresholds, in one pass over the outcomes."""
    steps = F.array(
        *[
            F.struct(
                F.lit(k / 20).alias("iou_threshold"),
                F.col(f"tp{k}").alias("tp"),
                F.col(f"fp{k}").alias("fp"),
                F.col(f"fn{k}").alias("fn"),
            )
            for k in SWEEP
        ]
    )
    return _scores(rows.agg(*_sweep_counts()).select(F.inline(steps)))


def evaluation_summary(rows: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One row. Quality is taken at IoU 0.5 whatever the matching threshold was.

    ``total_images`` counts ``images``; without them, the images that have a box.

    ``mean_precision_50_95`` averages the precision over the sweep; it is not an
    average precision, the boxes carry no confidence to rank by.
    """
    at_50 = SWEEP[0]
    tp, fp, fn = (F.col(f"{c}{at_50}") for c in ("tp", "fp", "fn"))
    precisions = [precision(F.col(f"tp{k}"), F.col(f"fp{k}")) for k in SWEEP]
    evaluated = (
        F.count_distinct("image_id") if images is None else F.count_if(F.col("kind") == "image")
    )
    return (
        _with_images(rows, images).agg(
            evaluated.alias("total_images"),
            F.count_if(_match() | _only_gt()).alias("total_gt_objects"),
            F.count_if(_match() | _only_pred()).alias("total_pred_objects"),
            F.count_if(_right()).alias("true_positives"),
            F.count_if(_only_pred() | _wrong()).alias("false_positives"),
            F.count_if(_only_gt() | _wrong()).alias("false_negatives"),
            *_sweep_counts(),
        )
        .withColumn("precision_at_50", precision(tp, fp))
        .withColumn("recall_at_50", recall(tp, fn))
        .withColumn("f1_at_50", f1(F.col("precision_at_50"), F.col("recall_at_50")))
        .withColumn("mean_precision_50_95", sum(precisions) / len(precisions))
        .drop(*[f"{c}{k}" for k in SWEEP for c in ("tp", "fp", "fn")])
    )


def class_metrics(rows: DataFrame) -> DataFrame:
    """Per evaluation category. A wrong match costs the true class and the predicted class."""

    def entry(cls: str, tp: Column, fp: Column, fn: Column) -> Column:
        return F.struct(
            F.col(cls).alias("category"),
            tp.cast("bigint").alias("tp"),
            fp.cast("bigint").alias("fp"),
            fn.cast("bigint").alias("fn"),
        )

    no = F.lit(False)
    entries = F.array(
        entry("gt_class", _right(), no, _wrong() | _only_gt()),
        entry("pred_class", no, _wrong() | _only_pred(), no),
    )
    return _scores(
        rows.select(F.inline(entries))
        .where(F.col("category").isNotNull() & (F.col("tp") + F.col("fp") + F.col("fn") > 0))
        .groupBy("category")
        .agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"), F.sum("fn").alias("fn"))
    )


def category_confusion(rows: DataFrame) -> DataFrame:
    """True raw category against predicted raw category, or ``unmatched``."""
    return (
        rows.where(~_only_pred())
        .groupBy(
            F.lower("gt_category").alias("gt_category"),
            F.coalesce(F.lower("pred_category"), F.lit("unmatched")).alias("predicted_as"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def original_category_metrics(rows: DataFrame) -> DataFrame:
    """Per raw category present in the ground truth."""
    gt, pred = F.lower("gt_category"), F.lower("pred_category")
    right = _match() & (gt == pred)

    def entry(category: Column, side_gt: Column, hit: Column, met: Column, side_pred: Column):
        return F.struct(
            category.alias("category"),
            side_gt.cast("bigint").alias("in_gt"),
            hit.cast("bigint").alias("hit"),
            met.cast("bigint").alias("met"),
            side_pred.cast("bigint").alias("in_pred"),
        )

    yes, no = F.lit(True), F.lit(False)
    entries = F.array(entry(gt, yes, right, _match(), no), entry(pred, no, no, no, yes))
    hit, n_gt, n_pred = (
        F.col("correct_predictions"),
        F.col("ground_truth_count"),
        F.col("total_times_predicted"),
    )
    return (
        rows.select(F.inline(entries))
        .where(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            F.sum("in_gt").alias("ground_truth_count"),
            F.sum("hit").alias("correct_predictions"),
            F.sum("met").alias("total_matched"),
            F.sum("in_pred").alias("total_times_predicted"),
        )
        .where(n_gt > 0)
        .withColumn("unmatched", n_gt - F.col("total_matched"))
        .withColumn("precision", ratio(hit, n_pred))
        .withColumn("recall", ratio(hit, n_gt))
        .withColumn("f1", f1(F.col("precision"), F.col("recall")))
    )


def attribute_comparison(truth: DataFrame, predicted: DataFrame, key: str = "name") -> DataFrame:
    """One row per image and attribute the ground truth carries, with the verdict.

    Compared without regard to case; a prediction without the attribute reads ''.
    """
    t = truth.select(key, *[F.col(f"attributes.{a}").alias(f"t_{a}") for a in SCENE_ATTRIBUTES])
    p = predicted.select(
        key, *[F.col(f"attributes.{a}").alias(f"p_{a}") for a in SCENE_ATTRIBUTES]
    )
    each = F.array(
        *[
            F.struct(
                F.lit(a).alias("attribute"),
                F.col(f"t_{a}").alias("truth"),
                F.coalesce(F.col(f"p_{a}"), F.lit("")).alias("predicted"),
            )
            for a in SCENE_ATTRIBUTES
        ]
    )
    return (
        t.join(p, key)
        .select(key, F.inline(each))
        .where(F.col("truth").isNotNull())
        .withColumn("is_match", F.lower("truth") == F.lower("predicted"))
    )


def attribute_accuracy(compared: DataFrame) -> DataFrame:
    """Accuracy per attribute and, as attribute ``overall``, over all of them."""
    return (
        compared.rollup("attribute")
        .agg(
            F.count_if("is_match").alias("n_match"),
            F.count(F.lit(1)).alias("n_compared"),
            F.grouping("attribute").alias("_all"),
        )
        .select(
            F.when(F.col("_all") == 1, "overall").otherwise(F.col("attribute")).alias("attribute"),
            "n_match",
            "n_compared",
            ratio(F.col("n_match"), F.col("n_compared")).alias("accuracy"),
        )
    )


def image_attribute_accuracy(
    names: DataFrame, compared: DataFrame, key: str = "name"
) -> DataFrame:
    """Accuracy per evaluated image; 1.0 where there was nothing to compare."""
    per_image = compared.groupBy(key).agg(
        F.avg(F.col("is_match").cast("double")).alias("accuracy")
    )
    return names.join(per_image, key, "left").withColumn(
        "accuracy", F.coalesce("accuracy", F.lit(1.0))
    )


def overlay_rows(gt: DataFrame, pred: DataFrame) -> DataFrame:
    """The boxes to draw over each image; true boxes come before generated ones."""

    def side(df: DataFrame, source: str, layer: int) -> DataFrame:
        return (
            with_index(df)
            .where(F.col("category").isNotNull() & F.col("x1").isNotNull())
            .select(
                "image_id",
                F.lit(source).alias("source"),
                F.lit(layer).alias("layer"),
                "idx",
                "label_id",
                "category",
                "x1",
                "y1",
                "x2",
                "y2",
            )
        )

    return side(gt, "ground_truth", 0).unionByName(side(pred, "generated", 1))


def overlay_attributes(truth: DataFrame, generated: DataFrame, key: str = "name") -> DataFrame:
    """The comparison lines of each generated image. Case counts here; N/A never matches."""
    t = truth.select(key, *[F.col(f"attributes.{a}").alias(f"t_{a}") for a in SCENE_ATTRIBUTES])
    g = generated.select(
        key, *[F.col(f"attributes.{a}").alias(f"g_{a}") for a in SCENE_ATTRIBUTES]
    )

    def line(position: int, a: str) -> Column:
        was = F.coalesce(F.col(f"t_{a}"), F.lit("N/A"))
        is_ = F.coalesce(F.col(f"g_{a}"), F.lit("unknown"))
        return F.struct(
            F.lit(position).alias("line_no"),
            F.format_string(f"{a.capitalize()}: GT=%s | GEN=%s", was, is_).alias("line"),
            ((was == is_) & (was != "N/A")).alias("is_match"),
        )

    lines = F.array(*[line(i, a) for i, a in enumerate(SCENE_ATTRIBUTES)])
    return g.join(t, key, "left").select(key, F.inline(lines))


def report_rows(
    rows: DataFrame,
    compared: DataFrame,
    threshold: float = 0.5,
    mapping: dict[str, str] | None = None,
    images: DataFrame | None = None,
) -> DataFrame:
    """The evaluation report as (section, name, body) rows, body being JSON.

    A row per attribute, class and confusion entry, so no section has to fit
    one record.
    """

    def section(df: DataFrame, title: str, name: Column) -> DataFrame:
        return df.select(
            F.lit(title).alias("section"), name.alias("name"), F.to_json(F.struct("*")).alias("body")
        )

    table = EVALUATION_CATEGORIES if mapping is None else mapping
    config = rows.sparkSession.range(1).select(
        F.lit(threshold).alias("iou_threshold"),
        F.create_map(*[F.lit(x) for kv in table.items() for x in kv]).alias("category_mapping"),
    )
    parts = [
        section(evaluation_summary(rows, images), "summary", F.lit("all")),
        section(attribute_accuracy(compared), "attribute_accuracy", F.col("attribute")),
        section(class_metrics(rows), "per_class_metrics", F.col("category")),
        section(original_category_metrics(rows), "original_category_metrics", F.col("category")),
        section(category_confusion(rows), "predicted_as", F.col("gt_category")),
        section(config, "configuration", F.lit("all")),
    ]
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)
    return report
