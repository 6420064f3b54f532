import random

import pytest
from test_matching import SCHEMA, moved, plain_greedy, random_boxes

from vialens.operators import evaluation, matching

NAMES = ["Car", "truck", "person", "Pedestrian", "dog"]


@pytest.fixture(scope="module")
def scenes():
    rng = random.Random(8)
    out = {}
    for i in range(8):
        gt = random_boxes(rng, rng.randint(0, 15), 60, 0.1)
        pred = moved(rng, gt)[: rng.randint(0, 15)] + random_boxes(rng, rng.randint(0, 5), 60, 0)
        out[i] = [(boxes, [rng.choice(NAMES) for _ in boxes]) for boxes in (gt, pred)]
    return out


def frames(spark, scenes):
    def side(s):
        return spark.createDataFrame(
            [
                (i, k, None, c, *[None if v is None else float(v) for v in b])
                for i, sides in scenes.items()
                for k, (b, c) in enumerate(zip(*sides[s]))
            ],
            SCHEMA,
        )

    return side(0), side(1)


def mapped(name):
    from vialens.schemas import EVALUATION_CATEGORIES

    return EVALUATION_CATEGORIES.get(name.lower(), name.lower())


@pytest.fixture(scope="module")
def plain(scenes):
    """Per image: matches as (iou, gt name, pred name) and the names left over."""
    out = {}
    for i, ((gt, gc), (pred, pc)) in scenes.items():
        met = plain_greedy(gt, pred, 0.3)
        used_g, used_p = {m[0] for m in met}, {m[1] for m in met}
        out[i] = (
            [(v, gc[g], pc[p]) for g, p, v in met],
            [c for k, c in enumerate(gc) if k not in used_g],
            [c for k, c in enumerate(pc) if k not in used_p],
        )
    return out


@pytest.fixture(scope="module")
def rows(spark, scenes):
    gt, pred = frames(spark, scenes)
    return evaluation.outcomes(gt, pred, matching.greedy_match(gt, pred, 0.3)).cache()


def scores(tp, fp, fn):
    p = tp / (tp + fp) if tp + fp else 0.0
    r = tp / (tp + fn) if tp + fn else 0.0
    return p, r, 2 * p * r / (p + r) if p + r else 0.0


def test_image_metrics(spark, rows, plain):
    images = spark.createDataFrame([(i,) for i in plain] + [(-5,), (None,)], "image_id long")
    got = {str(r.image_id): r for r in evaluation.image_metrics(rows, images).collect()}
    assert set(got) == {str(i) for i in plain} | {"-5"}
    assert (got["-5"].tp, got["-5"].total_gt, got["-5"].f1) == (0, 0, 0.0)
    for i, (met, only_gt, only_pred) in plain.items():
        tp = sum(mapped(a) == mapped(b) for _, a, b in met)
        fp, fn = len(only_pred) + len(met) - tp, len(only_gt)
        r = got[str(i)]
        assert (r.tp, r.fp, r.fn) == (tp, fp, fn)
        assert (r.precision, r.recall, r.f1) == pytest.approx(scores(tp, fp, fn))
        assert (r.total_gt, r.total_pred) == (len(met) + fn, len(met) + len(only_pred))


def plain_sweep(plain, t):
    tp = fp = fn = 0
    for met, only_gt, only_pred in plain.values():
        tp += sum(v >= t and mapped(a) == mapped(b) for v, a, b in met)
        fp += len(only_pred) + sum(v >= t and mapped(a) != mapped(b) for v, a, b in met)
        fn += len(only_gt) + sum(v < t for v, _, _ in met)
    return tp, fp, fn


def test_threshold_sweep(rows, plain):
    got = evaluation.threshold_sweep(rows).orderBy("iou_threshold").collect()
    assert [r.iou_threshold for r in got] == [k / 20 for k in range(10, 20)]
    for r in got:
        want = plain_sweep(plain, r.iou_threshold)
        assert (r.tp, r.fp, r.fn) == want
        assert (r.precision, r.recall, r.f1) == pytest.approx(scores(*want))


def test_summary(rows, plain):
    r = evaluation.evaluation_summary(rows).head()
    boxed = sum(any(v) for v in plain.values())
    assert r.total_images == boxed
    images = rows.select("image_id").union(rows.selectExpr('-1 - image_id'))
    assert evaluation.evaluation_summary(rows, images).head().total_images == 2 * boxed
    p, rec, f = scores(*plain_sweep(plain, 0.5))
    assert (r.precision_at_50, r.recall_at_50, r.f1_at_50) == pytest.approx((p, rec, f))
    mean = sum(scores(*plain_sweep(plain, k / 20))[0] for k in range(10, 20)) / 10
    assert r.mean_precision_50_95 == pytest.approx(mean)


def test_class_metrics(rows, plain):
    want = {}

    def add(c, k):
        want.setdefault(c, [0, 0, 0])[k] += 1

    for met, only_gt, only_pred in plain.values():
        for _, a, b in met:
            if mapped(a) == mapped(b):
                add(mapped(a), 0)
            else:
                add(mapped(b), 1)
                add(mapped(a), 2)
        for c in only_pred:
            add(mapped(c), 1)
        for c in only_gt:
            add(mapped(c), 2)
    got = {r.category: [r.tp, r.fp, r.fn] for r in evaluation.class_metrics(rows).collect()}
    assert got == want


def test_confusion_and_original_metrics(rows, plain):
    want = {}
    predicted = {}
    for met, only_gt, only_pred in plain.values():
        for _, a, b in met:
            want[(a.lower(), b.lower())] = want.get((a.lower(), b.lower()), 0) + 1
        for c in only_gt:
            want[(c.lower(), "unmatched")] = want.get((c.lower(), "unmatched"), 0) + 1
        for c in [b for _, _, b in met] + only_pred:
            predicted[c.lower()] = predicted.get(c.lower(), 0) + 1
    got = {
        (r.gt_category, r.predicted_as): r.n for r in evaluation.category_confusion(rows).collect()
    }
    assert got == want
    for r in evaluation.original_category_metrics(rows).collect():
        n_gt = sum(n for (a, _), n in want.items() if a == r.category)
        right = want.get((r.category, r.category), 0)
        assert r.ground_truth_count == n_gt
        assert r.unmatched == want.get((r.category, "unmatched"), 0)
        assert r.total_matched == n_gt - r.unmatched
        assert r.correct_predictions == right
        assert r.total_times_predicted == predicted.get(r.category, 0)
        assert r.recall == pytest.approx(right / n_gt)


def test_mapping_is_a_parameter(spark):
    df = spark.createDataFrame([("Van",), ("car",)], "c string")
    got = df.select(evaluation.evaluation_category(df.c, {"van": "vehicle"})).collect()
    assert [r[0] for r in got] == ["vehicle", "car"]


ATTRS = "name string, attributes struct<weather:string,timeofday:string,scene:string>"


@pytest.fixture(scope="module")
def attributes(spark):
    truth = spark.createDataFrame(
        [
            ("a", ("Clear", "day", "city")),
            ("b", ("rainy", None, "")),
            ("c", (None, None, None)),
            ("only truth", ("x", "y", "z")),
        ],
        ATTRS,
    )
    generated = spark.createDataFrame(
        [("a", ("clear", "night", None)), ("b", ("rainy", "day", None)), ("c", ("x", "y", "z")),
         ("alone", ("q", None, "z"))],
        ATTRS,
    )
    return truth, generated


def test_attribute_accuracy(attributes):
    compared = evaluation.attribute_comparison(*attributes)
    got = {r.attribute: (r.n_match, r.n_compared) for r in
           evaluation.attribute_accuracy(compared).collect()}
    assert got == {"weather": (2, 2), "timeofday": (0, 1), "scene": (1, 2), "overall": (3, 5)}
    names = attributes[0].select("name").where("name <> 'only truth'")
    per_image = {
        r.name: r.accuracy
        for r in evaluation.image_attribute_accuracy(names, compared).collect()
    }
    assert per_image == {"a": pytest.approx(1 / 3), "b": 1.0, "c": 1.0}


def test_overlay_lines(attributes):
    rows = evaluation.overlay_attributes(*attributes).where("name in ('a', 'alone')").collect()
    lines = {(r.name, r.line_no): (r.line, r.is_match) for r in rows}
    assert lines[("a", 0)] == ("Weather: GT=Clear | GEN=clear", False)
    assert lines[("alone", 1)] == ("Timeofday: GT=N/A | GEN=unknown", False)


def test_evaluated_files(attributes):
    got = {r.name: r.status for r in evaluation.evaluated_files(*attributes).collect()}
    assert got == {"a": "evaluated", "b": "evaluated", "c": "evaluated", "alone": "failed"}


def test_report_rows(rows, attributes):
    report = evaluation.report_rows(rows, evaluation.attribute_comparison(*attributes))
    sections = {r.section for r in report.select("section").distinct().collect()}
    assert sections == {
        "summary", "attribute_accuracy", "per_class_metrics", "original_category_metrics",
        "predicted_as", "configuration",
    }
