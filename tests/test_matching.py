import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vialens.functions.boxes import iou
from vialens.operators import matching

SCHEMA = (
    "image_id long, idx long, label_id string, category string, "
    "x1 double, y1 double, x2 double, y2 double"
)


def plain_iou(a, b):
    if a[0] is None or b[0] is None:
        return 0.0
    iw = min(a[2], b[2]) - max(a[0], b[0])
    ih = min(a[3], b[3]) - max(a[1], b[1])
    if iw <= 0 or ih <= 0:
        return 0.0
    union = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - iw * ih
    return iw * ih / union if union > 0 else 0.0


def plain_greedy(gt, pred, threshold, score=plain_iou):
    """All pairs, best first, ties by index; a pair counts while both boxes are free."""
    pairs = sorted(
        (-score(a, b), i, j)
        for i, a in enumerate(gt)
        for j, b in enumerate(pred)
        if score(a, b) >= threshold and score(a, b) > 0
    )
    met_g, met_p = {}, {}
    for value, i, j in pairs:
        if i not in met_g and j not in met_p:
            met_g[i] = met_p[j] = (i, j, -value)
    return list(met_g.values())


def random_boxes(rng, n, span, copies):
    out = []
    for _ in range(n):
        if out and rng.random() < copies:
            out.append(rng.choice(out))
        elif rng.random() < 0.04:
            out.append((None, None, None, None))
        elif rng.random() < 0.04:
            out.append((9, 9, 3, 3))
        else:
            x, y = rng.randint(0, span), rng.randint(0, span)
            out.append((x, y, x + rng.randint(1, 30), y + rng.randint(1, 30)))
    return out


def moved(rng, boxes):
    return [
        b if b[0] is None else (b[0] + rng.choice([-1, 0, 1]), b[1], b[2] + rng.choice([0, 1]), b[3])
        for b in boxes
    ]


@pytest.fixture(scope="module")
def images():
    rng = random.Random(5)
    out = {}
    for i in range(12):
        args = rng.choice([5, 40, 100]), rng.choice([0, 0.5, 0.9])
        gt = random_boxes(rng, rng.randint(0, 40), *args)
        pred = moved(rng, gt) if i % 3 == 0 else random_boxes(rng, rng.randint(0, 40), *args)
        out[i] = (gt, pred)
    return out


def frames(spark, images):
    def side(s):
        return spark.createDataFrame(
            [
                (i, k, None, f"c{k % 3}", *[None if v is None else float(v) for v in box])
                for i, sides in images.items()
                for k, box in enumerate(sides[s])
            ],
            SCHEMA,
        )

    return side(0), side(1)


@pytest.mark.parametrize("limit", [10_000, 60, 2])
def test_greedy_equals_the_loop(spark, images, limit):
    """Ordinary images in one expression, larger ones by rounds: the same matches."""
    gt, pred = frames(spark, images)
    got = matching.greedy_match(gt, pred, 0.5, limit=limit).collect()
    want = [
        (i, g, p, v) for i, sides in images.items() for g, p, v in plain_greedy(*sides, 0.5)
    ]
    assert sorted((r.image_id, r.g, r.p, r.iou) for r in got) == sorted(want)
    assert all(r.gt_category == f"c{r.g % 3}" and r.pred_id == str(r.p) for r in got)


@pytest.mark.parametrize("threshold", [0.05, 0.25, 0.5, 0.9, 1.0])
def test_grid_meets_the_same_pairs(spark, images, threshold):
    gt, pred = frames(spark, images)
    near = matching.box_pairs(gt, pred, threshold).collect()
    far = matching.box_pairs(gt, pred, threshold, limit=0).collect()
    want = [
        (i, g, p)
        for i, (a, b) in images.items()
        for g, x in enumerate(a)
        for p, y in enumerate(b)
        if plain_iou(x, y) >= threshold
    ]
    assert sorted((r.image_id, r.g, r.p) for r in near) == sorted(want)
    assert sorted(map(tuple, near)) == sorted(map(tuple, far))


def test_one_image_of_copies(spark):
    """A third of all boxes are one box: matched by class, not pair by pair."""
    gt = [(0, 0, 10, 10)] * 300 + [(20 * i, 50, 20 * i + 9, 60) for i in range(600)]
    pred = [(0, 0, 10, 10)] * 200 + [(20 * i, 50, 20 * i + 9, 61) for i in range(600)]
    a, b = frames(spark, {1: (gt, pred)})
    got = matching.greedy_match(a, b, 0.5).collect()
    copies = sorted((r.g, r.p) for r in got if r.g < 300)
    assert copies == [(i, i) for i in range(200)]
    assert sorted((r.g - 300, r.p - 200) for r in got if r.g >= 300) == [
        (i, i) for i in range(600)
    ]


def test_unmatched(spark, images):
    gt, pred = frames(spark, images)
    matches = matching.greedy_match(gt, pred)
    for boxes, side, s in ((gt, "g", 0), (pred, "p", 1)):
        left = {(r.image_id, r.idx) for r in matching.unmatched(boxes, matches, side).collect()}
        want = set()
        for i, sides in images.items():
            used = {m[s] for m in plain_greedy(*sides, 0.5)}
            want |= {(i, k) for k in range(len(sides[s])) if k not in used}
        assert left == want


def test_legacy_iou_matches_alike_on_both_paths(spark, images):
    gt, pred = frames(spark, images)

    def flawed(a, b):
        if a[0] is None or b[0] is None or a[2] <= a[0] or b[2] <= b[0]:
            return 0.0
        iw = min(a[2], b[2]) - max(a[0], b[0])
        ih = min(a[3], b[3]) - max(a[1], b[1])
        if iw <= 0 or ih <= 0:
            return 0.0
        union = (a[2] - a[0]) * (a[3] - a[1]) - iw * ih
        return iw * ih / union if union > 0 else 0.0

    want = sorted(
        (i, g, p) for i, s in images.items() for g, p, _ in plain_greedy(*s, 0.5, flawed)
    )
    for limit in (10_000, 60):
        got = matching.greedy_match(gt, pred, 0.5, legacy_iou=True, limit=limit).collect()
        assert sorted((r.image_id, r.g, r.p) for r in got) == want


corner = st.integers(-20, 20)
box = st.tuples(corner, corner, st.integers(1, 20), st.integers(1, 20)).map(
    lambda b: (b[0], b[1], b[0] + b[2], b[1] + b[3])
)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(box, box), min_size=20, max_size=40))
def test_iou_properties(spark, pairs):
    df = spark.createDataFrame(
        [tuple(map(float, (*a, *b))) for a, b in pairs],
        ", ".join(f"{s}{c} double" for s in "ab" for c in ("x1", "y1", "x2", "y2")),
    )
    a, b = ([F.col(f"{s}{c}") for c in ("x1", "y1", "x2", "y2")] for s in "ab")
    rows = df.select(
        iou(a, b).alias("ab"), iou(b, a).alias("ba"), iou(a, a).alias("aa"),
        iou(a, a, legacy_iou=True).alias("legacy"),
    ).collect()
    for r, (x, y) in zip(rows, pairs):
        assert r.ab == r.ba == plain_iou(x, y)
        assert 0 <= r.ab <= 1 and r.aa == 1.0 and r.legacy == 0.0


def test_boxes_of_documents(spark):
    docs = spark.createDataFrame(
        [("a", [{"id": "7", "category": None, "box2d": {"x1": 1.0}}, {"category": "car"}])],
        "name string, labels array<struct<id:string,category:string,"
        "box2d:struct<x1:double,y1:double,x2:double,y2:double>>>",
    )
    rows = matching.with_index(matching.explode_boxes(docs)).orderBy("idx").collect()
    assert [(r.idx, r.label_id, r.category) for r in rows] == [(0, "7", ""), (1, "1", "car")]
