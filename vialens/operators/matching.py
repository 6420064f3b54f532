"""Greedy one-to-one matching of predicted boxes to true boxes, image by image.

Input boxes: image_id, idx (unique within an image and side), x1, y1, x2, y2,
category and, optionally, label_id. A box without corners matches nothing.

The order of matching is total: highest IoU first, then lowest true index,
then lowest predicted index. Images of ordinary size are matched inside one
expression; larger ones by rounds over the whole cluster. Both follow that
order exactly.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vialens.functions.boxes import CORNERS, box_area, corner_columns, overlaps
from vialens.operators.scale import number_rows, settle, written

# True boxes times predicted boxes up to which one image is matched in one place.
PAIR_LIMIT = 10_000

# Side lengths of one size class differ by less than this factor.
_GRID = 4.0

# Below this IoU two sides may differ so much that the grid stops paying off.
_GRID_THRESHOLD = 0.2


def with_index(boxes: DataFrame) -> DataFrame:
    """Adds the default label_id (the index as text) where there is none."""
    own = F.col("label_id") if "label_id" in boxes.columns else F.lit(None).cast("string")
    return boxes.withColumn("label_id", F.coalesce(own, F.col("idx").cast("string")))


def explode_boxes(documents: DataFrame, key: str = "name", labels: str = "labels") -> DataFrame:
    """Boxes of label documents; idx is the position in the document."""
    return documents.select(F.col(key).alias("image_id"), F.posexplode(labels)).select(
        "image_id",
        F.col("pos").cast("bigint").alias("idx"),
        F.col("col.id").alias("label_id"),
        F.coalesce("col.category", F.lit("")).alias("category"),
        *[F.col(f"col.box2d.{c}").alias(c) for c in CORNERS],
    )


def _proper(boxes: DataFrame) -> DataFrame:
    """Boxes with a positive area; the others overlap nothing."""
    x1, y1, x2, y2 = (F.col(c) for c in CORNERS)
    return boxes.where((x2 > x1) & (y2 > y1)).withColumn("_area", box_area(x1, y1, x2, y2))


def _meet(
    gt: DataFrame, pred: DataFrame, on: Column, threshold: float, legacy_iou: bool
) -> DataFrame:
    """Overlapping proper boxes joined on ``on``, with IoU of at least ``threshold``.

    The join condition is evaluated for every pair of an image, so it is kept
    bare: proper boxes that overlap need none of the guards of ``iou``.
    """
    g, p = corner_columns("g"), corner_columns("p")
    inter = (F.least(g[2], p[2]) - F.greatest(g[0], p[0])) * (
        F.least(g[3], p[3]) - F.greatest(g[1], p[1])
    )
    if legacy_iou:
        union = F.col("g._area") - inter
        score = F.when(union > 0, inter / union).otherwise(F.lit(0.0))
    else:
        # Spark may score a pair before it knows that the boxes overlap
        score = F.try_divide(inter, F.col("g._area") + F.col("p._area") - inter)
    enough = F.col("iou") >= threshold if threshold > 0 else F.col("iou") > 0
    met = gt.alias("g").join(pred.alias("p"), on & overlaps(g, p))
    return met.withColumn("iou", score).where(enough)


def _plain_pairs(gt: DataFrame, pred: DataFrame, threshold: float, legacy_iou: bool) -> DataFrame:
    """Pairs by image, the overlap test inside the join."""
    same_image = F.col("g.image_id") == F.col("p.image_id")
    return _meet(_proper(gt), _proper(pred), same_image, threshold, legacy_iou)


def _levels(extent: Column) -> Column:
    """Size class of a box side: powers of the grid base."""
    return F.floor(F.log(_GRID, extent)).cast("int")


def _cell(position: Column, size_level: Column) -> Column:
    return F.floor(position / F.pow(F.lit(_GRID), size_level + 1)).cast("bigint")


def _reach(low: Column, extent: Column, threshold: float) -> Column:
    """All (level, cell) of true sides that can reach ``threshold`` with this predicted side.

    IoU >= t needs each side's overlap to be at least t of both lengths. So the
    lengths differ by at most 1/t, and the low ends by at most 1-t of the longer.
    The margins are widened a little against rounding at the edges.
    """
    t = threshold * 0.999
    levels = F.sequence(_levels(extent * t), _levels(extent / t))

    def cells(lv: Column) -> Column:
        longest = F.least(F.pow(F.lit(_GRID), lv + 1), extent / t)
        slack = F.greatest(longest, extent) * (1 - t)
        span = F.sequence(_cell(low - slack, lv), _cell(low + slack, lv))
        return F.transform(span, lambda c: F.struct(lv.alias("lv"), c.alias("cell")))

    return F.flatten(F.transform(levels, cells))


def _grid_pairs(gt: DataFrame, pred: DataFrame, threshold: float) -> DataFrame:
    """Pairs of large images, met by box size class and position instead of by image alone.

    Every true box lies in one cell; a predicted box visits the few cells that
    can hold a partner. A pair meets in exactly one cell.
    """

    def sided(boxes: DataFrame) -> DataFrame:
        return _proper(boxes).withColumns(
            {"_w": F.col("x2") - F.col("x1"), "_h": F.col("y2") - F.col("y1")}
        )

    g = sided(gt).withColumns({"_lx": _levels(F.col("_w")), "_ly": _levels(F.col("_h"))})
    g = g.withColumns(
        {"_cx": _cell(F.col("x1"), F.col("_lx")), "_cy": _cell(F.col("y1"), F.col("_ly"))}
    )
    p = (
        sided(pred)
        .withColumn("_x", F.explode(_reach(F.col("x1"), F.col("_w"), threshold)))
        .withColumn("_y", F.explode(_reach(F.col("y1"), F.col("_h"), threshold)))
    )
    same_cell = (
        (F.col("g.image_id") == F.col("p.image_id"))
        & (F.col("g._lx") == F.col("p._x.lv"))
        & (F.col("g._ly") == F.col("p._y.lv"))
        & (F.col("g._cx") == F.col("p._x.cell"))
        & (F.col("g._cy") == F.col("p._y.cell"))
    )
    return _meet(g, p, same_cell, threshold, False)


def large_images(gt: DataFrame, pred: DataFrame, limit: int = PAIR_LIMIT) -> DataFrame:
    """Images whose box counts multiply to more than ``limit``."""
    n_gt = gt.groupBy("image_id").agg(F.count(F.lit(1)).alias("_g"))
    n_pred = pred.groupBy("image_id").agg(F.count(F.lit(1)).alias("_p"))
    return (
        n_gt.join(n_pred, "image_id").where(F.col("_g") * F.col("_p") > limit).select("image_id")
    )


def _divide(gt: DataFrame, pred: DataFrame, limit: int):
    """((gt, pred) of ordinary images, (gt, pred) of large images or None)."""
    large = large_images(gt, pred, limit)
    if large.isEmpty():
        return (gt, pred), None
    large = settle(large)
    rest = tuple(df.join(large, "image_id", "left_anti") for df in (gt, pred))
    return rest, tuple(df.join(large, "image_id", "left_semi") for df in (gt, pred))


def box_pairs(
    gt: DataFrame,
    pred: DataFrame,
    threshold: float = 0.5,
    legacy_iou: bool = False,
    limit: int = PAIR_LIMIT,
) -> DataFrame:
    """All pairs of one image with IoU of at least ``threshold`` (above 0)."""
    columns = ["g.image_id", F.col("g.idx").alias("g"), F.col("p.idx").alias("p"), "iou"]
    (gt_s, pred_s), large = _divide(gt, pred, limit)
    pairs = _plain_pairs(gt_s, pred_s, threshold, legacy_iou).select(*columns)
    if large:
        far = (
            _plain_pairs(*large, threshold, legacy_iou)
            if legacy_iou or threshold < _GRID_THRESHOLD
            else _grid_pairs(*large, threshold)
        )
        pairs = pairs.unionByName(far.select(*columns))
    return pairs


_RESULT = ["image_id", "g", "p", "iou", "gt_id", "pred_id", "gt_category", "pred_category"]


def _fold(pairs: DataFrame) -> DataFrame:
    """Walk each image's pairs best first, keeping a pair when both boxes are free.

    ``pairs``: image_id, g, p, iou and any columns that ride along.
    """
    extra = [c for c in pairs.columns if c not in ("image_id", "g", "p", "iou")]
    ranked = F.array_sort(
        F.collect_list(
            F.struct((-F.col("iou")).alias("k"), F.col("g"), F.col("p"), *extra)
        )
    )
    grouped = pairs.groupBy("image_id").agg(ranked.alias("_ranked"))
    empty = F.array().cast(grouped.schema["_ranked"].dataType)

    def step(kept: Column, pair: Column) -> Column:
        taken = F.exists(kept, lambda m: (m["g"] == pair["g"]) | (m["p"] == pair["p"]))
        return F.when(taken, kept).otherwise(F.concat(kept, F.array(pair)))

    kept = F.aggregate("_ranked", empty, step)
    return grouped.select("image_id", F.inline(kept)).select(
        "image_id", "g", "p", (-F.col("k")).alias("iou"), *extra
    )


def greedy_match(
    gt: DataFrame,
    pred: DataFrame,
    threshold: float = 0.5,
    legacy_iou: bool = False,
    limit: int = PAIR_LIMIT,
) -> DataFrame:
    """The matches: image_id, g, p (box indices), iou, ids and categories of both boxes."""
    gt, pred = with_index(gt), with_index(pred)
    (gt_s, pred_s), large = _divide(gt, pred, limit)
    near = _plain_pairs(gt_s, pred_s, threshold, legacy_iou).select(
        "g.image_id",
        F.col("g.idx").alias("g"),
        F.col("p.idx").alias("p"),
        "iou",
        F.col("g.label_id").alias("gt_id"),
        F.col("p.label_id").alias("pred_id"),
        F.col("g.category").alias("gt_category"),
        F.col("p.category").alias("pred_category"),
    )
    matches = _fold(near).select(*_RESULT)
    if large:
        matches = matches.unionByName(_match_large(*large, threshold, legacy_iou, limit))
    return matches


def _classes(boxes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Boxes with the same corners form one class, named by its lowest index.

    Returns (classes, members); ``ordinal`` numbers a class's members by index.
    """
    corners = list(CORNERS)
    full = boxes.dropna(subset=corners)
    classes = settle(
        full.groupBy("image_id", *corners).agg(
            F.min("idx").alias("idx"), F.count(F.lit(1)).alias("n")
        )
    )
    named = full.join(
        classes.withColumnRenamed("idx", "cls").drop("n"), ["image_id", *corners]
    ).select("image_id", "cls", "idx", "label_id", "category")
    return classes, settle(number_rows(named, ["idx"], ["image_id", "cls"], "ordinal"))


def _match_large(
    gt: DataFrame, pred: DataFrame, threshold: float, legacy_iou: bool, limit: int
) -> DataFrame:
    """Matching by rounds, for images too large to handle in one place.

    Works on classes of identical boxes, so copies never pair up one by one. In
    each round a class pair is matched when its next two free boxes come first
    among all pairs of either class: nothing could take them earlier. When no
    other pair of either class has the same IoU, all free boxes of the smaller
    class are matched at once. As soon as an image's open pairs are few, it
    leaves the rounds and is finished in one expression.

    A round writes two tables: what it matched, and the pairs still open.
    """
    g_classes, g_members = _classes(gt)
    p_classes, p_members = _classes(pred)
    met = (
        _plain_pairs(g_classes, p_classes, threshold, legacy_iou)
        if legacy_iou or threshold < _GRID_THRESHOLD
        else _grid_pairs(g_classes, p_classes, threshold)
    )
    first = met.select(
        "g.image_id",
        F.col("g.idx").alias("g_cls"),
        F.col("p.idx").alias("p_cls"),
        "iou",
        F.col("g.n").alias("n_g"),
        F.col("p.n").alias("n_p"),
        F.lit(0).cast("bigint").alias("at_g"),
        F.lit(0).cast("bigint").alias("at_p"),
        F.col("g.idx").alias("head_g"),
        F.col("p.idx").alias("head_p"),
    )
    read = gt.sparkSession.read
    open_paths, won_paths = [written(_with_few(first, limit))], []
    while True:
        rest = read.parquet(open_paths[-1]).where(~F.col("is_few")).drop("is_few")
        if rest.isEmpty():
            break
        won_paths.append(written(_round(rest)))
        left = _advance(rest, read.parquet(won_paths[-1]), g_members, p_members)
        open_paths.append(written(_with_few(left, limit)))
    # an image is few in one round only: the one it leaves in
    few = read.parquet(*open_paths).where("is_few").drop("is_few")
    done = _finish(few, g_members, p_members).select(*_RESULT)
    if won_paths:
        won = read.parquet(*won_paths)
        done = done.unionByName(_expand(won, g_members, p_members).select(*_RESULT))
    return done


def _with_few(pairs: DataFrame, limit: int) -> DataFrame:
    """Flags the pairs of images whose open pairs, counted by box, are within ``limit``."""
    boxes = (F.col("n_g") - F.col("at_g")) * (F.col("n_p") - F.col("at_p"))
    weight = pairs.groupBy("image_id").agg((F.sum(boxes) <= limit).alias("is_few"))
    return pairs.join(weight, "image_id")


def _round(pairs: DataFrame) -> DataFrame:
    """Class pairs that come first for both of their classes, with how many boxes to match."""

    def best(side: str) -> DataFrame:
        by_iou = pairs.groupBy("image_id", side, "iou").agg(
            F.count(F.lit(1)).alias("ties"), F.min(F.struct("head_g", "head_p")).alias("first")
        )
        return by_iou.groupBy("image_id", side).agg(
            F.max_by(F.struct("iou", "ties", "first"), "iou").alias(f"best_{side[0]}")
        )

    heads = F.struct("head_g", "head_p")
    candidates = pairs.join(best("g_cls"), ["image_id", "g_cls"]).join(best("p_cls"), ["image_id", "p_cls"])
    mutual = candidates.where(
        (F.col("iou") == F.col("best_g.iou"))
        & (F.col("iou") == F.col("best_p.iou"))
        & (heads == F.col("best_g.first"))
        & (heads == F.col("best_p.first"))
    )
    alone = (F.col("best_g.ties") == 1) & (F.col("best_p.ties") == 1)
    free = F.least(F.col("n_g") - F.col("at_g"), F.col("n_p") - F.col("at_p"))
    return mutual.select(
        "image_id",
        "g_cls",
        "p_cls",
        "iou",
        "at_g",
        "at_p",
        F.when(alone, free).otherwise(F.lit(1)).cast("bigint").alias("k"),
    )


def _expand(won: DataFrame, g_members: DataFrame, p_members: DataFrame) -> DataFrame:
    """Matched ranges of two classes as matched boxes, first free with first free."""
    g = g_members.select(
        "image_id",
        F.col("cls").alias("g_cls"),
        F.col("ordinal").alias("o"),
        F.col("idx").alias("g"),
        F.col("label_id").alias("gt_id"),
        F.col("category").alias("gt_category"),
    )
    p = p_members.select(
        "image_id",
        F.col("cls").alias("p_cls"),
        F.col("ordinal").alias("_partner"),
        F.col("idx").alias("p"),
        F.col("label_id").alias("pred_id"),
        F.col("category").alias("pred_category"),
    )
    in_range = (F.col("o") >= F.col("at_g")) & (F.col("o") < F.col("at_g") + F.col("k"))
    return (
        g.join(won, ["image_id", "g_cls"])
        .where(in_range)
        .withColumn("_partner", F.col("o") - F.col("at_g") + F.col("at_p"))
        .join(p, ["image_id", "p_cls", "_partner"])
    )


def _finish(pairs: DataFrame, g_members: DataFrame, p_members: DataFrame) -> DataFrame:
    """The rest of images with few open pairs: back to single boxes, then the fold."""
    g = g_members.select(
        "image_id",
        F.col("cls").alias("g_cls"),
        F.col("ordinal").alias("_og"),
        F.col("idx").alias("g"),
        F.col("label_id").alias("gt_id"),
        F.col("category").alias("gt_category"),
    )
    p = p_members.select(
        "image_id",
        F.col("cls").alias("p_cls"),
        F.col("ordinal").alias("_op"),
        F.col("idx").alias("p"),
        F.col("label_id").alias("pred_id"),
        F.col("category").alias("pred_category"),
    )
    single = (
        pairs.join(g, ["image_id", "g_cls"])
        .where(F.col("_og") >= F.col("at_g"))
        .join(p, ["image_id", "p_cls"])
        .where(F.col("_op") >= F.col("at_p"))
    )
    return _fold(single.select(*_RESULT))


def _advance(
    pairs: DataFrame, won: DataFrame, g_members: DataFrame, p_members: DataFrame
) -> DataFrame:
    """Open pairs after a round: positions moved on, used-up classes gone, new next boxes."""
    moved_g = won.select("image_id", "g_cls", F.col("k").alias("_kg"))
    moved_p = won.select("image_id", "p_cls", F.col("k").alias("_kp"))
    left = (
        pairs.join(moved_g, ["image_id", "g_cls"], "left")
        .join(moved_p, ["image_id", "p_cls"], "left")
        .withColumn("at_g", F.col("at_g") + F.coalesce("_kg", F.lit(0)))
        .withColumn("at_p", F.col("at_p") + F.coalesce("_kp", F.lit(0)))
        .where((F.col("at_g") < F.col("n_g")) & (F.col("at_p") < F.col("n_p")))
        .drop("_kg", "_kp", "head_g", "head_p")
    )
    heads_g = g_members.select(
        "image_id",
        F.col("cls").alias("g_cls"),
        F.col("ordinal").alias("at_g"),
        F.col("idx").alias("head_g"),
    )
    heads_p = p_members.select(
        "image_id",
        F.col("cls").alias("p_cls"),
        F.col("ordinal").alias("at_p"),
        F.col("idx").alias("head_p"),
    )
    return (
        left.join(heads_g, ["image_id", "g_cls", "at_g"])
        .join(heads_p, ["image_id", "p_cls", "at_p"])
        .select(*pairs.columns)
    )


def unmatched(boxes: DataFrame, matches: DataFrame, side: str) -> DataFrame:
    """Boxes in no match; ``side`` is ``g`` (true) or ``p`` (predicted)."""
    used = matches.select("image_id", F.col(side).alias("idx"))
    return with_index(boxes).join(used, ["image_id", "idx"], "left_anti")
