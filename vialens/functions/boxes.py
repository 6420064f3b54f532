"""Box arithmetic as Column expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

CORNERS = ("x1", "y1", "x2", "y2")


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return (x2 - x1) * (y2 - y1)


def iou(a: list[Column], b: list[Column], legacy_iou: bool = False) -> Column:
    """Intersection over union of two boxes given as [x1, y1, x2, y2].

    0.0 when the boxes do not overlap or the union is not positive.
    ``legacy_iou`` leaves the second box's area out of the union; it exists
    only to reproduce numbers made that way.
    """
    iw = F.least(a[2], b[2]) - F.greatest(a[0], b[0])
    ih = F.least(a[3], b[3]) - F.greatest(a[1], b[1])
    inter = iw * ih
    second = F.lit(0.0) if legacy_iou else box_area(*b)
    union = box_area(*a) + second - inter
    return F.when((iw > 0) & (ih > 0) & (union > 0), inter / union).when(
        iw.isNotNull() & ih.isNotNull(), F.lit(0.0)
    )


def overlaps(a: list[Column], b: list[Column]) -> Column:
    return (a[0] < b[2]) & (b[0] < a[2]) & (a[1] < b[3]) & (b[1] < a[3])


def corner_columns(side: str) -> list[Column]:
    """[x1, y1, x2, y2] of the aliased DataFrame ``side``."""
    return [F.col(f"{side}.{c}") for c in CORNERS]
