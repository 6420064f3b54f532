"""Where a sequence of attempts ends: after so many successes, or too many failures in a row.

Attempts have an order (their names) that means something over the whole table,
while the rows lie in slices. A run of failures goes on from slice to slice, so
every slice is summed up first: its rows, whether it has a success, and the
failures after its last one. These sums compose in order, which gives each slice
the failures and the successes it begins with; within a slice, a window does the
rest. One row a slice meets in one task, never the attempts.
"""

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vialens.operators.scale import number_rows, settle


def numbered_attempts(attempts: DataFrame, order: Sequence[str] = ("filename",), ok: str = "ok") -> DataFrame:
    """``attempts`` with ``consecutive`` and ``succeeded_before``.

    ``consecutive`` counts the failures in a row up to and with this attempt (0:
    it succeeded), ``succeeded_before`` the successes in front of it. ``order``
    must be unique; an attempt whose outcome is NULL failed.
    """
    order = list(order)
    rows = attempts.withColumn("_ok", F.coalesce(F.col(ok).cast("int"), F.lit(0)))
    placed = settle(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_slice", F.shiftright("_at", 33))
    upto = Window.partitionBy("_slice").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inner = placed.withColumn("_done", F.sum("_ok").over(upto))
    # failures behind the same number of successes stand in a row
    stretch = Window.partitionBy("_slice", "_done").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    inner = inner.withColumn("_row", F.sum(1 - F.col("_ok")).over(stretch))
    sums = inner.groupBy("_slice").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum("_ok").alias("_successes"),
        F.max_by("_row", "_at").alias("_trailing"),
    )
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    barren = F.when(F.col("_successes") == 0, F.col("_n")).otherwise(0)
    sums = sums.withColumn("_barren", F.coalesce(F.sum(barren).over(before), F.lit(0)))
    # the last slice with a success: its trailing failures, and all rows of the slices since
    last = F.struct("_trailing", "_barren")
    sums = sums.withColumn(
        "_last", F.last(F.when(F.col("_successes") > 0, last), ignorenulls=True).over(before)
    )
    since = F.col("_barren") - F.coalesce(F.col("_last._barren"), F.lit(0))
    carried = sums.select(
        "_slice",
        (F.coalesce(F.col("_last._trailing"), F.lit(0)) + since).alias("_carry"),
        F.coalesce(F.sum("_successes").over(before), F.lit(0)).alias("_earlier"),
    )
    joined = inner.join(settle(carried), "_slice")
    first = F.when(F.col("_done") == 0, F.col("_carry")).otherwise(0)
    return joined.select(
        *[F.col(f"`{c}`") for c in attempts.columns],
        F.when(F.col("_ok") == 1, 0).otherwise(F.col("_row") + first).cast("bigint").alias("consecutive"),
        (F.col("_earlier") + F.col("_done") - F.col("_ok")).alias("succeeded_before"),
    )


def attempted(
    attempts: DataFrame,
    limit: int | None = None,
    most_failures: int | None = None,
    continue_on_error: bool = False,
    order: Sequence[str] = ("filename",),
    ok: str = "ok",
) -> DataFrame:
    """The attempts that one after the other would have been made, and whether one of them warns.

    Attempts end with the ``limit``-th success, or with the ``most_failures``-th
    failure in a row. With ``continue_on_error`` they go on then, the count
    starts anew, and the failure that filled it has ``warns``.
    """
    numbered = numbered_attempts(attempts, order, ok)
    full = F.lit(False)
    if most_failures is not None:
        row = F.col("consecutive")
        full = (row > 0) & (row % most_failures == 0)
    out = numbered.withColumn("warns", full)
    if limit is not None:
        out = out.where(F.col("succeeded_before") < limit)
    if most_failures is not None and not continue_on_error:
        out = settle(out)
        stop = out.where("warns").agg(F.min(F.struct(*order)).alias("stop")).first().stop
        if stop is not None:
            last = F.struct(*[F.lit(stop[c]).alias(c) for c in order])
            out = out.where(F.struct(*order) <= last)
    return out


def in_waves(
    work: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    limit: int | None = None,
    most_failures: int | None = None,
    continue_on_error: bool = False,
    first_wave: int = 256,
    key: str = "filename",
) -> DataFrame:
    """Scores ``work`` in order of ``key`` until ``limit`` of it succeeded or too much failed in a row.

    ``score`` takes rows of ``work`` and returns one row for each, with ``key``
    and ``ok``. The first wave has ``limit`` rows (or ``first_wave``); each next
    one as many as should bring the missing successes at the rate seen so far,
    and at most four times the one before. No row is scored twice. The result
    has the attempts up to the one that ends them, whatever the waves were.
    """
    numbered = number_rows(work, [key], name="_no")
    total = numbered.count()
    size, begin, scored = max(1, limit or first_wave), 0, None
    while True:
        end = min(total, begin + size)
        part = numbered.where((F.col("_no") >= begin) & (F.col("_no") < end)).drop("_no")
        wave = settle(score(part))
        scored = wave if scored is None else scored.unionByName(wave)
        made = attempted(scored, limit, most_failures, continue_on_error, [key])
        if end >= total:
            return made
        successes, n = scored.agg(F.count_if("ok"), F.count(F.lit(1))).first()
        if limit is not None and successes >= limit:
            return made
        if most_failures is not None and not continue_on_error and not made.where("warns").isEmpty():
            return made
        missing = limit - successes if limit is not None else 4 * size
        rate = max(successes, 1) / max(n, 1)
        begin, size = end, min(4 * size, max(1, round(1.1 * missing / rate)))
