"""Profiles over any range of dates, from sketches kept by date.

A date's row has, for every profiled column, a theta sketch of its distinct
values and, for numbers, a quantile sketch. Sketches of dates unite into those of
a range, so a profile reads a row a date and none of the data; a date that
changes is sketched anew and replaces its row. Distinct counts are within about
three standard errors, ``3 / sqrt(2^LOG_ENTRIES)``; the rank of a quantile is within
about ``3 / QUANTILE_K``.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LOG_ENTRIES = 14
QUANTILE_K = 400
QUARTILES = (0.25, 0.5, 0.75)


def date_sketches(
    df: DataFrame,
    distinct: Sequence[str] = (),
    numbers: Sequence[str] = (),
    by: str = "ingestion_date",
) -> DataFrame:
    """(by, n_rows, distinct_<column>..., quantiles_<column>...): a row a date. NULLs are not counted."""
    theta = [F.theta_sketch_agg(F.col(c), LOG_ENTRIES).alias(f"distinct_{c}") for c in distinct]
    kll = [
        F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_K).alias(f"quantiles_{c}")
        for c in numbers
    ]
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n_rows"), *theta, *kll)


def range_profile(sketches: DataFrame, where: Column | None = None) -> DataFrame:
    """One row: rows, estimated distinct values and quartiles of the dates that match ``where``."""
    rows = sketches if where is None else sketches.where(where)
    distinct = [c.removeprefix("distinct_") for c in sketches.columns if c.startswith("distinct_")]
    numbers = [c.removeprefix("quantiles_") for c in sketches.columns if c.startswith("quantiles_")]
    united = rows.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"),
        *[F.theta_union_agg(f"distinct_{c}", LOG_ENTRIES).alias(f"distinct_{c}") for c in distinct],
        *[F.kll_merge_agg_double(f"quantiles_{c}", QUANTILE_K).alias(f"quantiles_{c}") for c in numbers],
    )
    ranks = F.array(*[F.lit(q) for q in QUARTILES])
    empty = lambda c: F.kll_sketch_get_n_double(c) == 0
    return united.select(
        "n_rows",
        *[F.theta_sketch_estimate(f"distinct_{c}").cast("bigint").alias(f"n_{c}") for c in distinct],
        *[
            F.when(~empty(F.col(f"quantiles_{c}")), F.kll_sketch_get_quantile_double(F.col(f"quantiles_{c}"), ranks)).alias(f"quartiles_{c}")
            for c in numbers
        ],
    )
