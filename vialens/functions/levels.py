"""Where a count lies against the quartiles of its baseline."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def level(n: Column, q1: Column, q3: Column) -> Column:
    return F.when(n < q1, "below_normal").when(n > q3, "above_normal").otherwise("normal")


def level_text(n: Column, q1: Column, q3: Column) -> Column:
    return (
        F.when(n < q1, F.format_string("below normal (Q1: %d)", q1))
        .when(n > q3, F.format_string("above normal (Q3: %d)", q3))
        .otherwise("within normal range")
    )


def percentile_band(n: Column, q1: Column, median: Column, q3: Column) -> Column:
    return (
        F.when(n <= q1, "bottom 25%")
        .when(n <= median, "25th-50th percentile")
        .when(n <= q3, "50th-75th percentile")
        .otherwise("top 25%")
    )


def one_decimal(x: Column) -> Column:
    """One decimal of the stored binary value, ties to even.

    ``format_string('%.1f')`` rounds the printed decimal half up instead
    (16.25 to 16.3, 1.15 to 1.2); this gives 16.2 and 1.1.
    """
    return F.call_function("format_number", x, F.lit("0.0"))
