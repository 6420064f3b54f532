"""Naming an intermediate value inside one expression."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` applied to ``value``, which is computed once however often body uses it.

    A column of an inner select gives no such promise: a filter pushed below the
    select repeats its expression at every use. Worth it for costly values only.
    """
    return F.transform(F.array(value), body)[0]
