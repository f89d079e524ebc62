"""Helpers for higher-order Column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, although the body uses it often.

    Inside lambdas Spark does not share common subexpressions; this binds one instead.
    """
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def tail(items: Column, start: int) -> Column:
    """Items from the 1-based place `start` on; empty when there are fewer."""
    return F.slice(items, F.lit(start), F.greatest(F.size(items), F.lit(0)))


def exploded(df: DataFrame, items: Column, *names: str) -> DataFrame:
    """One row per item that is not null, with its place before it if there are two names.

    Of a plain explode Spark infers a filter on the size and so computes the items twice per row.
    """
    explode = F.explode_outer if len(names) == 1 else F.posexplode_outer
    return df.select("*", explode(items).alias(*names)).where(F.col(names[-1]).isNotNull())
