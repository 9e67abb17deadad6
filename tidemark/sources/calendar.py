"""Calendars generated by Spark instead of a shared hour table.

A calendar is bounded by the data's own range (or an explicit ``as_of``), never by the
wall clock, so results are repeatable.  One row of bounds is exploded; the output is
one row per hour/day in range (tens of thousands of rows per decade at most).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import trunc_ts


def hours_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    return bounds.select(F.explode(F.sequence(trunc_ts("hour", lo), trunc_ts("hour", hi),
                                              F.expr("INTERVAL 1 HOUR"))).alias("hour"))


def days_between(bounds: DataFrame, lo: str = "lo", hi: str = "hi") -> DataFrame:
    return bounds.select(F.explode(F.sequence(F.to_date(lo), F.to_date(hi),
                                              F.expr("INTERVAL 1 DAY"))).alias("date"))


def data_bounds(df: DataFrame, ts: str, as_of: Column | None = None) -> DataFrame:
    hi = F.max(ts) if as_of is None else F.lit(as_of) if not isinstance(as_of, Column) else as_of
    return df.agg(F.min(ts).alias("lo"), hi.alias("hi"))
