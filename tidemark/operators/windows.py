"""Window jobs that must not become single-task windows at scale."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def forward_fill_global(df: DataFrame, order: str, value: str, chunk: Column) -> DataFrame:
    """``LAST_VALUE(value IGNORE NULLS) OVER (ORDER BY order ROWS UNBOUNDED PRECEDING)``
    with no partition key, without moving the whole table into one task.

    1. fill inside each chunk (e.g. a day) - a window partitioned by chunk;
    2. per chunk, its last non-null value (``max_by``) - one row per chunk;
    3. carry across chunks with a window over that small per-chunk table (one row per
       chunk, so a single task there is fine: a decade of days is 3,653 rows);
    4. rows still null after step 1 take the carry from earlier chunks.
    """
    x = df.withColumn("__chunk", chunk)
    w_in = Window.partitionBy("__chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("__fill", F.last(value, ignorenulls=True).over(w_in))
    last = (x.where(F.col(value).isNotNull()).groupBy("__chunk")
             .agg(F.max_by(value, order).alias("__chunk_last")))
    chunks = x.select("__chunk").distinct().join(last, "__chunk", "left")
    w_c = Window.orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = chunks.withColumn("__carry", F.last("__chunk_last", ignorenulls=True).over(w_c)) \
                  .select("__chunk", "__carry")
    out = x.join(carry, "__chunk", "left")
    return out.withColumn(value, F.coalesce("__fill", "__carry")).drop("__chunk", "__fill", "__carry")


def fill_forward(df: DataFrame, keys: list[str], order: str, value: str, out: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out or value, F.last(value, ignorenulls=True).over(w))
