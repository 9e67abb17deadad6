"""Data-quality checks as queries: each returns the failing rows (no rows = pass).

Gap checks need "the previous value in order".  With no partition key (or a hot key
holding a third of the table) a plain ``lag`` window would put everything in one task;
:func:`ordered_lag` range-partitions the rows instead and carries one row per partition.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def ordered_lag(df: DataFrame, keys: list[str], col: str, carry_cols: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``prev_<col>`` (and ``prev_<c>`` for each carry column): the values of the
    previous row ordered by ``col`` within ``keys`` (null keys are one key).

    Rows are range-partitioned by (keys, col), so neither a table without keys nor a hot key
    meets in one task.  ``lag`` runs inside each partition (the window's partition is the
    Spark partition, whose rows are already there); each partition's first row takes the
    last row of the nearest partition before it from a summary of one row per partition.
    """
    x = df.where(F.col(col).isNotNull()).repartitionByRange(*[F.col(k) for k in keys], F.col(col))
    path = scratch_path(df.sparkSession, "ordered")
    x.withColumn("__p", F.spark_partition_id()).write.parquet(path)  # the numbers must not change on a retry
    x = df.sparkSession.read.parquet(path)
    row = F.struct(*keys, col, *carry_cols)
    w = Window.partitionBy("__p").orderBy(*keys, col)
    x = x.withColumn("__prev", F.lag(row).over(w))
    ends = x.groupBy("__p").agg(F.max_by(row, F.struct(*keys, col)).alias("__last"))
    ends = ends.withColumn("__before", F.lag("__last").over(Window.orderBy("__p"))).select("__p", "__before")
    x = x.join(ends, "__p")
    x = x.withColumn("__prev", F.coalesce("__prev", "__before"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__prev.{k}")) for k in keys], F.lit(True))
    for c in (col, *carry_cols):
        x = x.withColumn(f"prev_{c}", F.when(same, F.col(f"__prev.{c}")))
    return x.drop("__p", "__prev", "__before")


def sequence_gaps(df: DataFrame, partition_by: list[str], column: str) -> DataFrame:
    """Rows where ``column - previous column <> 1``; ``gap = column - prev - 1``."""
    x = ordered_lag(df.select(*partition_by, column), partition_by, column)
    prev = F.col(f"prev_{column}")
    return x.where(F.col(column) - prev != 1).select(
        *partition_by, prev, column, (F.col(column) - prev - 1).alias("gap"))


def sequence_distinct_gaps(df: DataFrame, column: str) -> DataFrame:
    return sequence_gaps(df.select(column).distinct(), [], column)


def sequence_gaps_buffered(df: DataFrame, partition_by: list[str], column: str, delayed_column: str,
                           delayed_period: str) -> DataFrame:
    """Gaps whose previous row's ``delayed_column`` is older than MAX(delayed) - period,
    so rows still arriving do not raise false gaps.  MAX comes from the input itself."""
    x = ordered_lag(df.select(*partition_by, column, delayed_column), partition_by, column,
                    (delayed_column,))
    mx = df.select(F.max(delayed_column)).scalar()
    prev = F.col(f"prev_{column}")
    return x.where((F.col(column) - prev != 1)
                   & (F.col(f"prev_{delayed_column}") < mx - F.expr(f"INTERVAL {delayed_period}"))) \
            .select(*partition_by, prev, column, (F.col(column) - prev - 1).alias("gap"))


def date_gaps(df: DataFrame, partition_by: list[str], column: str,
              excluded: list[tuple[str, str]] = ()) -> DataFrame:
    """Consecutive dates more than one day apart; ``gap`` = days missing.  Rows whose date
    falls in an excluded span are not reported (anti join on a generated span table)."""
    x = ordered_lag(df.select(*partition_by, column), partition_by, column)
    prev = F.col(f"prev_{column}")
    out = x.where(F.datediff(F.col(column), prev) > 1).select(
        *partition_by, prev, column, (F.datediff(F.col(column), prev) - 1).cast("long").alias("gap"))
    if excluded:
        spark = df.sparkSession
        spans = reduce(lambda a, b: a.unionByName(b), [
            spark.range(1).select(F.explode(F.sequence(F.lit(lo).cast("date"), F.lit(hi).cast("date")))
                                  .alias("__d")) for lo, hi in excluded])
        out = out.join(spans, F.col(column).cast("date") == F.col("__d"),
                       "left_anti")
    return out


def negative_one(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) == "-1")


def not_null(df: DataFrame, column: str, where: Column | None = None) -> DataFrame:
    x = df if where is None else df.where(where)
    return x.where(F.col(column).isNull())


def unique_combination(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def recency(df: DataFrame, keys: list[str], column: str, as_of: Column, days: int) -> DataFrame:
    """Keys whose latest ``column`` is older than ``as_of - days``."""
    g = df.groupBy(*keys).agg(F.max(column).alias("latest"))
    return g.where(F.col("latest") < as_of - F.expr(f"INTERVAL {days} DAYS"))


def value_domain(df: DataFrame, column: str, allowed: list | None = None,
                 length: int | None = None) -> DataFrame:
    bad = F.lit(False)
    if allowed is not None:
        bad = bad | ~F.col(column).isin(*allowed)
    if length is not None:
        bad = bad | (F.length(column) != length)
    return df.where(bad)


def foreign_key(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Child rows whose non-null key has no parent row."""
    p = parent.select(F.col(parent_column).alias(column)).distinct()
    return child.where(F.col(column).isNotNull()).join(p, column, "left_anti")


def missing_columns(spark: SparkSession, df: DataFrame, expected: list[str]) -> DataFrame:
    """``expect_column_to_exist``: one row per expected column that the schema lacks.  Read
    from the schema alone."""
    return spark.createDataFrame([(c, "missing") for c in expected if c not in df.columns],
                                 "column_name string, problem string")


@dataclass(frozen=True)
class Check:
    name: str
    failures: DataFrame
    severity: str = "error"     # 'warn' or 'error'
    error_after: int = 0        # reference: warn, error only when failures > threshold


def report(checks: list[Check]) -> DataFrame:
    """One row per check: failures, level ('pass' / 'warn' / 'error').  Each count is a
    global aggregate over the failing rows; the union is one small job."""
    rows = []
    for c in checks:
        n = c.failures.agg(F.count(F.lit(1)).alias("failures"))
        level = F.when(F.col("failures") == 0, "pass")
        if c.severity == "warn":
            level = level.otherwise("warn")
        else:
            level = level.when(F.col("failures") > c.error_after, "error").otherwise("warn")
        rows.append(n.select(F.lit(c.name).alias("check_name"), "failures", level.alias("level")))
    return reduce(lambda a, b: a.unionByName(b), rows)
