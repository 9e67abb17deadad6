"""Relational helpers used across the jobs: null-aware NOT IN,
latest-per-key, tagged unions, disjunctive joins, neighbour joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared work folder, made once for all that read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str) -> DataFrame:
    """``df`` dealt by ``key`` to as many parts as :func:`written_by` makes buckets."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def written_by(df: DataFrame, key: str, name: str) -> DataFrame:
    """As :func:`written`, in buckets of ``key``: what joins or groups by it reads them as they lie, without an
    exchange.  ``df`` comes from :func:`dealt` rows (else tasks write files of many buckets); for a key with few rows
    a value, as one task reads a bucket.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, name)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = path.rpartition("/")[2].replace("-", "_")
    df.write.format("parquet").bucketBy(n, key).option("path", path).saveAsTable(table)
    return spark.table(table)


def not_in(df: DataFrame, col: str, other: DataFrame, other_col: str) -> DataFrame:
    """``col NOT IN (SELECT other_col FROM other)`` with SQL null semantics.

    One null on the right -> no rows; a null on the left is dropped unless the right is
    empty.  Planned as a left-anti join plus two EXISTS subqueries (no null-aware
    broadcast requirement, so it scales with both sides).
    """
    keys = other.select(F.col(other_col).alias("__k"))
    right_has_null = keys.where(F.col("__k").isNull()).exists()
    right_nonempty = keys.exists()
    anti = df.join(keys.where(F.col("__k").isNotNull()), F.col(col) == F.col("__k"), "left_anti")
    return anti.where(~right_has_null & (F.col(col).isNotNull() | ~right_nonempty))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """``QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order) = 1``.

    ``order`` must be a total order (add the key columns last) for a deterministic pick.
    Spark plans ``row_number() == 1`` with a group-limit before the shuffle
    (``WindowGroupLimit``), so each task forwards at most one row per key.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def count_distinct_many(df: DataFrame, group: list[str], cols: list[str],
                        names: list[str] | None = None) -> DataFrame:
    """Several exact ``COUNT(DISTINCT c)`` per group, in one scan.

    Every row becomes one (group, column number, value) row for each column; those are made
    distinct (partially map-side) and counted per group.  Nulls are not counted, as in SQL;
    a null group key is a group like any other, and groups of nulls alone count 0.
    """
    names = names or [f"n_{c}" for c in cols]
    values = [F.struct(F.lit(i).alias("n"), F.col(c).cast("string").alias("v")) for i, c in enumerate(cols)]
    rows = df.select(*group, F.explode(F.array(*values)).alias("__x")).select(*group, "__x.n", "__x.v").distinct()
    return rows.groupBy(*group).agg(*[F.count(F.when(F.col("n") == i, F.col("v"))).alias(name)
                                      for i, name in enumerate(names)])


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys match, as rows of one ``PARTITION BY`` group do; the
    left side's keys stay."""
    other = right.withColumnsRenamed({k: f"__rk_{k}" for k in keys})
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(other[f"__rk_{k}"]) for k in keys])
    return left.join(other, cond, how).drop(*[f"__rk_{k}" for k in keys])


def tagged_union(parts: dict[str, DataFrame], tag: str) -> DataFrame:
    """UNION ALL of same-shaped inputs with a literal source column."""
    tagged = [df.withColumn(tag, F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def or_join(left: DataFrame, right: DataFrame, shared: list[tuple[str, str]],
            alternatives: list[tuple], prefix: str = "r_") -> DataFrame:
    """``ON shared equalities AND (alt1 OR alt2 OR ...)`` as a UNION ALL of equi-joins (inner).

    An alternative is (left column, right column) or (left column, right column, condition),
    where ``condition(l, r)`` gets two functions from a column name to the left or right
    column and returns what must hold on that branch besides the equality.  Branch *i* joins
    on (shared, alt_i) - a hashable key, so no nested loop - and keeps only pairs for which
    no earlier alternative is true (``A OR B = A + (B AND NOT A)``, with null treated as
    false).  Each matching pair appears exactly once, without a de-duplication shuffle.
    Right columns whose name the left side has too come out with ``prefix``.
    """
    own = {c: f"__r{i}" for i, c in enumerate(right.columns)}
    other = right.select(*[F.col(c).alias(n) for c, n in own.items()])
    l, r = (lambda c: left[c]), (lambda c: other[own[c]])  # noqa: E741

    def holds(alt) -> Column:
        c = l(alt[0]) == r(alt[1])
        return c & alt[2](l, r) if len(alt) > 2 else c

    outs = []
    for i, alt in enumerate(alternatives):
        cond = [l(a) == r(b) for a, b in shared] + [holds(alt)]
        cond += [~F.coalesce(holds(x), F.lit(False)) for x in alternatives[:i]]
        outs.append(left.join(other, reduce(lambda a, b: a & b, cond), "inner"))
    names = {n: f"{prefix}{c}" if c in left.columns else c for c, n in own.items()}
    return reduce(lambda a, b: a.unionByName(b), outs).withColumnsRenamed(names)


def neighbour(df: DataFrame, group: str, pos: str, offset: int, cols: list[str],
              prefix: str) -> DataFrame:
    """Attach the columns of the row at ``pos + offset`` in the same group.

    The self-join ``a.pos + offset = b.pos`` as an equi-join on the computed key.  Unlike
    ``lag/lead`` it is exact when positions are sparse (a missing neighbour gives nulls),
    and both sides hash-partition on (group, pos), so a hot group is spread over its
    position values instead of landing in one window task.
    """
    other = df.select(F.col(group).alias("__g"), (F.col(pos) - F.lit(offset)).alias("__p"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    j = df.join(other, (df[group] == other["__g"]) & (df[pos] == other["__p"]), "left")
    return j.drop("__g", "__p")
