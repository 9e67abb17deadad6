"""Semi-structured helpers on Spark's VARIANT type.

Payloads stay JSON text in storage; they are parsed once (``try_parse_json``) and typed
columns are pulled with ``try_variant_get``.  FLATTEN maps to the ``variant_explode``
table function through a lateral join; the recursive FLATTEN of nested inner
transactions opens a few levels in one pass and writes them before the next pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def get(v, path: str, type_: str = "string") -> Column:
    """``v:a.b::TYPE`` -> ``try_variant_get(v, '$.a.b', type)`` (null on missing or bad cast)."""
    return F.try_variant_get(v if isinstance(v, Column) else F.col(v), path, type_)


def present(v, path: str) -> Column:
    """Key present (its value may be JSON null) - differs from ``get(...) IS NOT NULL``."""
    return F.variant_get(v if isinstance(v, Column) else F.col(v), path, "variant").isNotNull()


def is_json_null(v, path: str) -> Column:
    return F.coalesce(F.is_variant_null(F.variant_get(v if isinstance(v, Column) else F.col(v), path,
                                                      "variant")), F.lit(False))


def explode(df: DataFrame, array_col: str, outer: bool = False) -> DataFrame:
    """FLATTEN: one row per element (or object entry) with ``pos``, ``key``, ``value``.
    ``outer=True`` keeps rows whose input has no elements (nulls in pos/key/value)."""
    spark = df.sparkSession
    tvf = spark.tvf.variant_explode_outer if outer else spark.tvf.variant_explode
    return df.lateralJoin(tvf(F.col(array_col).outer()), how="left" if outer else "inner")


#: Levels of a tree that one pass flattens before its rows are written.
LEVELS = 4


def explode_recursive(df: DataFrame, payload: str, id_cols: list[str], fields: dict[str, tuple[str, str]],
                      child_path: str = "$.dt.itx", child_label: str = "dt.itx") -> DataFrame:
    """Every node of a tree of nested arrays, with its path text and the named ``fields``
    (name -> (variant path, type)): root path '' and children ``dt.itx[i]``,
    ``dt.itx[i].dt.itx[j]`` ... at any depth.

    A row is either a finished node (its typed fields) or an open one (its child array, still
    to be exploded).  One pass opens ``LEVELS`` levels without a shuffle and is written below
    ``spark.checkpoint.dir`` (a lost executor re-reads it); the next pass reads the open rows
    alone, and a pass that leaves none ends the walk.  So the payload is parsed once, a tree
    of depth d takes about d / ``LEVELS`` passes, and neither depth nor node count is bounded.
    """
    spark = df.sparkSession
    typed = [get("__node", p, t).alias(n) for n, (p, t) in fields.items()]
    kids = F.variant_get("__node", child_path, "variant")

    done = F.struct(F.lit(False).alias("__open"), *[F.coalesce(F.col(f"__{n}"), c).alias(n) for n, c in zip(fields, typed)],
                    F.lit(None).cast("variant").alias("__kids"))
    more = F.struct(F.lit(True).alias("__open"), *[F.lit(None).cast(t).alias(n) for n, (_, t) in fields.items()],
                    F.col("__below").alias("__kids"))
    rows = F.inline(F.when(F.col("__below").isNotNull(), F.array(done, more)).otherwise(F.array(done)))
    is_open, carried = F.col("__open"), [F.col(n).alias(f"__{n}") for n in fields]
    child = F.concat("path", F.when(F.col("path") == "", "").otherwise("."), F.lit(f"{child_label}["),
                     F.col("pos").cast("string"), F.lit("]"))
    path_, node = F.when(is_open, child).otherwise(F.col("path")).alias("path"), F.when(is_open, F.col("value")).alias("__node")
    kids_or_none = spark.tvf.variant_explode_outer(F.col("__kids").outer())
    # an open row without elements ends here
    lives = ~is_open | F.col("pos").isNotNull()

    def emit(nodes: DataFrame) -> DataFrame:
        """Finished rows stay; a node gives its finished row and, if it has children, an open one."""
        return nodes.select("*", kids.alias("__below")).select(*id_cols, "path", rows)

    def step(now: DataFrame) -> DataFrame:
        return emit(now.lateralJoin(kids_or_none).where(lives).select(*id_cols, path_, *carried, node))

    none = [F.lit(None).cast(t).alias(f"__{n}") for n, (_, t) in fields.items()]
    now = emit(df.select(*id_cols, F.lit("").alias("path"), *none, F.col(payload).alias("__node")))
    parts = []
    while True:
        for _ in range(LEVELS):
            now = step(now)
        path = scratch_path(spark, "flatten-levels")
        now.write.parquet(path)
        now = spark.read.schema(now.schema).parquet(path)
        parts.append(now.where(~F.col("__open")).select(*id_cols, "path", *fields))
        now = now.where("__open")
        if now.isEmpty():
            return reduce(DataFrame.unionByName, parts)
