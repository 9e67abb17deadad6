"""Incremental loads on plain parquet: high-water mark, look-back, merge by key.

A run reads the target's high-water mark once (one scalar), pushes it into the source
scan as a literal (so parquet row groups below it are skipped), and merges the new rows
by key.  Merge = keep target rows whose key is not in the batch, plus the batch; the
result is written as a new version folder under the shared work dir, which also cuts
lineage (a lost executor re-reads parquet, not the whole chain).
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..session import scratch_path


def high_water_mark(target: DataFrame, col: str):
    """``SELECT MAX(col) FROM this`` - one value to the driver, used as a literal."""
    return target.agg(F.max(col).alias("hwm")).first()["hwm"]


def new_rows(source: DataFrame, col: str, hwm, lookback: str | None = None) -> DataFrame:
    """``col >= hwm`` (minus an optional look-back such as ``"4 HOURS"``).  No stored
    state (first run) -> everything."""
    if hwm is None:
        return source
    bound = F.lit(hwm)
    if isinstance(hwm, _dt.datetime):
        # a Python datetime literal is read in the session time zone; go through text cast
        # to the column's own type so a zone-free mark stays exactly the stored value
        bound = F.lit(hwm.isoformat(sep=" ")).cast(source.schema[col].dataType)
    if lookback:
        bound = bound - F.expr(f"INTERVAL {lookback}")
    return source.where(F.col(col) >= bound)


def dedup_batch(batch: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Keep the newest row per key inside one batch (the merge source must be unique).  What
    ``order`` leaves equal is settled by the other columns, so replays pick the same row."""
    rest = [F.col(c).desc_nulls_last() for c in sorted(batch.columns) if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order, *rest)
    return batch.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn")


def same_key(left: DataFrame, right: DataFrame, keys: list[str]) -> Column:
    """Null-safe equality on the key columns."""
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def merge(target: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE: matched keys take the batch row (update all columns), others are inserted.

    Anti join of the target against the batch keys, union the batch: both sides shuffle
    on the key once; running it twice with the same batch gives the same table.  Null keys
    match null keys."""
    seen = batch.select(*keys).distinct()
    keep = target.join(seen, same_key(target, seen, keys), "left_anti")
    return keep.unionByName(batch.select(*target.columns))


def write_version(df: DataFrame, spark: SparkSession, name: str,
                  partition_by: list[str] | None = None) -> str:
    path = scratch_path(spark, name)
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The parquet table at ``path`` in its declared types (partition values included: text
    such as ``007`` stays text); an empty frame when nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path).select(*schema.names)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def delete_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def merge_partitions(spark: SparkSession, target_path: str, batch: DataFrame, keys: list[str],
                     part_col: str) -> None:
    """Merge ``batch`` into a table partitioned by ``part_col``, rewriting only the
    partitions that the batch's rows go to or that held its keys before.

    Null keys and null partition values are values like any other.  A key whose partition
    value changed leaves its old partition; partitions that end up empty are removed.
    Nothing but the folders of emptied partitions comes to the driver.  The merged
    partitions go to a staging folder first, then replace the target's by a dynamic
    partition overwrite; replaying the same batch gives the same table.
    """
    current = read_table(spark, target_path, batch.schema)
    seen = batch.select(*keys).distinct()
    held = current.join(seen, same_key(current, seen, keys), "left_semi").select(part_col)
    touched = held.unionByName(batch.select(part_col)).distinct()
    affected = current.join(touched, current[part_col].eqNullSafe(touched[part_col]), "left_semi")
    staging = scratch_path(spark, "merge-staging")
    merge(affected, batch, keys).write.partitionBy(part_col).parquet(staging)
    staged = spark.read.schema(batch.schema).parquet(staging).select(*batch.columns)
    full = staged.select(part_col).distinct()
    left = held.distinct().join(full, held[part_col].eqNullSafe(full[part_col]), "left_anti")
    emptied = []
    if not left.isEmpty():
        files = spark.read.schema(batch.schema).parquet(target_path)
        files = files.select(part_col, F.regexp_extract("_metadata.file_path", "^(.*)/[^/]+$", 1).alias("folder"))
        emptied = [r.folder for r in files.join(left, files[part_col].eqNullSafe(left[part_col]), "left_semi")
                   .select("folder").distinct().collect()]
    (staged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy(part_col).parquet(target_path))
    for folder in [*emptied, staging]:
        delete_folder(spark, folder)


def clustered_write(df: DataFrame, spark: SparkSession, name: str, partition_col: str,
                    sort_cols: list[str]) -> str:
    """``cluster_by``: range-partition on the clustering columns so each task writes a few
    partition folders, sort inside the task, partition the folder by ``partition_col``."""
    path = scratch_path(spark, name)
    (df.repartitionByRange(partition_col, *sort_cols).sortWithinPartitions(partition_col, *sort_cols)
       .write.mode("overwrite").partitionBy(partition_col).parquet(path))
    return path


def append_stamped(df: DataFrame, path: str, stamp_col: str = "_inserted_timestamp") -> None:
    """INSERT ... SELECT with the load time in UTC, whatever the session's time zone
    (``current_timestamp`` is fixed per query)."""
    utc = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    df.withColumn(stamp_col, utc).write.mode("append").parquet(path)
