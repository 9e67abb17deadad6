"""File sources: partitioned JSON folders, CSV seeds, file metadata.

The reference reads an external table of JSON files laid out by date, with typed
columns pulled from the payload and the arrival time taken from the file listing.
In Spark the layout is a ``partitionBy`` folder; the file listing is the hidden
``_metadata`` column, so no separate listing table or join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARTITION_COLS = ("year", "month", "day")


def write_json_by_date(df: DataFrame, path: str, ts_col: str) -> str:
    """Write ``df`` as JSON lines under ``year=/month=/day=`` folders of ``ts_col``.

    Rows are range-partitioned on the date first, so each task writes a few date folders
    instead of every task writing a file into every folder.
    """
    d = F.to_date(ts_col)
    out = (df.withColumn("year", F.year(d)).withColumn("month", F.month(d))
             .withColumn("day", F.dayofmonth(d))
             .withColumn(ts_col, F.date_format(ts_col, "yyyy-MM-dd HH:mm:ss.SSSSSS")))
    (out.repartitionByRange(*PARTITION_COLS).write.mode("overwrite")
        .partitionBy(*PARTITION_COLS).json(path))
    return path


def read_json_folder(spark: SparkSession, path: str, schema: T.StructType,
                     multiline: bool = False) -> DataFrame:
    """Read a partitioned JSON folder with a fixed schema (no inference pass).

    ``multiline=True`` also reads files whose top level is an array of records
    (the outer array is stripped: one row per element).
    """
    full = T.StructType(list(schema.fields) + [T.StructField(c, T.IntegerType()) for c in PARTITION_COLS])
    return (spark.read.schema(full).option("multiLine", multiline)
            .option("basePath", path).json(path))


def path_date(path_col="_metadata.file_path"):
    """Date built from the three ``year=/month=/day=`` segments of a file path."""
    p = F.col(path_col)
    part = lambda k: F.regexp_extract(p, rf"/{k}=([0-9]+)/", 1).cast("int")
    return F.make_date(part("year"), part("month"), part("day"))


def with_file_metadata(df: DataFrame) -> DataFrame:
    """Attach file name and modification time of each row's source file."""
    return (df.withColumn("_file_path", F.col("_metadata.file_path"))
              .withColumn("_file_modified", F.col("_metadata.file_modification_time")))


def write_csv_seed(df: DataFrame, path: str) -> str:
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_csv_seed(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
