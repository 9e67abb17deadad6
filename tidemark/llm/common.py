"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path, ship_package

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ASCII_LOWER = str.maketrans(UPPER, UPPER.lower())


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named columns of one input table."""
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a result under the shared work folder and read it back (cuts lineage)."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_column(column: str = "text"):
    """The text as a string column, null as empty."""
    return F.coalesce(F.col(column), F.lit("")).alias("text")


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text with A-Z in lower case, as UTF-8 bytes.

    ``bytes.lower`` changes A-Z alone and ``bytes.split`` cuts at space and 0x09-0x0D alone.
    """
    return text.encode("utf-8", "surrogatepass").lower().split()


def fresh(name: str) -> str:
    """A column name that no input column can hold by chance."""
    return f"__{name}_{uuid.uuid4().hex[:8]}"
