"""The corpus pipeline: documents in, clean token ids out.

Each stage is one operator of ``tidemark.llm`` over everything that the stage before kept;
its result is written under the shared work folder and read back, so a lost executor costs
a stage's tasks and never the stages before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, pieces, simhash, toxicity
from tidemark.llm.common import materialise, table
from tidemark.session import ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.7."""
    ship_package(spark)
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (4-word shingles, at most 4 differing bits)."""
    ship_package(spark)
    return simhash.keep_one(docs, shingle=4, max_bits=4)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def to_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids under merge-dropout; ``text`` is what the ids decode to."""
    ship_package(spark)
    return pieces.recode(docs, column="ids").withColumn("n_ids", F.size("ids"))


STAGES = [("toxicity", drop_toxic), ("simhash_near_dedup", drop_near_duplicates),
          ("benchmark_decontamination", drop_leaks), ("sentencepiece", to_pieces)]

#: The stages learn models and hash fingerprints; tests/llm compares them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = materialise(docs, f"stage-{name}")
    return docs
