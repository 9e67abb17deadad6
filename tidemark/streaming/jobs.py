"""Structured Streaming versions of the incremental jobs.

* :func:`upsert_stream`  - file stream -> ``foreachBatch`` merge by key, rewriting only the
  partitions that a batch touches; replaying a batch gives the same table.
* :func:`dedup_stream`   - watermark + ``dropDuplicatesWithinWatermark``: re-delivered
  rows (look-back re-reads) are dropped while state stays bounded by the watermark.
* :func:`hourly_counts_stream` - tumbling 1-hour windows in append mode: a window is
  emitted only once the watermark closes it (the "drop the open bucket" rule).

Every query runs with ``trigger(availableNow=True)`` and a checkpoint in the shared work
folder, so a restart (or a lost executor) resumes from the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.scalars import instant_to_ntz, ntz_to_instant
from ..operators.incremental import dedup_batch, merge_partitions


def upsert_stream(spark: SparkSession, source: str, schema: StructType, keys: list[str], order_col: str,
                  part_col, part_name: str, target: str, checkpoint: str) -> None:
    """Run the file stream until caught up; each micro-batch is merged by ``keys`` and
    rewrites only the partitions (``part_name`` = ``part_col`` expression, e.g. the event
    date) that it touches.  Of a key's rows in one batch the one that was loaded last wins
    (time of its file), then the greater ``order_col``."""

    def upsert_batch(batch: DataFrame, epoch_id: int) -> None:
        latest = dedup_batch(batch, keys, [F.col("__loaded").desc(), F.col(order_col).desc()])
        merge_partitions(spark, target, latest.drop("__loaded").withColumn(part_name, part_col), keys, part_name)

    q = (spark.readStream.schema(schema).parquet(source)
         .withColumn("__loaded", F.col("_metadata.file_modification_time"))
         .writeStream.foreachBatch(upsert_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def dedup_stream(spark: SparkSession, source: str, schema: StructType, keys: list[str], ts: str,
                 delay: str, sink: str, checkpoint: str) -> None:
    q = (spark.readStream.schema(schema).parquet(source)
         .withColumn("__event_time", ntz_to_instant(ts))
         .withWatermark("__event_time", delay).dropDuplicatesWithinWatermark(keys)
         .drop("__event_time")
         .writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def hourly_counts_stream(spark: SparkSession, source: str, schema: StructType, ts: str, key: str,
                         delay: str, sink: str, checkpoint: str) -> None:
    counts = (spark.readStream.schema(schema).parquet(source)
              .withColumn("__event_time", ntz_to_instant(ts))
              .withWatermark("__event_time", delay)
              .groupBy(F.window("__event_time", "1 hour"), key).agg(F.count(F.lit(1)).alias("n"))
              .select(instant_to_ntz("window.start").alias("window_start"),
                      instant_to_ntz("window.end").alias("window_end"), key, "n"))
    q = (counts.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()


def newest_parts(spark: SparkSession, root: str, before: int | None = None) -> dict[str, tuple[int, str]]:
    """Part -> (epoch, folder) of the newest finished epoch (below ``before``, if given) that
    wrote it, from the folder names ``epoch=N/part=P`` alone.  Parts are months or hash
    buckets, so this list follows the calendar, not the data."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    root_path = hadoop.Path(root)
    fs = root_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root_path):
        return {}
    out: dict[str, tuple[int, str]] = {}
    for run in fs.listStatus(root_path):
        name = run.getPath().getName()
        if not name.startswith("epoch="):
            continue
        epoch = int(name[len("epoch="):])
        if (before is not None and epoch >= before) or not fs.exists(hadoop.Path(run.getPath(), "_SUCCESS")):
            continue
        for part in fs.listStatus(run.getPath()):
            folder = part.getPath().getName()
            if folder.startswith("part="):
                key = folder[len("part="):]
                if key not in out or out[key][0] < epoch:
                    out[key] = (epoch, part.getPath().toString())
    return out


def read_parts(spark: SparkSession, parts: dict[str, tuple[int, str]], schema: StructType) -> DataFrame:
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[folder for _, folder in parts.values()])


def drop_older(spark: SparkSession, root: str, before: dict[str, tuple[int, str]], epoch_id: int) -> None:
    """Delete what no run can need again after ``epoch_id`` was written over ``before``: of each
    part written, all epochs but this one and the one a replay of this one starts from."""
    from ..operators.incremental import delete_folder
    now = newest_parts(spark, root, epoch_id + 1)
    for part, (epoch, _) in before.items():
        if now[part][0] == epoch_id:
            older = newest_parts(spark, root, epoch).get(part)
            while older:
                delete_folder(spark, older[1])
                older = newest_parts(spark, root, older[0]).get(part)


def current_balances(spark: SparkSession, out: str, keys: list[str]) -> DataFrame:
    """(keys, period, balance): the newest version of every month."""
    parts = newest_parts(spark, out)
    if not parts:
        raise ValueError(f"no balances in {out}")
    any_folder = next(iter(parts.values()))[1]
    return read_parts(spark, parts, spark.read.parquet(any_folder).schema).select(*keys, "period", "balance")


#: Hash buckets of the table of newest balances (fixed: stored state depends on it).
HEAD_BUCKETS = 64
#: Rows of a batch and of the days it meets that one task orders by key and day.
TASK_ROWS = 2_000_000


def running_balance_stream(spark: SparkSession, source: str, schema: StructType, key: str, ts: str,
                           amount: str, out: str, state: str, checkpoint: str) -> None:
    """Stateful running balance over a stream of legs, in any order of arrival.

    Two tables, each kept as versions by epoch: ``out`` holds one row per key and day (delta,
    the balance before it and after it) in parts by month, ``state`` the newest day and balance
    of each key in parts by hash bucket.  Each micro-batch is summed per (key, day) by Spark
    first (a hot key is collapsed before any per-key step).  A key's rows are made anew from
    its own first new day on; its opening is the balance before its next stored day, or its
    newest balance if it has none from there on.  So a batch reads and rewrites the months from
    its first day on and the buckets of its keys, never the months before: late legs and days
    split over batches redo exactly the days they change, and legs in order cost the same
    however long the history is.  Replaying an epoch starts from the versions before it and
    overwrites its own; older versions are removed.  Null keys are a key; legs without a time
    belong to no day and are left out.

    New days, stored days and newest balances are sent by key once and written once, as a
    version of the months; those in which no row was made anew are dropped from it.
    """
    from ..operators.incremental import delete_folder
    from ..operators.ledger import period_sums

    key_type = schema[key].dataType if isinstance(schema, StructType) else StructType.fromDDL(schema)[key].dataType
    day_rows = (StructType().add(key, key_type).add("period", "date").add("delta", "double")
                .add("opening", "double").add("balance", "double"))
    head_rows = StructType().add(key, key_type).add("period", "date").add("balance", "double")
    month = F.date_format("period", "yyyyMM").alias("part")
    bucket = F.pmod(F.xxhash64(key), F.lit(HEAD_BUCKETS)).cast("string").alias("part")
    none = F.lit(None).cast("double")

    def batch_fn(batch: DataFrame, epoch_id: int) -> None:
        dated = batch.where(F.col(ts).isNotNull())
        seen = dated.agg(F.date_format(F.min(F.to_date(ts)), "yyyyMM").alias("lo"), F.collect_set(bucket).alias("touched"),
                         F.count(F.lit(1)).alias("legs")).first()
        if seen.lo is None:
            return
        before, buckets = newest_parts(spark, out, epoch_id), newest_parts(spark, state, epoch_id)
        stored = read_parts(spark, {p: v for p, v in before.items() if p >= seen.lo}, day_rows)
        heads = read_parts(spark, {p: v for p, v in buckets.items() if p in seen.touched}, head_rows)
        sums = period_sums(dated, [key], F.to_date(ts), amount)
        both = (sums.select(key, "period", "delta", none.alias("opening"), none.alias("balance"), none.alias("head"), F.lit(True).alias("new"))
                .unionByName(stored.select("*", none.alias("head"), F.lit(False).alias("new")))
                .unionByName(heads.select(key, "period", none.alias("delta"), none.alias("opening"), none.alias("balance"),
                                          F.col("balance").alias("head"), F.lit(False).alias("new"))))
        tasks = (seen.legs + stored.count()) // TASK_ROWS
        few = tasks <= int(spark.conf.get("spark.sql.shuffle.partitions"))
        dealt = both.repartition(key) if few else both.repartition(tasks, key)
        days = dealt.groupBy(key, "period").agg(F.sum("delta").alias("delta"), F.max("new").alias("new"),
                                                *[F.max(c).alias(c) for c in ("opening", "balance", "head")])
        # all windows go over the same order; a day that only the newest balance names is no row
        w = Window.partitionBy(key).orderBy("period")
        whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        days = days.withColumn("redone", F.coalesce(F.col("period") >= F.min(F.when(F.col("new"), F.col("period"))).over(whole), F.lit(False)))
        redone, delta = F.col("redone"), F.when(F.col("redone"), F.col("delta"))
        # the balance before a key's first new day: before its next stored day, else its newest
        next_stored = F.min_by("opening", F.when(redone & F.col("opening").isNotNull(), F.col("period"))).over(whole)
        newest = F.max(F.when(~redone, F.col("head"))).over(whole)
        days = (days.withColumn("base", F.coalesce(next_stored, newest, F.lit(0.0)))
                .withColumn("till", F.sum(delta).over(w.rowsBetween(Window.unboundedPreceding, -1)))
                .withColumn("upto", F.sum(delta).over(w.rowsBetween(Window.unboundedPreceding, 0)))
                .withColumn("last", F.lead("period").over(w).isNull())
                .where(F.col("new") | F.col("opening").isNotNull()))
        days = days.select(key, "period", "delta",
                           F.when(redone, F.col("base") + F.coalesce("till", F.lit(0.0))).otherwise(F.col("opening")).alias("opening"),
                           F.when(redone, F.col("base") + F.col("upto")).otherwise(F.col("balance")).alias("balance"),
                           "redone", (redone & F.col("last")).alias("newest"), month)
        version = f"{out}/epoch={epoch_id}"
        days.write.mode("overwrite").partitionBy("part").parquet(version)
        made = spark.read.schema(days.schema).parquet(version)
        tops = (heads.withColumn("new", F.lit(False))
                .unionByName(made.where("newest").select(key, "period", "balance", F.lit(True).alias("new")))
                .groupBy(key).agg(F.max_by(F.struct("period", "balance"), "new").alias("top")))
        (tops.select(key, "top.period", "top.balance", bucket)
         .write.mode("overwrite").partitionBy("part").parquet(f"{state}/epoch={epoch_id}"))
        changed = {r.part for r in made.where("redone").select("part").distinct().collect()}
        for part, (epoch, folder) in newest_parts(spark, out, epoch_id + 1).items():
            if epoch == epoch_id and part not in changed:
                delete_folder(spark, folder)
        drop_older(spark, out, before, epoch_id)
        drop_older(spark, state, buckets, epoch_id)

    q = (spark.readStream.schema(schema).parquet(source)
         .writeStream.foreachBatch(batch_fn)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
