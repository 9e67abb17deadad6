"""Incremental queries (O12-O15, O18, O19, O143, O144)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import incremental as I
from ..session import scratch_path
from . import register
from .common import T

# Fixed parameters of the incremental scenarios: where the stored run ends and where the
# new batch starts (the batch overlaps the stored run, as a look-back re-read does).
ORDERS_CUT, ORDERS_BATCH = "1999-01-01 00:00:00", "1998-07-01 00:00:00"
EVENTS_CUT, EVENTS_BATCH = "2024-01-20 00:00:00", "2024-01-15 00:00:00"


def _ts(s: str):
    return F.lit(s).cast("timestamp_ntz")


@register("upsert_merge", f"""
WITH target AS (SELECT o_orderkey, 'O' AS o_orderstatus, o_totalprice FROM orders
                WHERE o_orderdate < TIMESTAMP '{ORDERS_CUT}'),
batch AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderdate >= TIMESTAMP '{ORDERS_BATCH}')
SELECT * FROM target WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)
UNION ALL SELECT * FROM batch
""")
def upsert_merge(spark, sf_dir):
    """Stored table (stale statuses, partitioned by order year) merged with an overlapping
    batch, by order key.  Only the years the batch touches are rewritten (dynamic
    partition overwrite through a staging folder); the year follows from the key."""
    o = T(spark, sf_dir).orders.withColumn("o_year", F.year("o_orderdate"))
    target = o.where(F.col("o_orderdate") < _ts(ORDERS_CUT)).select(
        "o_orderkey", F.lit("O").alias("o_orderstatus"), "o_totalprice", "o_year")
    stored = I.write_version(target, spark, "orders-stored", partition_by=["o_year"])
    batch = o.where(F.col("o_orderdate") >= _ts(ORDERS_BATCH)).select("o_orderkey", "o_orderstatus",
                                                                     "o_totalprice", "o_year")
    I.merge_partitions(spark, stored, batch, ["o_orderkey"], "o_year")
    return spark.read.parquet(stored).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("upsert_composite", f"""
WITH target AS (SELECT user_id, event_id, 0.0 AS value FROM events WHERE ts < TIMESTAMP '{EVENTS_CUT}'),
batch AS (SELECT user_id, event_id, value FROM events WHERE ts >= TIMESTAMP '{EVENTS_BATCH}')
SELECT t.* FROM target t LEFT JOIN batch b ON t.user_id = b.user_id AND t.event_id = b.event_id
WHERE b.event_id IS NULL
UNION ALL SELECT * FROM batch
""")
def upsert_composite(spark, sf_dir):
    """Merge by (user, event) into a table partitioned by event date: only the dates that the
    batch touches are rewritten."""
    e = T(spark, sf_dir).events.withColumn("event_date", F.to_date("ts"))
    target = e.where(F.col("ts") < _ts(EVENTS_CUT)).select("user_id", "event_id", F.lit(0.0).alias("value"), "event_date")
    stored = I.write_version(target, spark, "events-stored", partition_by=["event_date"])
    batch = e.where(F.col("ts") >= _ts(EVENTS_BATCH)).select("user_id", "event_id", "value", "event_date")
    I.merge_partitions(spark, stored, batch, ["user_id", "event_id"], "event_date")
    return spark.read.parquet(stored).select("user_id", "event_id", "value")


@register("incremental_hwm", f"""
SELECT event_id, ts FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{EVENTS_CUT}')
""")
def incremental_hwm(spark, sf_dir):
    """New rows since the stored table's high-water mark (read once, pushed as a literal)."""
    e = T(spark, sf_dir).events
    stored = e.where(F.col("ts") < _ts(EVENTS_CUT))
    hwm = I.high_water_mark(stored, "ts")
    return I.new_rows(e.select("event_id", "ts"), "ts", hwm)


@register("incremental_lookback", f"""
SELECT event_id, ts FROM events
WHERE ts >= (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '{EVENTS_CUT}') - INTERVAL 4 HOUR
""")
def incremental_lookback(spark, sf_dir):
    """High-water mark minus a 4 hour look-back, so late rows are re-read (the merge is
    idempotent, so re-reading is safe)."""
    e = T(spark, sf_dir).events
    hwm = I.high_water_mark(e.where(F.col("ts") < _ts(EVENTS_CUT)), "ts")
    return I.new_rows(e.select("event_id", "ts"), "ts", hwm, lookback="4 HOURS")


@register("clustered_write", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
       l_shipdate FROM lineitem
""")
def clustered_write(spark, sf_dir):
    """Write clustered by (ship year, ship date), folders by year; read back."""
    li = T(spark, sf_dir).lineitem.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                                          F.year("l_shipdate").alias("ship_year"), "l_shipdate")
    path = I.clustered_write(li, spark, "lineitem-clustered", "ship_year", ["l_shipdate"])
    return spark.read.parquet(path).select("l_orderkey", "l_linenumber", "ship_year", "l_shipdate")


@register("append_stamped", """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS batch, true AS stamped
FROM orders WHERE o_orderstatus IN ('F', 'O')
""")
def append_stamped(spark, sf_dir):
    """Two appends into one folder, each stamped with its load time."""
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus")
    path = scratch_path(spark, "orders-appended")
    I.append_stamped(o.where(F.col("o_orderstatus") == "F").withColumn("batch", F.lit(1)), path)
    I.append_stamped(o.where(F.col("o_orderstatus") == "O").withColumn("batch", F.lit(2)), path)
    back = spark.read.parquet(path)
    return back.select("o_orderkey", "batch", F.col("_inserted_timestamp").isNotNull().alias("stamped"))
