"""Source / ingest queries (O2-O10): JSON folders, path partitions, file metadata,
CSV seeds, calendars, work lists."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T_

from ..session import scratch_path
from ..sources import calendar, files
from . import register
from .common import T

EVENT_JSON_SCHEMA = T_.StructType([
    T_.StructField("event_id", T_.LongType()),
    T_.StructField("ts", T_.StringType()),
    T_.StructField("user_id", T_.LongType()),
    T_.StructField("event_type", T_.StringType()),
    T_.StructField("value", T_.DoubleType()),
    T_.StructField("data", T_.StructType([T_.StructField("k", T_.LongType())])),
])

_JSON_FOLDERS: dict[tuple[str, str], str] = {}


def event_json_folder(spark, sf_dir: str) -> str:
    """The events table landed as date-partitioned JSON files (written once per session)."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _JSON_FOLDERS:
        ev = T(spark, sf_dir).events
        payload = ev.select("event_id", "ts", "user_id", "event_type", "value",
                            F.from_json("props", "k BIGINT").alias("data"))
        _JSON_FOLDERS[key] = files.write_json_by_date(payload, scratch_path(spark, "events-json"), "ts")
    return _JSON_FOLDERS[key]


@register("scan_json_props", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, user_id,
       CAST(ts AS DATE) AS event_date
FROM events
""")
def scan_json_props(spark, sf_dir):
    raw = files.read_json_folder(spark, event_json_folder(spark, sf_dir), EVENT_JSON_SCHEMA)
    return raw.select("event_id", F.col("data.k").alias("k"), "user_id",
                      F.make_date("year", "month", "day").alias("event_date"))


@register("scan_path_partition", """
SELECT event_id, CAST(ts AS DATE) AS path_date FROM events
""")
def scan_path_partition(spark, sf_dir):
    raw = files.read_json_folder(spark, event_json_folder(spark, sf_dir), EVENT_JSON_SCHEMA)
    return raw.select("event_id", files.path_date().alias("path_date"))


@register("scan_file_metadata", """
SELECT event_id, CAST(ts AS DATE) AS file_date, true AS has_arrival_time FROM events
""")
def scan_file_metadata(spark, sf_dir):
    """Arrival time per record = its file's modification time; newest file wins."""
    raw = files.read_json_folder(spark, event_json_folder(spark, sf_dir), EVENT_JSON_SCHEMA)
    m = files.with_file_metadata(raw)
    newest = m.groupBy("event_id").agg(
        F.max_by("_file_path", F.struct("_file_modified", "_file_path")).alias("file_path"),
        F.max("_file_modified").alias("_inserted_timestamp"))
    part = [F.regexp_extract("file_path", f"/{n}=([0-9]+)/", 1).cast("int") for n in ("year", "month", "day")]
    return newest.select("event_id", F.make_date(*part).alias("file_date"),
                         F.col("_inserted_timestamp").isNotNull().alias("has_arrival_time"))


@register("scan_partition_pruned", """
SELECT event_id, CAST(day(ts) AS INTEGER) AS day FROM events
WHERE year(ts) = 2024 AND month(ts) = 1 AND day(ts) >= 15
""")
def scan_partition_pruned(spark, sf_dir):
    raw = files.read_json_folder(spark, event_json_folder(spark, sf_dir), EVENT_JSON_SCHEMA)
    # equality + watermark on partition columns -> PartitionFilters, whole folders skipped
    return raw.where((F.col("year") == 2024) & (F.col("month") == 1) & (F.col("day") >= 15)) \
              .select("event_id", "day")


SEED_SCHEMA = T_.StructType([
    T_.StructField("ID", T_.IntegerType()),
    T_.StructField("Name", T_.StringType()),
    T_.StructField("Region_ID", T_.IntegerType()),
])


@register("seed_names_join", """
SELECT c.c_custkey, c.c_name, n.n_name AS nation_name
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def seed_names_join(spark, sf_dir):
    """Names come from a header CSV seed (written from the nation table), read with a schema."""
    t = T(spark, sf_dir)
    path = files.write_csv_seed(
        t.nation.select(F.col("n_nationkey").alias("ID"), F.col("n_name").alias("Name"),
                        F.col("n_regionkey").alias("Region_ID")),
        scratch_path(spark, "seed-names"))
    seed = files.read_csv_seed(spark, path, SEED_SCHEMA)
    c = t.customer.select("c_custkey", "c_name", "c_nationkey")
    j = c.join(F.broadcast(seed), c.c_nationkey == seed.ID, "left")
    return j.select("c_custkey", "c_name", F.col("Name").alias("nation_name"))


@register("calendar_hours", """
SELECT unnest(generate_series(date_trunc('hour', min(ts)), date_trunc('hour', max(ts)),
                              INTERVAL 1 HOUR)) AS hour
FROM events
""")
def calendar_hours(spark, sf_dir):
    ev = T(spark, sf_dir).events
    return calendar.hours_between(calendar.data_bounds(ev, "ts"))


# Fixed parameter: as-of date standing in for CURRENT_DATE, so the calendar is repeatable.
AS_OF = "2001-12-31"


@register("calendar_days", f"""
WITH d AS (
  SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), DATE '{AS_OF}', INTERVAL 1 DAY))
              AS DATE) AS date
  FROM orders)
SELECT date, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month,
       CAST(dayofweek(date) AS BIGINT) AS day_of_week
FROM d
""")
def calendar_days(spark, sf_dir):
    o = T(spark, sf_dir).orders
    bounds = o.agg(F.min("o_orderdate").alias("lo"), F.lit(AS_OF).cast("date").alias("hi"))
    days = calendar.days_between(bounds)
    return days.select("date", F.year("date").cast("long").alias("year"),
                       F.month("date").cast("long").alias("month"),
                       (F.dayofweek("date") - 1).cast("long").alias("day_of_week"))


# Fixed parameter: keys fetched in one call.
WORK_BATCH = 100


@register("pending_work_list", f"""
SELECT o_orderkey AS tx_id, o_custkey AS account_id FROM orders
WHERE o_orderstatus = 'O'
  AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'O')
ORDER BY o_orderkey
LIMIT {WORK_BATCH}
""")
def pending_work_list(spark, sf_dir, batch=WORK_BATCH):
    """Keys wanted minus keys already fetched, one batch of them (the batch size is the
    feature: one fetch call's worth of work)."""
    t = T(spark, sf_dir)
    wanted = t.orders.where(F.col("o_orderstatus") == "O") \
                     .select(F.col("o_orderkey").alias("tx_id"), F.col("o_custkey").alias("account_id"))
    fetched = t.lineitem.where(F.col("l_linestatus") == "O").select(F.col("l_orderkey").alias("tx_id"))
    return wanted.join(fetched, "tx_id", "left_anti").orderBy("tx_id").limit(batch)
