"""Window, sort and top-k queries (O63-O69, O72, O73, O75-O77, O79, O146, O148)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R
from ..operators import windows as W
from . import register
from .common import T


@register("win_latest_per_key", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def win_latest_per_key(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return R.latest_per_key(o, ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@register("win_renumber", """
SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity,
       l_orderkey + row_number() OVER (
         PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity,
                                           l_extendedprice, l_discount, l_tax, l_returnflag,
                                           l_linestatus, l_shipdate) AS intra
FROM lineitem
""")
def win_renumber(spark, sf_dir):
    """``base + ROW_NUMBER() OVER (PARTITION BY tx ORDER BY path)`` with a total order over
    every column, so duplicate (order, line) pairs get stable, distinct positions.  The row's
    own base is added to, as the group keeps it apart: (group, position) is the key."""
    li = T(spark, sf_dir).lineitem
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
             "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
    w = Window.partitionBy("l_orderkey").orderBy(*order)
    return li.select("l_orderkey", "l_partkey", "l_suppkey",
                     F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity",
                     (F.col("l_orderkey") + F.row_number().over(w)).alias("intra"))


@register("win_first_last_leg", """
WITH r AS (SELECT conv_id, turn, role,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn_asc,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) AS rn_desc FROM conversations)
SELECT conv_id, max(CASE WHEN rn_asc = 1 THEN role END) AS first_role,
       max(CASE WHEN rn_desc = 1 THEN role END) AS last_role, count(*) AS n_turns
FROM r GROUP BY 1
""")
def win_first_last_leg(spark, sf_dir):
    """First and last leg of each group pivoted into one row.  The two-way ranking
    (ROW_NUMBER asc / desc, then pick rank 1) is the same as ``min_by`` / ``max_by`` on the
    (unique) position, which aggregates partially before the shuffle instead of sorting
    each group in one window task."""
    c = T(spark, sf_dir).conversations.select("conv_id", "turn", "role")
    return c.groupBy("conv_id").agg(F.min_by("role", "turn").alias("first_role"),
                                    F.max_by("role", "turn").alias("last_role"),
                                    F.count(F.lit(1)).alias("n_turns"))


@register("drop_open_bucket", """
WITH h AS (SELECT date_trunc('hour', ts) AS hour, count(*) AS n, round(sum(value), 2) AS v
           FROM events GROUP BY 1)
SELECT hour, n, v FROM h WHERE hour < (SELECT max(hour) FROM h)
""")
def drop_open_bucket(spark, sf_dir):
    """The newest hour is still filling: drop it with ``hour < max(hour)`` (a scalar
    subquery) instead of a global RANK() window, which would run in one task."""
    e = T(spark, sf_dir).events.select("ts", "value")
    h = e.groupBy(S.trunc_ts("hour", "ts").alias("hour")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("v"))
    return h.where(F.col("hour") < h.select(F.max("hour")).scalar())


@register("tumbling_hour", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n
FROM events GROUP BY 1, 2, 3
""")
def tumbling_hour(spark, sf_dir):
    e = T(spark, sf_dir).events.select("ts", "event_type")
    g = e.groupBy(F.window("ts", "1 hour"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                    "event_type", "n")


_FILL_SQL = """
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events
           GROUP BY 1, 2),
b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h),
grid AS (SELECT t.event_type, unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS hour
         FROM (SELECT DISTINCT event_type FROM h) t, b),
f AS (SELECT g.event_type, g.hour, h.v IS NULL AS imputed,
             LAST_VALUE(h.v IGNORE NULLS) OVER (PARTITION BY g.event_type ORDER BY g.hour
                                                ROWS UNBOUNDED PRECEDING) AS v
      FROM grid g LEFT JOIN h ON g.event_type = h.event_type AND g.hour = h.hour)
SELECT event_type, hour, floor(v * 10000 + 0.5) / 10000 AS value, imputed FROM f WHERE v IS NOT NULL
"""


@register("win_forward_fill", _FILL_SQL)
def win_forward_fill(spark, sf_dir):
    """Dense hour grid per event type (global range), forward-filled; rows before a type's
    first value are dropped (qualify on the fill result)."""
    e = T(spark, sf_dir).events.select("event_type", "ts", "value")
    h = e.groupBy("event_type", S.trunc_ts("hour", "ts").alias("hour")).agg(F.avg("value").alias("v"))
    lo, hi = h.select(F.min("hour")).scalar(), h.select(F.max("hour")).scalar()
    grid = h.select("event_type").distinct().select(
        "event_type", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    j = grid.join(h, ["event_type", "hour"], "left").withColumn("imputed", F.col("v").isNull())
    f = W.fill_forward(j, ["event_type"], "hour", "v")
    return f.where(F.col("v").isNotNull()).select("event_type", "hour",
                                                  S.round_half_up("v", 4).alias("value"), "imputed")


@register("win_forward_fill_global", """
WITH h AS (SELECT date_trunc('hour', ts) AS hour, avg(CASE WHEN event_type = 'purchase' THEN value END) AS v
           FROM events GROUP BY 1),
cal AS (SELECT unnest(generate_series((SELECT min(date_trunc('hour', ts)) FROM events),
                                      (SELECT max(date_trunc('hour', ts)) FROM events),
                                      INTERVAL 1 HOUR)) AS hour),
f AS (SELECT c.hour, LAST_VALUE(h.v IGNORE NULLS) OVER (ORDER BY c.hour ROWS UNBOUNDED PRECEDING) AS v
      FROM cal c LEFT JOIN h ON c.hour = h.hour)
SELECT hour, floor(v * 10000 + 0.5) / 10000 AS value FROM f
""")
def win_forward_fill_global(spark, sf_dir):
    """Fill over the whole hour calendar with no partition key, chunked by day."""
    from ..sources import calendar
    ev = T(spark, sf_dir).events
    cal = calendar.hours_between(calendar.data_bounds(ev, "ts"))
    h = (ev.groupBy(S.trunc_ts("hour", "ts").alias("hour"))
           .agg(F.avg(F.when(F.col("event_type") == "purchase", F.col("value"))).alias("v")))
    j = cal.join(h, "hour", "left")
    f = W.forward_fill_global(j, "hour", "v", F.to_date("hour"))
    return f.select("hour", S.round_half_up("v", 4).alias("value"))


@register("win_share", """
WITH d AS (SELECT CAST(l_shipdate AS DATE) AS date, l_returnflag AS program, sum(l_quantity) AS volume
           FROM lineitem GROUP BY 1, 2)
SELECT date, program, volume, floor(volume / sum(volume) OVER (PARTITION BY date) * 1000000 + 0.5) / 1000000 AS share
FROM d
""")
def win_share(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    d = li.groupBy(F.to_date("l_shipdate").alias("date"), F.col("l_returnflag").alias("program")) \
          .agg(F.sum("l_quantity").alias("volume"))
    share = F.col("volume") / F.sum("volume").over(Window.partitionBy("date"))
    return d.select("date", "program", "volume", S.round_half_up(share, 6).alias("share"))


@register("win_even_split", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey,
       floor(o.o_totalprice / count(*) OVER (PARTITION BY l.l_orderkey) * 10000 + 0.5) / 10000 AS price_share
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def win_even_split(spark, sf_dir):
    """Group payment split evenly over the group's legs: ``total / COUNT(1) OVER (g)``."""
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice")
    j = li.join(o, "l_orderkey")
    share = F.col("o_totalprice") / F.count(F.lit(1)).over(Window.partitionBy("l_orderkey"))
    return j.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey",
                    S.round_half_up(share, 4).alias("price_share"))


@register("win_source_preference", """
WITH s AS (SELECT l_partkey AS asset_id, CAST(l_shipdate AS DATE) AS date, l_returnflag AS program,
                  avg(l_extendedprice / l_quantity) AS price,
                  CASE l_returnflag WHEN 'N' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS rnk
           FROM lineitem GROUP BY 1, 2, 3)
SELECT asset_id, date, floor(arg_min(price, rnk) * 10000 + 0.5) / 10000 AS price, arg_min(program, rnk) AS program
FROM s GROUP BY 1, 2
""")
def win_source_preference(spark, sf_dir):
    """Lowest-rank source per bucket: ``min_by(price, rank)`` (an aggregate, not a window)."""
    li = T(spark, sf_dir).lineitem
    s = li.groupBy(F.col("l_partkey").alias("asset_id"), F.to_date("l_shipdate").alias("date"),
                   F.col("l_returnflag").alias("program")) \
          .agg(F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price")) \
          .withColumn("rnk", F.when(F.col("program") == "N", 1).when(F.col("program") == "R", 2).otherwise(3))
    return s.groupBy("asset_id", "date").agg(
        S.round_half_up(F.min_by("price", "rnk"), 4).alias("price"), F.min_by("program", "rnk").alias("program"))


@register("sort_output", """
SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, round(sum(o_totalprice), 2) AS total
FROM orders GROUP BY 1, 2 ORDER BY o_custkey, date DESC
""")
def sort_output(spark, sf_dir):
    """Final ORDER BY key, date DESC (range-partitioned sort; only for presented output)."""
    o = T(spark, sf_dir).orders
    g = o.groupBy("o_custkey", F.to_date("o_orderdate").alias("date")).agg(
        F.round(F.sum("o_totalprice"), 2).alias("total"))
    return g.orderBy(F.col("o_custkey").asc(), F.col("date").desc())


@register("sort_null_order", """
WITH j AS (SELECT d.source, d.doc_id, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT source, doc_id, CAST(quality AS DOUBLE) AS quality FROM j
QUALIFY row_number() OVER (PARTITION BY source ORDER BY quality DESC NULLS FIRST, doc_id) = 1
""")
def sort_null_order(spark, sf_dir):
    """Reference dialect puts nulls first on DESC; Spark puts them last - say it."""
    t = T(spark, sf_dir)
    j = t.documents.select("source", "doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return R.latest_per_key(j, ["source"], [F.col("quality").desc_nulls_first(), F.col("doc_id").asc()]) \
            .select("source", "doc_id", F.col("quality").cast("double").alias("quality"))
