"""Aggregation queries (O49-O53, O56-O60, O62, O122)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import groups as G
from ..operators import relational as R
from . import register
from .common import T


@register("agg_basic", """
SELECT l_returnflag, l_linestatus,
       sum(l_quantity) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_price,
       min(l_extendedprice) AS min_price, max(l_extendedprice) AS max_price,
       floor(avg(l_discount) * 1000000 + 0.5) / 1000000 AS avg_disc, count(*) AS count_order
FROM lineitem GROUP BY 1, 2
""")
def agg_basic(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.sum("l_quantity").alias("sum_qty"), F.round(F.sum("l_extendedprice"), 2).alias("sum_price"),
        F.min("l_extendedprice").alias("min_price"), F.max("l_extendedprice").alias("max_price"),
        S.round_half_up(F.avg("l_discount"), 6).alias("avg_disc"),
        F.count(F.lit(1)).alias("count_order"))


@register("agg_count_distinct", """
SELECT l_returnflag, count(DISTINCT l_orderkey) AS n_orders, count(DISTINCT l_partkey) AS n_parts,
       count(DISTINCT l_suppkey) AS n_suppliers
FROM lineitem GROUP BY 1
""")
def agg_count_distinct(spark, sf_dir):
    li = T(spark, sf_dir).lineitem.select("l_returnflag", "l_orderkey", "l_partkey", "l_suppkey")
    return R.count_distinct_many(li, ["l_returnflag"], ["l_orderkey", "l_partkey", "l_suppkey"],
                                 ["n_orders", "n_parts", "n_suppliers"])


@register("agg_conditional", """
SELECT l_partkey,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity END) AS returned_qty,
       sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS returned_qty_or_zero,
       floor(avg(CASE WHEN l_linestatus = 'F' THEN l_discount END) * 1000000 + 0.5) / 1000000 AS avg_final_disc,
       count(DISTINCT CASE WHEN l_returnflag = 'A' THEN l_orderkey END) AS accepted_orders
FROM lineitem GROUP BY 1
""")
def agg_conditional(spark, sf_dir):
    """SUM/AVG/COUNT(DISTINCT) of CASE expressions: null when nothing matches unless the
    CASE has ELSE 0.  The distinct count is its own two-phase aggregation joined on the
    group key (both sides are already partitioned by it), instead of an ``Expand`` that
    doubles every input row."""
    li = T(spark, sf_dir).lineitem
    r = F.col("l_returnflag") == "R"
    plain = li.groupBy("l_partkey").agg(
        F.sum(F.when(r, F.col("l_quantity"))).alias("returned_qty"),
        F.sum(F.when(r, F.col("l_quantity")).otherwise(F.lit(0.0))).alias("returned_qty_or_zero"),
        S.round_half_up(F.avg(F.when(F.col("l_linestatus") == "F", F.col("l_discount"))), 6)
         .alias("avg_final_disc"))
    accepted = li.select("l_partkey", F.when(F.col("l_returnflag") == "A", F.col("l_orderkey")).alias("acc"))
    distinct = R.count_distinct_many(accepted, ["l_partkey"], ["acc"], ["accepted_orders"])
    distinct = distinct.withColumnRenamed("l_partkey", "__k")
    return plain.join(distinct, plain["l_partkey"].eqNullSafe(distinct["__k"])).drop("__k")


@register("agg_having_shape", """
SELECT l_orderkey, count(*) AS n_legs, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_R,
       count(CASE WHEN l_returnflag = 'A' THEN 1 END) AS n_A
FROM lineitem GROUP BY 1
HAVING n_legs >= 2 AND n_R = 1 AND n_A = 0
""")
def agg_having_shape(spark, sf_dir):
    """Group shape classifier: at least two legs, exactly one 'R' leg, no 'A' leg."""
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_returnflag")
    return G.shape_filter(li, "l_orderkey", "l_returnflag", {"R": 1}, min_legs=2, absent=("A",))


@register("agg_distinct", """
SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem
""")
def agg_distinct(spark, sf_dir):
    return T(spark, sf_dir).lineitem.select("l_suppkey", "l_returnflag").distinct()


@register("agg_pivot_object", """
SELECT user_id,
       round(sum(CASE WHEN event_type = 'click' THEN value END), 2) AS click,
       round(sum(CASE WHEN event_type = 'view' THEN value END), 2) AS view,
       round(sum(CASE WHEN event_type = 'purchase' THEN value END), 2) AS purchase,
       round(sum(CASE WHEN event_type = 'signup' THEN value END), 2) AS signup,
       round(sum(CASE WHEN event_type = 'error' THEN value END), 2) AS error
FROM (SELECT user_id, event_type, round(value, 2) AS value FROM events) GROUP BY 1
""")
def agg_pivot_object(spark, sf_dir):
    """OBJECT_AGG(type, total) then ``obj:type`` per key = a pivot with a fixed key list
    (conditional aggregates; no map, so duplicate keys cannot fail)."""
    e = T(spark, sf_dir).events.select("user_id", "event_type", F.round("value", 2).alias("value"))
    kinds = ["click", "view", "purchase", "signup", "error"]
    out = e.groupBy("user_id").pivot("event_type", kinds).agg(F.round(F.sum("value"), 2))
    return out.select("user_id", *kinds)


@register("agg_listagg", """
SELECT l_orderkey, listagg(DISTINCT l_returnflag, '-' ORDER BY l_returnflag) AS flags
FROM lineitem GROUP BY 1
""")
def agg_listagg(spark, sf_dir):
    """``LISTAGG(DISTINCT x, '-') WITHIN GROUP (ORDER BY x)``.  Spark plans the DISTINCT
    form with an extra (key, value) shuffle; ``collect_set`` de-duplicates map-side in
    one exchange, and sorting the small set gives the same text (null if no values)."""
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_returnflag")
    vals = F.array_sort(F.collect_set("l_returnflag"))
    return li.groupBy("l_orderkey").agg(F.when(F.size(vals) > 0, F.array_join(vals, "-")).alias("flags"))


@register("agg_then_window", """
WITH g AS (SELECT l_partkey, l_returnflag, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY last_ship DESC, l_returnflag) AS rn FROM g)
SELECT l_partkey, l_returnflag, last_ship FROM r WHERE rn = 1
""")
def agg_then_window(spark, sf_dir):
    """ROW_NUMBER() OVER (... ORDER BY MAX(x) DESC) after GROUP BY: aggregate, then rank."""
    li = T(spark, sf_dir).lineitem.select("l_partkey", "l_returnflag", "l_shipdate")
    g = li.groupBy("l_partkey", "l_returnflag").agg(F.max("l_shipdate").alias("last_ship"))
    w = Window.partitionBy("l_partkey").orderBy(F.col("last_ship").desc(), F.col("l_returnflag"))
    return g.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")


@register("agg_group_expr", """
SELECT CAST(year(l_shipdate) AS BIGINT) AS ship_year,
       CASE WHEN l_quantity < 25 THEN 'small' ELSE 'large' END AS size_class,
       count(*) AS n, sum(l_quantity) AS qty
FROM lineitem GROUP BY 1, 2
""")
def agg_group_expr(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.groupBy(F.year("l_shipdate").cast("long").alias("ship_year"),
                      F.when(F.col("l_quantity") < 25, "small").otherwise("large").alias("size_class")) \
             .agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").alias("qty"))


@register("agg_ratio", """
SELECT l_orderkey,
       floor((sum(l_extendedprice) + sum(l_extendedprice * l_tax) / count(l_tax)) * 10000 + 0.5) / 10000
         AS price_plus_avg_tax
FROM lineitem GROUP BY 1
""")
def agg_ratio(spark, sf_dir):
    """SUM(x) + SUM(y) / COUNT(y): the division binds before the addition."""
    li = T(spark, sf_dir).lineitem
    g = li.groupBy("l_orderkey").agg(
        (F.sum("l_extendedprice") + F.sum(F.col("l_extendedprice") * F.col("l_tax")) / F.count("l_tax"))
        .alias("v"))
    return g.select("l_orderkey", S.round_half_up("v", 4).alias("price_plus_avg_tax"))


@register("agg_global_range", """
SELECT min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship, count(*) AS n_lines,
       min(l_orderkey) AS min_key, max(l_orderkey) AS max_key
FROM lineitem
""")
def agg_global_range(spark, sf_dir):
    """Whole-table MIN/MAX: partial aggregates per task, one tiny final merge."""
    li = T(spark, sf_dir).lineitem
    return li.agg(F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
                  F.count(F.lit(1)).alias("n_lines"), F.min("l_orderkey").alias("min_key"),
                  F.max("l_orderkey").alias("max_key"))
