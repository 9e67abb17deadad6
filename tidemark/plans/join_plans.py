"""Join queries (O32-O48).

Dimension sides that are bounded by definition (nation: 25 rows, region: 5) are
broadcast after a bounded count; everything that grows with the data is left to the
planner (AQE: sort-merge, or broadcast at runtime when the measured size is small).
No cross joins and no pair-emitting theta joins: ranges become ``explode(sequence)``,
"next later row of a kind" becomes a window over the (protocol-bounded) group, and OR
conditions become equi-joins.
"""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import pricing as P
from ..operators import relational as R
from . import register
from .common import T, transfers


@register("join_inner", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, p.p_name, l.l_quantity
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
""")
def join_inner(spark, sf_dir):
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    p = t.part.select("p_partkey", "p_name")
    return li.join(p, li.l_partkey == p.p_partkey, "inner") \
             .select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                     "p_name", "l_quantity")


@register("join_left", """
SELECT d.doc_id, d.lang, CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def join_left(spark, sf_dir):
    t = T(spark, sf_dir)
    # optional attributes are null when unmatched; carried as DOUBLE so a null renders the
    # same in every client (a nullable integer does not)
    lab = t.labels.select("doc_id", F.col("quality").cast("double").alias("quality"),
                          F.col("toxic").cast("double").alias("toxic"))
    return t.documents.select("doc_id", "lang").join(lab, "doc_id", "left")


@register("join_role_playing", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey,
       bn.n_name AS buyer_nation, sn.n_name AS seller_nation,
       br.r_name AS buyer_region, sr.r_name AS seller_region
FROM lineitem l
JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
LEFT JOIN nation bn ON c.c_nationkey = bn.n_nationkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey
LEFT JOIN region br ON bn.n_regionkey = br.r_regionkey
LEFT JOIN region sr ON sn.n_regionkey = sr.r_regionkey
""")
def join_role_playing(spark, sf_dir):
    """One dimension joined under several roles (buyer / seller x nation / region)."""
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    o = t.orders.select("o_orderkey", "o_custkey")
    c = t.customer.select("c_custkey", "c_nationkey")
    s = t.supplier.select("s_suppkey", "s_nationkey")
    n, r = t.nation, t.region
    geo = n.join(r, n.n_regionkey == r.r_regionkey, "left").select("n_nationkey", "n_name", "r_name")
    geo = F.broadcast(geo)  # 25 nations: fixed by the data model

    def role(prefix):
        return geo.select(F.col("n_nationkey").alias(f"{prefix}_nk"),
                          F.col("n_name").alias(f"{prefix}_nation"),
                          F.col("r_name").alias(f"{prefix}_region"))

    x = (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
           .join(c, F.col("o_custkey") == c.c_custkey, "left")
           .join(s, F.col("l_suppkey") == s.s_suppkey, "left"))
    b, sl = role("buyer"), role("seller")
    x = x.join(b, x.c_nationkey == b.buyer_nk, "left").join(sl, x.s_nationkey == sl.seller_nk, "left")
    return x.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey",
                    "buyer_nation", "seller_nation", "buyer_region", "seller_region")


@register("join_composite", """
WITH s AS (SELECT user_id, event_type, avg(value) AS avg_value FROM events GROUP BY 1, 2)
SELECT e.event_id, e.user_id, e.event_type, ROUND(e.value - s.avg_value, 6) AS vs_avg
FROM events e JOIN s ON e.user_id = s.user_id AND e.event_type = s.event_type
""")
def join_composite(spark, sf_dir):
    e = T(spark, sf_dir).events.select("event_id", "user_id", "event_type", "value")
    s = e.groupBy("user_id", "event_type").agg(F.avg("value").alias("avg_value"))
    j = e.join(s, ["user_id", "event_type"], "inner")
    return j.select("event_id", "user_id", "event_type",
                    F.round(F.col("value") - F.col("avg_value"), 6).alias("vs_avg"))


@register("join_neighbour", """
SELECT a.conv_id, a.turn, a.role, b.role AS prev_role, r.role AS plus2_role
FROM conversations a
LEFT JOIN conversations b ON a.conv_id = b.conv_id AND a.turn - 1 = b.turn
LEFT JOIN conversations r ON a.conv_id = r.conv_id AND a.turn + 2 = r.turn
""")
def join_neighbour(spark, sf_dir):
    c = T(spark, sf_dir).conversations.select("conv_id", "turn", "role")
    x = R.neighbour(c, "conv_id", "turn", -1, ["role"], "prev_")
    x = R.neighbour(x, "conv_id", "turn", 2, ["role"], "plus2_")
    return x.select("conv_id", "turn", "role", "prev_role", "plus2_role")


@register("join_theta_residual", """
SELECT a.conv_id, a.turn, CAST(min(b.turn) AS DOUBLE) AS reply_turn
FROM conversations a
LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn > a.turn AND b.role = 'assistant'
WHERE a.role = 'user'
GROUP BY a.conv_id, a.turn
""")
def join_theta_residual(spark, sf_dir):
    """First later 'assistant' leg after each 'user' leg of the same group.

    Same answer as the equi + ``b.turn > a.turn`` join followed by MIN, but as a
    window over following rows, so no pairs are materialised.  Groups are bounded
    (a transaction group has at most 16 legs; conversations here 2-8 turns).
    """
    c = T(spark, sf_dir).conversations.select("conv_id", "turn", "role")
    w = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(1, Window.unboundedFollowing)
    x = c.withColumn("reply_turn", F.min(F.when(F.col("role") == "assistant", F.col("turn"))).over(w))
    return x.where(F.col("role") == "user").select("conv_id", "turn",
                                                   F.col("reply_turn").cast("double").alias("reply_turn"))


@register("join_disjunctive", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey, l.l_suppkey, o.tx_key, o.side
FROM lineitem l
JOIN (SELECT o_orderkey AS l_orderkey, o_custkey % 50 AS tx_key, CASE WHEN o_orderstatus = 'F' THEN 'in' ELSE 'out' END AS side
      FROM orders) o
  ON l.l_orderkey = o.l_orderkey
 AND ((l.l_suppkey % 50 = o.tx_key AND o.side = 'in') OR (l.l_partkey % 50 = o.tx_key AND l.l_returnflag <> 'N'))
""")
def join_disjunctive(spark, sf_dir):
    """Each alternative has its own condition, and both sides name the group key alike."""
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag",
                           (F.col("l_suppkey") % 50).alias("s_key"), (F.col("l_partkey") % 50).alias("p_key"))
    o = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), (F.col("o_custkey") % 50).alias("tx_key"),
                        F.when(F.col("o_orderstatus") == "F", "in").otherwise("out").alias("side"))
    j = R.or_join(li, o, [("l_orderkey", "l_orderkey")], [
        ("s_key", "tx_key", lambda l, r: r("side") == "in"), ("p_key", "tx_key", lambda l, r: l("l_returnflag") != "N")])
    return j.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey", "l_suppkey",
                    "tx_key", "side")


@register("join_range_spine", """
WITH m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month,
                  count(*) AS n, sum(o_totalprice) AS total
           FROM orders GROUP BY 1, 2),
r AS (SELECT o_custkey, min(month) AS lo, max(month) AS hi FROM m GROUP BY 1),
spine AS (SELECT o_custkey, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS month
          FROM r)
SELECT s.o_custkey, s.month, CAST(COALESCE(m.n, 0) AS BIGINT) AS n_orders,
       ROUND(COALESCE(m.total, 0), 2) AS total
FROM spine s LEFT JOIN m ON s.o_custkey = m.o_custkey AND s.month = m.month
""")
def join_range_spine(spark, sf_dir):
    """``month BETWEEN lo AND hi`` per customer: each customer expands its own range
    (``explode(sequence)``) instead of a nested-loop join against a calendar."""
    o = T(spark, sf_dir).orders.select("o_custkey", "o_orderdate", "o_totalprice")
    m = o.groupBy("o_custkey", F.trunc("o_orderdate", "month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
    r = m.groupBy("o_custkey").agg(F.min("month").alias("lo"), F.max("month").alias("hi"))
    spine = r.select("o_custkey", F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("month"))
    j = spine.join(m, ["o_custkey", "month"], "left")
    return j.select("o_custkey", "month", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"),
                    F.round(F.coalesce("total", F.lit(0.0)), 2).alias("total"))


@register("grid_cross_join", """
WITH h AS (SELECT event_type, date_trunc('hour', ts) AS hour, count(*) AS n FROM events GROUP BY 1, 2),
b AS (SELECT min(hour) AS lo, max(hour) AS hi FROM h),
types AS (SELECT DISTINCT event_type FROM h),
grid AS (SELECT t.event_type, unnest(generate_series(b.lo, b.hi, INTERVAL 1 HOUR)) AS hour
         FROM types t, b)
SELECT g.event_type, g.hour, CAST(COALESCE(h.n, 0) AS BIGINT) AS n_events
FROM grid g LEFT JOIN h ON g.event_type = h.event_type AND g.hour = h.hour
""")
def grid_cross_join(spark, sf_dir):
    """Densify hours x tokens.  The global hour range enters as two scalar subqueries, so
    each token row expands itself: no cross join, no nested loop."""
    e = T(spark, sf_dir).events.select("event_type", "ts")
    h = e.groupBy("event_type", S.trunc_ts("hour", "ts").alias("hour")).agg(F.count(F.lit(1)).alias("n"))
    lo = h.select(F.min("hour")).scalar()
    hi = h.select(F.max("hour")).scalar()
    grid = h.select("event_type").distinct().select(
        "event_type", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 HOUR"))).alias("hour"))
    j = grid.join(h, ["event_type", "hour"], "left")
    return j.select("event_type", "hour", F.coalesce("n", F.lit(0)).cast("long").alias("n_events"))


@register("join_anti", """
SELECT c.c_custkey, c.c_name FROM customer c
LEFT JOIN (SELECT o_custkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-01 00:00:00') r
  ON c.c_custkey = r.o_custkey
WHERE r.o_custkey IS NULL
""")
def join_anti(spark, sf_dir):
    t = T(spark, sf_dir)
    recent = t.orders.where(F.col("o_orderdate") >= F.lit("2001-01-01 00:00:00").cast("timestamp_ntz")) \
                     .select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(recent, "c_custkey", "left_anti")


@register("join_semi", """
SELECT l.l_orderkey, CAST(l.l_linenumber AS BIGINT) AS l_linenumber, l.l_partkey FROM lineitem l
JOIN (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') g
  ON l.l_orderkey = g.o_orderkey
""")
def join_semi(spark, sf_dir):
    t = T(spark, sf_dir)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select(F.col("o_orderkey").alias("l_orderkey"))
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey")
    return li.join(urgent, "l_orderkey", "left_semi") \
             .select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey")


@register("lateral_explode_join", """
SELECT e.vec_id, e.label, CAST(f.idx - 1 AS BIGINT) AS idx, CAST(f.v AS DOUBLE) AS value
FROM embeddings e, (SELECT vec_id, unnest(embedding) AS v,
                           unnest(generate_series(1, len(embedding))) AS idx FROM embeddings) f
WHERE e.vec_id = f.vec_id AND f.v > 0.2
""")
def lateral_explode_join(spark, sf_dir):
    """``FROM e, TABLE(FLATTEN(e.embedding)) f WHERE ...``: a lateral join of each row with
    the table function over its own array (no shuffle; the generator runs in the scan task)."""
    e = T(spark, sf_dir).embeddings.select("vec_id", "label", "embedding")
    f = e.lateralJoin(spark.tvf.posexplode(F.col("embedding").outer()))
    return f.where(F.col("col") > 0.2).select("vec_id", "label", F.col("pos").cast("long").alias("idx"),
                                              F.col("col").cast("double").alias("value"))


@register("join_prev_day", """
WITH d AS (SELECT l_partkey AS asset_id, CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS qty
           FROM lineitem GROUP BY 1, 2)
SELECT a.asset_id, a.date, a.qty, b.qty AS prev_qty
FROM d a LEFT JOIN d b ON a.asset_id = b.asset_id AND a.date - 1 = b.date
""")
def join_prev_day(spark, sf_dir):
    li = T(spark, sf_dir).lineitem.select("l_partkey", "l_shipdate", "l_quantity")
    d = li.groupBy(F.col("l_partkey").alias("asset_id"), F.to_date("l_shipdate").alias("date")) \
          .agg(F.sum("l_quantity").alias("qty"))
    prev = d.select("asset_id", F.date_add("date", 1).alias("date"), F.col("qty").alias("prev_qty"))
    return d.join(prev, ["asset_id", "date"], "left").select("asset_id", "date", "qty", "prev_qty")


@register("join_on_date", """
SELECT o.o_orderkey, l.l_orderkey AS shipped_order, CAST(l.l_linenumber AS BIGINT) AS l_linenumber,
       CAST(o.o_orderdate AS DATE) AS block_date
FROM orders o JOIN lineitem l
  ON CAST(l.l_shipdate AS DATE) = CAST(o.o_orderdate AS DATE) AND o.o_custkey = l.l_suppkey
""")
def join_on_date(spark, sf_dir):
    t = T(spark, sf_dir)
    o = t.orders.select("o_orderkey", "o_custkey", F.to_date("o_orderdate").alias("block_date"))
    li = t.lineitem.select(F.col("l_orderkey").alias("shipped_order"), "l_linenumber", "l_suppkey",
                           F.to_date("l_shipdate").alias("ship_date"))
    j = o.join(li, (o.block_date == li.ship_date) & (o.o_custkey == li.l_suppkey), "inner")
    return j.select("o_orderkey", "shipped_order", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                    "block_date")


# Fixed parameter: the hour to which both providers' prices are carried.
PRICE_HOUR = "2024-01-31 23:00:00"


def _imputed_sql(name: str, odd: int) -> str:
    return f"""
{name}_own AS (SELECT event_type AS asset_id, date_trunc('hour', ts) AS hour, avg(value) AS price FROM events
               WHERE user_id % 2 = {odd} GROUP BY 1, 2),
{name} AS (
  SELECT g.asset_id, g.hour, p.price IS NULL AS imputed,
         LAST_VALUE(p.price IGNORE NULLS) OVER (PARTITION BY g.asset_id ORDER BY g.hour ROWS UNBOUNDED PRECEDING) AS price
  FROM grid g LEFT JOIN {name}_own p ON g.asset_id = p.asset_id AND g.hour = p.hour)"""


@register("join_preference", f"""
WITH grid AS (
  SELECT e.event_type AS asset_id, h.hour FROM (SELECT DISTINCT event_type FROM events) e
  CROSS JOIN (SELECT unnest(generate_series((SELECT date_trunc('hour', min(ts)) FROM events), TIMESTAMP '{PRICE_HOUR}',
                                            INTERVAL 1 HOUR)) AS hour) h),
{_imputed_sql('cg', 0)}, {_imputed_sql('cmc', 1)},
j AS (SELECT g.asset_id, g.hour, a.price AS ap, CASE WHEN a.price IS NOT NULL THEN a.imputed END AS ai,
             b.price AS bp, CASE WHEN b.price IS NOT NULL THEN b.imputed END AS bi
      FROM grid g LEFT JOIN cg a ON g.asset_id = a.asset_id AND g.hour = a.hour
                  LEFT JOIN cmc b ON g.asset_id = b.asset_id AND g.hour = b.hour)
SELECT asset_id, hour,
       floor(CASE WHEN ai = FALSE THEN ap WHEN bi = FALSE THEN bp WHEN ai = TRUE THEN ap WHEN bi = TRUE THEN bp END * 10000 + 0.5) / 10000
         AS price,
       CASE WHEN ai = FALSE THEN ai WHEN bi = FALSE THEN bi WHEN ai = TRUE THEN ai WHEN bi = TRUE THEN bi END AS is_imputed
FROM j WHERE COALESCE(ai, bi) IS NOT NULL
""")
def join_preference(spark, sf_dir):
    """Two providers' hourly prices, each carried over its gaps: observed before imputed, the
    first provider before the second."""
    e = T(spark, sf_dir).events.select("event_type", "ts", "user_id", "value")

    def provider(odd: int):
        own = e.where(F.col("user_id") % 2 == odd).groupBy(
            F.col("event_type").alias("asset_id"), S.trunc_ts("hour", "ts").alias("hour")).agg(F.avg("value").alias("price"))
        return P.impute_on_grid(own, ["asset_id"], "hour", "price", F.lit(PRICE_HOUR).cast("timestamp_ntz"), "1 HOUR")

    out = P.prefer_observed(provider(0), provider(1), ["asset_id", "hour"], "price")
    return out.select("asset_id", "hour", S.round_half_up("price", 4).alias("price"), "is_imputed")


@register("two_pass_match", """
WITH lines AS (SELECT l_orderkey, l_linenumber, l_suppkey FROM lineitem),
shape AS (SELECT l_orderkey FROM lines GROUP BY 1 HAVING count(*) = 2),
pass1 AS (SELECT l.* FROM lines l WHERE l.l_orderkey IN (SELECT l_orderkey FROM shape)),
pools AS (SELECT DISTINCT l_suppkey FROM pass1),
pass2 AS (SELECT l.* FROM lines l
          WHERE l.l_orderkey NOT IN (SELECT l_orderkey FROM shape)
            AND l.l_suppkey IN (SELECT l_suppkey FROM pools))
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_suppkey, 'pass1' AS pass FROM pass1
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), l_suppkey, 'pass2' FROM pass2
""")
def two_pass_match(spark, sf_dir):
    """Pass 1: groups of exactly two legs teach the pool addresses.  Pass 2: legs of the
    remaining groups that touch a learned pool."""
    from ..operators import groups as G
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber", "l_suppkey")
    out = G.two_pass_match(li, group="l_orderkey", learn_col="l_suppkey", legs_in_shape=2)
    return out.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                      "l_suppkey", "pass")
