"""Star-schema and group-job queries (O9, O16, O30, O35, O121, O123, O128, O129)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import dims as D
from ..operators import groups as G
from . import register
from .common import T, transfers

_DIM_CUSTOMER_SQL = """
SELECT md5(COALESCE(CAST(c_custkey AS VARCHAR), '')) AS dim_customer_id, c_custkey, c_name, c_mktsegment
FROM customer
UNION ALL SELECT '-1', -1, 'unknown', NULL
UNION ALL SELECT '-2', -2, 'not applicable', NULL
"""


def dim_customer(spark, t, where=None):
    c = t.customer.select("c_custkey", "c_name", "c_mktsegment")
    if where is not None:
        c = c.where(where)
    d = D.with_key(c, "dim_customer_id", "c_custkey").select("dim_customer_id", "c_custkey", "c_name",
                                                             "c_mktsegment")
    return D.with_sentinels(spark, d, "dim_customer_id",
                            {D.UNKNOWN_KEY: {"c_custkey": -1, "c_name": "unknown"},
                             D.NOT_APPLICABLE_KEY: {"c_custkey": -2, "c_name": "not applicable"}})


@register("dim_sentinels", _DIM_CUSTOMER_SQL)
def dim_sentinels(spark, sf_dir):
    return dim_customer(spark, T(spark, sf_dir))


@register("dim_inferred_members", """
WITH known AS (SELECT p_partkey AS asset_id, p_name AS asset_name FROM part WHERE p_size <= 45),
dim AS (SELECT md5(COALESCE(CAST(asset_id AS VARCHAR), '')) AS dim_asset_id, asset_id, asset_name,
               false AS inferred FROM known),
inf AS (SELECT DISTINCT l_partkey AS asset_id FROM lineitem
        WHERE l_partkey NOT IN (SELECT asset_id FROM known))
SELECT * FROM dim
UNION ALL SELECT md5(COALESCE(CAST(asset_id AS VARCHAR), '')), asset_id, NULL, true FROM inf
UNION ALL SELECT '-1', -1, 'unknown', false
UNION ALL SELECT '-2', -2, 'not applicable', false
""")
def dim_inferred_members(spark, sf_dir):
    """Asset dimension from the known catalogue, plus members inferred from facts that
    reference assets the catalogue lacks, plus the two sentinels."""
    t = T(spark, sf_dir)
    known = t.part.where(F.col("p_size") <= 45).select(F.col("p_partkey").alias("asset_id"),
                                                        F.col("p_name").alias("asset_name"))
    dim = D.with_key(known, "dim_asset_id", "asset_id").select("dim_asset_id", "asset_id", "asset_name")
    seen = t.lineitem.select(F.col("l_partkey").alias("asset_id"))
    full = D.inferred_members(dim, seen, "asset_id", "dim_asset_id")
    return D.with_sentinels(spark, full.select("dim_asset_id", "asset_id", "asset_name", "inferred"),
                            "dim_asset_id",
                            {D.UNKNOWN_KEY: {"asset_id": -1, "asset_name": "unknown", "inferred": False},
                             D.NOT_APPLICABLE_KEY: {"asset_id": -2, "asset_name": "not applicable",
                                                    "inferred": False}})


_FACT_SQL = """
WITH dim AS (SELECT md5(COALESCE(CAST(c_custkey AS VARCHAR), '')) AS k, c_custkey FROM customer
             WHERE c_acctbal >= 0),
f AS (SELECT o_orderkey, o_orderdate, o_custkey,
             CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS closer FROM orders)
SELECT f.o_orderkey,
       CASE WHEN f.o_custkey IS NULL THEN '-2' ELSE COALESCE(a.k, '-1') END AS dim_customer_id,
       CASE WHEN f.closer IS NULL THEN '-2' ELSE COALESCE(b.k, '-1') END AS dim_closer_id
FROM f LEFT JOIN dim a ON f.o_custkey = a.c_custkey LEFT JOIN dim b ON f.closer = b.c_custkey
"""


def fact_orders(spark, t, dim_where):
    dim = dim_customer(spark, t, dim_where)
    f = t.orders.select("o_orderkey", "o_orderdate", "o_custkey",
                        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey")).alias("closer"))
    f = D.lookup_key(f, dim, "o_custkey", "c_custkey", "dim_customer_id", "dim_customer_id")
    return D.lookup_key(f, dim, "closer", "c_custkey", "dim_customer_id", "dim_closer_id")


@register("fact_with_sentinels", _FACT_SQL)
def fact_with_sentinels(spark, sf_dir):
    """Fact keys resolved against a dimension that is missing some members (customers
    with a negative balance arrive late): unmatched -> '-1', role not present -> '-2'."""
    t = T(spark, sf_dir)
    return fact_orders(spark, t, F.col("c_acctbal") >= 0).select("o_orderkey", "dim_customer_id",
                                                                  "dim_closer_id")


# Fixed parameter: the cut that separates the stored fact run from the new run.
REPAIR_CUT = "2000-01-01"


@register("late_key_repair", f"""
WITH old AS ({_FACT_SQL}),
o AS (SELECT o_orderkey, o_orderdate, o_custkey FROM orders)
SELECT o.o_orderkey, md5(COALESCE(CAST(o.o_custkey AS VARCHAR), '')) AS dim_customer_id,
       o.o_orderdate >= TIMESTAMP '{REPAIR_CUT} 00:00:00' AS recent
FROM o
WHERE o.o_orderdate >= TIMESTAMP '{REPAIR_CUT} 00:00:00'
   OR o.o_orderkey IN (SELECT o_orderkey FROM old WHERE dim_customer_id = '-1')
""")
def late_key_repair(spark, sf_dir):
    """Rebuild rows that are recent OR whose stored key was unresolved ('-1').  The OR
    with an IN-subquery is planned as two disjoint parts: a pushed-down range filter,
    and a left-semi join of the older rows against the unresolved keys."""
    t = T(spark, sf_dir)
    stored = fact_orders(spark, t, F.col("c_acctbal") >= 0)            # previous run
    unresolved = stored.where(F.col("dim_customer_id") == D.UNKNOWN_KEY).select("o_orderkey")
    cut = F.lit(f"{REPAIR_CUT} 00:00:00").cast("timestamp_ntz")
    o = t.orders.select("o_orderkey", "o_orderdate", "o_custkey")
    redo = o.where(F.col("o_orderdate") >= cut).unionByName(
        o.where(F.col("o_orderdate") < cut).join(unresolved, "o_orderkey", "left_semi"))
    dim = dim_customer(spark, t)                                         # current dimension
    fixed = D.lookup_key(redo, dim, "o_custkey", "c_custkey", "dim_customer_id", "dim_customer_id")
    return fixed.select("o_orderkey", "dim_customer_id", (F.col("o_orderdate") >= cut).alias("recent"))


# Tier rules by product group and item number (first match wins).
TIER_RULES = [
    (("PROMO", "LARGE"), 5, "legendary"),
    (("PROMO", "LARGE"), 20, "epic"),
    (("PROMO", "LARGE"), 50, "rare"),
    (("STANDARD", "ECONOMY", "MEDIUM", "SMALL"), 10, "rare"),
]


@register("tier_classify", """
SELECT p_partkey, p_type, p_size,
       CASE WHEN p_type IN ('PROMO', 'LARGE') AND p_size <= 5 THEN 'legendary'
            WHEN p_type IN ('PROMO', 'LARGE') AND p_size <= 20 THEN 'epic'
            WHEN p_type IN ('PROMO', 'LARGE') AND p_size <= 50 THEN 'rare'
            WHEN p_type IN ('STANDARD', 'ECONOMY', 'MEDIUM', 'SMALL') AND p_size <= 10 THEN 'rare'
            ELSE 'common' END AS tier
FROM part
""")
def tier_classify(spark, sf_dir):
    p = T(spark, sf_dir).part.select("p_partkey", "p_type", "p_size")
    return p.withColumn("tier", D.tier_case(F.col("p_type"), F.col("p_size"), TIER_RULES, "common"))


@register("direction_tag", """
WITH transfers AS (
  SELECT l.l_orderkey AS tx_id, CAST(l.l_linenumber AS BIGINT) AS intra,
         'c' || CAST(o.o_custkey AS VARCHAR) AS sender, 's' || CAST(l.l_suppkey AS VARCHAR) AS receiver
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
cust AS (SELECT 's' || CAST(s_suppkey AS VARCHAR) AS a FROM supplier WHERE s_nationkey = 0
         UNION SELECT 'c' || CAST(c_custkey AS VARCHAR) FROM customer WHERE c_nationkey = 0)
SELECT t.tx_id, t.intra, t.sender, t.receiver,
       CASE WHEN r.a IS NOT NULL THEN 'inbound' ELSE 'outbound' END AS direction,
       COALESCE(r.a, s.a) AS bridge_address
FROM transfers t LEFT JOIN cust r ON t.receiver = r.a LEFT JOIN cust s ON t.sender = s.a
WHERE r.a IS NOT NULL OR s.a IS NOT NULL
""")
def direction_tag(spark, sf_dir):
    """Custodian list (addresses of nation 0) -> inbound / outbound transfers."""
    t = T(spark, sf_dir)
    cust = t.supplier.where(F.col("s_nationkey") == 0).select(
        F.concat(F.lit("s"), F.col("s_suppkey").cast("string")).alias("address")).unionByName(
        t.customer.where(F.col("c_nationkey") == 0).select(
            F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("address")))
    tr = transfers(t).select("tx_id", "intra", "sender", "receiver")
    return G.direction_tag(tr, cust).select("tx_id", "intra", "sender", "receiver", "direction",
                                            "bridge_address")


@register("group_pattern_match", """
SELECT a.conv_id, a.turn, CAST(length(p.text) AS BIGINT) AS prev_chars, n.role AS next_role
FROM conversations a
JOIN conversations p ON p.conv_id = a.conv_id AND p.turn = a.turn - 1
JOIN conversations n ON n.conv_id = a.conv_id AND n.turn = a.turn + 1
WHERE a.role = 'assistant' AND p.role = 'user'
""")
def group_pattern_match(spark, sf_dir):
    """Call leg (assistant turn) whose previous leg is a user turn and which has a next leg."""
    c = T(spark, sf_dir).conversations.select("conv_id", "turn", "role",
                                              F.length("text").cast("long").alias("chars"))
    m = G.pattern_match(c, "conv_id", "turn", F.col("role") == "assistant",
                        F.col("prev_role") == "user", F.col("next_role").isNotNull(), ["role", "chars"])
    return m.select("conv_id", "turn", F.col("prev_chars"), "next_role")


_GROUP_LEGS_SQL = """
legs AS (
  SELECT l_orderkey AS tx, CAST(l_linenumber AS BIGINT) AS pos,
         CASE l_returnflag WHEN 'A' THEN 'pay' WHEN 'N' THEN 'axfer' ELSE 'appl' END AS kind,
         CASE WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN 's' || CAST(l_suppkey AS VARCHAR)
              ELSE 'c' || CAST(o_custkey AS VARCHAR) END AS sender,
         'c' || CAST(o_custkey AS VARCHAR) AS receiver, l_partkey AS asset,
         CASE WHEN l_returnflag = 'A' THEN round(l_extendedprice) ELSE l_quantity END AS amount,
         l_partkey AS out_asset, l_quantity AS out_amount, 's' || CAST(l_suppkey AS VARCHAR) AS pool
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
assets AS (SELECT p_partkey AS asset, p_partkey % 4 AS decimals FROM part)"""


def _group_legs(t):
    """Orders as transaction groups: returned lines call a program, accepted ones pay, the rest
    move an asset (from the supplier or between the customer's own accounts)."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_suppkey", "l_partkey",
                           "l_extendedprice", "l_quantity")
    o = t.orders.select("o_orderkey", "o_custkey")
    buyer = F.concat(F.lit("c"), F.col("o_custkey").cast("string"))
    shop = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    kind = F.when(F.col("l_returnflag") == "A", "pay").when(F.col("l_returnflag") == "N", "axfer").otherwise("appl")
    legs = li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("group"), F.col("l_linenumber").cast("long").alias("pos"), kind.alias("kind"),
        F.when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), shop).otherwise(buyer).alias("sender"),
        buyer.alias("receiver"), F.col("l_partkey").alias("asset"),
        F.when(F.col("l_returnflag") == "A", F.round("l_extendedprice")).otherwise(F.col("l_quantity")).alias("amount"),
        F.col("l_partkey").alias("out_asset"), F.col("l_quantity").alias("out_amount"), shop.alias("pool"))
    assets = t.part.select(F.col("p_partkey").alias("asset"), (F.col("p_partkey") % 4).alias("decimals"))
    return legs, assets


_SCALED = "CASE WHEN {d} > 0 THEN {a} / pow(10, {d}) ELSE CAST({a} AS DOUBLE) END"


@register("group_swap_rows", f"""
WITH {_GROUP_LEGS_SQL},
sent AS (
  SELECT tx, pos, sender, CAST(0 AS BIGINT) AS from_asset, amount / 1e6 AS from_amount FROM legs WHERE kind = 'pay'
  UNION
  SELECT l.tx, l.pos, l.sender, l.asset, {_SCALED.format(a='l.amount', d='a.decimals')}
  FROM legs l JOIN assets a ON l.asset = a.asset WHERE l.kind = 'axfer'),
calls AS (
  SELECT l.tx, l.pos, l.sender, l.pool, l.out_asset AS to_asset, {_SCALED.format(a='l.out_amount', d='a.decimals')} AS to_amount
  FROM legs l JOIN assets a ON l.out_asset = a.asset WHERE l.kind = 'appl')
SELECT c.tx, c.pos, s.sender AS swapper, CAST(s.from_asset AS DOUBLE) AS from_asset,
       floor(COALESCE(s.from_amount, 0) * 1000000 + 0.5) / 1000000 AS from_amount, c.pool, c.to_asset,
       floor(COALESCE(c.to_amount, 0) * 1000000 + 0.5) / 1000000 AS to_amount
FROM calls c LEFT JOIN sent s ON c.tx = s.tx AND c.pos - 1 = s.pos AND c.sender = s.sender
""")
def group_swap_rows(spark, sf_dir):
    """From group legs to swap rows: both amounts in their assets' units (M27)."""
    legs, assets = _group_legs(T(spark, sf_dir))
    out = G.swap_rows(legs, assets, F.lit(True))
    return out.select(F.col("group").alias("tx"), "pos", "swapper", F.col("from_asset").cast("double").alias("from_asset"),
                      S.round_half_up("from_amount", 6).alias("from_amount"), "pool", "to_asset",
                      S.round_half_up("to_amount", 6).alias("to_amount"))


@register("group_sale_rows", f"""
WITH {_GROUP_LEGS_SQL},
atomic AS (
  SELECT tx, count(*) AS n, sum(CASE WHEN kind = 'pay' THEN 1 ELSE 0 END) AS pays,
         count(DISTINCT CASE WHEN kind = 'axfer' AND amount > 0 THEN sender END) AS sellers
  FROM legs GROUP BY 1 HAVING n >= 2 AND pays = 1 AND sellers = 1)
SELECT x.tx, x.pos, x.receiver AS purchaser, x.asset,
       floor(({_SCALED.format(a='x.amount', d='a.decimals')}) * 1000000 + 0.5) / 1000000 AS n_items,
       floor(p.amount / 1e6 / t.sellers * 1000000 + 0.5) / 1000000 AS total_sales_amount
FROM atomic t
JOIN legs x ON t.tx = x.tx AND x.kind = 'axfer'
JOIN legs p ON t.tx = p.tx AND p.kind = 'pay' AND x.receiver = p.sender
LEFT JOIN assets a ON x.asset = a.asset
LEFT JOIN (SELECT DISTINCT tx FROM legs WHERE kind = 'appl') e ON t.tx = e.tx
WHERE x.amount BETWEEN 0 AND 450 AND p.amount > 0 AND e.tx IS NULL
""")
def group_sale_rows(spark, sf_dir):
    """From group legs to sale rows: buyer, items and what was paid (M37)."""
    legs, assets = _group_legs(T(spark, sf_dir))
    out = G.sale_rows(legs, assets)
    return out.select(F.col("group").alias("tx"), "pos", "purchaser", "asset", S.round_half_up("n_items", 6).alias("n_items"),
                      S.round_half_up("total_sales_amount", 6).alias("total_sales_amount"))
