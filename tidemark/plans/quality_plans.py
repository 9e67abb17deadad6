"""Data-quality queries (O131-O142): failing rows, and a severity report."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from . import register
from .common import T
from .dim_plans import fact_orders


@register("dq_sequence_gaps", """
WITH s AS (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS prev_l_orderkey FROM lineitem)
SELECT prev_l_orderkey, l_orderkey, l_orderkey - prev_l_orderkey - 1 AS gap FROM s
WHERE l_orderkey - prev_l_orderkey <> 1
""")
def dq_sequence_gaps(spark, sf_dir):
    """Sequence gaps over the whole table (no partition key): repeated numbers and holes."""
    return Q.sequence_gaps(T(spark, sf_dir).lineitem.select("l_orderkey"), [], "l_orderkey")


@register("dq_sequence_distinct_gaps", """
WITH d AS (SELECT DISTINCT l_orderkey FROM lineitem),
s AS (SELECT l_orderkey, lag(l_orderkey) OVER (ORDER BY l_orderkey) AS prev_l_orderkey FROM d)
SELECT prev_l_orderkey, l_orderkey, l_orderkey - prev_l_orderkey - 1 AS gap FROM s
WHERE l_orderkey - prev_l_orderkey <> 1
""")
def dq_sequence_distinct_gaps(spark, sf_dir):
    return Q.sequence_distinct_gaps(T(spark, sf_dir).lineitem.select("l_orderkey"), "l_orderkey")


@register("dq_sequence_gaps_buffered", """
WITH s AS (SELECT o_custkey, o_orderkey,
                  lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev_o_orderkey,
                  lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS prev_o_orderdate
           FROM orders)
SELECT o_custkey, prev_o_orderkey, o_orderkey, o_orderkey - prev_o_orderkey - 1 AS gap FROM s
WHERE o_orderkey - prev_o_orderkey <> 1
  AND prev_o_orderdate < (SELECT max(o_orderdate) FROM orders) - INTERVAL 400 DAY
""")
def dq_sequence_gaps_buffered(spark, sf_dir):
    """Per-customer order-key gaps, ignoring rows whose previous row is newer than
    MAX(date) - 400 days (those may still be filling in)."""
    o = T(spark, sf_dir).orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return Q.sequence_gaps_buffered(o, ["o_custkey"], "o_orderkey", "o_orderdate", "400 DAYS")


# Fixed parameter: a span of days excused from the date-gap check.
EXCLUDED_SPANS = [("1998-01-01", "1998-03-31")]


@register("dq_date_gaps", """
WITH d AS (SELECT DISTINCT l_suppkey, CAST(l_shipdate AS DATE) AS ship_date FROM lineitem),
s AS (SELECT l_suppkey, ship_date,
             lag(ship_date) OVER (PARTITION BY l_suppkey ORDER BY ship_date) AS prev_ship_date FROM d)
SELECT l_suppkey, prev_ship_date, ship_date, CAST(date_diff('day', prev_ship_date, ship_date) - 1 AS BIGINT) AS gap
FROM s
WHERE date_diff('day', prev_ship_date, ship_date) > 1
  AND NOT (ship_date BETWEEN DATE '1998-01-01' AND DATE '1998-03-31')
""")
def dq_date_gaps(spark, sf_dir):
    """Days without a shipment, per supplier."""
    li = T(spark, sf_dir).lineitem.select("l_suppkey", F.to_date("l_shipdate").alias("ship_date")).distinct()
    return Q.date_gaps(li, ["l_suppkey"], "ship_date", EXCLUDED_SPANS)


_FACT_SQL_UNRESOLVED = """
WITH dim AS (SELECT md5(COALESCE(CAST(c_custkey AS VARCHAR), '')) AS k, c_custkey FROM customer
             WHERE c_acctbal >= 0)
SELECT o.o_orderkey, COALESCE(a.k, '-1') AS dim_customer_id
FROM orders o LEFT JOIN dim a ON o.o_custkey = a.c_custkey
WHERE COALESCE(a.k, '-1') = '-1'
"""


@register("dq_unresolved_key", _FACT_SQL_UNRESOLVED)
def dq_unresolved_key(spark, sf_dir):
    f = fact_orders(spark, T(spark, sf_dir), F.col("c_acctbal") >= 0)
    return Q.negative_one(f, "dim_customer_id").select("o_orderkey", "dim_customer_id")


@register("dq_not_null", """
SELECT d.doc_id, CAST(l.quality AS DOUBLE) AS quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.lang = 'en' AND l.quality IS NULL
""")
def dq_not_null(spark, sf_dir):
    t = T(spark, sf_dir)
    j = t.documents.select("doc_id", "lang").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return Q.not_null(j, "quality", where=F.col("lang") == "en").select(
        "doc_id", F.col("quality").cast("double").alias("quality"))


@register("dq_unique_combo", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def dq_unique_combo(spark, sf_dir):
    li = T(spark, sf_dir).lineitem.select("l_orderkey", "l_linenumber")
    return Q.unique_combination(li, ["l_orderkey", "l_linenumber"])


# Fixed parameter: the as-of time of the recency check (stands in for the wall clock).
RECENCY_AS_OF = "2024-01-31 00:00:00"


@register("dq_recency", f"""
SELECT user_id, max(ts) AS latest FROM events GROUP BY 1
HAVING max(ts) < TIMESTAMP '{RECENCY_AS_OF}' - INTERVAL 2 DAY
""")
def dq_recency(spark, sf_dir):
    e = T(spark, sf_dir).events.select("user_id", "ts")
    return Q.recency(e, ["user_id"], "ts", F.lit(RECENCY_AS_OF).cast("timestamp_ntz"), 2)


@register("dq_value_domain", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE NOT (o_orderstatus IN ('F', 'O')) OR length(o_orderpriority) <> 8
""")
def dq_value_domain(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_orderstatus", "o_orderpriority")
    a = Q.value_domain(o, "o_orderstatus", allowed=["F", "O"])
    b = Q.value_domain(o, "o_orderpriority", length=8)
    return a.unionByName(b).distinct()


@register("dq_foreign_key", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IS NOT NULL AND o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
""")
def dq_foreign_key(spark, sf_dir):
    t = T(spark, sf_dir)
    parent = t.customer.where(F.col("c_acctbal") >= 0)
    return Q.foreign_key(t.orders.select("o_orderkey", "o_custkey"), "o_custkey", parent, "c_custkey")


@register("dq_schema", """
SELECT column_name, 'missing' AS problem FROM (VALUES ('o_orderkey'), ('o_custkey'), ('o_orderdate'), ('o_totalprice')) v(column_name)
WHERE column_name NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'orders')
UNION ALL
SELECT column_name, 'missing' AS problem FROM (VALUES ('l_orderkey'), ('l_linenumber'), ('l_shipdate'), ('l_loaded_at')) v(column_name)
WHERE column_name NOT IN (SELECT column_name FROM information_schema.columns WHERE table_name = 'lineitem')
""")
def dq_schema(spark, sf_dir):
    """``expect_column_to_exist`` on each table: rows = expected columns that the schema
    lacks (the line table has no load time)."""
    t = T(spark, sf_dir)
    return Q.missing_columns(spark, t.orders, ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"]) \
            .unionByName(Q.missing_columns(spark, t.lineitem, ["l_orderkey", "l_linenumber", "l_shipdate", "l_loaded_at"]))


@register("dq_report", """
SELECT 'unique_order_line' AS check_name, count(*) AS failures,
       CASE WHEN count(*) = 0 THEN 'pass' ELSE 'warn' END AS level
FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1)
UNION ALL
SELECT 'order_customer_fk', count(*),
       CASE WHEN count(*) = 0 THEN 'pass' WHEN count(*) > 10 THEN 'error' ELSE 'warn' END
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)
UNION ALL
SELECT 'status_domain', count(*), CASE WHEN count(*) = 0 THEN 'pass' ELSE 'error' END
FROM orders WHERE o_orderstatus NOT IN ('F', 'O', 'P')
""")
def dq_report(spark, sf_dir):
    """Severity: warn-only checks, and 'error after 10 failures' as in the reference tests."""
    t = T(spark, sf_dir)
    checks = [
        Q.Check("unique_order_line", Q.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"]), "warn"),
        Q.Check("order_customer_fk", Q.foreign_key(t.orders, "o_custkey",
                                                   t.customer.where(F.col("c_acctbal") >= 0), "c_custkey"),
                "error", error_after=10),
        Q.Check("status_domain", Q.value_domain(t.orders, "o_orderstatus", allowed=["F", "O", "P"])),
    ]
    return Q.report(checks)
