"""Projection and predicate queries (O20-O31).  All filters are plain Column predicates so
Catalyst pushes them into the parquet scan (PushedFilters) and prunes columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import relational as R
from . import register
from .common import T


@register("scan_project", """
SELECT o_orderkey AS block_id, o_custkey AS account_id, o_orderstatus AS status,
       o_totalprice AS total, CAST(o_orderdate AS DATE) AS block_date, o_orderdate AS block_timestamp
FROM orders
""")
def scan_project(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.select(F.col("o_orderkey").alias("block_id"), F.col("o_custkey").alias("account_id"),
                    F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
                    F.col("o_orderdate").cast("date").alias("block_date"),
                    F.col("o_orderdate").alias("block_timestamp"))


@register("filter_conj", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_quantity, l_discount
FROM lineitem
WHERE l_quantity > 10 AND l_discount <= 0.05 AND l_returnflag = 'R'
  AND l_shipdate >= TIMESTAMP '1997-01-01 00:00:00'
""")
def filter_conj(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.where((F.col("l_quantity") > 10) & (F.col("l_discount") <= 0.05)
                    & (F.col("l_returnflag") == "R")
                    & (F.col("l_shipdate") >= F.lit("1997-01-01 00:00:00").cast("timestamp_ntz"))) \
             .select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                     "l_partkey", "l_quantity", "l_discount")


@register("filter_in_list", """
SELECT o_orderkey, o_orderpriority, o_orderstatus FROM orders
WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')
""")
def filter_in_list(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
                   & ~F.col("o_orderstatus").isin("P")) \
            .select("o_orderkey", "o_orderpriority", "o_orderstatus")


@register("filter_patterns", """
SELECT p_partkey, lower(p_name) AS name_lower, p_type, p_brand FROM part
WHERE (p_name LIKE '%ring%' OR p_type ILIKE 'eco%')
  AND p_name NOT LIKE 'red%' AND p_brand NOT ILIKE 'brand#1_'
""")
def filter_patterns(spark, sf_dir):
    p = T(spark, sf_dir).part
    return p.where((F.col("p_name").like("%ring%") | F.col("p_type").ilike("eco%"))
                   & ~F.col("p_name").like("red%") & ~F.col("p_brand").ilike("brand#1_")) \
            .select("p_partkey", F.lower("p_name").alias("name_lower"), "p_type", "p_brand")


@register("filter_between", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity FROM lineitem
WHERE l_quantity BETWEEN 5 AND 15
""")
def filter_between(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.where(F.col("l_quantity").between(5, 15)) \
             .select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_quantity")


@register("filter_not_both", """
SELECT o_orderkey, o_orderstatus, o_orderpriority FROM orders
WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '5-LOW')
""")
def filter_not_both(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.where(~((F.col("o_orderstatus") == "F") & (F.col("o_orderpriority") == "5-LOW"))) \
            .select("o_orderkey", "o_orderstatus", "o_orderpriority")


@register("filter_case", """
SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders
WHERE CASE WHEN o_orderstatus = 'F' THEN o_totalprice > 200000
           WHEN o_orderstatus = 'O' THEN o_orderpriority = '1-URGENT'
           ELSE FALSE END = TRUE
""")
def filter_case(spark, sf_dir):
    o = T(spark, sf_dir).orders
    pred = (F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 200000)
             .when(F.col("o_orderstatus") == "O", F.col("o_orderpriority") == "1-URGENT")
             .otherwise(F.lit(False)))
    return o.where(pred == F.lit(True)).select("o_orderkey", "o_orderstatus", "o_totalprice")


@register("lateral_alias", """
WITH x AS (
  SELECT page_id, regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) AS host FROM pages)
SELECT page_id, host, split_part(host, '.', 1) AS subdomain FROM x
WHERE host LIKE '%.example.com' AND length(split_part(host, '.', 1)) >= 5
""")
def lateral_alias(spark, sf_dir):
    """Aliases reused by later columns and by the filter: chain withColumn before where."""
    p = T(spark, sf_dir).pages.select("page_id", "url")
    x = (p.withColumn("host", S.url_host("url"))
          .withColumn("subdomain", F.split_part("host", F.lit("."), F.lit(1))))
    return x.where(F.col("host").like("%.example.com") & (F.length("subdomain") >= 5)) \
            .select("page_id", "host", "subdomain")


@register("filter_scalar_subquery", """
SELECT o_orderkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 90 DAY FROM orders)
""")
def filter_scalar_subquery(spark, sf_dir):
    t = T(spark, sf_dir)
    hwm = t.orders.select((F.max("o_orderdate") - F.expr("INTERVAL 90 DAYS"))).scalar()
    return t.orders.where(F.col("o_orderdate") >= hwm).select("o_orderkey", "o_orderdate")


@register("semi_in", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')
""")
def semi_in(spark, sf_dir):
    t = T(spark, sf_dir)
    building = t.customer.where(F.col("c_mktsegment") == "BUILDING").select(F.col("c_custkey").alias("o_custkey"))
    return t.orders.select("o_orderkey", "o_custkey").join(building, "o_custkey", "left_semi") \
                   .select("o_orderkey", "o_custkey")


@register("anti_not_in", """
SELECT c_custkey, c_name FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
""")
def anti_not_in(spark, sf_dir):
    t = T(spark, sf_dir)
    urgent = t.orders.where(F.col("o_orderpriority") == "1-URGENT").select("o_custkey")
    return R.not_in(t.customer.select("c_custkey", "c_name"), "c_custkey", urgent, "o_custkey")


@register("filter_null_safe", """
SELECT d.doc_id, COALESCE(CAST(l.toxic AS VARCHAR), '') AS toxic_text
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE COALESCE(CAST(l.toxic AS VARCHAR), '') <> '1'
""")
def filter_null_safe(spark, sf_dir):
    t = T(spark, sf_dir)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "toxic"), "doc_id", "left")
    text = F.coalesce(F.col("toxic").cast("string"), F.lit(""))
    return j.where(text != "1").select("doc_id", text.alias("toxic_text"))
