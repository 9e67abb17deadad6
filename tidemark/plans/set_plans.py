"""Set-operation queries (O81-O85) and the view composition (O11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import relational as R
from . import register
from .common import T, transfers


@register("set_union_all", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_quantity, 'bulk' AS reason
FROM lineitem WHERE l_quantity > 45
UNION ALL
SELECT l_orderkey, CAST(l_linenumber AS BIGINT), l_quantity, 'discounted' FROM lineitem WHERE l_discount > 0.09
""")
def set_union_all(spark, sf_dir):
    li = T(spark, sf_dir).lineitem.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                                          "l_quantity", "l_discount")
    a = li.where(F.col("l_quantity") > 45).withColumn("reason", F.lit("bulk"))
    b = li.where(F.col("l_discount") > 0.09).withColumn("reason", F.lit("discounted"))
    return a.unionByName(b).drop("l_discount")


@register("set_union_distinct", """
SELECT 'c' || CAST(o_custkey AS VARCHAR) AS address FROM orders
UNION
SELECT 's' || CAST(l_suppkey AS VARCHAR) FROM lineitem
""")
def set_union_distinct(spark, sf_dir):
    t = T(spark, sf_dir)
    a = t.orders.select(F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("address"))
    b = t.lineitem.select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("address"))
    return a.union(b).distinct()


# Fixed parameter: the year's first and last moment, as a range that reaches the scan.
YEAR_1998 = ("1998-01-01 00:00:00", "1998-12-31 23:59:59.999999")


@register("set_except", """
SELECT c_custkey FROM customer
EXCEPT
SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998
""")
def set_except(spark, sf_dir):
    t = T(spark, sf_dir)
    active = t.orders.where(F.col("o_orderdate").between(*[F.lit(x).cast("timestamp_ntz") for x in YEAR_1998])).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey").subtract(active)


@register("unpivot_legs", """
WITH transfers AS (
  SELECT l.l_orderkey AS tx_id, CAST(l.l_linenumber AS BIGINT) AS intra,
         'c' || CAST(o.o_custkey AS VARCHAR) AS sender, 's' || CAST(l.l_suppkey AS VARCHAR) AS receiver
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)
SELECT tx_id, intra, 'sender' AS role, sender AS address FROM transfers
UNION ALL
SELECT tx_id, intra, 'receiver', receiver FROM transfers
""")
def unpivot_legs(spark, sf_dir):
    """Sender/receiver columns to rows in one scan (``stack``), not a UNION ALL that
    reads the input twice."""
    tr = transfers(T(spark, sf_dir))
    return tr.select("tx_id", "intra",
                     F.expr("stack(2, 'sender', sender, 'receiver', receiver) AS (role, address)"))


@register("set_tagged_union", """
SELECT 'returns' AS program, l_orderkey AS tx_id, CAST(l_linenumber AS BIGINT) AS intra,
       l_quantity AS amount, NULL AS fee
FROM lineitem WHERE l_returnflag = 'R'
UNION ALL
SELECT 'accepted', l_orderkey, CAST(l_linenumber AS BIGINT), l_quantity, round(l_extendedprice * l_tax, 4)
FROM lineitem WHERE l_returnflag = 'A'
UNION ALL
SELECT 'open', l_orderkey, CAST(l_linenumber AS BIGINT), l_quantity, NULL
FROM lineitem WHERE l_returnflag = 'N'
UNION ALL
SELECT 'orders', o_orderkey, CAST(0 AS BIGINT), o_totalprice, NULL FROM orders
""")
def set_tagged_union(spark, sf_dir):
    """Several programs' streams on one shape with a literal source tag; missing columns
    are null (``unionByName(allowMissingColumns=True)``)."""
    t = T(spark, sf_dir)
    li = t.lineitem
    ret = li.where(F.col("l_returnflag") == "R").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_linenumber").cast("long").alias("intra"),
        F.col("l_quantity").alias("amount"))
    acc = li.where(F.col("l_returnflag") == "A").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_linenumber").cast("long").alias("intra"),
        F.col("l_quantity").alias("amount"), F.round(F.col("l_extendedprice") * F.col("l_tax"), 4).alias("fee"))
    rest = li.where(F.col("l_returnflag") == "N").select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_linenumber").cast("long").alias("intra"),
        F.col("l_quantity").alias("amount"))
    ords = t.orders.select(
        F.col("o_orderkey").alias("tx_id"), F.lit(0).cast("long").alias("intra"),
        F.col("o_totalprice").alias("amount"))
    u = R.tagged_union({"returns": ret, "accepted": acc, "open": rest, "orders": ords}, "program")
    return u.select("program", "tx_id", "intra", "amount", F.col("fee").cast("double").alias("fee"))


@register("view_compose", """
WITH fact AS (SELECT o_orderkey, o_custkey, o_totalprice, md5(o_orderstatus) AS status_key FROM orders),
dim AS (SELECT c_custkey, c_name, c_mktsegment FROM customer)
SELECT f.o_orderkey, d.c_name, d.c_mktsegment, f.o_totalprice
FROM fact f LEFT JOIN dim d ON f.o_custkey = d.c_custkey
WHERE f.status_key = md5('F')
""")
def view_compose(spark, sf_dir):
    """Views are functions returning DataFrames; composing them is one Catalyst plan, and
    the constant key filter (``md5('F')`` is folded) reaches the fact scan."""
    t = T(spark, sf_dir)

    def fact_orders():
        return t.orders.select("o_orderkey", "o_custkey", "o_totalprice",
                               F.md5("o_orderstatus").alias("status_key"))

    def dim_customer():
        return t.customer.select("c_custkey", "c_name", "c_mktsegment")

    def ez_final_orders():
        f, d = fact_orders(), dim_customer()
        return (f.where(F.col("status_key") == F.md5(F.lit("F")))
                 .join(d, f.o_custkey == d.c_custkey, "left")
                 .select("o_orderkey", "c_name", "c_mktsegment", "o_totalprice"))

    return ez_final_orders()
