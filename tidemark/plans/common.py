"""Shared derived inputs for the plans, each with its DuckDB twin.

The driver tables stand in for the ledger (FIXTURES.md part D):

* transfer  = one lineitem: the order's customer pays the line's supplier
              ``extendedprice * (1 - discount)`` at the order date;
              ``tx_id`` = order key, ``intra`` = line number.
* address   = ``'c' || custkey`` for customers, ``'s' || suppkey`` for suppliers.
* trade     = one lineitem: asset = part, program = return flag,
              price = extendedprice / quantity, hour = ship date.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..sources.tables import Tables


def T(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


def transfers(t: Tables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_suppkey", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner").select(
        F.col("l_orderkey").alias("tx_id"),
        F.col("l_linenumber").cast("long").alias("intra"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sender"),
        F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("receiver"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amount"),
        F.col("o_orderdate").alias("ts"),
    )


TRANSFERS_SQL = """
transfers AS (
  SELECT l.l_orderkey AS tx_id, CAST(l.l_linenumber AS BIGINT) AS intra,
         'c' || CAST(o.o_custkey AS VARCHAR) AS sender,
         's' || CAST(l.l_suppkey AS VARCHAR) AS receiver,
         l.l_extendedprice * (1.0 - l.l_discount) AS amount,
         o.o_orderdate AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
)"""

def transactions(t: Tables) -> DataFrame:
    """Order lines as ledger transactions: most are payments, every third final one only pays
    its fee; first lines earn a reward, some returned lines close an account out."""
    n = F.col("l_linenumber")
    # what a line gives is made before it is sent to its order, and only that is sent
    li = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", F.coalesce((F.col("l_linestatus") == "F") & (n % 3 == 0), F.lit(False)).alias("keyreg"),
        (F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))).alias("amount"), F.when(n == 1, F.col("l_tax")).alias("reward"),
        ((F.col("l_returnflag") == "R") & (n % 4 == 0)).alias("closes"), "l_quantity")
    li = li.withColumn("close_amount", F.when(F.col("closes"), F.col("l_quantity")))
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    supplier = F.concat(F.lit("s"), F.col("l_suppkey").cast("string"))
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("tx_id"), F.col("l_linenumber").cast("long").alias("intra"),
        F.when(F.col("keyreg"), "keyreg").otherwise("pay").alias("tx_type"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("sender"), supplier.alias("receiver"), "amount", "reward",
        F.when(F.col("closes"), supplier).alias("close_to"), "close_amount", F.col("o_orderdate").alias("ts"))


def accounts(t: Tables) -> DataFrame:
    """The account table: customers that owe nothing and all suppliers, opened in January
    1995.  Other customers are addresses without an account."""
    def side(df, key, letter):
        day = (F.col(key) % 28).cast("int")
        return df.select(F.concat(F.lit(letter), F.col(key).cast("string")).alias("address"),
                         F.date_add(F.lit("1995-01-01").cast("date"), day).alias("opened"))
    return side(t.customer.where(F.col("c_acctbal") >= 0), "c_custkey", "c").unionByName(side(t.supplier, "s_suppkey", "s"))


ACCOUNTS_SQL = """
accounts AS (
  SELECT 'c' || CAST(c_custkey AS VARCHAR) AS address, CAST(DATE '1995-01-01' + CAST(c_custkey % 28 AS INTEGER) AS DATE) AS opened FROM customer WHERE c_acctbal >= 0
  UNION ALL
  SELECT 's' || CAST(s_suppkey AS VARCHAR), CAST(DATE '1995-01-01' + CAST(s_suppkey % 28 AS INTEGER) AS DATE) FROM supplier
)"""

LEGS_SQL = """
txns AS (
  SELECT l.l_orderkey AS tx_id, CAST(l.l_linenumber AS BIGINT) AS intra,
         CASE WHEN l_linestatus = 'F' AND l_linenumber % 3 = 0 THEN 'keyreg' ELSE 'pay' END AS tx_type,
         'c' || CAST(o.o_custkey AS VARCHAR) AS sender, 's' || CAST(l.l_suppkey AS VARCHAR) AS receiver,
         l.l_extendedprice * (1.0 - l.l_discount) AS amount, o.o_orderdate AS ts,
         CASE WHEN l_linenumber = 1 THEN l_tax END AS reward,
         l_returnflag = 'R' AND l_linenumber % 4 = 0 AS closes, l_quantity AS close_amount
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
legs AS (
  SELECT sender AS address, 'out' AS leg, ts, -amount AS amount, tx_id, intra FROM txns WHERE tx_type = 'pay'
  UNION ALL SELECT sender, 'fee', ts, CAST(-0.001 AS DOUBLE), tx_id, intra FROM txns
  UNION ALL SELECT receiver, 'in', ts, amount, tx_id, intra FROM txns WHERE tx_type = 'pay'
  UNION ALL SELECT sender, 'reward', ts, reward, tx_id, intra FROM txns WHERE reward IS NOT NULL
  UNION ALL SELECT receiver, 'close', ts, close_amount, tx_id, intra FROM txns WHERE closes
  UNION ALL SELECT sender, 'close_from', ts, close_amount, tx_id, intra FROM txns WHERE closes
)"""


def trades(t: Tables) -> DataFrame:
    return t.lineitem.select(
        F.col("l_partkey").alias("asset_id"),
        F.col("l_returnflag").alias("program"),
        F.col("l_orderkey").alias("tx_id"),
        F.col("l_linenumber").cast("long").alias("intra"),
        F.col("l_shipdate").alias("ts"),
        S.trunc_ts("hour", "l_shipdate").alias("hour"),
        F.col("l_quantity").alias("qty"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("price"),
    )


#: Assets of the swap stand-in: the anchor currency and the native coin (fixed values).
ANCHOR, NATIVE, ASSETS = 31566704, 0, 9


def swaps(t: Tables) -> DataFrame:
    """Order lines as swaps: goods (or the native coin) for the anchor currency or the coin."""
    coin = F.col("l_partkey") % 5 == 0
    return t.lineitem.select(
        S.trunc_ts("hour", "l_shipdate").alias("hour"),
        F.when(coin, F.lit(NATIVE)).otherwise(F.col("l_partkey") % ASSETS + 1).cast("long").alias("from_asset"),
        F.col("l_quantity").alias("from_amount"),
        F.when(coin | (F.col("l_linenumber") % 2 == 0), F.lit(ANCHOR)).otherwise(F.lit(NATIVE)).cast("long").alias("to_asset"),
        (F.col("l_extendedprice") / 1000).alias("to_amount"),
        F.concat("l_returnflag", "l_linestatus").alias("venue"))


SWAPS_SQL = f"""
swaps AS (
  SELECT date_trunc('hour', l_shipdate) AS block_hour,
         CASE WHEN l_partkey % 5 = 0 THEN {NATIVE} ELSE l_partkey % {ASSETS} + 1 END AS from_asset,
         l_quantity AS from_amt,
         CASE WHEN l_partkey % 5 = 0 OR l_linenumber % 2 = 0 THEN {ANCHOR} ELSE {NATIVE} END AS to_asset,
         l_extendedprice / 1000 AS to_amt, l_returnflag || l_linestatus AS dex
  FROM lineitem)"""

TRADES_SQL = """
trades AS (
  SELECT l_partkey AS asset_id, l_returnflag AS program, l_orderkey AS tx_id,
         CAST(l_linenumber AS BIGINT) AS intra, l_shipdate AS ts,
         date_trunc('hour', l_shipdate) AS hour, l_quantity AS qty,
         l_extendedprice / NULLIF(l_quantity, 0) AS price
  FROM lineitem
)"""
