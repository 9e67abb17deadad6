"""Movement jobs over the driver tables: every order line is a transaction of its order's group.

Line 1 calls an application (700 and 701 are bridges), even lines transfer the part, the other
odd ones pay; lines from 5 on are inner ones.  Some close an account out in their message.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import movements as M
from . import register
from .bridge_plans import _LINES_SQL, bridge_lines
from .common import T
from .market_plans import market_assets

ACCOUNT_BRIDGE, INNER_BRIDGE, CUSTODIANS, FEES, COIN = 700, 701, ["s1", "s2", "s3"], [100000, 1002000], "COIN"

_TX_SQL = _LINES_SQL + f""",
tx AS (
  SELECT *, (k % 4) * 8 + n AS intra, group_id || '-' || CAST(n AS VARCHAR) AS tx_id, n >= 5 AS inner_tx,
         CASE WHEN n = 1 THEN 'appl' WHEN n % 2 = 0 THEN 'axfer' ELSE 'pay' END AS tx_type,
         CASE WHEN n = 1 THEN CASE k % 5 WHEN 0 THEN {ACCOUNT_BRIDGE} WHEN 1 THEN {INNER_BRIDGE} ELSE 9 END END AS app_id,
         CASE WHEN n = 4 THEN 0 WHEN n % 2 = 0 THEN quantity END AS asset_amount,
         CASE WHEN n = 3 AND k % 10 = 1 THEN {FEES[0]} WHEN n % 2 = 1 AND n > 1 THEN price END AS amount,
         CASE WHEN k % 7 = 0 AND n = 2 THEN 's1' ELSE c END AS sender
  FROM base),
closes AS (
  SELECT block_id, intra, group_id, tx_id, inner_tx, s AS account, asset_id, quantity AS amount FROM tx WHERE n IN (2, 6) AND k % 2 = 0 AND k % 14 <> 0
  UNION ALL SELECT block_id, intra, group_id, tx_id, inner_tx, s, 0, price // 10 FROM tx WHERE n = 3 AND k % 3 = 1 AND price // 10 > 0),
assets AS (SELECT p_partkey AS asset_id, p_size % 3 AS decimals FROM part)"""


def flow_transactions(t):
    b, k, n, null = bridge_lines(t), F.col("k"), F.col("n"), F.lit(None)
    axfer, pay = n % 2 == 0, (n % 2 == 1) & (n > 1)
    part = F.to_json(F.struct(F.when(k % 14 == 0, 0).otherwise(F.col("quantity")).alias("aca"),
                              F.struct(F.col("s").alias("aclose"), F.col("asset_id").alias("xaid")).alias("txn")))
    coin = F.to_json(F.struct(F.expr("price div 10").alias("ca"), F.struct(F.col("s").alias("close")).alias("txn")))
    return b.select(
        "block_id", ((k % 4) * 8 + n).cast("long").alias("intra"), "group_id", F.concat("group_id", F.lit("-"), n.cast("string")).alias("tx_id"),
        (n >= 5).alias("inner_tx"), F.when(n == 1, "appl").when(axfer, "axfer").otherwise("pay").alias("tx_type"),
        F.when(n == 1, F.when(k % 5 == 0, ACCOUNT_BRIDGE).when(k % 5 == 1, INNER_BRIDGE).otherwise(9)).alias("app_id"),
        F.when(axfer, F.col("asset_id")).when(pay, 0).cast("long").alias("asset_id"),
        F.when(n == 4, 0).when(axfer, F.col("quantity")).cast("long").alias("asset_amount"),
        F.when((n == 3) & (k % 10 == 1), FEES[0]).when(pay, F.col("price")).cast("long").alias("amount"),
        F.when((k % 7 == 0) & (n == 2), "s1").otherwise(F.col("c")).alias("sender"), F.when(pay, F.col("s")).otherwise(null).alias("receiver"),
        F.when(axfer & (k % 3 == 0), F.col("s")).alias("asset_sender"), F.when(axfer, F.col("s")).alias("asset_receiver"), (n + 1000).cast("long").alias("fee"),
        F.when(n.isin(2, 6) & (k % 2 == 0), part).when((n == 3) & (k % 3 == 1), coin).when(n == 7, F.lit("{oops")).when(n == 5, F.lit('{"txn":{}}')).alias("message"))


@register("close_outs", f"""
WITH {_TX_SQL}
SELECT block_id, CAST(intra AS BIGINT) AS intra, group_id, tx_id, inner_tx, account, asset_id, CAST(sum(amount) AS BIGINT) AS amount
FROM closes GROUP BY ALL
""")
def close_outs(spark, sf_dir):
    """Remainders of closed accounts, out of the message; zero amounts and broken messages hold none."""
    return M.close_outs(flow_transactions(T(spark, sf_dir)))


@register("asset_flow", f"""
WITH {_TX_SQL},
legs AS (
  SELECT block_id, asset_id, CASE WHEN k % 3 = 0 THEN s ELSE sender END AS address, -1 * asset_amount AS amount FROM tx WHERE tx_type = 'axfer' AND asset_amount > 0
  UNION ALL SELECT block_id, asset_id, s, asset_amount FROM tx WHERE tx_type = 'axfer' AND asset_amount > 0
  UNION ALL SELECT block_id, asset_id, account, amount FROM closes WHERE asset_id > 0
  UNION ALL SELECT a.block_id, a.asset_id, b.sender, a.amount FROM closes a
            JOIN (SELECT DISTINCT block_id, intra, sender FROM tx) b ON a.block_id = b.block_id AND a.intra = b.intra WHERE a.asset_id > 0)
SELECT block_id, l.asset_id, address, round(sum(CASE WHEN decimals > 0 THEN amount / pow(10, decimals) ELSE amount END), 4) AS amount
FROM legs l LEFT JOIN assets USING (asset_id) GROUP BY 1, 2, 3
""")
def asset_flow(spark, sf_dir):
    """Signed movements per block, asset and address: transfers out and in, and close-outs."""
    t = T(spark, sf_dir)
    tx = flow_transactions(t)
    return M.asset_flow(tx, M.close_outs(tx), market_assets(t)).withColumn("amount", F.round("amount", 4))


@register("bridge_groups", f"""
WITH {_TX_SQL},
x AS (SELECT *, sender IN ('s1', 's2', 's3') AS sent, s IN ('s1', 's2', 's3') AS got FROM tx
      WHERE tx_type = 'axfer' AND group_id IN (SELECT group_id FROM tx WHERE tx_type = 'appl' AND app_id = {ACCOUNT_BRIDGE}))
SELECT block_id, CAST(intra AS BIGINT) AS intra, tx_id, asset_id, asset_amount AS amount, CASE WHEN sent THEN s WHEN got THEN sender END AS bridger_address,
       CASE WHEN sent THEN sender WHEN got THEN s END AS bridge_address, CASE WHEN sent THEN 'inbound' WHEN got THEN 'outbound' END AS direction
FROM x
""")
def bridge_groups(spark, sf_dir):
    """Transfers of groups that call the bridge; its side is told by a list of accounts."""
    return M.bridge_by_accounts(flow_transactions(T(spark, sf_dir)), ACCOUNT_BRIDGE, CUSTODIANS)


@register("bridge_inner", f"""
WITH {_TX_SQL},
x AS (SELECT block_id, intra, tx_id, CASE WHEN n % 2 = 0 THEN asset_id ELSE 0 END AS asset_id, COALESCE(asset_amount, amount) AS raw, sender, s, inner_tx
      FROM tx WHERE tx_type <> 'appl' AND group_id IN (SELECT group_id FROM tx WHERE tx_type = 'appl' AND app_id = {INNER_BRIDGE}))
SELECT block_id, CAST(intra AS BIGINT) AS intra, tx_id, x.asset_id,
       CASE WHEN x.asset_id = 0 THEN CAST(raw AS DOUBLE) / 1e6 WHEN decimals > 0 THEN CAST(raw AS DOUBLE) / pow(10, decimals) ELSE CAST(raw AS DOUBLE) END AS amount,
       CASE WHEN inner_tx THEN s ELSE sender END AS bridger_address, CASE WHEN inner_tx THEN sender ELSE s END AS bridge_address,
       CASE WHEN inner_tx THEN 'inbound' ELSE 'outbound' END AS direction
FROM x LEFT JOIN assets USING (asset_id) WHERE NOT (x.asset_id = 0 AND raw IN ({FEES[0]}, {FEES[1]}))
""")
def bridge_inner(spark, sf_dir):
    """Transfers and payments of groups that call the bridge; inner ones are inbound, fees left out."""
    t = T(spark, sf_dir)
    return M.bridge_by_inner(flow_transactions(t), INNER_BRIDGE, market_assets(t), FEES)


@register("pool_labels", f"""
WITH sw AS (
  SELECT DISTINCT l_returnflag || l_linestatus AS program, 's' || CAST(l_suppkey AS VARCHAR) AS pool,
         CASE WHEN l_partkey % 5 = 0 THEN 0 ELSE l_partkey END AS f, CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_partkey + 1 END AS g
  FROM lineitem WHERE l_linenumber <> 7),
a AS (SELECT p_partkey AS id, CASE WHEN p_size % 10 <> 0 THEN p_name END AS name, p_size AS at FROM part WHERE p_size <= 45),
j AS (
  SELECT program, pool, CASE WHEN f = 0 THEN '{COIN}' ELSE COALESCE(a.name, CAST(f AS VARCHAR)) END AS fn,
         CASE WHEN g = 0 THEN '{COIN}' ELSE COALESCE(b.name, CAST(g AS VARCHAR)) END AS gn,
         row_number() OVER (PARTITION BY pool ORDER BY a.at DESC NULLS FIRST, b.at DESC NULLS FIRST, f DESC, g DESC, program DESC) AS rn
  FROM sw LEFT JOIN a ON f = a.id LEFT JOIN a b ON g = b.id)
SELECT pool AS address, 'dex' AS label_type, 'pool' AS label_subtype, program AS label, program || ': ' || fn || '-' || gn || ' pool' AS address_name
FROM j WHERE rn = 1
""")
def pool_labels(spark, sf_dir):
    """One label a pool (supplier) from the newest pair it swaps."""
    t = T(spark, sf_dir)
    swaps = t.lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("program"), F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("pool"),
        F.when(F.col("l_partkey") % 5 == 0, 0).otherwise(F.col("l_partkey")).cast("long").alias("from_asset"),
        F.when(F.col("l_linenumber") % 2 == 0, 0).when(F.col("l_linenumber") != 7, F.col("l_partkey") + 1).cast("long").alias("to_asset"))
    assets = t.part.where("p_size <= 45").select(F.col("p_partkey").alias("asset_id"), F.when(F.col("p_size") % 10 != 0, F.col("p_name")).alias("asset_name"),
                                                 F.col("p_size").alias("created_at"))
    return M.pool_labels(swaps, assets, COIN)


_BLOCKS_SQL = """
blocks AS (SELECT o_orderkey // 4 AS block_id, min(o_orderdate) AS block_timestamp FROM orders GROUP BY 1),
dim_block AS (SELECT md5(CAST(block_id AS VARCHAR)) AS dim_block_id, block_id, block_timestamp FROM blocks WHERE block_id % 9 <> 0)"""


def _blocks(t):
    blocks = t.orders.groupBy(F.floor(F.col("o_orderkey") / 4).alias("block_id")).agg(F.min("o_orderdate").alias("block_timestamp"))
    dim = blocks.where(F.col("block_id") % 9 != 0).withColumn("dim_block_id", S.surrogate_key("block_id"))
    return blocks, dim


@register("holdings_fact", f"""
WITH {_BLOCKS_SQL},
held AS (
  SELECT 's' || CAST(l_suppkey AS VARCHAR) AS address, l_partkey AS asset_id, sum(l_quantity) AS amount, min(l_orderkey) // 4 AS created_at,
         CASE WHEN min(l_returnflag) = 'R' THEN max(l_orderkey) // 4 END AS closed_at, min(l_returnflag) = 'R' AS asset_closed, max(l_linestatus) = 'F' AS frozen
  FROM lineitem GROUP BY l_suppkey, l_partkey),
accounts AS (
  SELECT 's' || CAST(s_suppkey AS VARCHAR) AS address, CAST(round(s_acctbal * 100) AS BIGINT) * 10000 AS raw_amount, s_suppkey AS created_at,
         CASE WHEN s_acctbal < 0 THEN s_suppkey + 1 END AS closed_at FROM supplier),
x AS (SELECT * FROM held UNION ALL SELECT address, 0, raw_amount / 1e6, created_at, closed_at, false, false FROM accounts)
SELECT md5(x.address || '-' || CAST(x.asset_id AS VARCHAR)) AS fact_account_asset_id,
       CASE WHEN s_acctbal >= 0 THEN md5(x.address) ELSE '-1' END AS dim_account_id, x.address,
       CASE WHEN p_size <= 45 THEN md5(CAST(x.asset_id AS VARCHAR)) ELSE '-1' END AS dim_asset_id, x.asset_id, amount,
       COALESCE(c.dim_block_id, '-1') AS dim_block_id__asset_added_at, c.block_timestamp AS asset_added_at,
       COALESCE(b.dim_block_id, '-2') AS dim_block_id__asset_last_removed, b.block_timestamp AS asset_last_removed, asset_closed, frozen
FROM x LEFT JOIN dim_block c ON x.created_at = c.block_id LEFT JOIN dim_block b ON x.closed_at = b.block_id
LEFT JOIN supplier ON x.address = 's' || CAST(s_suppkey AS VARCHAR) LEFT JOIN part ON x.asset_id = p_partkey
""")
def holdings_fact(spark, sf_dir):
    """Holdings of every supplier, with its native coin, and the keys of four dimension roles; some
    accounts, assets and blocks are not in their dimensions yet."""
    t = T(spark, sf_dir)
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    closed = F.min("l_returnflag") == "R"
    held = t.lineitem.groupBy(name("l_suppkey").alias("address"), F.col("l_partkey").alias("asset_id")).agg(
        F.sum("l_quantity").alias("amount"), F.floor(F.min("l_orderkey") / 4).alias("created_at"),
        F.when(closed, F.floor(F.max("l_orderkey") / 4)).alias("closed_at"), closed.alias("asset_closed"), (F.max("l_linestatus") == "F").alias("frozen"))
    accounts = t.supplier.select(name("s_suppkey").alias("address"), (F.round(F.col("s_acctbal") * 100).cast("long") * 10000).alias("raw_amount"),
                                 F.col("s_suppkey").alias("created_at"), F.when(F.col("s_acctbal") < 0, F.col("s_suppkey") + 1).alias("closed_at"))
    dim_account = t.supplier.where("s_acctbal >= 0").select(name("s_suppkey").alias("address")).withColumn("dim_account_id", S.surrogate_key("address"))
    dim_asset = t.part.where("p_size <= 45").select(F.col("p_partkey").alias("asset_id")).withColumn("dim_asset_id", S.surrogate_key("asset_id"))
    return M.holdings_fact(held, accounts, dim_account, dim_asset, _blocks(t)[1])


@register("block_fact", f"""
WITH {_TX_SQL}, {_BLOCKS_SQL},
per AS (SELECT block_id, count(DISTINCT intra) AS n, count(DISTINCT sender) AS s, sum(n + 1000) AS f FROM tx WHERE k % 3 <> 0 GROUP BY 1)
SELECT md5(CAST(b.block_id AS VARCHAR)) AS fact_block_id, b.block_id, b.block_timestamp, COALESCE(d.dim_block_id, '-1') AS dim_block_id,
       CAST(COALESCE(n, 0) AS BIGINT) AS tx_count, CAST(COALESCE(s, 0) AS BIGINT) AS tx_sender_count, CAST(COALESCE(f, 0) AS BIGINT) AS fee_total
FROM blocks b LEFT JOIN per ON b.block_id = per.block_id LEFT JOIN dim_block d ON b.block_id = d.block_id
""")
def block_fact(spark, sf_dir):
    """Transactions, senders and fees of every block; orders with a key divisible by 3 sent nothing."""
    t = T(spark, sf_dir)
    blocks, dim = _blocks(t)
    # the group's name carries the order key
    tx = flow_transactions(t).where(F.substring("group_id", 2, 20).cast("long") % 3 != 0)
    return M.block_fact(blocks, tx, dim)
