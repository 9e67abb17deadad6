"""Bridge jobs over the driver tables: order lines as transfers and application calls.

A group is an order; lines 1 call the bridge's application (arguments as base64 in a JSON
list, some of them broken), all other lines transfer a part.  For the bridge by note, supplier 1 is its
account and the note carries the far address.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import bridges as B
from . import register
from .common import T
from .market_plans import market_assets, market_lines

APP, FEE, BRIDGE = 813, "s2", "s1"
#: The call's arguments by position, and what its description ends with.
FIELDS = {"far_address": 0, "far_token": 2, "own_token": 3, "description": 4, "far_tx_id": 5}
DIRECTIONS = {"release": "inbound", "deposit": "outbound"}
MARKS = {"inbound": "a1:", "outbound": "a1:u"}

_LINES_SQL = """
base AS (
  SELECT l_orderkey AS k, l_linenumber AS n, l_orderkey // 4 AS block_id, 'g' || CAST(l_orderkey AS VARCHAR) AS group_id,
         'c' || CAST(o_custkey AS VARCHAR) AS c, 's' || CAST(l_suppkey % 5 AS VARCHAR) AS s, l_partkey AS asset_id,
         CAST(round(l_extendedprice * 100) AS BIGINT) AS price, CAST(l_quantity AS BIGINT) AS quantity, l_suppkey
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _b64(c):
    return F.base64(F.encode(c, "UTF-8"))


def _text(c):
    return c.cast("string")


def bridge_lines(t):
    return market_lines(t).withColumn("s", F.concat(F.lit("s"), _text(F.col("l_suppkey") % 5)))


def call_transactions(t):
    b, k, n = bridge_lines(t), F.col("k"), F.col("n")
    said = F.concat(F.lit("order "), _text(k), F.when(k % 4 == 0, " release").when(k % 4 == 1, " deposit").when(k % 4 == 2, " refund").otherwise(" other"))
    args = F.array(_b64(F.concat(F.lit("far-é-"), F.col("c"))), F.lit("AAAA"), F.when(k % 3 == 0, F.lit("/w==")).otherwise(_b64(F.concat(F.lit("tok"), _text(k % 9)))),
                   F.when(k % 5 == 0, F.lit("%%")).otherwise(_b64(F.lit("own"))), F.when(k % 7 == 0, F.lit("/w==")).otherwise(_b64(said)),
                   _b64(F.when(k % 2 == 0, F.lit("null")).otherwise(F.concat(F.lit("tx"), _text(k)))))
    call = n == 1
    return b.select(
        "block_id", "group_id", n.cast("long").alias("intra"), F.when(call, "appl").when(n % 2 == 0, "axfer").otherwise("pay").alias("tx_type"),
        F.when(call, F.when(k % 11 == 0, 1).otherwise(APP)).alias("app_id"), F.when(call, F.to_json(args)).alias("args"),
        F.when(~call, F.when(n % 2 == 0, F.col("asset_id")).otherwise(0)).cast("long").alias("asset_id"),
        F.when(n % 2 == 0, F.when(n == 6, 0).otherwise(F.col("quantity"))).alias("asset_amount"), F.when(~call & (n % 2 == 1), F.col("price")).alias("amount"),
        F.col("c").alias("sender"), F.when(~call & (n % 2 == 1), F.col("s")).alias("receiver"), F.when(n % 2 == 0, F.col("s")).alias("asset_receiver"),
        F.when(n == 2, _b64(F.concat(F.lit("memo "), _text(k)))).when(n == 3, F.lit("/w==")).alias("note"))


@register("bridge_calls", f"""
WITH {_LINES_SQL},
calls AS (
  SELECT group_id, 'far-é-' || c AS far_address, CASE WHEN k % 3 <> 0 THEN 'tok' || CAST(k % 9 AS VARCHAR) END AS far_token,
         CASE WHEN k % 5 <> 0 THEN 'own' END AS own_token,
         'order ' || CAST(k AS VARCHAR) || CASE k % 4 WHEN 0 THEN ' release' WHEN 1 THEN ' deposit' ELSE ' other' END AS description,
         CASE WHEN k % 2 <> 0 THEN 'tx' || CAST(k AS VARCHAR) END AS far_tx_id, CASE k % 4 WHEN 0 THEN 'inbound' WHEN 1 THEN 'outbound' END AS direction
  FROM base WHERE n = 1 AND k % 7 <> 0 AND k % 4 <> 2 AND k % 11 <> 0),
moved AS (
  SELECT block_id, group_id, n AS intra, CASE WHEN n % 2 = 0 THEN asset_id ELSE 0 END AS asset_id,
         CASE WHEN n = 6 THEN 0 WHEN n % 2 = 0 THEN quantity ELSE price END AS amount, c AS sender, s AS receiver, CASE WHEN n = 2 THEN 'memo ' || CAST(k AS VARCHAR) END AS note
  FROM base WHERE n <> 1 AND s <> '{FEE}')
SELECT block_id, CAST(intra AS BIGINT) AS intra, group_id, asset_id, amount, CASE direction WHEN 'inbound' THEN receiver WHEN 'outbound' THEN sender END AS bridger_address,
       CASE direction WHEN 'inbound' THEN sender WHEN 'outbound' THEN receiver END AS bridge_address, direction, far_address, far_token, own_token,
       description, far_tx_id, note
FROM moved JOIN calls USING (group_id)
""")
def bridge_calls(spark, sf_dir):
    """Bridge transfers by application calls: positional base64 arguments, broken ones as null."""
    return B.bridge_by_call(call_transactions(T(spark, sf_dir)), APP, FIELDS, "description", DIRECTIONS, "refund", FEE, {"far_tx_id": "null"})


def note_transactions(t):
    b, k, n = bridge_lines(t), F.col("k"), F.col("n")
    out = n % 2 == 0  # out of the bridge
    note = F.concat(F.lit("v1/"), F.when(out, F.lit("a1:0x")).otherwise(F.lit("a1:u0x")), _text(k), F.lit("/end"))
    return b.select(
        "block_id", "group_id", n.cast("long").alias("intra"), F.when(n == 7, "appl").when(n % 3 == 0, "pay").otherwise("axfer").alias("tx_type"),
        F.when(n % 3 == 0, 0).otherwise(F.col("asset_id")).cast("long").alias("asset_id"), F.when(n % 3 != 0, F.col("quantity")).alias("asset_amount"),
        F.when(n % 3 == 0, F.col("price")).alias("amount"), F.when(out, F.col("s")).when(k % 13 == 0, BRIDGE).otherwise(F.col("c")).alias("sender"),
        F.when(n % 3 == 0, F.when(out, F.col("c")).otherwise(F.col("s"))).alias("receiver"),
        F.when(n % 3 != 0, F.when(out, F.col("c")).otherwise(F.col("s"))).alias("asset_receiver"),
        F.when(k % 6 == 0, F.lit("/w==")).when(k % 6 != 1, _b64(note)).alias("note"))


@register("bridge_notes", f"""
WITH {_LINES_SQL},
x AS (
  SELECT block_id, n AS intra, CASE WHEN n % 3 = 0 THEN 0 ELSE asset_id END AS asset_id, CASE WHEN n % 3 = 0 THEN price ELSE quantity END AS raw,
         CASE WHEN n % 2 = 0 THEN s WHEN k % 13 = 0 THEN '{BRIDGE}' ELSE c END AS sender, CASE WHEN n % 2 = 0 THEN c ELSE s END AS receiver,
         CASE WHEN k % 6 > 1 THEN CASE WHEN n % 2 = 0 THEN 'a1:0x' ELSE 'a1:u0x' END || CAST(k AS VARCHAR) END AS far
  FROM base WHERE n <> 7),
ways AS (
  SELECT *, 'inbound' AS direction, receiver AS bridger_address, sender AS bridge_address, replace(far, 'a1:', '') AS far_address FROM x WHERE sender = '{BRIDGE}'
  UNION ALL SELECT *, 'outbound', sender, receiver, replace(far, 'a1:u', '') FROM x WHERE receiver = '{BRIDGE}')
SELECT block_id, CAST(intra AS BIGINT) AS intra, w.asset_id,
       CASE WHEN w.asset_id = 0 THEN CAST(raw AS DOUBLE) / 1e6 WHEN p_size % 3 > 0 THEN CAST(raw AS DOUBLE) / pow(10, p_size % 3) ELSE CAST(raw AS DOUBLE) END AS amount,
       bridger_address, bridge_address, direction, far_address
FROM ways w LEFT JOIN part ON p_partkey = w.asset_id
""")
def bridge_notes(spark, sf_dir):
    """Transfers from and to a bridge's account; the far address is parsed out of the note."""
    t = T(spark, sf_dir)
    return B.bridge_by_note(note_transactions(t), market_assets(t), BRIDGE, MARKS)
