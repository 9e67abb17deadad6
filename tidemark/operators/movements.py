"""Movements of assets as jobs: close-outs, signed flows, bridges by group, pool labels, facts.

Transactions: block_id, intra (unique in its block), group_id, tx_id, inner_tx, tx_type, app_id,
asset_id, asset_amount, amount, sender, receiver, asset_sender, asset_receiver, fee and ``message``
(JSON text).  Amounts are raw integers; they are summed as such and scaled once a group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import scalars as S
from .dims import NOT_APPLICABLE_KEY, UNKNOWN_KEY

#: Copies of the native coin's row that the pairs of pools are dealt to (cost, not result).
COIN_COPIES = 64


def close_outs(tx: DataFrame) -> DataFrame:
    """What an account still held when it was closed, sent to the account that the message names.

    ``$.ca`` to ``$.txn.close`` for the native coin (asset 0), ``$.aca`` to ``$.txn.aclose`` for the asset
    ``$.txn.xaid``; only amounts above 0.  Broken messages hold none.
    """
    m = tx.where(F.col("message").isNotNull()).withColumn("__m", F.try_parse_json("message"))
    x = m.select("block_id", "intra", "group_id", "tx_id", "inner_tx",
                 F.coalesce(J.get("__m", "$.txn.close"), J.get("__m", "$.txn.aclose")).alias("account"),
                 F.coalesce(J.get("__m", "$.txn.xaid", "long"), F.lit(0)).cast("long").alias("asset_id"),
                 F.coalesce(J.get("__m", "$.ca", "long"), J.get("__m", "$.aca", "long")).alias("amount"))
    x = x.where(F.col("account").isNotNull() & (F.col("amount") > 0))
    return x.groupBy("block_id", "intra", "group_id", "tx_id", "inner_tx", "account", "asset_id").agg(F.sum("amount").alias("amount"))


def asset_flow(tx: DataFrame, closes: DataFrame, assets: DataFrame, sender_sign: int = 1) -> DataFrame:
    """(block_id, asset_id, address, amount): signed movement of every asset, address and block.

    A transfer is out of its asset sender (or else sender) and into its asset receiver (or else
    receiver).  A close-out counts for the account that gets it and for the sender of its
    transaction, there times ``sender_sign`` (the reference adds it, as 1 does).  The native coin's
    close-outs don't count.  Both legs of a transfer come from one scan; raw amounts are summed
    per (block, asset, address) map-side before the assets' decimals are joined to the sums.
    """
    moved = tx.where((F.col("tx_type") == "axfer") & (F.col("asset_amount") > 0))
    legs = F.array(F.struct(F.coalesce("asset_sender", "sender").alias("address"), (-F.col("asset_amount")).alias("amount")),
                   F.struct(F.coalesce("asset_receiver", "receiver").alias("address"), F.col("asset_amount").alias("amount")))
    moved = moved.select("block_id", "asset_id", F.inline(legs))
    closed = closes.where((F.col("amount") > 0) & (F.col("asset_id") > 0))
    to = closed.select("block_id", "asset_id", F.col("account").alias("address"), "amount")
    senders = tx.select("block_id", "intra", "sender").distinct()
    by = closed.join(senders, ["block_id", "intra"]).select(
        "block_id", "asset_id", F.col("sender").alias("address"), (F.col("amount") * sender_sign).alias("amount"))
    sums = moved.unionByName(to).unionByName(by).groupBy("block_id", "asset_id", "address").agg(F.sum("amount").alias("raw"))
    known = assets.select("asset_id", "decimals")
    return sums.join(known, "asset_id", "left").select("block_id", "asset_id", "address", S.scale_amount("raw", "decimals").alias("amount"))


def _calling_groups(tx: DataFrame, app_id: int) -> DataFrame:
    return tx.where((F.col("tx_type") == "appl") & (F.col("app_id") == app_id)).select("group_id").distinct()


def bridge_by_accounts(tx: DataFrame, app_id: int, accounts: list[str]) -> DataFrame:
    """Asset transfers of groups that call the bridge, the bridge's side told by its accounts (a
    short fixed list): what they send is inbound, what they receive outbound.  A transfer
    between two of them is inbound and bridges to the receiver; one between others has no sides."""
    moved = tx.where(F.col("tx_type") == "axfer").join(_calling_groups(tx, app_id), "group_id", "left_semi")
    sent, got = F.col("sender").isin(*accounts), F.col("asset_receiver").isin(*accounts)
    return moved.select(
        "block_id", "intra", "tx_id", "asset_id", F.col("asset_amount").alias("amount"),
        F.when(sent, F.col("asset_receiver")).when(got, F.col("sender")).alias("bridger_address"),
        F.when(sent, F.col("sender")).when(got, F.col("asset_receiver")).alias("bridge_address"),
        F.when(sent, "inbound").when(got, "outbound").alias("direction"))


def bridge_by_inner(tx: DataFrame, app_id: int, assets: DataFrame, fees: list[int]) -> DataFrame:
    """Transfers and payments of groups that call the bridge: those that its call makes itself
    (inner ones) are inbound, all others outbound.  Native payments of exactly one of the raw
    amounts ``fees`` are the bridge's fees and left out, like rows without an amount."""
    to, amount = F.coalesce("asset_receiver", "receiver"), F.coalesce("asset_amount", "amount")
    fee = (F.col("asset_id") == S.NATIVE_ASSET_ID) & amount.isin(*fees)
    moved = tx.where(F.col("tx_type").isin("axfer", "pay") & amount.isNotNull() & ~F.coalesce(fee, F.lit(False)))
    moved = moved.join(_calling_groups(tx, app_id), "group_id", "left_semi").withColumn("__raw", amount).withColumn("__to", to)
    inner = F.col("inner_tx")
    x = moved.join(assets.select("asset_id", "decimals"), "asset_id", "left")
    return x.select("block_id", "intra", "tx_id", "asset_id", S.scale_amount("__raw", "decimals", "asset_id").alias("amount"),
                    F.when(inner, F.col("__to")).when(~inner, F.col("sender")).alias("bridger_address"),
                    F.when(inner, F.col("sender")).when(~inner, F.col("__to")).alias("bridge_address"),
                    F.when(inner, "inbound").when(~inner, "outbound").alias("direction"))


def pool_labels(swaps: DataFrame, assets: DataFrame, native_name: str) -> DataFrame:
    """(address, label_type, label_subtype, label, address_name): one readable label a pool.

    ``swaps``: program, pool, from_asset, to_asset; ``assets``: asset_id, asset_name, created_at.  Of a pool's
    pairs the one of the newest assets counts (first from, then to; unknown assets before
    all), ties by the greater ids and program.  Swaps become distinct pairs before any join,
    and a pool's pair is a partial maximum: a pool with a third of all swaps is one row a task.
    """
    pairs = swaps.where("from_asset IS NOT NULL AND to_asset IS NOT NULL").select("program", "pool", "from_asset", "to_asset").distinct()

    # the native coin is a side of most pairs: they are dealt to copies of its row, if there is one
    copies = F.when(F.col("asset_id") == S.NATIVE_ASSET_ID, F.sequence(F.lit(0), F.lit(COIN_COPIES - 1))).otherwise(F.array(F.lit(0)))
    known = assets.select("asset_id", "asset_name", "created_at", F.explode(copies).alias("copy"))
    copy = F.pmod(F.xxhash64("pool", "from_asset", "to_asset"), F.lit(COIN_COPIES)).cast("int")

    def named(df: DataFrame, side: str) -> DataFrame:
        a = known.select(F.col("asset_id").alias(f"{side}_asset"), "copy", F.col("asset_name").alias(f"{side}_name"), F.col("created_at").alias(f"{side}_at"))
        own = F.when(F.col(f"{side}_asset") == S.NATIVE_ASSET_ID, copy).otherwise(F.lit(0))
        return df.withColumn("copy", own).join(a, [f"{side}_asset", "copy"], "left").drop("copy")

    def shown(side: str) -> Column:
        own = F.coalesce(f"best.{side}_name", F.col(f"best.{side}_asset").cast("string"))
        return F.when(F.col(f"best.{side}_asset") == S.NATIVE_ASSET_ID, F.lit(native_name)).otherwise(own)

    x = named(named(pairs, "from"), "to")
    rank = F.struct(F.col("from_at").isNull().alias("a"), "from_at", F.col("to_at").isNull().alias("b"), "to_at", "from_asset", "to_asset",
                    "program", "from_name", "to_name")
    return x.groupBy("pool").agg(F.max(rank).alias("best")).select(
        F.col("pool").alias("address"), F.lit("dex").alias("label_type"), F.lit("pool").alias("label_subtype"), F.col("best.program").alias("label"),
        F.concat("best.program", F.lit(": "), shown("from"), F.lit("-"), shown("to"), F.lit(" pool")).alias("address_name"))


def _short(key: str) -> Column:
    """A text key as binary, for rows that are sent on: 16 bytes for 32 lower hex digits, as surrogate keys are; any
    other text after a mark, and never of 16 bytes.  :func:`_long` is the way back."""
    mark = F.when(F.octet_length(key) == 15, F.lit("!!")).otherwise(F.lit("~"))
    return F.when(F.col(key).rlike(r"\A[0-9a-f]{32}\z"), F.unhex(key)).otherwise(F.concat(mark, F.col(key)).cast("binary"))


def _long(key: str) -> Column:
    text = F.expr(f"CAST(substring(`{key}`, CASE WHEN substring(`{key}`, 1, 1) = X'21' THEN 3 ELSE 2 END) AS STRING)")
    return F.when(F.octet_length(key) == 16, F.lower(F.hex(key))).otherwise(text)


def _block_role(df: DataFrame, blocks: DataFrame, column: str, key: str, time: str) -> DataFrame:
    """Short key and time of the block in ``column``.  Rows without a block are salted."""
    # 0 for every block, but no constant: the optimiser would take one out of the join key
    zero = lambda c: F.pmod(F.xxhash64(c), F.lit(1).cast("long"))
    salt = F.when(F.col(column).isNull(), F.pmod(F.xxhash64(*df.columns), F.lit(4096)) + 1).otherwise(zero(column))
    d = blocks.select(F.col("block_id").alias("__b"), _short("dim_block_id").alias(key), F.col("block_timestamp").alias(time),
                      zero("block_id").alias("__none"))
    x = df.withColumn("__salt", salt.cast("long"))
    x = x.join(d, (x[column] == d["__b"]) & (x["__salt"] == d["__none"]), "left")
    return x.drop("__b", "__none", "__salt")


def holdings_fact(held: DataFrame, accounts: DataFrame, dim_account: DataFrame, dim_asset: DataFrame, dim_block: DataFrame) -> DataFrame:
    """One fact row per account and asset, the native coin among them, with its dimension keys.

    ``held``: address, asset_id, amount, created_at, closed_at, asset_closed, frozen; ``accounts``: address,
    raw_amount of the native coin, created_at, closed_at.  An account, asset or first block that its
    dimension lacks is ``-1``; without a block of removal the role does not apply (``-2``).

    Every join sends the rows anew: those without a block of removal skip its join, keys travel short, and what
    adds most is joined last.
    """
    coin = accounts.select("address", F.lit(S.NATIVE_ASSET_ID).cast("long").alias("asset_id"), (F.col("raw_amount") / 10.0 ** S.NATIVE_DECIMALS).alias("amount"),
                           "created_at", "closed_at", F.lit(False).alias("asset_closed"), F.lit(False).alias("frozen"))
    x = held.select(coin.columns).unionByName(coin)
    closed = _block_role(x.where("closed_at IS NOT NULL"), dim_block, "closed_at", "__removed", "asset_last_removed")
    time = dim_block.schema["block_timestamp"].dataType
    x = closed.unionByName(x.where("closed_at IS NULL").withColumn("__removed", F.lit(None).cast("binary"))
                           .withColumn("asset_last_removed", F.lit(None).cast(time))).drop("closed_at")
    x = x.join(dim_asset.select("asset_id", _short("dim_asset_id").alias("__asset")), "asset_id", "left")
    x = x.join(dim_account.select("address", _short("dim_account_id").alias("__account")), "address", "left")
    x = _block_role(x, dim_block, "created_at", "__added", "asset_added_at")
    known = lambda c, missing: F.coalesce(_long(c), F.lit(missing))
    return x.select(
        S.surrogate_key("address", "asset_id").alias("fact_account_asset_id"), known("__account", UNKNOWN_KEY).alias("dim_account_id"),
        "address", known("__asset", UNKNOWN_KEY).alias("dim_asset_id"), "asset_id", "amount", known("__added", UNKNOWN_KEY).alias("dim_block_id__asset_added_at"),
        "asset_added_at", known("__removed", NOT_APPLICABLE_KEY).alias("dim_block_id__asset_last_removed"), "asset_last_removed", "asset_closed", "frozen")


def block_fact(blocks: DataFrame, tx: DataFrame, dim_block: DataFrame) -> DataFrame:
    """Per block: transactions, distinct senders and fees (0 for an empty block), with its key.

    Transactions are aggregated before the blocks are joined: counts and fees map-side, distinct
    senders as rows of their own, so a block's rows never meet before they are made distinct."""
    sums = tx.groupBy("block_id", "intra", "sender").agg(F.sum("fee").alias("fee"))
    per = sums.groupBy("block_id").agg(F.count_distinct("intra").alias("n"), F.count_distinct("sender").alias("s"), F.sum("fee").alias("f"))
    x = blocks.join(per, "block_id", "left").join(dim_block.select("block_id", "dim_block_id"), "block_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    return x.select(S.surrogate_key("block_id").alias("fact_block_id"), "block_id",
                    F.coalesce("block_timestamp", F.lit("1900-01-01").cast("timestamp_ntz")).alias("block_timestamp"),
                    F.coalesce("dim_block_id", F.lit(UNKNOWN_KEY)).alias("dim_block_id"), zero("n").alias("tx_count"),
                    zero("s").alias("tx_sender_count"), zero("f").alias("fee_total"))
