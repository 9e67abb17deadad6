"""Bridge transfers: direction and far side decoded from call arguments or notes, by tables.

A bridge is described by parameters, so one job serves bridges that speak through application
calls (:func:`bridge_by_call`) and one those that write into the transfer's note
(:func:`bridge_by_note`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import jsonx as J
from ..functions import scalars as S


def decoded_args(df: DataFrame, args: str, fields: dict[str, int]) -> DataFrame:
    """``df`` with a text column for each named position of ``args`` (JSON text, a list of base64).

    Missing positions, what is no base64 and bytes that are no UTF-8 give null.
    """
    df = df.withColumn("__args", F.try_parse_json(args))
    return df.select("*", *[S.b64_text(J.get("__args", f"$[{i}]")).alias(n) for n, i in fields.items()]).drop("__args")


def by_suffix(text: Column, directions: dict[str, str]) -> Column:
    """The direction of the first suffix that the text ends with; null for all others."""
    out = F
    for suffix, direction in directions.items():
        out = out.when(text.endswith(suffix), F.lit(direction))
    return out


def bridge_by_call(tx: DataFrame, app_id: int, fields: dict[str, int], said: str, directions: dict[str, str], failed: str,
                   fee_address: str, nulls: dict[str, str] | None = None) -> DataFrame:
    """Transfers of groups in which the bridge's application is called.

    ``fields`` names the call's arguments, ``said`` the one whose suffix tells the direction;
    calls that end in ``failed`` (or say nothing) don't count, transfers to ``fee_address`` and
    those without an amount are left out.  ``nulls``: texts that stand for null, by field.  Inbound, the
    receiver bridges and the sender is the bridge, outbound the other way round.
    """
    receiver = F.coalesce("asset_receiver", "receiver")
    base = tx.where(F.coalesce(receiver, F.lit("")) != fee_address)
    calls = decoded_args(base.where((F.col("tx_type") == "appl") & (F.col("app_id") == app_id)).select("group_id", "args"), "args", fields)
    calls = calls.where(~F.col(said).endswith(failed)).withColumn("direction", by_suffix(F.col(said), directions))
    for field, text in (nulls or {}).items():
        calls = calls.withColumn(field, F.nullif(field, F.lit(text)))
    moved = base.where(F.col("tx_type").isin("axfer", "pay")).withColumn("amount", F.coalesce("asset_amount", "amount"))
    moved = moved.where("amount IS NOT NULL").select("block_id", "group_id", "intra", "asset_id", "amount", "sender", receiver.alias("__to"), "note")
    inbound, outbound = F.col("direction") == "inbound", F.col("direction") == "outbound"
    return moved.join(calls.drop("args"), "group_id").select(
        "block_id", "intra", "group_id", "asset_id", "amount", F.when(inbound, F.col("__to")).when(outbound, F.col("sender")).alias("bridger_address"),
        F.when(inbound, F.col("sender")).when(outbound, F.col("__to")).alias("bridge_address"), "direction", *fields, S.b64_text("note").alias("note"))


def bridge_by_note(tx: DataFrame, assets: DataFrame, bridge: str, marks: dict[str, str], native: int = 0) -> DataFrame:
    """Transfers from and to a bridge's account, with the far address from the note.

    The note is base64 of ``.../<mark><address>/...``; ``marks`` gives the text to take out for each
    direction.  Amounts are scaled by the asset's decimals, the native coin's by 10^6.  A
    transfer of the bridge to itself is one in each direction.
    """
    receiver = F.coalesce("asset_receiver", "receiver")
    amount = F.coalesce("asset_amount", "amount")
    near = tx.where(F.col("tx_type").isin("axfer", "pay") & amount.isNotNull() & ((F.col("sender") == bridge) | (receiver == bridge)))
    near = near.select("block_id", "intra", "asset_id", amount.alias("amount"), receiver.alias("__to"), "sender",
                       F.split_part(S.b64_text("note"), F.lit("/"), F.lit(2)).alias("__far"))
    ways = F.array_compact(F.array(F.when(F.col("sender") == bridge, "inbound"), F.when(F.col("__to") == bridge, "outbound")))
    each = near.withColumn("direction", F.explode(ways))
    inbound = F.col("direction") == "inbound"
    far = F.when(inbound, F.replace("__far", F.lit(marks["inbound"]), F.lit(""))).otherwise(F.replace("__far", F.lit(marks["outbound"]), F.lit("")))
    known = assets.select("asset_id", "decimals")
    return each.join(known, "asset_id", "left").select(
        "block_id", "intra", "asset_id", S.scale_amount("amount", "decimals", "asset_id").alias("amount"),
        F.when(inbound, F.col("__to")).otherwise(F.col("sender")).alias("bridger_address"),
        F.when(inbound, F.col("sender")).otherwise(F.col("__to")).alias("bridge_address"), "direction", far.alias("far_address"))
