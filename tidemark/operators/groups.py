"""Transaction-group jobs: rows sharing a group id, ordered by a position.

* :func:`pattern_match`  - a "call" leg with the leg before it and the leg after it.
* :func:`shape_filter`   - keep groups with an exact count of legs per kind.
* :func:`two_pass_match` - groups of one shape teach keys that resolve the rest.
* :func:`direction_tag`  - inbound / outbound by a custodian address list.

Positions are looked up with equi-joins on (group, position +- k): both sides are
hash-partitioned on the pair, so a hot group is spread over its positions instead of
landing in one window task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def pattern_match(legs: DataFrame, group: str, pos: str, is_call: Column,
                  prev_ok: Column | None, next_ok: Column | None, cols: list[str]) -> DataFrame:
    """Calls whose previous leg satisfies ``prev_ok`` and whose next leg satisfies
    ``next_ok`` (predicates over ``prev_*`` / ``next_*`` columns).  Missing neighbour ->
    no match when a predicate is given."""
    others = legs.select(group, pos, *cols)
    x = legs.where(is_call).select(group, pos, *cols)
    x = neighbour_on(x, others, group, pos, -1, cols, "prev_")
    x = neighbour_on(x, others, group, pos, 1, cols, "next_")
    if prev_ok is not None:
        x = x.where(prev_ok)
    if next_ok is not None:
        x = x.where(next_ok)
    return x


def neighbour_on(df: DataFrame, others: DataFrame, group: str, pos: str, offset: int,
                 cols: list[str], prefix: str) -> DataFrame:
    o = others.select(F.col(group).alias("__g"), (F.col(pos) - F.lit(offset)).alias("__p"),
                      *[F.col(c).alias(f"{prefix}{c}") for c in cols])
    return df.join(o, (df[group] == o["__g"]) & (df[pos] == o["__p"]), "left").drop("__g", "__p")


def shape_filter(legs: DataFrame, group: str, kind: str, exact: dict[str, int],
                 min_legs: int = 1, absent: tuple[str, ...] = ()) -> DataFrame:
    """Groups with exactly ``exact[k]`` legs of kind ``k``, at least ``min_legs`` legs, and
    none of the kinds in ``absent``.  One aggregation with conditional counts (partial
    aggregation before the shuffle) and a HAVING filter."""
    aggs = [F.count(F.lit(1)).alias("n_legs")]
    aggs += [F.count(F.when(F.col(kind) == k, 1)).alias(f"n_{k}") for k in exact]
    aggs += [F.count(F.when(F.col(kind) == k, 1)).alias(f"n_{k}") for k in absent]
    g = legs.groupBy(group).agg(*aggs)
    cond = F.col("n_legs") >= min_legs
    for k, n in exact.items():
        cond = cond & (F.col(f"n_{k}") == n)
    for k in absent:
        cond = cond & (F.col(f"n_{k}") == 0)
    return g.where(cond)


def two_pass_match(legs: DataFrame, group: str, learn_col: str, legs_in_shape: int) -> DataFrame:
    """Pass 1: groups with exactly ``legs_in_shape`` legs; their ``learn_col`` values are
    learned.  Pass 2: legs of the other groups whose ``learn_col`` was learned."""
    spark = legs.sparkSession
    shape = legs.groupBy(group).agg(F.count(F.lit(1)).alias("n")) \
                .where(F.col("n") == legs_in_shape).select(F.col(group).alias("__g"))
    # flagged once and written: learning and matching read that table, not the legs again
    flagged = legs.join(shape, legs[group] == F.col("__g"), "left") \
                  .withColumn("__shape", F.col("__g").isNotNull()).drop("__g")
    path = scratch_path(spark, "two-pass")
    flagged.write.parquet(path)
    flagged = spark.read.schema(flagged.schema).parquet(path)
    learned = flagged.where("__shape").select(F.col(learn_col).alias("__learned")).distinct()
    x = flagged.join(learned, flagged[learn_col] == F.col("__learned"), "left")
    return x.where(F.col("__shape") | F.col("__learned").isNotNull()) \
            .withColumn("pass", F.when(F.col("__shape"), F.lit("pass1")).otherwise(F.lit("pass2"))) \
            .drop("__shape", "__learned")


def direction_tag(transfers: DataFrame, custodians: DataFrame, sender: str = "sender",
                  receiver: str = "receiver") -> DataFrame:
    """Tag transfers that touch a custodian: to a custodian = 'inbound', from one =
    'outbound' (a transfer between two custodians counts as inbound)."""
    cust = custodians.select(F.col("address").alias("__c")).where("__c IS NOT NULL").distinct()
    to_c = transfers.join(cust, F.col(receiver) == F.col("__c"), "left") \
                    .withColumnRenamed("__c", "__to")
    both = to_c.join(cust, F.col(sender) == F.col("__c"), "left").withColumnRenamed("__c", "__from")
    tagged = both.withColumn(
        "direction",
        F.when(F.col("__to").isNotNull(), F.lit("inbound"))
         .when(F.col("__from").isNotNull(), F.lit("outbound")))
    return tagged.where(F.col("direction").isNotNull()) \
                 .withColumn("bridge_address", F.coalesce("__to", "__from")).drop("__to", "__from")


def scaled(amount: str, decimals: str) -> Column:
    """An integer amount in its asset's unit; no or zero decimals leave it as it is."""
    return F.when(F.col(decimals) > 0, F.col(amount) / F.pow(F.lit(10.0), F.col(decimals))).otherwise(
        F.col(amount).cast("double"))


def swap_rows(legs: DataFrame, assets: DataFrame, is_swap: Column) -> DataFrame:
    """One row per swap call: what the caller sent in just before it and what came back.

    ``legs``: group, pos, kind, sender, asset, amount, out_asset, out_amount, pool (the last
    three of the call's own inner transfer).  ``assets``: asset, decimals.  The leg before the
    call, of the same sender, is the amount sent: a ``pay`` in the native coin (asset 0, six
    decimals) or an ``axfer`` of a known asset; without one the amount is 0 and the asset null.
    Equal legs count once.  Positions are matched by an equi-join on (group, position + 1).
    """
    native = F.col("kind") == "pay"
    known = assets.select(F.col("asset").alias("__a"), F.col("decimals").alias("__d"))
    sent = (legs.where(F.col("kind").isin("pay", "axfer"))
            .join(known, F.when(~native, F.col("asset")) == F.col("__a"), "left")
            .where(native | F.col("__a").isNotNull())
            .select(F.col("group").alias("__g"), (F.col("pos") + 1).alias("__p"), F.col("sender").alias("swapper"),
                    F.when(native, F.lit(0)).otherwise(F.col("asset")).cast("long").alias("from_asset"),
                    F.when(native, F.col("amount") / 1e6).otherwise(scaled("amount", "__d")).alias("from_amount"))
            .distinct())
    calls = (legs.where((F.col("kind") == "appl") & is_swap)
             .join(assets.withColumnRenamed("asset", "__o"), F.col("out_asset") == F.col("__o"))
             .select("group", "pos", "sender", "pool", F.col("out_asset").alias("to_asset"),
                     scaled("out_amount", "decimals").alias("to_amount")))
    j = calls.join(sent, (calls["group"] == sent["__g"]) & (calls["pos"] == sent["__p"])
                   & (calls["sender"] == sent["swapper"]), "left")
    return j.select("group", "pos", "swapper", "from_asset", F.coalesce("from_amount", F.lit(0.0)).alias("from_amount"),
                    "pool", "to_asset", F.coalesce("to_amount", F.lit(0.0)).alias("to_amount"))


def sale_rows(legs: DataFrame, assets: DataFrame, most: float = 450.0) -> DataFrame:
    """One row per asset leg of an atomic sale: groups of two or more legs with exactly one
    payment, one sender of assets and no application call, whose buyer is the payer.

    ``legs``: group, pos, kind, sender, receiver, asset, amount.  The group test is one
    aggregation; only the groups that pass meet their legs again.
    """
    axfer, pay = F.col("kind") == "axfer", F.col("kind") == "pay"
    shape = legs.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(pay, 1)).alias("pays"),
        F.count_distinct(F.when(axfer & (F.col("amount") > 0), F.col("sender"))).alias("sellers"),
        F.count(F.when(F.col("kind") == "appl", 1)).alias("calls"),
        F.max(F.when(pay, F.col("amount"))).alias("paid"), F.max(F.when(pay, F.col("sender"))).alias("payer"))
    sales = shape.where((F.col("n") >= 2) & (F.col("pays") == 1) & (F.col("sellers") == 1) & (F.col("calls") == 0)
                        & (F.col("paid") > 0)).select("group", "paid", "payer")
    items = legs.where(axfer & F.col("amount").between(0, most)).join(sales, "group")
    items = items.where(F.col("receiver") == F.col("payer")).join(assets, "asset", "left")
    return items.select("group", "pos", F.col("receiver").alias("purchaser"), "asset",
                        scaled("amount", "decimals").alias("n_items"), (F.col("paid") / 1e6).alias("total_sales_amount"))
