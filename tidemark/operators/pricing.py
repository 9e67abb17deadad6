"""Price jobs: from trades (trim + weighted mean), from pool reserves, imputation.

Statistics over raw trades are aggregates joined back on (asset, bucket) - partial
aggregation before the shuffle, and AQE can split a hot bucket in the join.  Windows
are used only after trades are aggregated per (asset, bucket, venue), where a partition
holds at most one row per venue; the previous-day weights are a one-day RANGE frame
per (asset, venue) on those aggregated rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import safe_div
from ..session import scratch_path
from .relational import null_safe_join


@dataclass(frozen=True)
class TradePriceParams:
    # Fixed values of the reference rules: trim of the native coin beyond 2 sigma, median
    # rule abs(p - m) > 2 m, current-hour shares under 20 swaps or 4 venues in the hour.
    sigmas: float = 2.0
    median_factor: float = 2.0
    min_swaps: int = 20
    min_venues: int = 4


def with_bucket_stats(df: DataFrame, keys: list[str], **stats: Column) -> DataFrame:
    """``df`` with aggregates of its (keys) bucket on every row, as ``agg() OVER (PARTITION BY
    keys)`` has them: aggregated (partially map-side) and joined back null-safe, so a hot
    bucket is split by the skew-aware join where a window would hold it in one task."""
    table = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    return null_safe_join(df, table, keys)


def with_bucket_median(df: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``df`` with the exact median of its bucket: equal values are counted first (map-side
    sums), so what one group gathers is its distinct values, not its rows."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    table = counted.groupBy(*keys).agg(F.percentile(value, 0.5, F.col("__n")).alias(out))
    return null_safe_join(df, table, keys, "left")


def _written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table of the shared work folder, made once for all that read it."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def anchored_legs(swaps: DataFrame, anchors: list, native, p: TradePriceParams) -> DataFrame:
    """(hour, asset, price, venue, amount): a swap's legs priced in the anchor currency.

    ``swaps``: hour, from_asset, from_amount, to_asset, to_amount, venue.  A leg whose other
    side is an anchor asset (worth 1) costs the other amount over its own; a leg whose other
    side is the native coin costs that times the native coin's hourly price, the mean of its
    anchored prices within ``sigmas`` sample std-devs (a lone price has no std-dev and
    stays).  An anchor asset itself costs 1.  A swap can give two legs, or none.

    The legs are made in one pass over the swaps and written; the native coin's hourly price
    (one row an hour) is taken from them and joined back.
    """
    side = [F.struct(F.col(f"{x}_asset").alias("asset"), F.col(f"{x}_amount").alias("amount"),
                     F.col(f"{y}_asset").alias("other"), F.col(f"{y}_amount").alias("other_amount"))
            for x, y in (("from", "to"), ("to", "from"))]
    direct = F.col("other").isin(*anchors)
    crossed = (F.col("other") == native) & (F.col("asset") != native)
    legs = swaps.select("hour", "venue", F.inline(F.array(*side))).where(direct | crossed)
    legs = _written(legs.select("hour", "asset", "venue", "amount", "other_amount",
                                F.coalesce(direct, F.lit(False)).alias("direct")), "price-legs")

    def price(rate: Column) -> Column:
        return F.when(F.col("asset").isin(*anchors), F.lit(1.0)).otherwise(
            safe_div(F.col("other_amount") * rate, F.col("amount")))

    coin = legs.where(F.col("direct") & (F.col("asset") == native)).select("hour", price(F.lit(1.0)).alias("price"))
    coin = with_bucket_stats(coin, ["hour"], __avg=F.avg("price"), __sd=F.stddev_samp("price"))
    far = F.coalesce(F.abs(F.col("price") - F.col("__avg")) > p.sigmas * F.col("__sd"), F.lit(False))
    rate = coin.groupBy("hour").agg(F.avg(F.when(~far, F.col("price"))).alias("__coin"))
    x = null_safe_join(legs, rate, ["hour"], "left")
    return x.select("hour", "asset", price(F.when(F.col("direct"), F.lit(1.0)).otherwise(F.col("__coin"))).alias("price"),
                    "venue", "amount")


def venue_stats(legs: DataFrame, p: TradePriceParams) -> DataFrame:
    """Per (hour, asset, venue): mean price, count and amount of the legs that the median rule
    keeps; lowest, highest, count and amount of all legs."""
    x = with_bucket_median(legs, ["asset", "hour"], "price", "__med")
    kept = ~F.coalesce(F.abs(F.col("price") - F.col("__med")) > p.median_factor * F.col("__med"), F.lit(False))
    return x.groupBy("hour", "asset", "venue").agg(
        F.avg(F.when(kept, F.col("price"))).alias("kept_price"),
        F.sum(F.when(kept, F.lit(1))).alias("kept_swaps"), F.sum(F.when(kept, F.col("amount"))).alias("kept_amount"),
        F.min("price").alias("low"), F.max("price").alias("high"),
        F.count(F.lit(1)).alias("swaps"), F.sum("amount").alias("amount"))


def price_from_trades(swaps: DataFrame, anchors: list, native, params: TradePriceParams = TradePriceParams()) -> DataFrame:
    """(hour, asset, price, min_price, max_price, volatility, swaps, volume): hourly price of
    every asset on the dense hours from its first price to the last closed hour.

    The newest hour is still filling and is left out.  Venues are weighted by their share of
    the asset's kept volume on the day before, or, when the hour itself is thin (fewer than
    ``min_swaps`` swaps or ``min_venues`` venues), by their share of the hour's swaps; the
    weights are not scaled up again.  Hours without swaps carry the last price.  Rows here
    are one per (hour, asset, venue), so the per-asset fill is bounded by the calendar.
    """
    good = swaps.where((F.col("from_amount") > 0) & (F.col("to_amount") > 0))
    # the two newest hours come to the driver and are pushed as literals: the newest is left
    # out, the one before ends the calendar
    newest = [r["hour"] for r in good.where(F.col("hour").isNotNull()).select(F.col("hour").cast("string").alias("hour"))
              .distinct().orderBy(F.desc("hour")).limit(2).collect()] + [None, None]
    open_hour, last = (F.lit(h).cast(swaps.schema["hour"].dataType) for h in newest[:2])
    closed = good.where(F.col("hour") < open_hour)
    stats = _written(venue_stats(anchored_legs(closed, anchors, native, params), params), "price-venues")
    stats = stats.withColumn("day", F.to_date("hour"))
    days = stats.groupBy("asset", "venue", "day").agg(F.sum("kept_amount").alias("day_amount"))
    days = with_bucket_stats(days, ["asset", "day"], whole=F.sum("day_amount"))
    days = days.select("asset", "venue", F.date_add("day", 1).alias("day"),
                       safe_div(F.col("day_amount"), F.col("whole")).alias("day_share"))
    x = null_safe_join(stats, days, ["asset", "venue", "day"], "left")
    x = with_bucket_stats(x, ["hour", "asset"], hour_swaps=F.sum("swaps"), venues=F.count(F.lit(1)))
    thin = (F.col("hour_swaps") < params.min_swaps) | (F.col("venues") < params.min_venues)
    weight = F.when(thin, F.col("swaps") / F.col("hour_swaps")).otherwise(F.col("day_share"))
    hourly = x.groupBy("hour", "asset").agg(
        F.sum(F.col("kept_price") * weight).alias("price"), F.min("low").alias("min_price"),
        F.max("high").alias("max_price"), F.sum("swaps").alias("swaps"), F.sum("amount").alias("volume"))
    return fill_hours(hourly.withColumn("volatility", F.col("max_price") - F.col("min_price"))
                      .withColumn("volume", F.col("volume") * F.col("price")), last)


def fill_hours(hourly: DataFrame, last: Column) -> DataFrame:
    """One row per asset and hour from the asset's first price to ``last``: hours without one
    take the last price before, their other columns are null.  A row that changes nothing
    stays; each row expands itself up to the next, so there is no grid to join."""
    w = Window.partitionBy("asset").orderBy("hour")
    x = hourly.withColumn("filled", F.last("price", ignorenulls=True).over(
        w.rowsBetween(Window.unboundedPreceding, Window.currentRow))).withColumn("next", F.lead("hour").over(w))
    hour = F.expr("INTERVAL 1 HOUR")
    x = x.withColumn("at", F.explode(F.sequence("hour", F.coalesce(F.col("next") - hour, last), hour)))
    own = F.col("at") == F.col("hour")
    kept = [F.when(own, F.col(c)).alias(c) for c in hourly.columns if c not in ("hour", "asset", "price")]
    return x.where(F.col("filled").isNotNull()).select(F.col("at").alias("hour"), "asset", F.col("filled").alias("price"), *kept)


def reserve_price(balances: DataFrame, pool: str, period: str, asset: str, base_asset: str,
                  quote_asset: str, base_price: DataFrame, exclude: DataFrame | None = None) -> DataFrame:
    """(pool, period, base_reserve, quote_reserve, price_in_base, price_usd) from dense reserves.

    The two reserves of each pool become columns (conditional max, not a map, so a duplicate
    key cannot fail); both must be above 0, and a quote reserve that rounds to 0 prices at 0.
    ``base_price``: (period, base_price); periods without one are left out.  ``exclude``: a
    table of pools that are left out.
    """
    kept = balances if exclude is None else balances.join(exclude.select(pool).distinct(), pool, "left_anti")
    piv = kept.groupBy(pool, period).agg(
        F.max(F.when(F.col(asset) == base_asset, F.col("balance"))).alias("base_reserve"),
        F.max(F.when(F.col(asset) == quote_asset, F.col("balance"))).alias("quote_reserve"))
    ratio = F.when(F.round("quote_reserve") == 0, F.lit(0.0)).otherwise(
        safe_div(F.col("base_reserve"), F.col("quote_reserve")))
    both = piv.where((F.col("base_reserve") > 0) & (F.col("quote_reserve") > 0)).withColumn("price_in_base", ratio)
    return both.join(base_price, period).withColumn("price_usd", F.col("price_in_base") * F.col("base_price"))


def impute_on_grid(df: DataFrame, keys: list[str], order: str, value: str, last: Column, step: str) -> DataFrame:
    """(keys, order, value, imputed) on a grid that all keys share: every period from the key's
    first value to ``last`` (the end of the shared calendar).

    Periods without a value of their own carry the last one before and are ``imputed``.  Rows
    are unique per (keys, order); each expands itself up to the next one, so the grid is never
    joined.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    unit = F.expr(f"INTERVAL {step}")
    x = df.where(F.col(value).isNotNull()).withColumn("__next", F.lead(order).over(w))
    at = F.explode(F.sequence(F.col(order), F.coalesce(F.col("__next") - unit, last), unit))
    x = x.select(*keys, F.col(order).alias("__own"), at.alias("__at"), value)
    return x.select(*keys, F.col("__at").alias(order), value, (F.col("__at") != F.col("__own")).alias("imputed"))


def prefer_observed(first: DataFrame, second: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, is_imputed) of two imputed price tables: an observed price of the first,
    an observed one of the second, an imputed one of the first, an imputed one of the second.
    Keys that neither has are left out."""
    a, b = (df.select(*keys, F.struct(value, "imputed").alias(n)) for df, n in ((first, "__a"), (second, "__b")))
    j = a.join(b, keys, "full")
    pick = F.coalesce(F.when(~F.col("__a.imputed"), F.col("__a")), F.when(~F.col("__b.imputed"), F.col("__b")),
                      F.col("__a"), F.col("__b"))
    return j.select(*keys, pick[value].alias(value), pick["imputed"].alias("is_imputed"))


def preference(cols: list[tuple[str, Column]]) -> tuple[Column, Column]:
    """First non-null candidate in preference order, and the name of its source."""
    val = F.coalesce(*[c for _, c in cols])
    src = F.when(cols[0][1].isNotNull(), F.lit(cols[0][0]))
    for name, c in cols[1:]:
        src = src.when(c.isNotNull(), F.lit(name))
    return val, src
