"""Pricing queries (O61, O124-O127, O54/O55/O71 as stages)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import ledger
from ..operators import pricing as P
from . import register
from .common import ANCHOR, NATIVE, SWAPS_SQL, TRADES_SQL, T, swaps, trades


def _hu(expr: str, d: int = 4) -> str:
    """Oracle twin of ``scalars.round_half_up``."""
    return f"floor(({expr}) * {10 ** d} + 0.5) / {10 ** d}"


def _trade_price_sql(min_swaps: int, min_venues: int) -> str:
    """The reference's chain of steps, one CTE for each of its own."""
    return f"""
WITH {SWAPS_SQL},
good AS (SELECT * FROM swaps WHERE from_amt > 0 AND to_amt > 0),
closed AS (SELECT * FROM good QUALIFY rank() OVER (ORDER BY block_hour DESC) <> 1),
legs AS (
  SELECT block_hour, dex, from_asset AS asset, from_amt AS amt, to_asset AS other, to_amt AS other_amt FROM closed
  UNION ALL SELECT block_hour, dex, to_asset, to_amt, from_asset, from_amt FROM closed),
direct AS (
  SELECT block_hour, asset, CASE WHEN asset = {ANCHOR} THEN 1 ELSE other_amt / NULLIF(amt, 0) END AS price, dex, amt
  FROM legs WHERE other = {ANCHOR}),
coin AS (
  SELECT block_hour, price, stddev(price) OVER (PARTITION BY block_hour) AS sd,
         avg(price) OVER (PARTITION BY block_hour) AS mean
  FROM direct WHERE asset = {NATIVE}),
coin_hour AS (
  SELECT block_hour, avg(CASE WHEN CASE WHEN abs(price - mean) > sd * 2 THEN 1 ELSE 0 END = 0 THEN price END) AS price
  FROM coin GROUP BY 1),
crossed AS (
  SELECT l.block_hour, l.asset,
         CASE WHEN l.asset = {ANCHOR} THEN 1 ELSE l.other_amt * c.price / NULLIF(l.amt, 0) END AS price, l.dex, l.amt
  FROM legs l LEFT JOIN coin_hour c ON l.block_hour = c.block_hour
  WHERE l.other = {NATIVE} AND l.asset <> {NATIVE}),
combo AS (SELECT * FROM direct UNION ALL SELECT * FROM crossed),
flagged AS (
  SELECT *, CASE WHEN abs(price - median(price) OVER (PARTITION BY asset, block_hour))
                      > median(price) OVER (PARTITION BY asset, block_hour) * 2 THEN 1 ELSE 0 END AS excluded
  FROM combo),
final_dex AS (
  SELECT block_hour, CAST(block_hour AS DATE) AS block_date, asset, dex,
         avg(CASE WHEN excluded = 0 THEN price END) AS avg_price, min(price) AS low, max(price) AS high,
         sum(CASE WHEN excluded = 0 THEN amt END) AS kept_amt, count(*) AS swaps, sum(amt) AS amt
  FROM flagged GROUP BY 1, 2, 3, 4),
weights AS (
  SELECT dex, asset, block_date, kept / sum(kept) OVER (PARTITION BY asset, block_date) AS vol_weight
  FROM (SELECT dex, asset, block_date, sum(kept_amt) AS kept FROM final_dex GROUP BY 1, 2, 3)),
thin AS (
  SELECT block_hour, asset FROM final_dex GROUP BY 1, 2
  HAVING sum(swaps) < {min_swaps} OR count(DISTINCT dex) < {min_venues}),
shares AS (SELECT *, swaps * 1.00 / sum(swaps) OVER (PARTITION BY block_hour, asset) AS hour_weight FROM final_dex),
priced AS (
  SELECT a.block_hour, a.asset, min(low) AS low, max(high) AS high, sum(swaps) AS swaps, sum(amt) AS volume,
         sum(avg_price * CASE WHEN c.asset IS NULL THEN vol_weight ELSE hour_weight END) AS price
  FROM shares a
  LEFT JOIN weights b ON a.asset = b.asset AND a.dex = b.dex AND a.block_date - 1 = b.block_date
  LEFT JOIN thin c ON a.asset = c.asset AND a.block_hour = c.block_hour
  GROUP BY a.block_hour, a.asset),
grid AS (
  SELECT h.hour, a.asset
  FROM (SELECT unnest(generate_series((SELECT min(block_hour) FROM closed), (SELECT max(block_hour) FROM closed),
                                      INTERVAL 1 HOUR)) AS hour) h
  CROSS JOIN (SELECT DISTINCT asset FROM priced) a),
filled AS (
  SELECT g.hour, g.asset, LAST_VALUE(p.price IGNORE NULLS) OVER (
           PARTITION BY g.asset ORDER BY g.hour ROWS UNBOUNDED PRECEDING) AS price_usd,
         p.low, p.high, p.swaps, p.volume * p.price AS volume
  FROM grid g LEFT JOIN priced p ON g.hour = p.block_hour AND g.asset = p.asset)
SELECT asset AS asset_id, hour, {_hu('price_usd')} AS price, {_hu('low')} AS min_price, {_hu('high')} AS max_price,
       {_hu('high - low')} AS volatility, CAST(swaps AS DOUBLE) AS swaps, {_hu('volume', 2)} AS volume
FROM filled WHERE price_usd IS NOT NULL
"""


def _trade_price(spark, sf_dir, params):
    out = P.price_from_trades(swaps(T(spark, sf_dir)), [ANCHOR], NATIVE, params)
    return out.select(F.col("asset").alias("asset_id"), "hour", S.round_half_up("price", 4).alias("price"),
                      S.round_half_up("min_price", 4).alias("min_price"),
                      S.round_half_up("max_price", 4).alias("max_price"),
                      S.round_half_up("volatility", 4).alias("volatility"),
                      F.col("swaps").cast("double").alias("swaps"), S.round_half_up("volume", 2).alias("volume"))


@register("price_from_trades", _trade_price_sql(20, 4))
def price_from_trades(spark, sf_dir):
    """Hourly price per asset in the anchor currency, direct or through the native coin, on
    dense filled hours."""
    return _trade_price(spark, sf_dir, P.TradePriceParams())


@register("agg_weighted_price", _trade_price_sql(2, 2))
def agg_weighted_price(spark, sf_dir):
    """Same chain with thresholds low enough that previous-day weights are used."""
    return _trade_price(spark, sf_dir, P.TradePriceParams(min_swaps=2, min_venues=2))


@register("agg_volatility", f"""
WITH {TRADES_SQL}
SELECT asset_id, CAST(date_trunc('month', ts) AS DATE) AS month,
       {_hu('max(price) - min(price)')} AS volatility, CAST(count(*) AS BIGINT) AS swaps
FROM trades GROUP BY 1, 2
""")
def agg_volatility(spark, sf_dir):
    tr = trades(T(spark, sf_dir))
    g = tr.groupBy("asset_id", F.trunc("ts", "month").alias("month")).agg(
        (F.max("price") - F.min("price")).alias("v"), F.count(F.lit(1)).alias("swaps"))
    return g.select("asset_id", "month", S.round_half_up("v", 4).alias("volatility"), "swaps")


@register("win_median_outlier", f"""
WITH {TRADES_SQL},
m AS (SELECT *, median(price) OVER (PARTITION BY asset_id, date_trunc('month', ts)) AS med FROM trades)
SELECT tx_id, intra, asset_id, {_hu('price')} AS price, {_hu('med')} AS median_price FROM m
WHERE NOT (abs(price - med) > 2.0 * med)
""")
def win_median_outlier(spark, sf_dir):
    """Median per (asset, month) attached to every trade; drop trades with
    abs(p - median) > 2 * median.  ``MEDIAN() OVER (PARTITION BY ...)`` is computed as
    the aggregate joined back on the bucket key (same values; a hot bucket is split by
    the skew-aware join instead of sitting in one window task)."""
    tr = trades(T(spark, sf_dir)).withColumn("month", F.trunc("ts", "month"))
    m = P.with_bucket_median(tr, ["asset_id", "month"], "price", "med")
    return m.where(~(F.abs(F.col("price") - F.col("med")) > 2.0 * F.col("med"))).select(
        "tx_id", "intra", "asset_id", S.round_half_up("price", 4).alias("price"),
        S.round_half_up("med", 4).alias("median_price"))


@register("win_stddev_trim", f"""
WITH {TRADES_SQL},
s AS (SELECT *, avg(price) OVER (PARTITION BY asset_id, date_trunc('month', ts)) AS a,
             stddev_samp(price) OVER (PARTITION BY asset_id, date_trunc('month', ts)) AS sd FROM trades)
SELECT tx_id, intra, asset_id, {_hu('price')} AS price, sd IS NULL AS single_trade FROM s
WHERE sd IS NULL OR abs(price - a) <= 2.0 * sd
""")
def win_stddev_trim(spark, sf_dir):
    """2-sigma trim per (asset, month); a single trade has a null std-dev and is kept.
    The windowed mean / sample std-dev are aggregates joined back on the bucket key."""
    tr = trades(T(spark, sf_dir)).withColumn("month", F.trunc("ts", "month"))
    s = P.with_bucket_stats(tr, ["asset_id", "month"], a=F.avg("price"), sd=F.stddev_samp("price"))
    return s.where(F.col("sd").isNull() | (F.abs(F.col("price") - F.col("a")) <= 2.0 * F.col("sd"))).select(
        "tx_id", "intra", "asset_id", S.round_half_up("price", 4).alias("price"),
        F.col("sd").isNull().alias("single_trade"))


# Fixed parameter: the as-of day to which reserves and prices are carried.
AS_OF = "2002-01-31"


@register("price_from_reserves", f"""
WITH li AS (SELECT 's' || CAST(l_suppkey AS VARCHAR) AS pool, CAST(l_shipdate AS DATE) AS date, l_linenumber,
                   CAST(round(l_extendedprice * (1.0 - l_discount) * 10000) AS BIGINT) AS native_units,
                   l_quantity AS token, l_extendedprice / l_quantity AS unit FROM lineitem),
legs AS (SELECT pool, date, 'native' AS asset, CAST(native_units AS DOUBLE) AS amount FROM li WHERE l_linenumber % 2 = 0
         UNION ALL SELECT pool, date, 'token', token FROM li WHERE l_linenumber % 2 = 1),
d AS (SELECT pool, asset, date, sum(amount) AS delta FROM legs GROUP BY 1, 2, 3),
r AS (SELECT pool, asset, date, sum(delta) OVER (PARTITION BY pool, asset ORDER BY date) AS balance FROM d),
spine AS (SELECT pool, asset, CAST(unnest(generate_series(min(date), GREATEST(max(date), DATE '{AS_OF}'), INTERVAL 1 DAY)) AS DATE) AS date
          FROM d GROUP BY pool, asset),
dense AS (SELECT s.pool, s.asset, s.date, LAST_VALUE(r.balance IGNORE NULLS) OVER (
            PARTITION BY s.pool, s.asset ORDER BY s.date ROWS UNBOUNDED PRECEDING) AS balance
          FROM spine s LEFT JOIN r ON s.pool = r.pool AND s.asset = r.asset AND s.date = r.date),
piv AS (SELECT pool, date, max(CASE WHEN asset = 'native' THEN balance END) / 10000.0 AS base_reserve,
               max(CASE WHEN asset = 'token' THEN balance END) AS quote_reserve
        FROM dense WHERE pool NOT IN (SELECT 's' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_acctbal < 0) GROUP BY 1, 2),
bp AS (SELECT date, avg(unit) / 1000.0 AS base_price FROM li GROUP BY 1),
p AS (SELECT piv.*, CASE WHEN round(quote_reserve) = 0 THEN 0.0 ELSE base_reserve / NULLIF(quote_reserve, 0) END AS price_in_base,
             bp.base_price
      FROM piv JOIN bp ON piv.date = bp.date WHERE base_reserve > 0 AND quote_reserve > 0)
SELECT pool, date, base_reserve, quote_reserve,
       {_hu('price_in_base', 6)} AS price_in_base, {_hu('price_in_base * base_price', 4)} AS price_usd
FROM p
""")
def price_from_reserves(spark, sf_dir):
    """Pool = supplier; its reserves are the native amount received on even lines and the goods
    quantity shipped on odd ones, so most days move one of them alone: both are dense daily
    balances up to the as-of day.  Suppliers in debt are the excluded pools.

    Amounts are carried in integer ten-thousandths, so reserve sums are exact whatever
    the summation order (a ratio can sit exactly on a rounding tie)."""
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_suppkey", "l_shipdate", "l_linenumber", "l_extendedprice", "l_discount", "l_quantity")
    name = lambda c: F.concat(F.lit("s"), F.col(c).cast("string"))
    units = F.round(F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount")) * 10000)
    native = F.col("l_linenumber") % 2 == 0
    legs = li.select(name("l_suppkey").alias("pool"), F.col("l_shipdate").alias("ts"),
                     F.when(native, "native").otherwise("token").alias("asset"),
                     F.when(native, units).otherwise(F.col("l_quantity")).alias("amount"))
    sums = ledger.period_sums(legs, ["pool", "asset"], F.to_date("ts"))
    # dealt by pool: balances, dense days and the two reserves of a day are then made where they are
    sums = sums.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "pool")
    dense = ledger.densify(ledger.running_balance(sums, ["pool", "asset"]), ["pool", "asset"], "day",
                           F.lit(AS_OF).cast("date"))
    bal = dense.withColumn("balance", F.when(F.col("asset") == "native", F.col("balance") / 10000.0)
                                       .otherwise(F.col("balance")))
    base = li.groupBy(F.to_date("l_shipdate").alias("date")).agg(
        (F.avg(F.col("l_extendedprice") / F.col("l_quantity")) / 1000.0).alias("base_price"))
    debt = t.supplier.where(F.col("s_acctbal") < 0).select(name("s_suppkey").alias("pool"))
    out = P.reserve_price(bal, "pool", "date", "asset", "native", "token", base, debt)
    return out.select("pool", "date", "base_reserve", "quote_reserve",
                      S.round_half_up("price_in_base", 6).alias("price_in_base"),
                      S.round_half_up("price_usd", 4).alias("price_usd"))


@register("price_impute", f"""
WITH t AS (SELECT p.p_brand AS brand, CAST(l.l_shipdate AS DATE) AS date,
                  avg(l.l_extendedprice / l.l_quantity) AS price
           FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1, 2),
g AS (SELECT brand, CAST(unnest(generate_series((SELECT min(date) FROM t), DATE '{AS_OF}', INTERVAL 1 DAY)) AS DATE) AS date
      FROM (SELECT DISTINCT brand FROM t)),
j AS (SELECT g.brand, g.date, t.price FROM g LEFT JOIN t ON g.brand = t.brand AND g.date = t.date),
f AS (SELECT brand, date, price IS NULL AS imputed,
             LAST_VALUE(price IGNORE NULLS) OVER (PARTITION BY brand ORDER BY date ROWS UNBOUNDED PRECEDING) AS price
      FROM j)
SELECT brand, date, {_hu('price')} AS price, imputed FROM f WHERE price IS NOT NULL
""")
def price_impute(spark, sf_dir):
    """Daily price per brand on the calendar that all brands share; gaps carry the last price,
    flagged."""
    t = T(spark, sf_dir)
    li = t.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice", "l_quantity")
    p = t.part.select("p_partkey", "p_brand")
    daily = li.join(p, li.l_partkey == p.p_partkey).groupBy(
        F.col("p_brand").alias("brand"), F.to_date("l_shipdate").alias("date")).agg(
        F.avg(F.col("l_extendedprice") / F.col("l_quantity")).alias("price"))
    filled = P.impute_on_grid(daily, ["brand"], "date", "price", F.lit(AS_OF).cast("date"), "1 DAY")
    return filled.select("brand", "date", S.round_half_up("price", 4).alias("price"), "imputed")
