"""Streaming and codec queries (O103, O144, O145, O148)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.address import address_table, decode_address, look_up, written
from ..session import scratch_path
from ..streaming import jobs
from . import register
from .common import LEGS_SQL, TRANSFERS_SQL, T, transactions, transfers

EVENT_SCHEMA = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double"
# Fixed parameters: first landing = events before the cut (with stale values), second
# landing = events from the re-read start on (overlapping the first by five days).
CUT, REREAD = "2024-01-20 00:00:00", "2024-01-15 00:00:00"


def _land(df, path):
    df.write.mode("append").parquet(path)


@register("stream_upsert", f"""
SELECT event_id, user_id,
       CASE WHEN ts >= TIMESTAMP '{REREAD}' THEN value ELSE floor(value) END AS value
FROM events
""")
def stream_upsert(spark, sf_dir):
    """Two landings processed as they arrive (two availableNow runs on one checkpoint);
    each micro-batch is merged by event id, rewriting only the event dates it touches."""
    e = T(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    landing, ckpt = scratch_path(spark, "landing-upsert"), scratch_path(spark, "ckpt-upsert")
    target = scratch_path(spark, "events-upserted")
    ts = F.col("ts")
    run = lambda: jobs.upsert_stream(
        spark, landing, EVENT_SCHEMA, ["event_id"], "ts", F.to_date("ts"), "event_date", target, ckpt)
    _land(e.where(ts < F.lit(CUT).cast("timestamp_ntz")).withColumn("value", F.floor("value").cast("double")),
          landing)
    run()
    _land(e.where(ts >= F.lit(REREAD).cast("timestamp_ntz")), landing)
    run()
    return spark.read.parquet(target).select("event_id", "user_id", "value")


@register("stream_dedup", """
SELECT event_id, ts, user_id FROM events
""")
def stream_dedup(spark, sf_dir):
    """Overlapping landings (a look-back re-read) deduplicated within a 7-day watermark."""
    e = T(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    landing, ckpt, sink = (scratch_path(spark, "landing-dedup"), scratch_path(spark, "ckpt-dedup"),
                           scratch_path(spark, "events-dedup"))
    ts = F.col("ts")
    _land(e.where(ts < F.lit(CUT).cast("timestamp_ntz")), landing)
    jobs.dedup_stream(spark, landing, EVENT_SCHEMA, ["event_id"], "ts", "7 days", sink, ckpt)
    _land(e.where(ts >= F.lit(REREAD).cast("timestamp_ntz")), landing)
    jobs.dedup_stream(spark, landing, EVENT_SCHEMA, ["event_id"], "ts", "7 days", sink, ckpt)
    return spark.read.parquet(sink).select("event_id", "ts", "user_id")


@register("stream_tumbling_hour", """
WITH h AS (SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n FROM events GROUP BY 1, 2)
SELECT window_start, window_start + INTERVAL 1 HOUR AS window_end, event_type, n FROM h
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR
""")
def stream_tumbling_hour(spark, sf_dir):
    """Append-mode hourly counts: only windows closed by the watermark (max event time -
    1 hour) are emitted, so the still-open newest buckets never appear."""
    e = T(spark, sf_dir).events.select("event_id", "ts", "user_id", "event_type", "value")
    landing, ckpt, sink = (scratch_path(spark, "landing-hourly"), scratch_path(spark, "ckpt-hourly"),
                           scratch_path(spark, "events-hourly"))
    _land(e, landing)
    jobs.hourly_counts_stream(spark, landing, EVENT_SCHEMA, "ts", "event_type", "1 hour", sink, ckpt)
    return spark.read.parquet(sink)


LEDGER_CUT = "1999-01-01 00:00:00"


@register("stream_running_balance", f"""
WITH {LEGS_SQL},
daily AS (SELECT address, CAST(ts AS DATE) AS date, SUM(amount) AS delta FROM legs GROUP BY 1, 2)
SELECT address, date, ROUND(SUM(delta) OVER (PARTITION BY address ORDER BY date), 4) AS balance
FROM daily
""")
def stream_running_balance(spark, sf_dir):
    """Ledger legs arrive in three landings that split days and come late (by the row's
    amount and time); each address's balances are redone from its first new day on.  Equals
    the batch rebuild.  The legs are made and written once; landings are read from there."""
    from ..operators import ledger
    legs = ledger.ledger_legs(transactions(T(spark, sf_dir)), ledger.default_legs()) \
                 .select("address", "ts", "amount")
    landing, ckpt = scratch_path(spark, "landing-legs"), scratch_path(spark, "ckpt-balance")
    out, state = scratch_path(spark, "balances"), scratch_path(spark, "balance-state")
    cut = F.lit(LEDGER_CUT).cast("timestamp_ntz")
    schema = "address string, ts timestamp_ntz, amount double"
    late = F.pmod(F.xxhash64("address", "ts", "amount"), F.lit(5)) == 0
    part = F.when(late, 2).when(F.col("ts") < cut, 0).when(F.col("ts") >= cut, 1)
    legs = written(legs.withColumn("landing", part))
    for n in range(3):
        _land(legs.where(F.col("landing") == n).drop("landing"), landing)
        jobs.running_balance_stream(spark, landing, schema, "address", "ts", "amount", out, state, ckpt)
    return jobs.current_balances(spark, out, ["address"]).select(
        "address", F.col("period").alias("date"), F.round("balance", 4).alias("balance"))


@register("encode_addresses", f"""
WITH {TRANSFERS_SQL}
SELECT tx_id, intra, upper(sha256(sender)) AS sender_key, 58 AS sender_length,
       upper(sha256(receiver)) AS receiver_key, 58 AS receiver_length
FROM transfers
""")
def encode_addresses_q(spark, sf_dir):
    """Public key per address (SHA-256 of the address text stands in for the key).  Each
    distinct key is encoded, and its address decoded back to the key, checksum included,
    once; the written table is joined to both legs of every transfer."""
    keyed = transfers(T(spark, sf_dir)).select("tx_id", "intra", "sender", "receiver")
    names = keyed.select(F.explode(F.array("sender", "receiver")).alias("name")).where("name IS NOT NULL").distinct()
    names = written(names.select("name", F.sha2("name", 256).alias("pk")))
    table = address_table(names, ["pk"]).withColumn("decoded", decode_address("address"))
    # transfers meet the table by the short name; of an address its length goes with them
    table = written(look_up(names, table, "pk", {"decoded": "decoded", "address": "address"})
                    .select(F.col("name").alias("key"), "decoded", F.length("address").alias("length")))
    for leg in ("sender", "receiver"):
        keyed = look_up(keyed, table, leg, {"decoded": f"{leg}_key", "length": f"{leg}_length"}).drop(leg)
    return keyed.select("tx_id", "intra", "sender_key", "sender_length", "receiver_key", "receiver_length")
