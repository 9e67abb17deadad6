"""Scalar-function queries (O86-O107): null handling, CASE, math, casts, keys, text, dates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import scalars as S
from . import register
from .common import T


@register("fn_null_handling", """
SELECT d.doc_id,
       CAST(COALESCE(l.quality, -1) AS INTEGER) AS quality_or_unknown,
       CAST(IFNULL(l.toxic, 0) AS INTEGER) AS toxic_or_zero,
       CAST(COALESCE(l.quality, 0) AS INTEGER) AS quality_zero,
       NULLIF(d.lang, 'en') AS lang_not_en
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def fn_null_handling(spark, sf_dir):
    t = T(spark, sf_dir)
    d = t.documents.select("doc_id", "lang")
    lab = t.labels.select("doc_id", "quality", "toxic")
    j = d.join(lab, "doc_id", "left")
    return j.select(
        "doc_id",
        F.coalesce("quality", F.lit(-1)).alias("quality_or_unknown"),
        F.ifnull("toxic", F.lit(0)).alias("toxic_or_zero"),
        F.zeroifnull("quality").cast("int").alias("quality_zero"),
        F.nullif("lang", F.lit("en")).alias("lang_not_en"),
    )


@register("fn_case", """
SELECT p_partkey,
       CASE WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium' ELSE 'large' END AS size_class,
       CASE p_type WHEN 'ECONOMY' THEN 'eco' WHEN 'STANDARD' THEN 'std' ELSE lower(p_type) END AS type_code
FROM part
""")
def fn_case(spark, sf_dir):
    p = T(spark, sf_dir).part
    return p.select(
        "p_partkey",
        F.when(F.col("p_size") <= 10, "small").when(F.col("p_size") <= 30, "medium")
         .otherwise("large").alias("size_class"),
        F.when(F.col("p_type") == "ECONOMY", "eco").when(F.col("p_type") == "STANDARD", "std")
         .otherwise(F.lower("p_type")).alias("type_code"),
    )


@register("fn_decimal_scale", """
SELECT p_partkey AS asset_id, CAST(p_size % 7 AS INTEGER) AS decimals,
       ROUND(CASE WHEN p_partkey = 0 THEN CAST(ROUND(p_retailprice * 1000000) AS BIGINT) / 1e6
                  WHEN p_size % 7 > 0 THEN CAST(ROUND(p_retailprice * 1000000) AS BIGINT) / pow(10, p_size % 7)
                  ELSE CAST(ROUND(p_retailprice * 1000000) AS BIGINT) END, 6) AS amount
FROM part
""")
def fn_decimal_scale(spark, sf_dir):
    p = T(spark, sf_dir).part
    raw = F.round(F.col("p_retailprice") * 1000000).cast("long")
    return p.select(
        F.col("p_partkey").alias("asset_id"),
        (F.col("p_size") % 7).alias("decimals"),
        F.round(S.scale_amount(raw, F.col("p_size") % 7, F.col("p_partkey")), 6).alias("amount"),
    )


@register("fn_math", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       ROUND(pow(l_discount, 2), 6) AS disc_sq,
       ROUND(abs(l_tax - l_discount), 6) AS tax_gap,
       ROUND(l_extendedprice / 3, 2) AS third,
       greatest(l_quantity, l_tax * 100) AS biggest
FROM lineitem
""")
def fn_math(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select(
        "l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "l_partkey",
        F.round(F.pow("l_discount", 2), 6).alias("disc_sq"),
        F.round(F.abs(F.col("l_tax") - F.col("l_discount")), 6).alias("tax_gap"),
        F.round(F.col("l_extendedprice") / 3, 2).alias("third"),
        F.greatest("l_quantity", F.col("l_tax") * 100).alias("biggest"),
    )


@register("fn_safe_div", """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
       ROUND(l_extendedprice / NULLIF(l_tax, 0), 4) AS price_per_tax
FROM lineitem
""")
def fn_safe_div(spark, sf_dir):
    li = T(spark, sf_dir).lineitem
    return li.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"),
                     "l_partkey",
                     F.round(S.safe_div("l_extendedprice", "l_tax"), 4).alias("price_per_tax"))


@register("fn_try_cast", """
SELECT p_partkey,
       TRY_CAST(regexp_extract(p_brand, '#(.*)$', 1) AS INTEGER) AS brand_no,
       TRY_CAST(p_name AS INTEGER) IS NOT NULL AS name_is_int
FROM part
""")
def fn_try_cast(spark, sf_dir):
    p = T(spark, sf_dir).part
    return p.select("p_partkey",
                    F.regexp_extract("p_brand", "#(.*)$", 1).try_cast("int").alias("brand_no"),
                    F.col("p_name").try_cast("int").isNotNull().alias("name_is_int"))


@register("fn_casts", """
SELECT CAST(o_orderkey AS INTEGER) AS key_int,
       CAST(CAST(o_orderkey AS VARCHAR) AS BIGINT) AS key_roundtrip,
       CAST(o_custkey AS DOUBLE) AS cust_double,
       CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS DOUBLE) AS total_dec,
       CAST(o_orderdate AS DATE) AS order_date,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_ts,
       CAST(CASE WHEN o_orderstatus = 'F' THEN 'true' ELSE 'false' END AS BOOLEAN) AS is_final,
       CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_no
FROM orders
""")
def fn_casts(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.select(
        F.col("o_orderkey").cast("int").alias("key_int"),
        F.col("o_orderkey").cast("string").cast("long").alias("key_roundtrip"),
        F.col("o_custkey").cast("double").alias("cust_double"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("double").alias("total_dec"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderdate").cast("date").cast("timestamp_ntz").alias("order_ts"),
        F.when(F.col("o_orderstatus") == "F", "true").otherwise("false").cast("boolean").alias("is_final"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_no"),
    )


@register("fn_surrogate_key", """
SELECT o_orderkey,
       md5(concat_ws('-', COALESCE(CAST(o_orderkey AS VARCHAR), ''),
                          COALESCE(CAST(o_custkey AS VARCHAR), ''),
                          COALESCE(CAST(NULLIF(o_orderstatus, 'P') AS VARCHAR), ''))) AS fact_order_id,
       md5('pay') AS type_key
FROM orders
""")
def fn_surrogate_key(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.select("o_orderkey",
                    S.surrogate_key("o_orderkey", "o_custkey",
                                    F.nullif("o_orderstatus", F.lit("P"))).alias("fact_order_id"),
                    F.md5(F.lit("pay")).alias("type_key"))


@register("fn_concat_key", """
SELECT o_orderkey,
       CASE WHEN NULLIF(o_orderstatus, 'P') IS NOT NULL
            THEN concat_ws('-', CAST(o_orderkey AS VARCHAR), NULLIF(o_orderstatus, 'P')) END AS _unique_key,
       CAST(o_custkey AS VARCHAR) || '--' || o_orderpriority AS pair_key
FROM orders
""")
def fn_concat_key(spark, sf_dir):
    o = T(spark, sf_dir).orders
    return o.select("o_orderkey",
                    S.concat_ws_strict("-", "o_orderkey", F.nullif("o_orderstatus", F.lit("P")))
                     .alias("_unique_key"),
                    F.concat(F.col("o_custkey").cast("string"), F.lit("--"), F.col("o_orderpriority"))
                     .alias("pair_key"))


@register("fn_substr", """
SELECT p_partkey, left(p_name, 3) AS head3, right(p_name, 4) AS tail4,
       substr(p_name, 1, 4) AS from_zero, substr(p_type, 2) AS type_rest
FROM part
""")
def fn_substr(spark, sf_dir):
    p = T(spark, sf_dir).part
    return p.select("p_partkey", F.left("p_name", F.lit(3)).alias("head3"),
                    F.right("p_name", F.lit(4)).alias("tail4"),
                    # start 0 behaves like 1 (reference dialect and Spark agree)
                    F.expr("substr(p_name, 0, 4)").alias("from_zero"),
                    F.expr("substring(p_type, 2)").alias("type_rest"))


@register("fn_regexp", """
SELECT page_id,
       regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
       regexp_extract(url, '/([a-z][a-z])/', 1) AS lang,
       CAST(TRY_CAST(NULLIF(regexp_extract(url, 'page=([0-9]+)', 1), '') AS INTEGER) AS DOUBLE) AS page_no,
       CASE WHEN regexp_matches(url, '[0-9]') THEN strpos(url, regexp_extract(url, '[0-9]')) ELSE 0 END
         AS first_digit_at,
       CASE WHEN regexp_matches(substr(url, 10), '[0-9]')
            THEN strpos(substr(url, 10), regexp_extract(substr(url, 10), '[0-9]')) + 9 ELSE 0 END
         AS first_digit_from_10,
       CAST(length(html) AS BIGINT) AS html_chars
FROM pages
""")
def fn_regexp(spark, sf_dir):
    """Title text mining over whole pages (O96, O130)."""
    p = T(spark, sf_dir).pages
    return p.select(
        "page_id",
        F.regexp_extract("html", "<title>([^<]*)</title>", 1).alias("title"),
        F.regexp_extract("url", "/([a-z][a-z])/", 1).alias("lang"),
        F.nullif(F.regexp_extract("url", "page=([0-9]+)", 1), F.lit("")).try_cast("int").cast("double")
         .alias("page_no"),
        F.regexp_instr("url", F.lit("[0-9]")).alias("first_digit_at"),
        S.regexp_instr_from("url", "[0-9]", 10).alias("first_digit_from_10"),
        F.length("html").cast("long").alias("html_chars"),
    )


@register("fn_split_replace", """
SELECT page_id, split_part(url, '/', 3) AS host, replace(url, 'http://', '') AS bare,
       split_part(split_part(url, '?', 2), '&', 1) AS first_param
FROM pages
""")
def fn_split_replace(spark, sf_dir):
    p = T(spark, sf_dir).pages
    return p.select("page_id", F.split_part("url", F.lit("/"), F.lit(3)).alias("host"),
                    F.replace("url", F.lit("http://"), F.lit("")).alias("bare"),
                    F.split_part(F.split_part("url", F.lit("?"), F.lit(2)), F.lit("&"), F.lit(1))
                     .alias("first_param"))


@register("fn_concat_label", """
SELECT p_partkey, p_brand || ' - ' || p_type || ' (' || CAST(p_size AS VARCHAR) || ')' AS label,
       p_name || NULLIF(p_type, 'ECONOMY') AS name_type
FROM part
""")
def fn_concat_label(spark, sf_dir):
    p = T(spark, sf_dir).part
    return p.select("p_partkey",
                    F.concat("p_brand", F.lit(" - "), "p_type", F.lit(" ("),
                             F.col("p_size").cast("string"), F.lit(")")).alias("label"),
                    F.concat("p_name", F.nullif("p_type", F.lit("ECONOMY"))).alias("name_type"))


@register("fn_base64_text", """
SELECT doc_id, md5(text) AS text_md5,
       md5(decode(from_base64(to_base64(encode(text))))) AS decoded_md5,
       CAST(length(decode(from_base64(to_base64(encode(text))))) AS BIGINT) AS decoded_chars
FROM documents
""")
def fn_base64_text(spark, sf_dir):
    """Whole documents to base64 and back through the null-safe decoder (O100)."""
    d = T(spark, sf_dir).documents.select("doc_id", "text")
    decoded = S.b64_text(F.base64(F.encode("text", "UTF-8")))
    return d.select("doc_id", F.md5("text").alias("text_md5"),
                    F.md5(decoded).alias("decoded_md5"),
                    F.length(decoded).cast("long").alias("decoded_chars"))


@register("fn_base64_bytes", """
SELECT doc_id, hex(from_base64(to_base64(unhex(lpad(hex(doc_id % 16), 2, '0'))))) AS byte_hex,
       hex(from_base64(to_base64(unhex(lpad(hex(doc_id % 16), 2, '0'))))) = '03' AS is_03
FROM documents
""")
def fn_base64_bytes(spark, sf_dir):
    d = T(spark, sf_dir).documents.select("doc_id")
    one_byte = F.unhex(F.lpad(F.hex(F.col("doc_id") % 16), 2, "0"))
    hx = S.b64_hex(F.base64(one_byte))
    return d.select("doc_id", hx.alias("byte_hex"), (hx == "03").alias("is_03"))


@register("fn_hex_text", """
SELECT doc_id, hex(source) AS source_hex, decode(unhex(hex(source))) AS source_back
FROM documents
""")
def fn_hex_text(spark, sf_dir):
    d = T(spark, sf_dir).documents.select("doc_id", "source")
    h = F.hex(F.encode("source", "UTF-8"))
    return d.select("doc_id", h.alias("source_hex"), S.hex_text(h).alias("source_back"))


@register("fn_epoch_millis", """
SELECT event_id, epoch_us(ts) // 1000 AS load_ms,
       make_timestamp((epoch_us(ts) // 1000) * 1000) AS _inserted_timestamp
FROM events
""")
def fn_epoch_millis(spark, sf_dir):
    e = T(spark, sf_dir).events.select("event_id", "ts")
    ms = S.epoch_millis("ts")
    return e.select("event_id", ms.alias("load_ms"), S.from_epoch_millis(ms).alias("_inserted_timestamp"))


@register("fn_date_math", """
SELECT o_orderkey,
       CAST(o_orderdate AS DATE) + 1 AS next_day,
       CAST(o_orderdate AS DATE) - 7 AS week_before,
       CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS BIGINT) AS days_to_2002,
       o_orderdate - INTERVAL 4 HOUR AS lookback_4h,
       CAST(o_orderdate AS DATE) - INTERVAL 2 DAY AS lookback_2d
FROM orders
""")
def fn_date_math(spark, sf_dir):
    o = T(spark, sf_dir).orders.select("o_orderkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    return o.select(
        "o_orderkey", F.date_add(d, 1).alias("next_day"), F.date_sub(d, 7).alias("week_before"),
        F.datediff(F.lit("2002-01-01").cast("date"), d).cast("long").alias("days_to_2002"),
        (F.col("o_orderdate") - F.expr("INTERVAL 4 HOURS")).alias("lookback_4h"),
        (d.cast("timestamp_ntz") - F.expr("INTERVAL 2 DAYS")).alias("lookback_2d"),
    )


@register("fn_date_trunc", """
SELECT event_id, date_trunc('hour', ts) AS block_hour, date_trunc('day', ts) AS block_day,
       CAST(date_trunc('month', ts) AS TIMESTAMP) AS block_month
FROM events
""")
def fn_date_trunc(spark, sf_dir):
    e = T(spark, sf_dir).events.select("event_id", "ts")
    return e.select("event_id", S.trunc_ts("hour", "ts").alias("block_hour"),
                    S.trunc_ts("day", "ts").alias("block_day"),
                    S.trunc_ts("month", "ts").alias("block_month"))


@register("fn_calendar_parts", """
SELECT event_id,
       CAST(hour(ts) AS BIGINT) AS block_hour, CAST(minute(ts) AS BIGINT) AS block_minute,
       CAST(weekofyear(ts) AS BIGINT) AS block_week, CAST(month(ts) AS BIGINT) AS block_month,
       CAST(quarter(ts) AS BIGINT) AS block_quarter, CAST(year(ts) AS BIGINT) AS block_year,
       CAST(dayofmonth(ts) AS BIGINT) AS block_day_of_month,
       CAST(dayofweek(ts) AS BIGINT) AS block_day_of_week,
       CAST(dayofyear(ts) AS BIGINT) AS block_day_of_year
FROM events
""")
def fn_calendar_parts(spark, sf_dir):
    e = T(spark, sf_dir).events.select("event_id", "ts")
    parts = {
        "block_hour": F.hour("ts"), "block_minute": F.minute("ts"), "block_week": F.weekofyear("ts"),
        "block_month": F.month("ts"), "block_quarter": F.quarter("ts"), "block_year": F.year("ts"),
        "block_day_of_month": F.dayofmonth("ts"), "block_day_of_week": S.dow0("ts"),
        "block_day_of_year": F.dayofyear("ts"),
    }
    return e.select("event_id", *[c.cast("long").alias(n) for n, c in parts.items()])
