"""Semi-structured queries (O109-O117).  The driver tables carry no nested payloads, so each
query builds its JSON text from table columns (``to_json(struct(...))``) and reads it back
through VARIANT; the oracle builds the same document with DuckDB's JSON functions."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import jsonx as J
from . import register
from .common import T


@register("json_path", """
WITH p AS (SELECT o_orderkey,
                  json_object('txn', json_object('type', o_orderstatus, 'snd', o_custkey, 'amt', o_totalprice),
                              'quoted-key', o_orderpriority) AS j FROM orders)
SELECT o_orderkey, json_extract_string(j, '$.txn.type') AS tx_type,
       CAST(json_extract(j, '$.txn.snd') AS BIGINT) AS sender,
       CAST(json_extract(j, '$.txn.amt') AS DOUBLE) AS amount,
       json_extract_string(j, '$."quoted-key"') AS quoted
FROM p
""")
def json_path(spark, sf_dir):
    o = T(spark, sf_dir).orders
    text = F.to_json(F.struct(
        F.struct(F.col("o_orderstatus").alias("type"), F.col("o_custkey").alias("snd"),
                 F.col("o_totalprice").alias("amt")).alias("txn"),
        F.col("o_orderpriority").alias("quoted-key")))
    v = o.select("o_orderkey", F.parse_json(text).alias("v"))
    return v.select("o_orderkey", J.get("v", "$.txn.type").alias("tx_type"),
                    J.get("v", "$.txn.snd", "bigint").alias("sender"),
                    J.get("v", "$.txn.amt", "double").alias("amount"),
                    J.get("v", '$["quoted-key"]').alias("quoted"))


# Fixed value: base64 text of 'click', compared against the first call argument.
CLICK_B64 = "Y2xpY2s="


@register("json_array_index", f"""
WITH p AS (SELECT event_id,
                  json_object('itx', json_array(json_object('txn', json_object('type', event_type, 'amt', value)),
                                                json_object('txn', json_object('type', 'pay', 'amt', user_id))),
                              'apaa', json_array(to_base64(encode(event_type)))) AS j FROM events)
SELECT event_id, json_extract_string(j, '$.itx[0].txn.type') AS first_type,
       CAST(json_extract(j, '$.itx[1].txn.amt') AS BIGINT) AS second_amt,
       json_extract_string(j, '$.apaa[0]') = '{CLICK_B64}' AS is_click
FROM p
""")
def json_array_index(spark, sf_dir):
    e = T(spark, sf_dir).events
    itx = F.array(F.struct(F.struct(F.col("event_type").alias("type"), F.col("value").alias("amt")).alias("txn")),
                  F.struct(F.struct(F.lit("pay").alias("type"), F.col("user_id").cast("double").alias("amt"))
                           .alias("txn")))
    text = F.to_json(F.struct(itx.alias("itx"), F.array(F.base64(F.encode("event_type", "UTF-8"))).alias("apaa")))
    v = e.select("event_id", F.parse_json(text).alias("v"))
    return v.select("event_id", J.get("v", "$.itx[0].txn.type").alias("first_type"),
                    J.get("v", "$.itx[1].txn.amt", "bigint").alias("second_amt"),
                    (J.get("v", "$.apaa[0]") == CLICK_B64).alias("is_click"))


@register("json_try_parse", """
WITH p AS (SELECT event_id, CASE WHEN event_type = 'error' THEN replace(props, '}', '') ELSE props END AS txt
           FROM events)
SELECT event_id, json_valid(txt) AS valid,
       CASE WHEN json_valid(txt) THEN json_extract_string(txt, '$.k') END AS k
FROM p
""")
def json_try_parse(spark, sf_dir):
    """TRY_PARSE_JSON: malformed text (error events lose their closing brace) -> null, no
    failure.  (A stray trailing brace would not do: the parser stops after one value.)"""
    e = T(spark, sf_dir).events
    txt = F.when(F.col("event_type") == "error", F.replace("props", F.lit("}"), F.lit(""))) \
           .otherwise(F.col("props"))
    v = e.select("event_id", F.try_parse_json(txt).alias("v"))
    return v.select("event_id", F.col("v").isNotNull().alias("valid"), J.get("v", "$.k").alias("k"))


def _params_json(outer: bool):
    q = F.split_part("url", F.lit("?"), F.lit(2))
    arr = F.split(q, "&")
    if outer:
        arr = F.when(F.col("url").contains("?"), arr).otherwise(F.array().cast("array<string>"))
    return F.parse_json(F.to_json(arr))


@register("json_explode", """
WITH p AS (SELECT page_id, string_split(split_part(url, '?', 2), '&') AS arr FROM pages WHERE url LIKE '%?%')
SELECT page_id, CAST(i - 1 AS INTEGER) AS pos, arr[i] AS param
FROM (SELECT page_id, arr, unnest(generate_series(1, len(arr))) AS i FROM p)
""")
def json_explode(spark, sf_dir):
    p = T(spark, sf_dir).pages.where(F.col("url").contains("?")).select("page_id", _params_json(False).alias("arr"))
    x = J.explode(p, "arr")
    return x.select("page_id", "pos", F.variant_get("value", "$", "string").alias("param"))


@register("json_explode_outer", """
WITH p AS (SELECT page_id, CASE WHEN url LIKE '%?%' THEN string_split(split_part(url, '?', 2), '&')
                                ELSE [] END AS arr FROM pages),
e AS (SELECT page_id, arr, unnest(CASE WHEN len(arr) = 0 THEN [NULL] ELSE generate_series(1, len(arr)) END) AS i
      FROM p)
SELECT page_id, CAST(i - 1 AS DOUBLE) AS pos, arr[i] AS param FROM e
""")
def json_explode_outer(spark, sf_dir):
    """FLATTEN(OUTER => TRUE): pages without query parameters keep one row of nulls."""
    p = T(spark, sf_dir).pages.select("page_id", _params_json(True).alias("arr"))
    x = J.explode(p, "arr", outer=True)
    # pos is null on kept empty rows; carried as DOUBLE so a null renders the same everywhere
    return x.select("page_id", F.col("pos").cast("double").alias("pos"),
                    F.variant_get("value", "$", "string").alias("param"))


@register("json_explode_object", """
WITH j AS (SELECT event_id, json_object('props', json(props),
                                        'meta', json_object('type', event_type, 'user', user_id)) AS p FROM events),
k1 AS (SELECT event_id, p, unnest(json_keys(p)) AS k1 FROM j),
k2 AS (SELECT event_id, p, k1, unnest(json_keys(json_extract(p, '$.' || k1))) AS k2 FROM k1)
SELECT event_id, k1 AS outer_key, k2 AS inner_key, json_extract_string(p, '$.' || k1 || '.' || k2) AS value
FROM k2
""")
def json_explode_object(spark, sf_dir):
    """Two chained FLATTENs of an object of objects: (outer key, inner key, value)."""
    e = T(spark, sf_dir).events
    text = F.to_json(F.struct(F.from_json("props", "k BIGINT").alias("props"),
                              F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"))
                               .alias("meta")))
    v = e.select("event_id", F.parse_json(text).alias("v"))
    lvl1 = J.explode(v, "v").select("event_id", F.col("key").alias("outer_key"), F.col("value").alias("obj"))
    lvl2 = J.explode(lvl1, "obj")
    return lvl2.select("event_id", "outer_key", F.col("key").alias("inner_key"),
                       F.variant_get("value", "$", "string").alias("value"))


@register("json_explode_recursive", """
WITH nodes AS (
  SELECT o_orderkey AS tx_id, '' AS path, 'appl' AS tx_type, NULL::DOUBLE AS amount FROM orders
  UNION ALL
  SELECT o_orderkey, 'dt.itx[0]', 'pay', o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')
  UNION ALL
  SELECT o_orderkey, 'dt.itx[1]', 'axfer', NULL FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, 'dt.itx[1].dt.itx[0]', 'pay', CAST(o_custkey AS DOUBLE) FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey, substr(repeat('.dt.itx[0]', CAST(k AS INTEGER)), 2),
         CASE WHEN k < 1 + o_custkey % 13 THEN 'axfer' ELSE 'pay' END,
         CASE WHEN k < 1 + o_custkey % 13 THEN NULL ELSE CAST(k AS DOUBLE) END
  FROM orders, unnest(generate_series(1, 1 + o_custkey % 13)) AS s(k) WHERE o_orderstatus = 'P')
SELECT tx_id, path, tx_type, amount, path <> '' AS inner_tx,
       row_number() OVER (PARTITION BY tx_id ORDER BY path) - 1 AS intra_offset
FROM nodes
""")
def json_explode_recursive(spark, sf_dir):
    """Outer transaction plus every nested inner transaction, numbered by path text
    (reference order: 'dt.itx[10]' sorts before 'dt.itx[2]').  Orders of status P hold a
    chain of 1 to 13 transactions, one inside the other."""
    o = T(spark, sf_dir).orders

    def txn(kind, amt=None):
        return F.struct(F.lit(kind).alias("type"),
                        (amt if amt is not None else F.lit(None)).cast("double").alias("amt")).alias("txn")

    deep = F.struct(txn("pay", F.col("o_custkey")))
    no_kids = F.lit(None).cast("struct<itx:array<struct<txn:struct<type:string,amt:double>>>>")
    leaf_pay = F.struct(txn("pay", F.col("o_totalprice")), no_kids.alias("dt"))
    axfer = F.struct(txn("axfer"), F.struct(F.array(deep).alias("itx")).alias("dt"))
    kids = F.when(F.col("o_orderstatus") == "F", F.array(leaf_pay, axfer)) \
            .when(F.col("o_orderstatus") == "O", F.array(leaf_pay))
    root = F.struct(txn("appl"), F.when(kids.isNotNull(), F.struct(kids.alias("itx"))).alias("dt"))
    links = (F.col("o_custkey") % 13).cast("int")
    chain = F.concat(F.repeat(F.lit('{"txn":{"type":"axfer"},"dt":{"itx":['), links),
                     F.lit('{"txn":{"type":"pay","amt":'), (links + 1).cast("string"), F.lit("}}"),
                     F.repeat(F.lit("]}}"), links))
    # null fields are left out of the JSON text
    text = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit('{"txn":{"type":"appl"},"dt":{"itx":['), chain, F.lit("]}}"))) \
            .otherwise(F.to_json(root))
    v = o.select(F.col("o_orderkey").alias("tx_id"), F.parse_json(text).alias("v"))
    nodes = J.explode_recursive(v, "v", ["tx_id"], {"tx_type": ("$.txn.type", "string"),
                                                    "amount": ("$.txn.amt", "double")})
    typed = nodes.where(F.col("tx_type").isNotNull())
    w = Window.partitionBy("tx_id").orderBy("path")
    return typed.select("tx_id", "path", "tx_type", "amount", (F.col("path") != "").alias("inner_tx"),
                        (F.row_number().over(w) - 1).cast("long").alias("intra_offset"))


@register("json_presence", """
WITH p AS (SELECT o_orderkey, CASE o_orderstatus WHEN 'O' THEN '{"close": null}'
                                             WHEN 'F' THEN json_object('close', o_custkey)::VARCHAR
                                             ELSE '{}' END AS j FROM orders)
SELECT o_orderkey, json_extract(j, '$.close') IS NOT NULL AS has_close,
       COALESCE(json_type(j, '$.close') = 'NULL', false) AS close_is_null,
       json_extract_string(j, '$.close') AS close_to
FROM p
""")
def json_presence(spark, sf_dir):
    """Missing key, JSON null and a value are three different states."""
    o = T(spark, sf_dir).orders
    text = F.when(F.col("o_orderstatus") == "O", F.lit('{"close": null}')) \
            .when(F.col("o_orderstatus") == "F", F.to_json(F.struct(F.col("o_custkey").alias("close")))) \
            .otherwise(F.lit("{}"))
    v = o.select("o_orderkey", F.parse_json(text).alias("v"))
    return v.select("o_orderkey", J.present("v", "$.close").alias("has_close"),
                    J.is_json_null("v", "$.close").alias("close_is_null"),
                    J.get("v", "$.close").alias("close_to"))
