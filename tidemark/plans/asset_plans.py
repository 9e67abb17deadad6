"""Asset jobs over the driver tables: title mining, the asset master, the catalogue merge.

Stand-ins (all rows of the tables):

* upload    = one lineitem: metadata of asset ``l_partkey``, as JSON text with a title in it.
* asset     = one part; every seventh is deleted (its parameters are gone).
* configuration change = one lineitem of its part, some of them incomplete.
* collection list = one urgent order, its lines as entries.
* note      = one lineitem's base64 text: the standard, another one, no JSON or no base64.
* catalogues: suppliers (addresses are part numbers) and customers (lists of addresses).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assets as A
from . import register
from .common import T

TITLE_UPLOADS_SQL = """
uploads AS (
  SELECT l_partkey AS asset_id,
         CASE WHEN l_partkey % 97 = 0 THEN 'test' ELSE 'D' END || lpad(CAST(l_partkey % 6 AS VARCHAR), 2, '0') || '-'
           || lpad(CAST(l_partkey * 7 % 60 AS VARCHAR), 2, '0') AS asset_name,
         'ipfs://a/' || CAST(l_partkey AS VARCHAR) AS asset_url,
         'ipfs://m/' || CAST(l_orderkey AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS metadata_url,
         'Moment ' || CAST(l_linenumber AS VARCHAR)
           || CASE WHEN l_linenumber = 2 THEN '' ELSE ' (' || CAST(l_partkey % 900 + 100 AS VARCHAR) || ' Editions)' END AS name,
         CASE WHEN l_partkey % 4 = 0
              THEN 'Open Womens World Cup NATION_' || CAST(l_suppkey % 25 AS VARCHAR) || ' ' || CAST(1991 + l_suppkey % 30 AS VARCHAR)
              ELSE CAST(1930 + l_suppkey % 70 AS VARCHAR) || ' Open World Cup NATION_' || CAST(l_suppkey % 25 AS VARCHAR) END || '™'
         || CASE WHEN l_linenumber = 6 THEN ' Trophy' ELSE
              ' ' || chr(CAST(65 + l_suppkey % 26 AS INTEGER)) || 'RG ' || CAST(l_orderkey % 10 AS VARCHAR) || ' - '
              || CAST(l_partkey % 10 AS VARCHAR) || ' BR' || chr(CAST(65 + l_orderkey % 26 AS INTEGER))
              || CASE WHEN l_linenumber = 7 THEN ', **Final Whistle**' ELSE
                   ', **' || CASE l_returnflag WHEN 'A' THEN 'Goal' WHEN 'N' THEN 'Save' ELSE 'Free Kick' END || ': '
                   || CASE l_linestatus WHEN 'F' THEN 'Ana Lima' ELSE 'Núria Okoro' END || ' '
                   || CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) || '''**' END END AS description
  FROM lineitem)"""

_TITLES_SQL = f"""
{TITLE_UPLOADS_SQL},
one AS (
  SELECT * FROM uploads WHERE asset_name NOT LIKE 'test%'
  QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY name, description, metadata_url) = 1),
marks AS (
  SELECT *, description LIKE '%Womens World Cup%' AS womens, strpos(description, '™') AS tm, strpos(description, '-') AS dash,
         strpos(description, ',') AS comma, strpos(description, ':') AS colon, CAST(asset_name[2:3] AS INTEGER) AS drop_number,
         substr(asset_name, strpos(asset_name, '-') + 1, 2) AS item_no
  FROM one),
places AS (
  SELECT *, substr(description, dash - 6, 13) AS teams, substr(description, colon + 2) AS said FROM marks),
titles AS (
  SELECT asset_id AS nft_asset_id, asset_name AS nft_asset_name, asset_url AS nft_url, metadata_url,
    'https://v/' || CAST(asset_id AS VARCHAR) AS animation_url, 'video/mp4' AS animation_url_mimetype, description,
    'https://x' AS external_url, 'text/html' AS external_url_mimetype, 'ipfs://i/' || CAST(asset_id AS VARCHAR) AS image,
    'sha256-' || CAST(asset_id AS VARCHAR) AS image_integrity, 'image/png' AS image_mimetype, name, 'true' AS rekey_checked,
    CAST(asset_id + 1000 AS VARCHAR) AS application_id, drop_number,
    CASE drop_number WHEN 1 THEN 'genesis' WHEN 2 THEN 'archives' WHEN 3 THEN 'south american flair'
                     WHEN 4 THEN 'archives 2' WHEN 5 THEN '80s-90s' END AS drop_name,
    item_no,
    CASE WHEN strpos(name, '(') > 0 THEN substr(name, strpos(name, '(') + 1, strpos(name, ')') - strpos(name, '(') - 10)
         ELSE '' END AS editions,
    CASE WHEN drop_number = 0 THEN NULL
         WHEN CAST(item_no AS INTEGER) < CASE drop_number WHEN 1 THEN 3 WHEN 2 THEN 2 WHEN 4 THEN 2 ELSE 4 END THEN 'Iconic'
         WHEN CAST(item_no AS INTEGER) < CASE drop_number WHEN 1 THEN 9 WHEN 2 THEN 6 WHEN 4 THEN 6 ELSE 13 END THEN 'Epic'
         WHEN CAST(item_no AS INTEGER) < CASE drop_number WHEN 1 THEN 22 WHEN 2 THEN 18 WHEN 4 THEN 18 ELSE 31 END THEN 'Rare'
         ELSE 'Common' END AS rarity,
    CASE WHEN womens THEN 'Womens' ELSE 'Mens' END AS world_cup_type,
    CASE WHEN womens THEN regexp_extract(description, '[1-2][0-9][0-9][0-9]') ELSE substr(description, 1, 4) END AS year,
    CASE WHEN womens THEN substr(description, 22, tm - 27) ELSE substr(description, 20, tm - 20) END AS host,
    left(teams, 3) AS country_1, substr(teams, 5, 1) AS country_1_score, right(teams, 3) AS country_2,
    substr(teams, 9, 1) AS country_2_score,
    CASE WHEN colon > comma + 4 THEN substr(description, comma + 4, colon - comma - 4) ELSE '' END AS event_type,
    CASE WHEN colon > 0 THEN substr(said, 1, strpos(said, regexp_extract(said, '[0-9]')) - 1) END AS player,
    CASE WHEN colon > 0 THEN replace(substr(said, strpos(said, regexp_extract(said, ' [0-9]')), 10), '**', '') END AS minute
  FROM places)"""


def title_uploads(t):
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag", "l_linestatus")
    part, order, supp, line = (F.col(c) for c in ("l_partkey", "l_orderkey", "l_suppkey", "l_linenumber"))

    def text(c):
        return c.cast("string")

    def two(c):
        return F.lpad(text(c), 2, "0")

    place = F.concat(F.lit("NATION_"), text(supp % 25))
    opening = F.when(part % 4 == 0, F.concat(F.lit("Open Womens World Cup "), place, F.lit(" "), text(1991 + supp % 30))).otherwise(
        F.concat(text(1930 + supp % 70), F.lit(" Open World Cup "), place))
    event = F.when(line == 7, F.lit(", **Final Whistle**")).otherwise(F.concat(
        F.lit(", **"), F.when(F.col("l_returnflag") == "A", "Goal").when(F.col("l_returnflag") == "N", "Save").otherwise("Free Kick"),
        F.lit(": "), F.when(F.col("l_linestatus") == "F", "Ana Lima").otherwise("Núria Okoro"), F.lit(" "),
        text(F.col("l_quantity").cast("int")), F.lit("'**")))
    match = F.when(line == 6, F.lit(" Trophy")).otherwise(F.concat(
        F.lit(" "), F.char(65 + supp % 26), F.lit("RG "), text(order % 10), F.lit(" - "), text(part % 10), F.lit(" BR"),
        F.char(65 + order % 26), event))
    name = F.concat(F.lit("Moment "), text(line), F.when(line == 2, F.lit("")).otherwise(
        F.concat(F.lit(" ("), text(part % 900 + 100), F.lit(" Editions)"))))
    key = text(part)
    arc18 = F.struct(F.lit("true").alias("rekey-checked"))
    arc20 = F.struct(text(part + 1000).alias("application-id"))
    metadata = F.to_json(F.struct(
        F.concat(F.lit("https://v/"), key).alias("animation_url"), F.lit("video/mp4").alias("animation_url_mimetype"),
        F.concat(opening, F.lit("™"), match).alias("description"), F.lit("https://x").alias("external_url"),
        F.lit("text/html").alias("external_url_mimetype"), F.concat(F.lit("ipfs://i/"), key).alias("image"),
        F.concat(F.lit("sha256-"), key).alias("image_integrity"), F.lit("image/png").alias("image_mimetype"), name.alias("name"),
        F.struct(arc18.alias("arc-18"), arc20.alias("arc-20")).alias("properties")))
    return li.select(
        part.alias("asset_id"),
        F.concat(F.when(part % 97 == 0, "test").otherwise("D"), two(part % 6), F.lit("-"), two(part * 7 % 60)).alias("asset_name"),
        F.concat(F.lit("ipfs://a/"), key).alias("asset_url"),
        F.concat(F.lit("ipfs://m/"), text(order), F.lit("/"), text(line)).alias("metadata_url"), metadata.alias("metadata"))


@register("title_mining", f"WITH {_TITLES_SQL} SELECT * FROM titles")
def title_mining(spark, sf_dir):
    """Year, host, teams, scores, event, player, minute, item number and editions, cut out of the title
    that each asset's first upload carries as JSON text."""
    return A.mine_titles(title_uploads(T(spark, sf_dir)))


# ----------------------------------------------------------------------------- asset master
_MASTER_SQL = f"""
{_TITLES_SQL},
history AS (
  SELECT l_partkey AS asset_id, CASE WHEN l_returnflag <> 'A' THEN 'cfg ' || CAST(l_linenumber AS VARCHAR) END AS asset_name,
         CASE WHEN l_linenumber <> 4 THEN CAST(l_quantity AS BIGINT) END AS asset_amount,
         CASE WHEN l_linenumber % 2 = 0 THEN 0 ELSE l_suppkey % 4 END AS decimals, l_shipdate AS ts
  FROM lineitem),
last AS (
  SELECT * FROM history WHERE asset_name IS NOT NULL AND asset_amount IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY ts DESC, asset_name DESC, asset_amount DESC, decimals DESC) = 1),
entries AS (
  SELECT l.l_partkey AS nft, 'set ' || CAST(l_suppkey % 9 AS VARCHAR) AS collection,
         'listed ' || CAST(l_partkey AS VARCHAR) || '.' || CAST(l_linenumber AS VARCHAR) AS name,
         CASE WHEN l_suppkey % 3 = 0 THEN 'https://c/#arc3' ELSE 'https://c/' || CAST(l_suppkey AS VARCHAR) END AS url,
         row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS pos,
         'algo-nft-meta-' || CAST(l_orderkey AS VARCHAR) AS key, l_linenumber
  FROM lineitem l JOIN orders o ON l_orderkey = o_orderkey WHERE o_orderpriority = '1-URGENT'),
listed AS (
  SELECT * FROM entries WHERE l_linenumber <> 3
  QUALIFY row_number() OVER (PARTITION BY nft ORDER BY pos, key) = 1),
noted AS (SELECT DISTINCT l_partkey AS nft FROM lineitem WHERE l_linenumber = 7 AND l_returnflag = 'R'),
own AS (
  SELECT p_partkey AS asset_id, p_partkey % 7 = 0 AS deleted,
         CASE WHEN p_partkey % 7 = 0 OR p_partkey % 5 = 1 THEN NULL
              WHEN p_size % 3 = 0 THEN 'https://p/' || CAST(p_partkey AS VARCHAR)
              WHEN p_size % 3 = 1 THEN 'template-ipfs://reserve/' || CAST(p_size AS VARCHAR)
              ELSE 'ipfs://' || p_brand || '#arc3' END AS url,
         CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 3 = 0 THEN p_name WHEN p_partkey % 3 = 1 THEN 'é ' || p_type END AS name,
         CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_size % 3 END AS t,
         CASE WHEN p_partkey % 7 = 0 OR p_size % 5 = 0 THEN 0 ELSE p_size % 2 END AS dc
  FROM part),
wide AS (
  SELECT own.*, last.asset_id IS NOT NULL AND deleted AS gone, last.asset_name AS past_name, last.asset_amount, last.decimals,
         listed.nft IS NOT NULL AS is_listed, noted.nft IS NOT NULL AS is_noted, listed.collection, listed.name AS coll_name,
         listed.url AS coll_url, titles.nft_asset_id IS NOT NULL AS is_title, titles.name AS title_name, drop_name, animation_url
  FROM own LEFT JOIN last USING (asset_id) LEFT JOIN listed ON own.asset_id = listed.nft
  LEFT JOIN noted ON own.asset_id = noted.nft LEFT JOIN titles ON own.asset_id = titles.nft_asset_id),
judged AS (
  SELECT *, CASE WHEN gone THEN asset_amount ELSE t END AS supply, CASE WHEN gone THEN wide.decimals ELSE dc END AS places,
         coalesce(url, coll_url) AS any_url
  FROM wide)
SELECT asset_id, coalesce(CASE WHEN gone THEN past_name ELSE name END, coll_name, title_name) AS asset_name,
       CAST(supply AS DOUBLE) AS total_supply, coalesce(any_url, animation_url) AS asset_url, CAST(places AS BIGINT) AS decimals,
       deleted AS asset_deleted, 's' || CAST(asset_id % 10 AS VARCHAR) AS creator_address,
       DATE '1995-01-01' + CAST(asset_id % 900 AS INTEGER) AS created_at,
       CASE WHEN deleted THEN DATE '2001-01-01' END AS closed_at,
       coalesce(collection, 'TITLES - ' || drop_name) AS collection_name, is_listed OR is_title AS collection_nft,
       is_noted AS arc69_nft, coalesce(any_url LIKE '%#arc3%', FALSE) AS ar3_nft, coalesce(any_url LIKE '%reserve%', FALSE) AS ar19_nft,
       coalesce(places = 0 AND supply = 1, FALSE) AS traditional_nft,
       is_listed OR is_noted OR coalesce(any_url LIKE '%#arc3%', FALSE) OR coalesce(any_url LIKE '%reserve%', FALSE)
         OR coalesce(places = 0 AND supply = 1, FALSE) AS is_nft
FROM judged"""


def asset_rows(t):
    p, size = F.col("p_partkey"), F.col("p_size")
    gone = p % 7 == 0

    def b64(c):
        return F.base64(F.encode(c, "UTF-8"))

    url = F.when(p % 5 != 1, F.when(size % 3 == 1, F.concat(F.lit("template-ipfs://reserve/"), size.cast("string"))).when(
        size % 3 == 2, F.concat(F.lit("ipfs://"), "p_brand", F.lit("#arc3"))).otherwise(F.concat(F.lit("https://p/"), p.cast("string"))))
    # names in base64; for p % 3 = 2 bytes that are no UTF-8 text
    name64 = F.when(p % 3 == 1, b64(F.concat(F.lit("é "), "p_type"))).when(p % 3 == 2, F.base64(F.unhex(F.lit("C3"))))
    params = F.struct(F.when(p % 2 == 0, url).alias("au"), F.when(p % 2 == 1, b64(url)).alias("au64"),
                      F.when(p % 3 == 0, F.col("p_name")).alias("an"), name64.alias("an64"), (size % 3).alias("t"),
                      F.when(size % 5 != 0, size % 2).alias("dc"))
    return t.part.select(
        p.alias("asset_id"), F.concat(F.lit("s"), (p % 10).cast("string")).alias("creator_address"),
        F.when(gone, F.lit("{}")).otherwise(F.to_json(params)).alias("params"), gone.alias("deleted"),
        F.date_add(F.lit("1995-01-01").cast("date"), (p % 900).cast("int")).alias("created_at"),
        F.when(gone, F.lit("2001-01-01").cast("date")).alias("closed_at"))


def asset_history(t):
    line = F.col("l_linenumber")
    return t.lineitem.select(
        F.col("l_partkey").alias("asset_id"),
        F.when(F.col("l_returnflag") != "A", F.concat(F.lit("cfg "), line.cast("string"))).alias("asset_name"),
        F.when(line != 4, F.col("l_quantity").cast("long")).alias("asset_amount"),
        F.when(line % 2 == 0, F.lit(0)).otherwise(F.col("l_suppkey") % 4).cast("long").alias("decimals"), F.col("l_shipdate").alias("ts"))


def collection_lists(t):
    """One list for each order; the lines of an order, at most a few, are its entries."""
    li = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    entry = F.struct(
        F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey"),
        F.when(F.col("l_linenumber") == 3, F.lit("")).otherwise(F.col("l_partkey").cast("string")).alias("asset"),
        F.concat(F.lit("set "), (F.col("l_suppkey") % 9).cast("string")).alias("collection"), F.lit("m").alias("manager"),
        F.concat(F.lit("listed "), F.col("l_partkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")).alias("name"),
        F.when(F.col("l_suppkey") % 3 == 0, F.lit("https://c/#arc3")).otherwise(
            F.concat(F.lit("https://c/"), F.col("l_suppkey").cast("string"))).alias("url"))
    lists = li.groupBy("l_orderkey").agg(F.to_json(F.array_sort(F.collect_list(entry))).alias("content"))
    orders = t.orders.select("o_orderkey", "o_orderpriority")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "algo-nft-meta-").otherwise("other-")
    return lists.join(orders, lists.l_orderkey == orders.o_orderkey).select(
        F.concat(kind, F.col("l_orderkey").cast("string")).alias("key"), "content")


def asset_notes(t):
    standard = F.when(F.col("l_returnflag") == "R", "arc69").otherwise("arc3")
    text = F.concat(F.lit('{"standard":"'), standard, F.lit('"}'))
    note = F.when(F.col("l_linenumber") == 7, F.base64(F.encode(text, "UTF-8"))).when(
        F.col("l_linenumber") == 6, F.base64(F.encode(F.lit('{"standard":"arc69"'), "UTF-8"))).when(
        F.col("l_linenumber") == 5, F.lit("no base64: arc69"))
    return t.lineitem.select("l_partkey", note.alias("note"))


@register("asset_master", f"WITH {_MASTER_SQL}")
def asset_master(spark, sf_dir):
    """Every asset with names, supply, collection and token flags; deleted ones by their last
    complete configuration, standards detected from notes and urls."""
    t = T(spark, sf_dir)
    fields = ["asset_name", "asset_amount", "decimals"]
    out = A.asset_master(asset_rows(t), A.last_versions(asset_history(t), "asset_id", "ts", fields),
                         A.first_listing(collection_lists(t), "content"), A.noted_standard(asset_notes(t), "l_partkey", "note"),
                         A.mine_titles(title_uploads(t)))
    return out.withColumn("total_supply", F.col("total_supply").cast("double"))


# ------------------------------------------------------------------------- catalogue merge
@register("catalogue_merge", """
WITH first AS (
  SELECT CASE WHEN s_suppkey = 1 THEN '0' ELSE CAST(s_suppkey % 60 AS VARCHAR) END AS asset_id,
         'cg-' || CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_suppkey % 4 <> 0 THEN s_name END AS name,
         CASE WHEN s_suppkey = 1 THEN 'coin' ELSE 'S' || CAST(s_suppkey % 60 AS VARCHAR) END AS symbol,
         CAST(DATE '2000-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS TIMESTAMP) AS loaded
  FROM supplier WHERE s_suppkey = 1 OR s_nationkey % 2 = 0 AND s_suppkey % 11 <> 0),
newest AS (SELECT * FROM first QUALIFY row_number() OVER (PARTITION BY asset_id ORDER BY loaded DESC, id DESC) = 1),
second AS (
  SELECT CASE WHEN c_custkey = 1 THEN '0' ELSE CAST(c_custkey + 30 + i AS VARCHAR) END AS asset_id, c_custkey AS id, c_name AS name,
         CASE WHEN c_custkey = 1 THEN 'COIN' ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS symbol, 'logo' || CAST(c_custkey AS VARCHAR) AS logo,
         CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_mktsegment END AS tags,
         CAST(DATE '2000-01-01' + CAST(c_custkey % 400 AS INTEGER) AS TIMESTAMP) AS loaded
  FROM customer, (VALUES (0), (100000)) AS two(i)
  WHERE (c_custkey <> 1 OR i = 0) AND (c_custkey = 1 OR c_custkey % 5 <> 0 AND (i = 0 OR c_custkey % 7 = 0)))
SELECT coalesce(n.asset_id, s.asset_id) AS asset_id, coalesce(n.name, s.name) AS token_name, coalesce(n.symbol, s.symbol) AS symbol,
       n.id AS first_id, CAST(s.id AS DOUBLE) AS second_id, tags, logo, greatest(coalesce(n.loaded, TIMESTAMP '1900-01-01'),
       coalesce(s.loaded, TIMESTAMP '1900-01-01')) AS loaded
FROM newest n FULL JOIN second s ON n.asset_id = s.asset_id
""")
def catalogue_merge(spark, sf_dir):
    """One token row out of two catalogues; the second one's addresses are lists of objects, empty ones
    (the coin has no address) and other platforms among them."""
    t = T(spark, sf_dir)
    key = F.col("s_suppkey")

    def day(c, days):
        return F.date_add(F.lit("2000-01-01").cast("date"), (c % days).cast("int")).cast("timestamp_ntz")

    first = t.supplier.select(
        F.when(key != 1, F.when(key % 11 != 0, (key % 60).cast("string")).otherwise(F.lit("0xabc"))).alias("token_address"),
        F.when(F.col("s_nationkey") % 2 == 0, "ledger").otherwise("other").alias("platform"),
        F.concat(F.lit("cg-"), key.cast("string")).alias("id"), F.when(key % 4 != 0, F.col("s_name")).alias("name"),
        F.when(key == 1, "coin").otherwise(F.concat(F.lit("S"), (key % 60).cast("string"))).alias("symbol"), day(key, 300).alias("loaded"))
    number = F.col("token_address").try_cast("long").isNotNull()
    first = first.where(((F.col("platform") == "ledger") & number) | (F.col("symbol") == "coin")).withColumn(
        "asset_id", F.coalesce("token_address", F.lit("0")))
    cust = F.col("c_custkey")

    def at(address, platform):
        return F.struct(address.alias("contract_address"), F.struct(platform.alias("name")).alias("platform"))

    here = F.when(cust % 5 != 0, "Ledger").otherwise("Elsewhere")
    # every customer: an address of its own, one that is no number; some a second one; customer 1: none at all
    two = F.array(at((cust + 30).cast("string"), here), at(F.lit("0xfe"), F.lit("Ledger")),
                  at((cust + 100030).cast("string"), F.when((cust % 7 == 0) & (cust % 5 != 0), "Ledger").otherwise("Elsewhere")))
    second = t.customer.select(
        F.when(cust != 1, F.to_json(two)).otherwise(F.lit("[]")).alias("addresses"), cust.cast("double").alias("id"),
        F.col("c_name").alias("name"), F.when(cust == 1, "COIN").otherwise(F.concat(F.lit("C"), cust.cast("string"))).alias("symbol"),
        F.concat(F.lit("logo"), cust.cast("string")).alias("logo"),
        F.when(cust % 3 == 0, F.lit("null")).otherwise(F.col("c_mktsegment")).alias("tags"), F.lit("t").alias("twitter"),
        F.lit("w").alias("website"), F.lit("d").alias("description"), day(cust, 400).alias("loaded"))
    second = A.catalogue_addresses(second, "addresses", "Ledger", F.col("symbol") == "COIN").drop("addresses")
    return A.merge_catalogues(first, second).drop("twitter", "website", "description")
