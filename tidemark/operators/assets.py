"""Asset jobs: title mining, the asset master, and the merge of two token catalogues."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import jsonx as J
from ..functions import scalars as S
from ..functions import textmine as X

# Fixed values of the title series: names of its drops, rarity limits by drop, and rarity names.
DROP_NAMES = {1: "genesis", 2: "archives", 3: "south american flair", 4: "archives 2", 5: "80s-90s"}
RARITY_LIMITS = {1: (3, 9, 22), 2: (2, 6, 18), 3: (4, 13, 31), 4: (2, 6, 18), 5: (4, 13, 31)}
RARITY_NAMES = ("Iconic", "Epic", "Rare", "Common")
WOMENS = "%Womens World Cup%"

_COLON, _DASH = X.Anchor(":"), X.Anchor("-")
#: Fields of a title, from the description, the display name and the asset's name.
TITLE_RULES = {
    "year": ("description", X.Kinds(WOMENS, X.Match("[1-2][0-9][0-9][0-9]"), X.Slice(1, length=4))),
    "host": ("description", X.Kinds(WOMENS, X.Slice(22, until=X.Anchor("™"), less=27),
                                    X.Slice(20, until=X.Anchor("™"), less=20))),
    "teams": ("description", X.Slice(_DASH, -6, length=13)),
    "country_1": ("teams", X.Slice(1, length=3)),
    "country_1_score": ("teams", X.Slice(5, length=1)),
    "country_2": ("teams", X.Slice(-3)),
    "country_2_score": ("teams", X.Slice(9, length=1)),
    "event_type": ("description", X.Slice(X.Anchor(", *"), 4, until=_COLON, less=4)),
    "player": ("description", X.Slice(_COLON, 2, until=X.Anchor("[0-9]", _COLON), less=2, when="%:%")),
    "minute": ("description", X.Slice(X.Anchor(" [0-9]", _COLON), length=10, drop="**", when="%:%")),
    "item_no": ("asset_name", X.Slice(_DASH, 1, length=2)),
    "editions": ("name", X.Slice(X.Anchor(r"\("), 1, until=X.Anchor(r"\)"), less=10)),
}
#: Columns taken from the metadata text: name -> JSON path.
TITLE_METADATA = {
    "animation_url": "$.animation_url", "animation_url_mimetype": "$.animation_url_mimetype",
    "description": "$.description", "external_url": "$.external_url",
    "external_url_mimetype": "$.external_url_mimetype", "image": "$.image",
    "image_integrity": "$.image_integrity", "image_mimetype": "$.image_mimetype", "name": "$.name",
    "rekey_checked": "$.properties['arc-18']['rekey-checked']",
    "application_id": "$.properties['arc-20']['application-id']",
}


def mine_titles(uploads: DataFrame) -> DataFrame:
    """One row per asset: the fields of its title.

    ``uploads``: (asset_id, asset_name, asset_url, metadata_url, metadata), the last as JSON
    text.  Test assets are left out.  Of several uploads of an asset the one with the smallest
    name (then description, then url; nulls last) counts; the texts are mined after that, so
    only one upload an asset is.  Names without a number give null drops and rarities.
    """
    parsed = (uploads.where(~F.col("asset_name").like("test%"))
              .withColumn("__v", F.try_parse_json("metadata"))
              .withColumn("name", J.get("__v", TITLE_METADATA["name"]))
              .withColumn("description", J.get("__v", TITLE_METADATA["description"])))
    order = [F.col(c).asc_nulls_last() for c in ("name", "description", "metadata_url")]
    first = F.row_number().over(Window.partitionBy("asset_id").orderBy(*order))
    # the parsed form stays behind: the chosen upload is parsed again, so rows are sorted and sent with their text alone
    one = (parsed.drop("__v").withColumn("__first", first).where(F.col("__first") == 1)
           .withColumn("__v", F.try_parse_json("metadata")))
    for column, path in TITLE_METADATA.items():
        one = one.withColumn(column, J.get("__v", path))
    drop = F.right(F.left("asset_name", F.lit(3)), F.lit(2)).try_cast("int")
    mined = X.mine(one.withColumn("drop_number", drop), TITLE_RULES)
    item = F.col("item_no").try_cast("int")
    named = rarity = F  # F.when begins a CASE, Column.when goes on with it
    for number, name in DROP_NAMES.items():
        here = F.col("drop_number") == number
        named = named.when(here, F.lit(name))
        rarity = rarity.when(here, X.tier(item, RARITY_LIMITS[number], RARITY_NAMES))
    return mined.select(
        F.col("asset_id").alias("nft_asset_id"), F.col("asset_name").alias("nft_asset_name"),
        F.col("asset_url").alias("nft_url"), "metadata_url", *TITLE_METADATA, "drop_number", named.alias("drop_name"),
        "item_no", "editions", rarity.alias("rarity"),
        F.when(F.col("description").like(WOMENS), "Womens").otherwise("Mens").alias("world_cup_type"),
        "year", "host", "country_1", "country_1_score", "country_2", "country_2_score", "event_type", "player", "minute")


def last_versions(history: DataFrame, key: str, order: str, fields: list[str], together: bool = True) -> DataFrame:
    """(key, fields): the last known values of each key.

    ``together``: those of the newest row in which all fields are there; otherwise every field's
    newest value on its own.  Rows of one time are ordered by their fields.  One aggregate with a
    map-side step: the order of arrival plays no part, and a key's history is never gathered.
    """
    if together:
        whole = history.dropna(subset=fields)
        top = F.max(F.struct(order, *fields)).alias("top")
        return whole.groupBy(key).agg(top).select(key, *[F.col("top")[f].alias(f) for f in fields])
    newest = [F.max(F.when(F.col(f).isNotNull(), F.struct(order, f)))[f].alias(f) for f in fields]
    return history.groupBy(key).agg(*newest)


def first_listing(uploads: DataFrame, content: str, like: str = "%algo-nft-meta%") -> DataFrame:
    """(nft, collection, name, url): for each asset its entry nearest the start of an uploaded list.

    ``uploads``: (key, content as JSON text); other keys and entries with an empty asset are left
    out, entries of one place are ordered by the upload's key.
    """
    lists = uploads.where(F.col("key").like(like)).select(F.col("key").alias("upload"), F.try_parse_json(content).alias("__list"))
    entries = J.explode(lists, "__list").select(
        "upload", "pos", J.get("value", "$.asset", "string").alias("asset"),
        *[J.get("value", f"$.{f}").alias(f) for f in ("collection", "name", "url")])
    best = F.min(F.struct("pos", "upload", "collection", "name", "url")).alias("e")
    return (entries.where(F.col("asset") != "").withColumn("nft", F.col("asset").try_cast("long"))
            .where(F.col("nft").isNotNull()).groupBy("nft").agg(best)
            .select("nft", "e.collection", "e.name", "e.url"))


def noted_standard(transactions: DataFrame, asset: str, note: str, standard: str = "arc69") -> DataFrame:
    """(nft): assets with a note (base64 of JSON text) that names ``standard``; what is not base64, not UTF-8
    or not JSON names none."""
    named = J.get(F.try_parse_json(S.b64_text(note)), "$.standard")
    return transactions.where(named == standard).select(F.col(asset).alias("nft")).distinct()


def asset_master(assets: DataFrame, history: DataFrame, listings: DataFrame, noted: DataFrame, titles: DataFrame) -> DataFrame:
    """One row per asset with its names, supply and token flags.

    ``assets``: (asset_id, creator_address, params as JSON text, deleted, created_at, closed_at).  Text comes
    from its plain field, else from its base64 field.  A deleted asset shows the last values
    that its configuration history knows (:func:`last_versions`: asset_name, asset_amount,
    decimals), if it has any.  ``listings``, ``noted`` and ``titles`` have one row per asset.
    """
    p = F.col("__p")
    plain = (assets.withColumn("__p", F.try_parse_json("params"))
             .withColumn("own_url", F.coalesce(J.get(p, "$.au"), S.b64_text(J.get(p, "$.au64"))))
             .withColumn("own_name", F.coalesce(J.get(p, "$.an"), S.b64_text(J.get(p, "$.an64")))))
    past = history.select(F.col("asset_id").alias("__past"), F.col("asset_name").alias("past_name"),
                          F.col("asset_amount").alias("past_amount"), F.col("decimals").alias("past_decimals"))
    gone = F.col("deleted") & F.col("__past").isNotNull()
    known = (plain.join(past, F.col("asset_id") == F.col("__past"), "left")
             .withColumn("own_name", F.when(gone, F.col("past_name")).otherwise(F.col("own_name")))
             .withColumn("total_supply", F.when(gone, F.col("past_amount")).otherwise(J.get(p, "$.t", "bigint")))
             .withColumn("decimals", F.when(gone, F.col("past_decimals"))
                         .otherwise(F.coalesce(J.get(p, "$.dc", "bigint"), F.lit(0)))))
    coll = listings.select(F.col("nft").alias("__coll"), "collection", F.col("name").alias("coll_name"), F.col("url").alias("coll_url"))
    note = noted.select(F.col("nft").alias("__note"))
    title = titles.select(F.col("nft_asset_id").alias("__title"), F.col("name").alias("title_name"), "drop_name", "animation_url")
    wide = (known.join(coll, F.col("asset_id") == F.col("__coll"), "left")
            .join(note, F.col("asset_id") == F.col("__note"), "left")
            .join(title, F.col("asset_id") == F.col("__title"), "left"))
    url = F.coalesce("own_url", "coll_url")

    def yes(c: Column) -> Column:
        return F.coalesce(c, F.lit(False))

    listed, by_note = F.col("__coll").isNotNull(), F.col("__note").isNotNull()
    arc3, arc19 = yes(url.like("%#arc3%")), yes(url.like("%reserve%"))
    single = yes((F.col("decimals") == 0) & (F.col("total_supply") == 1))
    return wide.select(
        "asset_id", F.coalesce("own_name", "coll_name", "title_name").alias("asset_name"), "total_supply",
        F.coalesce("own_url", "coll_url", "animation_url").alias("asset_url"), "decimals",
        F.col("deleted").alias("asset_deleted"), "creator_address", "created_at", "closed_at",
        F.coalesce("collection", F.concat(F.lit("TITLES - "), "drop_name")).alias("collection_name"),
        (listed | F.col("__title").isNotNull()).alias("collection_nft"), by_note.alias("arc69_nft"),
        arc3.alias("ar3_nft"), arc19.alias("ar19_nft"), single.alias("traditional_nft"),
        (listed | by_note | arc3 | arc19 | single).alias("is_nft"))


def catalogue_addresses(catalogue: DataFrame, addresses: str, chain: str, coin: Column) -> DataFrame:
    """``catalogue`` with ``asset_id``: one row for each of an entry's addresses on ``chain``.

    ``addresses``: JSON text, a list of {contract_address, platform: {name}}.  Addresses that
    are no number are left out; entries for which ``coin`` holds stay without any, as asset '0'.
    """
    lists = catalogue.withColumn("__list", F.try_parse_json(addresses)).withColumn("__coin", coin)
    each = J.explode(lists, "__list", outer=True)
    address = J.get("value", "$.contract_address")
    here = (J.get("value", "$.platform.name") == chain) & address.try_cast("long").isNotNull()
    return (each.where(here | F.col("__coin")).withColumn("asset_id", F.coalesce(address, F.lit("0")))
            .drop("__list", "__coin", "pos", "key", "value"))


def merge_catalogues(first: DataFrame, second: DataFrame) -> DataFrame:
    """One row for each asset of either catalogue.

    ``first`` (asset_id, id, name, symbol, loaded) has its newest row per asset (ties: largest
    id); ``second`` (asset_id, id, name, symbol, logo, tags, twitter, website, description, loaded)
    joins as it is.  Names and symbols come from the first catalogue that has them, the time
    is the later one.  Keys are distinct on one side, so a full outer join serves both.
    """
    newest = F.max(F.struct("loaded", "id", "name", "symbol")).alias("f")
    one = first.groupBy("asset_id").agg(newest)
    two = second.select("asset_id", F.struct(*[c for c in second.columns if c != "asset_id"]).alias("s"))
    old = F.lit("1900-01-01 00:00:00").cast("timestamp_ntz")
    return one.join(two, "asset_id", "full_outer").select(
        "asset_id", F.coalesce("f.name", "s.name").alias("token_name"), F.coalesce("f.symbol", "s.symbol").alias("symbol"),
        F.col("f.id").alias("first_id"), F.col("s.id").alias("second_id"),
        F.nullif("s.tags", F.lit("null")).alias("tags"), "s.logo", "s.twitter", "s.website", "s.description",
        F.greatest(F.coalesce("f.loaded", old), F.coalesce("s.loaded", old)).alias("loaded"))
