"""Title mining, asset master, catalogues and sales on literal rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.functions import textmine as X
from tidemark.operators import assets as A
from tidemark.operators import markets as M


def test_slices_equal_brute_force(spark):
    """Positions of the reference dialect: 0 for not found, starts below 1 from the end, no negative lengths."""
    def sub(s, start, n):
        start = 1 if start == 0 else start
        low = start - 1 if start > 0 else len(s) + start
        return s[max(0, low):max(0, low + n)] if n > 0 else ""

    def at(s, p, low=1):
        m = re.search(p, s[max(low, 1) - 1:])
        return m.start() + max(low, 1) if m else 0

    rnd = random.Random(2)
    texts = ["".join(rnd.choice("ab-:™, *7é") for _ in range(rnd.randrange(25))) for _ in range(300)]
    colon = X.Anchor(":")
    rules = {"a": ("t", X.Slice(X.Anchor("-"), -6, length=13)), "b": ("t", X.Slice(20, until=X.Anchor("™"), less=3)),
             "c": ("t", X.Slice(X.Anchor(", *"), 4, until=colon, less=4)),
             "d": ("t", X.Slice(colon, 2, until=X.Anchor("[0-9]", colon), less=2, when="%:%")),
             "e": ("t", X.Slice(X.Anchor(" [0-9]", colon), length=10, drop="**", when="%:%")), "f": ("a", X.Slice(-3)),
             "g": ("t", X.Kinds("%7%", X.Match("[0-9]"), X.Slice(1, length=4)))}
    df = spark.createDataFrame([(t,) for t in texts] + [(None,)], "t string")
    for r in X.mine(df, rules).collect():
        t = r.t
        if t is None:
            assert all(r[c] is None for c in "abcdefg")
            continue
        c = at(t, ":")
        a = sub(t, at(t, "-") - 6, 13)
        assert r.a == a and r.b == sub(t, 20, at(t, "™") - 3) and r.f == (a[-3:] if len(a) >= 3 else a)
        assert r.c == sub(t, at(t, ", *") + 4, c - at(t, ", *") - 4)
        assert r.d == (sub(t, c + 2, at(t, "[0-9]", c) - c - 2) if ":" in t else None)
        assert r.e == (sub(t, at(t, " [0-9]", c), 10).replace("**", "") if ":" in t else None)
        assert r.g == (re.search("[0-9]", t)[0] if "7" in t else t[:4])


def test_titles_take_the_first_upload(spark):
    up = "asset_id long, asset_name string, asset_url string, metadata_url string, metadata string"
    text = '{"name": "%s (250 Editions)", "description": "1998 Open World Cup France™ BRA 0 - 3 FRA, **Goal: Zi 45\'**"}'
    rows = [(1, "D01-08", "u", "m2", text % "b"), (1, "D01-08", "u", "m1", text % "a"), (2, "test1", "u", "m", text % "a"),
            (3, "D05-31", "u", "m", "no json"), (4, "xx", None, None, None)]
    got = {r.nft_asset_id: r for r in A.mine_titles(spark.createDataFrame(rows, up)).collect()}
    assert set(got) == {1, 3, 4}
    r = got[1]
    assert (r.metadata_url, r.drop_name, r.rarity, r.item_no, r.editions) == ("m1", "genesis", "Epic", "08", "250")
    assert (r.year, r.host, r.country_1, r.country_1_score, r.country_2, r.country_2_score) == ("1998", " France", "BRA", "0", "FRA", "3")
    assert (r.event_type, r.player, r.minute, r.world_cup_type) == ("Goal", "Zi ", " 45'", "Mens")
    assert got[3].rarity == "Common" and got[3].year is None and got[4].drop_number is None


def test_last_versions_together_and_by_field(spark):
    rows = [(1, 3, "new", None), (1, 2, "mid", 20), (1, 1, "old", 10), (2, 5, None, 7), (3, 1, None, None)]
    for seed in range(3):  # the order of arrival plays no part
        random.Random(seed).shuffle(rows)
        h = spark.createDataFrame(rows, "k long, ts long, name string, amount long").repartition(3)
        assert [tuple(r) for r in A.last_versions(h, "k", "ts", ["name", "amount"]).collect()] == [(1, "mid", 20)]
        each = sorted(tuple(r) for r in A.last_versions(h, "k", "ts", ["name", "amount"], together=False).collect())
        assert each == [(1, "new", 20), (2, None, 7), (3, None, None)]


def test_deleted_assets_show_their_last_version(spark):
    rows = [(1, "c", '{"an":"own","t":1,"dc":0,"au":"x#arc3"}', False), (2, "c", "{}", True), (3, "c", "{}", True),
            (4, "c", '{"an64":"w6k=","au64":"!!","t":5}', False), (5, "c", None, False)]
    assets = spark.createDataFrame(rows, "asset_id long, creator_address string, params string, deleted boolean").selectExpr(
        "*", "DATE'2020-01-01' AS created_at", "DATE'2020-01-02' AS closed_at")
    past = spark.createDataFrame([(2, "was", 9, 2), (1, "not used", 3, 3)], "asset_id long, asset_name string, asset_amount long, decimals long")
    lists = A.first_listing(spark.createDataFrame(
        [("algo-nft-meta-2", '[{"asset":"5","collection":"late","name":"n2","url":"u"}]'), ("other", '[{"asset":"4","name":"no"}]'),
         ("algo-nft-meta-1", '[{"asset":"","name":"e"},{"asset":"x"}]'), ("algo-nft-meta-0", '[{"asset":"5","collection":"first","name":"n1","url":"reserve"}]'),
         ("algo-nft-meta-9", "no json")], "key string, content string"), "content")
    noted = A.noted_standard(spark.createDataFrame([(3, "eyJzdGFuZGFyZCI6ImFyYzY5In0="), (4, "%%"), (4, "e30=")], "a long, note string"), "a", "note")
    titles = A.mine_titles(spark.createDataFrame([], "asset_id long, asset_name string, asset_url string, metadata_url string, metadata string"))
    got = {r.asset_id: r for r in A.asset_master(assets, past, lists, noted, titles).collect()}
    assert len(got) == 5 and got[1].asset_name == "own" and got[1].ar3_nft and got[1].traditional_nft and got[1].is_nft
    assert (got[2].asset_name, got[2].total_supply, got[2].decimals, got[2].is_nft) == ("was", 9, 2, False)
    assert (got[3].asset_name, got[3].total_supply, got[3].arc69_nft, got[3].is_nft) == (None, None, True, True)
    assert (got[4].asset_name, got[4].asset_url, got[4].is_nft) == ("é", None, False)
    assert (got[5].asset_name, got[5].collection_name, got[5].ar19_nft, got[5].collection_nft) == ("n1", "first", True, True)


def test_catalogues_one_both_and_conflicting(spark):
    first = spark.createDataFrame([("1", "a", "A", "SA", "2020-01-01"), ("1", "b", None, "SB", "2021-01-01"), ("2", "c", "C", None, "2020-01-01")],
                                  "asset_id string, id string, name string, symbol string, loaded string").withColumn("loaded", F.col("loaded").cast("timestamp_ntz"))
    raw = spark.createDataFrame(
        [(7, "x", "S", '[{"contract_address":"1","platform":{"name":"L"}},{"contract_address":"3","platform":{"name":"L"}},'
          '{"contract_address":"0x","platform":{"name":"L"}},{"contract_address":"2","platform":{"name":"E"}}]', "null"),
         (8, "coin", "COIN", "[]", "t"), (9, "gone", "G", "[]", "t"), (10, "bad", "B", "no json", "t")],
        "id long, name string, symbol string, addresses string, tags string")
    second = A.catalogue_addresses(raw, "addresses", "L", F.col("symbol") == "COIN").drop("addresses").selectExpr(
        "*", "'l' AS logo", "'t' AS twitter", "'w' AS website", "'d' AS description", "TIMESTAMP_NTZ'2020-06-01 00:00:00' AS loaded")
    got = {r.asset_id: r for r in A.merge_catalogues(first, second).collect()}
    assert set(got) == {"0", "1", "2", "3"}
    assert (got["1"].token_name, got["1"].symbol, got["1"].first_id, got["1"].second_id, got["1"].tags) == ("x", "SB", "b", 7, None)
    assert got["1"].loaded.year == 2021 and got["3"].loaded.month == 6 and got["2"].second_id is None and got["0"].token_name == "coin"


def test_units_are_dealt_exactly(spark):
    rnd = random.Random(1)
    rows = [(g, i, rnd.choice([10 ** 17 + 3, 7, 0, 100]), rnd.choice([0, 1, 3, 10 ** 12])) for g in range(60) for i in range(rnd.randrange(1, 7))]
    totals = {}
    rows = [(g, i, totals.setdefault(g, t), w) for g, i, t, w in rows] + [(99, 0, 10, 0), (99, 1, 10, None), (99, 2, 10, 0)]
    df = spark.createDataFrame(rows, "g long, i long, total long, w long")
    got = M.allocated(df, ["g"], "total", "w", ["i"], "share").collect()
    for g, total in totals.items():
        own = [r for r in got if r.g == g]
        assert sum(r.share for r in own) == total and all(r.share >= 0 for r in own)
        every = sum(r.w for r in own)
        if every:
            assert all(abs(r.share - total * r.w // every) <= 1 for r in own)
    assert sorted(r.share for r in got if r.g == 99) == [3, 3, 4]


def test_one_activity_serves_one_sale(spark):
    sales = spark.createDataFrame([(1, "b", 1), (1, "b", 2), (1, "b", 3), (1, "c", 4), (None, "b", 5), (None, "b", 6)], "asset long, buyer string, n int")
    paid = spark.createDataFrame([(1, "b", 20, "p2"), (1, "b", 10, "p1"), (1, "d", 5, "x"), (None, "b", 1, "null")], "asset long, buyer string, at int, p string")
    got = {r.n: r.p for r in M.matched_one_to_one(sales, paid, ["asset", "buyer"], ["n"], ["at"]).collect()}
    assert got == {1: "p1", 2: "p2", 3: None, 4: None, 5: None, 6: None}


def test_changes_of_several_accounts(spark):
    key = "bGlzdGVk"  # listed
    rows = [(1, f'{{"{key}": {{"at": 1, "ui": 2}}}}'), (2, f'[{{"{key}": {{"ui": 2}}}}, {{"{key}": {{"ui": 1}}}}, {{"{key}": {{"ui": 2}}}}]'),
            (3, f'{{"{key}": {{"at": 2}}}}'), (4, '{"%%": {"ui": 2}}'), (5, "no json"), (6, None), (7, "[]"), (8, f'{{"{key}": 2}}'), (9, '"text"')]
    calls = spark.createDataFrame(rows, "n int, delta string").withColumn("delta", F.try_parse_json("delta"))
    assert sorted(r.n for r in M.changed_state(calls, "delta", "listed", "ui", 2).select("n").collect()) == [1, 2, 2]


@pytest.mark.parametrize("null_in_winner", [False, True])
def test_peer_sales_give_way(spark, null_in_winner):
    cols = "tx_group_id string, nft_asset_id long, price double"
    mine = [("g1", 1, 1.0), ("g2", 1, 1.0)] + ([(None, 5, 1.0)] if null_in_winner else [])
    markets = {"a": spark.createDataFrame(mine, cols), "b": spark.createDataFrame([("g3", 2, 1.0)], cols), "c": spark.createDataFrame([("g9", 9, 1.0)], cols),
               "p": spark.createDataFrame([("g1", 1, 9.0), ("g1", 2, 9.0), ("g3", 2, 9.0), ("g9", 9, 9.0), (None, 7, 9.0)], cols)}
    got = M.all_sales(markets, "p", ["a", "b"], ["tx_group_id", "nft_asset_id", "price"]).where("nft_marketplace = 'p'").collect()
    # c does not win; a null among the winning keys leaves no peer sale, as NOT IN does
    assert sorted((r.tx_group_id, r.nft_asset_id) for r in got) == ([] if null_in_winner else [("g1", 2), ("g9", 9)])


def test_name_sales_are_disjoint(spark):
    import __spark_entry__ as E
    rows = E.queries()["sales_names"](spark, "/root/testdata/sf0.001").collect()
    kinds = {}
    for r in rows:
        kinds.setdefault((r.tx_group_id, r.type == "secondary and transfers"), set()).add(r.type)
    assert {r.type for r in rows} == {"primary", "curated", "secondary and transfers"}
    moved = {(r.tx_group_id, r.nft_asset_id) for r in rows if r.type == "curated"}
    assert not moved & {(r.tx_group_id, r.nft_asset_id) for r in rows if r.type == "secondary and transfers"}


def test_broken_arguments_are_null(spark):
    from tidemark.operators import bridges as B
    rows = [(1, '["aGk=", "%%", "/w=="]'), (2, "[]"), (3, "no json"), (4, None), (5, '{"0": "aGk="}')]
    got = B.decoded_args(spark.createDataFrame(rows, "n int, args string"), "args", {"a": 0, "b": 1, "c": 2}).orderBy("n").collect()
    assert [(r.a, r.b, r.c) for r in got] == [("hi", None, None)] + [(None, None, None)] * 4
    ends = spark.createDataFrame([("x deposit",), ("deposit x",), (None,)], "t string").select(B.by_suffix(F.col("t"), {"deposit": "outbound"}))
    assert [r[0] for r in ends.collect()] == ["outbound", None, None]
