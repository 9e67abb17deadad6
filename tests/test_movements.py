"""Movement jobs on literal rows: nulls, ties, repeats and empty inputs."""

import datetime as dt

from tidemark.operators import movements as M

TX = ("block_id long, intra long, group_id string, tx_id string, inner_tx boolean, tx_type string, app_id long, asset_id long, asset_amount long, "
      "amount long, sender string, receiver string, asset_sender string, asset_receiver string, fee long, message string")
ASSETS = "asset_id long, decimals int"


def tx(spark, *rows):
    names = [c.split()[0] for c in TX.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], TX)


def got(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=str)


def test_close_outs_take_positive_amounts_of_whole_messages(spark):
    base = dict(block_id=1, intra=1, group_id="g", tx_id="t", inner_tx=False)
    df = tx(spark, {**base, "message": '{"ca":5,"txn":{"close":"a"}}'}, {**base, "message": '{"ca":2,"txn":{"close":"a"}}'},
            {**base, "message": '{"aca":7,"txn":{"aclose":"b","xaid":9}}'}, {**base, "message": '{"ca":0,"txn":{"close":"a"}}'},
            {**base, "message": '{"ca":3,"txn":{}}'}, {**base, "message": "{oops"}, {**base, "message": None}, {**base, "message": ""})
    assert got(M.close_outs(df), "account", "asset_id", "amount") == [("a", 0, 7), ("b", 9, 7)]
    assert M.close_outs(df.limit(0)).count() == 0


def test_asset_flow_signs_and_scale(spark):
    t = dict(block_id=1, tx_type="axfer", asset_id=7)
    df = tx(spark, {**t, "intra": 1, "sender": "a", "asset_receiver": "b", "asset_amount": 100},
            {**t, "intra": 2, "sender": "x", "asset_sender": "a", "receiver": "b", "asset_amount": 50},
            {**t, "intra": 3, "sender": "a", "asset_receiver": "b", "asset_amount": 0},
            {**t, "intra": 4, "sender": "a", "asset_receiver": "a", "asset_amount": 9},
            {**t, "intra": 5, "asset_id": 8, "sender": None, "asset_receiver": "b", "asset_amount": 3})
    closes = spark.createDataFrame([(1, 1, "c", 7, 10), (1, 1, "c", 0, 99)], "block_id long, intra long, account string, asset_id long, amount long")
    assets = spark.createDataFrame([(7, 1)], ASSETS)
    assert got(M.asset_flow(df, closes, assets), "asset_id", "address", "amount") == sorted(
        [(7, "a", -14.0), (7, "b", 15.0), (7, "c", 1.0), (8, "b", 3.0), (8, None, -3.0)], key=str)
    assert ("a", -16.0) in got(M.asset_flow(df, closes, assets, sender_sign=-1), "address", "amount")


def test_bridges_by_accounts_and_by_inner_flag(spark):
    call = [dict(tx_type="appl", app_id=5, group_id="g"), dict(tx_type="appl", app_id=5, group_id="g"), dict(tx_type="appl", app_id=6, group_id="h")]
    t = dict(tx_type="axfer", group_id="g", asset_id=7, asset_amount=10, inner_tx=False)
    df = tx(spark, *call, {**t, "intra": 1, "sender": "B", "asset_receiver": "u"}, {**t, "intra": 2, "sender": "u", "asset_receiver": "B"},
            {**t, "intra": 3, "sender": "u", "asset_receiver": "v", "inner_tx": True}, {**t, "intra": 4, "sender": "B", "asset_receiver": "B"},
            {**t, "intra": 5, "group_id": "h", "sender": "B", "asset_receiver": "u"}, {**t, "intra": 6, "group_id": None, "sender": "B"},
            dict(tx_type="pay", group_id="g", intra=7, asset_id=0, amount=100000, sender="u", receiver="B", inner_tx=False),
            dict(tx_type="pay", group_id="g", intra=8, asset_id=0, amount=2000000, sender="u", receiver="B", inner_tx=None),
            dict(tx_type="pay", group_id="g", intra=9, asset_id=None, amount=100000, sender="u", receiver="B", inner_tx=True))
    assert got(M.bridge_by_accounts(df, 5, ["B"]), "intra", "direction", "bridger_address", "bridge_address") == [
        (1, "inbound", "u", "B"), (2, "outbound", "u", "B"), (3, None, None, None), (4, "inbound", "B", "B")]
    out = M.bridge_by_inner(df, 5, spark.createDataFrame([(7, 1)], ASSETS), [100000])
    assert got(out, "intra", "direction", "bridger_address", "amount") == [
        (1, "outbound", "B", 1.0), (2, "outbound", "u", 1.0), (3, "inbound", "v", 1.0), (4, "outbound", "B", 1.0), (8, None, None, 2.0),
        (9, "inbound", "B", 100000.0)]


def test_pool_labels_newest_pair_and_missing_names(spark):
    sw = spark.createDataFrame([("P", "p1", 0, 2), ("P", "p1", 0, 2), ("P", "p1", 1, 2), ("P", "p2", 1, 3), ("P", "p3", 1, None), ("Q", "p2", 1, 2),
                                ("Q", None, 1, 2)], "program string, pool string, from_asset long, to_asset long")
    a = spark.createDataFrame([(1, "one", 5), (2, None, 6)], "asset_id long, asset_name string, created_at int")
    # the native coin has no creation block and asset 3 is unknown: both count as newest
    assert got(M.pool_labels(sw, a, "COIN"), "address", "address_name") == sorted(
        [("p1", "P: COIN-2 pool"), ("p2", "P: one-3 pool"), (None, "Q: one-2 pool")], key=str)


def test_holdings_and_blocks_carry_sentinel_keys(spark):
    day = dt.datetime(2024, 1, 1)
    held = spark.createDataFrame([("a", 7, 1.5, 1, None, False, False), ("z", 8, 0.0, 5, 1, True, None), (None, None, None, None, 5, None, None)],
                                 "address string, asset_id long, amount double, created_at long, closed_at long, asset_closed boolean, frozen boolean")
    accounts = spark.createDataFrame([("a", 2500000, 1, None)], "address string, raw_amount long, created_at long, closed_at long")
    dim_a = spark.createDataFrame([("a", "ka")], "address string, dim_account_id string")
    dim_s = spark.createDataFrame([(7, "k7"), (0, "k0")], "asset_id long, dim_asset_id string")
    dim_b = spark.createDataFrame([(1, "b1", day)], "block_id long, dim_block_id string, block_timestamp timestamp_ntz")
    f = M.holdings_fact(held, accounts, dim_a, dim_s, dim_b)
    assert got(f, "address", "dim_account_id", "dim_asset_id", "amount", "dim_block_id__asset_added_at", "dim_block_id__asset_last_removed") == sorted(
        [("a", "ka", "k7", 1.5, "b1", "-2"), ("a", "ka", "k0", 2.5, "b1", "-2"), ("z", "-1", "-1", 0.0, "-1", "b1"),
         (None, "-1", "-1", None, "-1", "-2")], key=str)
    blocks = spark.createDataFrame([(1, day), (2, None)], "block_id long, block_timestamp timestamp_ntz")
    rows = tx(spark, dict(block_id=1, intra=1, sender="a", fee=3), dict(block_id=1, intra=1, sender="a", fee=4), dict(block_id=1, intra=2, sender=None, fee=None),
              dict(block_id=9, intra=1, sender="a", fee=1))
    assert got(M.block_fact(blocks, rows, dim_b), "block_id", "dim_block_id", "tx_count", "tx_sender_count", "fee_total") == [
        (1, "b1", 2, 1, 7), (2, "-1", 0, 0, 0)]
