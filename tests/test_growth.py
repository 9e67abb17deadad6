"""What is sorted, sent and made once, read off the plans; results on rows of the tests' own."""

import datetime
import re

from pyspark.sql import functions as F
from pyspark.sql.types import VariantType

from tidemark.operators import assets as A
from tidemark.operators import dims as D
from tidemark.operators import ledger as L
from tidemark.operators import movements as M
from tidemark.operators import relational as R
from tidemark.plans import REGISTRY

SF = "/root/testdata/sf0.001"


def executed(spark, make):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_salts_of_rows_without_a_key_stay_in_the_join(spark):
    """A constant on the other side was taken out of the join key, and with it the salt."""
    held = spark.createDataFrame([("a", 1, 1.0, 4, None, False, True), ("b", 2, 2.0, 5, 5, True, None)],
                                 "address string, asset_id long, amount double, created_at long, closed_at long, asset_closed boolean, frozen boolean")
    accounts = spark.createDataFrame([("a", 5, 4, None)], "address string, raw_amount long, created_at long, closed_at long")
    blocks = spark.createDataFrame([("k5", 5, datetime.datetime(2024, 1, 1)), ("none", None, None)], "dim_block_id string, block_id long, block_timestamp timestamp_ntz")
    people = spark.createDataFrame([("a", "A")], "address string, dim_account_id string")
    things = spark.createDataFrame([(1, "one")], "asset_id long, dim_asset_id string")
    fact = M.holdings_fact(held, accounts, people, things, blocks)
    assert len(re.findall(r"hashpartitioning\((?:created|closed)_at#\d+L, __salt#\d+L", executed(spark, lambda: M.holdings_fact(held, accounts, people, things, blocks)))) == 2
    got = {(r.address, r.asset_id): (r.dim_block_id__asset_added_at, r.dim_block_id__asset_last_removed) for r in fact.collect()}
    assert got == {("a", 1): ("-1", "-2"), ("b", 2): ("k5", "k5"), ("a", 0): ("-1", "-2")}
    keyed = lambda: D.lookup_key(held, people, "address", "address", "dim_account_id", "who")
    assert re.search(r"hashpartitioning\(address#\d+, __who_salt#", executed(spark, keyed))


def test_uploads_are_sorted_without_their_parsed_form(spark):
    uploads = spark.createDataFrame([(1, "D01-02", "u", f"m{n}", f'{{"name": "n{n}", "image": "i{n}"}}') for n in (2, 1)],
                                    "asset_id long, asset_name string, asset_url string, metadata_url string, metadata string")
    titles = A.mine_titles(uploads)
    node = titles._jdf.queryExecution().optimizedPlan()
    while node.nodeName() != "Window":
        node = node.children().head()
    assert VariantType().simpleString() not in [node.output().apply(i).dataType().simpleString() for i in range(node.output().size())]
    assert [(r.name, r.image, r.metadata_url) for r in titles.collect()] == [("n1", "i1", "m1")]


def test_pairs_with_the_coin_are_dealt_out(spark):
    swaps = spark.createDataFrame([("p", f"pool{n}", n % 3, 0) for n in range(200)] + [("q", "pool0", 0, 1)], "program string, pool string, from_asset long, to_asset long")
    assets = spark.createDataFrame([(0, "zero", 5), (1, "one", 7), (2, None, 9)], "asset_id long, asset_name string, created_at long")
    plan = executed(spark, lambda: M.pool_labels(swaps, assets, "COIN"))
    assert len(re.findall(r"hashpartitioning\((?:from|to)_asset#\d+L, copy#\d+", plan)) >= 2
    got = {r.address: r.address_name for r in M.pool_labels(swaps, assets, "COIN").collect()}
    assert got == {f"pool{n}": f"p: {['COIN', 'one', '2'][n % 3]}-COIN pool" for n in range(1, 200)} | {"pool0": "q: COIN-one pool"}


def test_dense_reserves_are_not_sent(spark):
    plan = executed(spark, lambda: REGISTRY["price_from_reserves"].fn(spark, SF))
    above = plan[:plan.index("Generate explode")]
    assert "hashpartitioning(pool" not in above


def test_transfers_carry_no_keys_of_their_parties(spark):
    plan = executed(spark, lambda: REGISTRY["encode_addresses"].fn(spark, SF))
    assert "sender_pk" not in plan and "sha2(" not in plan


def test_lines_and_sales_of_all_markets_are_made_once(spark):
    plan = executed(spark, lambda: REGISTRY["sales_all_markets"].fn(spark, SF))
    assert "/lineitem.parquet" not in plan and "/orders.parquet" not in plan


def test_groups_of_all_markets_are_read_where_they_lie(spark):
    """Every aggregate and join by group sent the lines once more."""
    plan = executed(spark, lambda: REGISTRY["sales_all_markets"].fn(spark, SF))
    assert "Bucketed: true" in plan
    assert len(re.findall(r"hashpartitioning\(group_id#\d+, \d+\)", plan)) <= 2  # those of unions, which have no part of a bucket
    assert "hashpartitioning(block_id" not in plan and "hashpartitioning(group_id#" in plan


def test_rows_written_in_buckets_come_back(spark):
    rows = [("a", 1), ("b", 2), (None, 3), ("a", 1), (None, None)]
    df = R.written_by(R.dealt(spark.createDataFrame(rows, "g string, n long"), "g"), "g", "test-rows")
    sums = lambda: df.groupBy("g").agg(F.sum("n").alias("n")).join(df, "g", "left_semi")
    assert "Exchange" not in executed(spark, sums)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(rows, key=str)
    assert sorted(map(tuple, sums().collect())) == [("a", 2), ("b", 2)]


def test_holdings_send_short_keys_and_only_closed_ones_for_their_end(spark):
    """Each join sent all rows with the 32 digits of every key found before."""
    keys = ["0123456789abcdef" * 2, "0123456789ABCDEF" * 2, "~" * 15, "!" * 15, "~" * 16, "!" * 16, "!", "~", "", "k", "0123456789abcdef" * 2 + "\n", "é" * 8, None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", M._short("k").alias("s"))
    got = df.select("k", M._long("s").alias("back"), F.octet_length("s").alias("n")).collect()
    assert [r.back for r in got] == keys and [r.n == 16 for r in got] == [True] + [False] * 12
    held = spark.createDataFrame([("a", n, 1.0, 4 + n % 3, n if n % 2 else None, False, True) for n in range(6)],
                                 "address string, asset_id long, amount double, created_at long, closed_at long, asset_closed boolean, frozen boolean")
    accounts = spark.createDataFrame([("a", 5, 4, None)], "address string, raw_amount long, created_at long, closed_at long")
    blocks = spark.createDataFrame([(f"{n:032x}", n, datetime.datetime(2024, 1, n)) for n in (1, 3, 4, 6)], "dim_block_id string, block_id long, block_timestamp timestamp_ntz")
    people = spark.createDataFrame([("a", "f" * 32)], "address string, dim_account_id string")
    things = spark.createDataFrame([(n, f"{n:032x}") for n in range(5)], "asset_id long, dim_asset_id string")
    make = lambda: M.holdings_fact(held, accounts, people, things, blocks)
    above = executed(spark, make)
    above = above[:above.index("hashpartitioning(closed_at")]
    assert "isnotnull(closed_at" in executed(spark, make).split("hashpartitioning(closed_at")[1] and "hashpartitioning(created_at" in above
    key = lambda n, ok, other: f"{n:032x}" if n in ok else other
    assert sorted((r.asset_id, r.amount, r.dim_account_id, r.dim_asset_id, r.dim_block_id__asset_added_at, r.dim_block_id__asset_last_removed,
                   r.asset_last_removed and r.asset_last_removed.day) for r in make().collect()) == sorted(
        [(n, 1.0, "f" * 32, key(n, range(5), "-1"), key(4 + n % 3, (4, 6), "-1"), key(n, (1, 3), "-2") if n % 2 else "-2", n if n in (1, 3) else None) for n in range(6)]
        + [(0, 5e-6, "f" * 32, key(0, [0], ""), key(4, [4], ""), "-2", None)])


def test_day_sums_are_sent_by_key_once(spark):
    """Sums of legs, those of known accounts with their openings, and balances were four exchanges."""
    day = lambda n: datetime.date(2024, 1, n)
    legs = spark.createDataFrame([("a", datetime.datetime(2024, 1, 3, 5), 2.0), ("a", datetime.datetime(2024, 1, 3, 6), 1.0), ("b", datetime.datetime(2024, 1, 2), 5.0),
                                  (None, datetime.datetime(2024, 1, 2), 7.0)], "address string, ts timestamp_ntz, amount double")
    accounts = spark.createDataFrame([("a", day(2)), ("a", day(2)), ("c", day(4)), (None, day(4))], "address string, opened date")
    make = lambda: L.balance_intervals(legs, "address", None, accounts)
    plan = executed(spark, make)
    assert len(re.findall(r"hashpartitioning\(address#\d+, period", plan)) == 2 and len(re.findall(r"hashpartitioning\(address#\d+, \d+\)", plan)) == 2  # one each for keys and for none
    want = [("a", day(2), day(2), 0.0), ("a", day(3), None, 3.0), ("c", day(4), None, 0.0), (None, day(4), None, 0.0)]
    assert sorted(map(tuple, make().collect()), key=str) == sorted(want, key=str)
    dense = L.daily_balance(legs, "address", F.lit(day(4)), None, accounts)
    assert sorted(map(tuple, dense.collect()), key=str) == sorted(
        [("a", day(2), 0.0), ("a", day(3), 3.0), ("a", day(4), 3.0), ("c", day(4), 0.0), (None, day(4), 0.0)], key=str)
