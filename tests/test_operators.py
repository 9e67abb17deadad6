"""Unit tests on a handful of literal rows: nulls, duplicates, empty input, boundaries."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark.functions import address, jsonx
from tidemark.functions import scalars as S
from tidemark.operators import dims, groups, incremental, ledger, quality, relational, windows


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


# ---------------------------------------------------------------- scalars

def test_concat_ws_strict_is_null_when_any_part_null(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    out = df.select(S.concat_ws_strict("-", "x", "y").alias("k"))
    assert sorted(r.k for r in out.collect() if r.k) == ["a-b"]
    assert sum(r.k is None for r in out.collect()) == 1


def test_surrogate_key_null_is_empty_text(spark):
    df = spark.createDataFrame([("pay", None)], "x string, y string")
    got = df.select(S.surrogate_key("x", "y").alias("k")).first().k
    want = spark.range(1).select(F.md5(F.lit("pay-")).alias("m")).first().m
    assert got == want
    # fixed value from the reference: md5('pay')
    assert spark.range(1).select(F.md5(F.lit("pay"))).first()[0].startswith("b02a45a5")


def test_b64_text_invalid_is_null(spark):
    df = spark.createDataFrame([("aGVsbG8=",), ("!!!",), ("/w==",), (None,)], "s string")
    got = [r.t for r in df.select(S.b64_text("s").alias("t")).collect()]
    assert got == ["hello", None, None, None]   # '/w==' is byte 0xFF: not UTF-8


def test_regexp_instr_from_offset(spark):
    df = spark.createDataFrame([("a1b2c3",)], "s string")
    r = df.select(S.regexp_instr_from("s", "[0-9]", 1).alias("a"),
                  S.regexp_instr_from("s", "[0-9]", 3).alias("b"),
                  S.regexp_instr_from("s", "[0-9]", 7).alias("c")).first()
    assert (r.a, r.b, r.c) == (2, 4, 0)


def test_round_half_up_and_safe_div(spark):
    df = spark.createDataFrame([(2.5, 0.0), (1.00005, 2.0)], "x double, y double")
    r = df.select(S.round_half_up("x", 0).alias("r"), S.safe_div("x", "y").alias("d")).collect()
    assert r[0].r == 3.0 and r[0].d is None
    assert r[1].d == 1.00005 / 2.0


def test_dow0_sunday_is_zero(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")   # a Sunday
    assert df.select(S.dow0("d")).first()[0] == 0


def test_epoch_millis_round_trip_is_zone_free(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 7, 179575),)], "ts timestamp_ntz")
    r = df.select(S.epoch_millis("ts").alias("ms")).first()
    assert r.ms == 1704067207179
    back = df.select(S.from_epoch_millis(S.epoch_millis("ts")).alias("t")).first().t
    assert back == dt.datetime(2024, 1, 1, 0, 0, 7, 179000)


# ---------------------------------------------------------------- relational

def test_not_in_null_semantics(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right_ok = spark.createDataFrame([(2,)], "k2 int")
    right_null = spark.createDataFrame([(2,), (None,)], "k2 int")
    right_empty = spark.createDataFrame([], "k2 int")
    assert rows(relational.not_in(left, "k", right_ok, "k2"), "k") == [(1,)]
    assert relational.not_in(left, "k", right_null, "k2").count() == 0
    assert relational.not_in(left, "k", right_empty, "k2").count() == 3


def test_or_join_counts_each_pair_once(spark):
    left = spark.createDataFrame([(1, 5, 5), (1, 5, 6), (1, 7, 8), (2, None, 5)], "g int, a int, b int")
    right = spark.createDataFrame([(1, 5), (2, 5)], "g2 int, k int")
    out = relational.or_join(left, right, [("g", "g2")], [("a", "k"), ("b", "k")])
    assert rows(out, "g", "a", "b") == [(1, 5, 5), (1, 5, 6), (2, None, 5)]


def test_or_join_shared_names_and_branch_conditions(spark):
    left = spark.createDataFrame([("g", 1, 5, "in"), ("g", 2, 5, "out"), (None, 1, 5, "in")], "g string, a int, b int, kind string")
    right = spark.createDataFrame([("g", 1, "in"), ("g", 5, "out")], "g string, k int, kind string")
    out = relational.or_join(left, right, [("g", "g")], [
        ("a", "k", lambda l, r: r("kind") == "in"), ("b", "k", lambda l, r: l("kind") == r("kind"))])
    assert out.columns == ["g", "a", "b", "kind", "r_g", "k", "r_kind"]
    assert rows(out, "a", "b", "kind", "k") == [(1, 5, "in", 1), (2, 5, "out", 5)]


def test_count_distinct_null_group_and_null_values(spark):
    df = spark.createDataFrame([(None, 1, "x"), (None, 2, "x"), ("a", None, "y"), ("a", None, "y"), ("b", 3, None)],
                               "g string, v int, w string")
    out = relational.count_distinct_many(df, ["g"], ["v", "w"])
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(None, 2, 1), ("a", 0, 1), ("b", 1, 0)], key=str)


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 2, 10), ("b", 1, None)], "k string, v int, t int")
    out = relational.latest_per_key(df, ["k"], [F.col("t").desc_nulls_first(), F.col("v").desc()])
    assert rows(out, "k", "v") == [("a", 2), ("b", 1)]


def test_neighbour_sparse_positions(spark):
    df = spark.createDataFrame([(1, 0, "u"), (1, 1, "a"), (1, 3, "a")], "g int, p int, r string")
    out = relational.neighbour(df, "g", "p", -1, ["r"], "prev_")
    assert rows(out, "p", "prev_r") == [(0, None), (1, "u"), (3, None)]


# ---------------------------------------------------------------- ledger

def test_daily_balance_dense_and_filled(spark):
    legs = spark.createDataFrame([
        ("x", dt.datetime(2024, 1, 1), 10.0), ("x", dt.datetime(2024, 1, 1, 5), -3.0),
        ("x", dt.datetime(2024, 1, 4), 1.0), ("y", dt.datetime(2024, 1, 2), 2.0)],
        "address string, ts timestamp_ntz, amount double")
    out = ledger.daily_balance(legs)
    assert rows(out, "address", "date", "balance") == [
        ("x", dt.date(2024, 1, 1), 7.0), ("x", dt.date(2024, 1, 2), 7.0), ("x", dt.date(2024, 1, 3), 7.0),
        ("x", dt.date(2024, 1, 4), 8.0), ("y", dt.date(2024, 1, 2), 2.0)]


def test_ledger_legs_one_pass_drop_null_address(spark):
    day = dt.datetime(2024, 1, 1)
    tr = spark.createDataFrame([("a", "b", "pay", 5.0, 0.25, "z", 2.0, day), ("a", None, "pay", 1.0, None, None, None, day),
                                ("a", "b", "keyreg", 9.0, None, None, None, day)],
                               "sender string, receiver string, tx_type string, amount double, reward double, "
                               "close_to string, close_amount double, ts timestamp_ntz")
    legs = ledger.ledger_legs(tr, ledger.default_legs())
    kinds = sorted((r.leg, r.address, r.amount) for r in legs.collect())
    assert kinds == sorted([("out", "a", -5.0), ("out", "a", -1.0), ("fee", "a", -0.001), ("fee", "a", -0.001),
                            ("fee", "a", -0.001), ("in", "b", 5.0), ("reward", "a", 0.25), ("close", "z", 2.0),
                            ("close_from", "a", 2.0)])


def test_daily_balance_from_opening_to_as_of(spark):
    legs = spark.createDataFrame([("x", dt.datetime(2024, 1, 3), 5.0), ("stranger", dt.datetime(2024, 1, 3), 1.0)],
                                 "address string, ts timestamp_ntz, amount double")
    acc = spark.createDataFrame([("x", dt.date(2024, 1, 2)), ("quiet", dt.date(2024, 1, 4))], "address string, opened date")
    out = ledger.daily_balance(legs, through=F.lit("2024-01-05").cast("date"), accounts=acc)
    day = lambda d: dt.date(2024, 1, d)
    assert rows(out, "address", "date", "balance") == [
        ("quiet", day(4), 0.0), ("quiet", day(5), 0.0), ("x", day(2), 0.0), ("x", day(3), 5.0), ("x", day(4), 5.0), ("x", day(5), 5.0)]


def test_seeded_balance_equals_full_rebuild(spark):
    legs = spark.createDataFrame(
        [("x", dt.datetime(2024, 1, d), float(d)) for d in range(1, 10)] + [("y", dt.datetime(2024, 1, 3), 1.0)],
        "address string, ts timestamp_ntz, amount double")
    sums = ledger.period_sums(legs, ["address"], F.to_date("ts"))
    full = ledger.running_balance(sums, ["address"])
    cut = F.lit("2024-01-05").cast("date")
    stored = ledger.running_balance(sums.where(F.col("period") < cut), ["address"])
    inc = ledger.seeded_running_balance(stored, sums.where(F.col("period") >= cut), ["address"], cut)
    want = rows(full.where(F.col("period") >= cut), "address", "period", "balance")
    got = rows(inc.where(F.col("period") >= cut), "address", "period", "balance")
    assert got == want


# ---------------------------------------------------------------- windows / quality

def test_forward_fill_global_crosses_chunks(spark):
    data = [(dt.datetime(2024, 1, 1, h), 1.0 if h == 22 else None) for h in range(24)] + \
           [(dt.datetime(2024, 1, 2, h), None) for h in range(3)] + [(dt.datetime(2024, 1, 3, 0), 5.0)]
    df = spark.createDataFrame(data, "hour timestamp_ntz, v double")
    out = windows.forward_fill_global(df, "hour", "v", F.to_date("hour"))
    got = dict((r.hour, r.v) for r in out.collect())
    assert got[dt.datetime(2024, 1, 1, 21)] is None
    assert got[dt.datetime(2024, 1, 2, 2)] == 1.0
    assert got[dt.datetime(2024, 1, 3, 0)] == 5.0


def test_sequence_gaps_across_buckets_and_duplicates(spark):
    df = spark.createDataFrame([(v,) for v in [1, 2, 3, 7, 8, 8, 20, None]], "n long")
    out = quality.sequence_gaps(df, [], "n")
    assert rows(out, "prev_n", "n", "gap") == [(3, 7, 3), (8, 8, -1), (8, 20, 11)]


def test_sequence_gaps_buffered_uses_previous_delayed(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (3, dt.datetime(2024, 1, 2)),
                                (6, dt.datetime(2024, 1, 3, 12))], "n long, t timestamp_ntz")
    out = quality.sequence_gaps_buffered(df, [], "n", "t", "15 HOURS")
    assert rows(out, "n", "gap") == [(3, 1), (6, 2)]
    out2 = quality.sequence_gaps_buffered(df, [], "n", "t", "2 DAYS")
    assert rows(out2, "n") == [(3,)]


def test_date_gaps_with_excluded_span(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 5, 20)], "d date")
    assert rows(quality.date_gaps(df, [], "d"), "d", "gap") == [(dt.date(2024, 1, 5), 2), (dt.date(2024, 1, 20), 14)]
    out = quality.date_gaps(df, [], "d", [("2024-01-15", "2024-01-25")])
    assert rows(out, "d") == [(dt.date(2024, 1, 5),)]


def test_report_levels(spark):
    one = spark.createDataFrame([(1,)], "x int")
    none = spark.createDataFrame([], "x int")
    many = spark.range(11)
    rep = quality.report([quality.Check("a", none), quality.Check("b", one, "warn"),
                          quality.Check("c", one, "error", error_after=10),
                          quality.Check("d", many, "error", error_after=10)])
    assert rows(rep, "check_name", "level") == [("a", "pass"), ("b", "warn"), ("c", "warn"), ("d", "error")]


# ---------------------------------------------------------------- incremental / dims / groups

def test_merge_twice_equals_once(spark):
    target = spark.createDataFrame([(1, "old"), (2, "old")], "k int, v string")
    batch = spark.createDataFrame([(2, "new"), (3, "new")], "k int, v string")
    once = incremental.merge(target, batch, ["k"])
    twice = incremental.merge(once, batch, ["k"])
    assert rows(once, "k", "v") == rows(twice, "k", "v") == [(1, "old"), (2, "new"), (3, "new")]


def merged(spark, target, stored, batch, schema="k int, v string, p string"):
    for part in (stored, batch):
        incremental.merge_partitions(spark, target, spark.createDataFrame(part, schema), ["k"], "p")
    back = incremental.read_table(spark, target, spark.createDataFrame([], schema).schema)
    return sorted(map(tuple, back.collect()), key=str)


def test_merge_partitions_null_text_and_moved_values(spark, tmp_path):
    stored = [(1, "a", None), (9, "b", None), (2, "c", "007"), (3, "d", "x"), (4, "e", "y"), (None, "n", "x")]
    batch = [(9, "B", None), (2, "C", "007"), (3, "D", "y"), (5, "f", "7"), (None, "N", "x")]
    want = [(1, "a", None), (9, "B", None), (2, "C", "007"), (3, "D", "y"), (4, "e", "y"), (5, "f", "7"), (None, "N", "x")]
    assert merged(spark, f"{tmp_path}/t", stored, batch) == sorted(want, key=str)
    # the whole partition x is left behind when its only keys move
    assert merged(spark, f"{tmp_path}/u", [(1, "a", "x")], [(1, "b", "z")]) == [(1, "b", "z")]
    assert merged(spark, f"{tmp_path}/w", [(1, "a", None)], [(2, "b", None)]) == [(1, "a", None), (2, "b", None)]
    again = spark.createDataFrame([(1, "b", "z")], "k int, v string, p string")
    incremental.merge_partitions(spark, f"{tmp_path}/u", again, ["k"], "p")
    assert spark.read.parquet(f"{tmp_path}/u").count() == 1


def test_dedup_batch_ties_do_not_depend_on_order(spark):
    rows_ = [(1, 5, "a"), (1, 5, "b"), (1, 4, "z")]
    for part in (rows_, rows_[::-1]):
        df = spark.createDataFrame(part, "k int, t int, v string")
        assert incremental.dedup_batch(df, ["k"], [F.col("t").desc()]).head().v == "b"


def test_append_stamp_is_utc(spark, tmp_path):
    import datetime
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        incremental.append_stamped(spark.range(1), f"{tmp_path}/a")
        got = spark.read.parquet(f"{tmp_path}/a").head()["_inserted_timestamp"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    now = datetime.datetime.now(datetime.timezone.utc).replace(tzinfo=None)
    assert abs((now - got).total_seconds()) < 300


def stream_balances(spark, base, landings):
    from tidemark.streaming import jobs
    schema = "key string, ts timestamp_ntz, amount double"
    for part in landings:
        spark.createDataFrame(part, "key string, ts string, amount double") \
            .withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.mode("append").parquet(f"{base}/landing")
        jobs.running_balance_stream(spark, f"{base}/landing", schema, "key", "ts", "amount", f"{base}/out", f"{base}/state", f"{base}/ckpt")
    got = jobs.current_balances(spark, f"{base}/out", ["key"])
    return sorted(((r.key, str(r.period), r.balance) for r in got.collect()), key=str)


def test_stream_balance_split_days_and_late_rows(spark, tmp_path):
    got = stream_balances(spark, tmp_path, [
        [("a", "2024-01-01", 10.0), ("a", "2024-01-03", 100.0), ("b", "2024-01-02", 1.0)],
        [("a", "2024-01-01", 5.0), ("b", "2024-01-05", 1.0), (None, "2024-01-02", 7.0)],
        [("b", "2024-01-01", 2.0)],
        [("a", "2024-01-04", 1.0)]])
    assert got == sorted([("a", "2024-01-01", 15.0), ("a", "2024-01-03", 115.0), ("a", "2024-01-04", 116.0),
                          ("b", "2024-01-01", 2.0), ("b", "2024-01-02", 3.0), ("b", "2024-01-05", 4.0),
                          (None, "2024-01-02", 7.0)], key=str)


def test_stream_balance_cost_does_not_follow_the_history(spark, tmp_path):
    from tidemark.streaming import jobs
    landings = [[("a", f"2023-{m:02d}-10", 1.0), ("b", f"2023-{m:02d}-11", 2.0)] for m in range(1, 6)]
    got = stream_balances(spark, tmp_path, [*landings, [("a", "2023-05-10", 0.5), ("c", "2023-06-01", 9.0)],
                                            [("b", "2023-04-01", 7.0)], [("a", "2023-12-01", 1.0)]])
    assert got == sorted([("a", "2023-01-10", 1.0), ("a", "2023-02-10", 2.0), ("a", "2023-03-10", 3.0), ("a", "2023-04-10", 4.0),
                          ("a", "2023-05-10", 5.5), ("a", "2023-12-01", 6.5),
                          ("b", "2023-01-11", 2.0), ("b", "2023-02-11", 4.0), ("b", "2023-03-11", 6.0), ("b", "2023-04-01", 13.0),
                          ("b", "2023-04-11", 15.0), ("b", "2023-05-11", 17.0), ("c", "2023-06-01", 9.0)], key=str)
    # months before a batch's first day keep the version they had; superseded versions are gone
    epochs = {part: epoch for part, (epoch, _) in jobs.newest_parts(spark, f"{tmp_path}/out").items()}
    assert epochs == {"202301": 0, "202302": 1, "202303": 2, "202304": 6, "202305": 6, "202306": 5, "202312": 7}
    kept = {p.parent.name for p in (tmp_path / "out").glob("epoch=*/part=202305")}
    assert kept == {"epoch=5", "epoch=6"}


def test_stream_balance_replayed_epoch_counts_once(spark, tmp_path):
    from tidemark.streaming import jobs
    parts = [[("a", "2024-01-01", 10.0)], [("a", "2024-01-01", 5.0), ("a", "2024-02-01", 1.0), ("z", None, 3.0)]]
    stream_balances(spark, tmp_path, parts)
    # lose the commit of the last epoch: it is run again
    for p in (tmp_path / "ckpt" / "commits").glob("*1*"):
        p.unlink()
    stream_balances(spark, tmp_path, [])
    got = jobs.current_balances(spark, f"{tmp_path}/out", ["key"]).collect()
    assert sorted((r.key, str(r.period), r.balance) for r in got) == [("a", "2024-01-01", 15.0), ("a", "2024-02-01", 16.0)]


def test_stream_balance_any_order_in_many_tasks(spark, tmp_path, monkeypatch):
    import random
    from collections import defaultdict

    from tidemark.streaming import jobs
    monkeypatch.setattr(jobs, "TASK_ROWS", 4)
    rnd = random.Random(3)
    legs = [(rnd.choice(["a", "b", "c", None]), str(dt.date(2024, 1, 1) + dt.timedelta(rnd.randrange(150))), float(rnd.randrange(-50, 50)))
            for _ in range(90)]
    legs += [("once", "2024-02-02", 5.0), ("a", None, 9.0)]
    got = stream_balances(spark, tmp_path, [legs[:40], legs[40:75], legs[75:]])
    days = defaultdict(lambda: defaultdict(float))
    for key, day, amount in legs:
        if day:
            days[key][day] += amount
    want = [(key, day, sum(v for d, v in own.items() if d <= day)) for key, own in days.items() for day in own]
    assert got == sorted(want, key=str)


def test_stream_balance_legs_are_made_once(spark, tmp_path, monkeypatch):
    from tidemark.plans import REGISTRY, stream_plans
    read, land = [], stream_plans._land
    monkeypatch.setattr(stream_plans, "_land", lambda df, path: (read.append(df.inputFiles()), land(df, path)))
    orders = [(n, n % 3, dt.datetime(1998, 12, 20) + dt.timedelta(n)) for n in range(30)]
    lines = [(n, i, (n + i) % 4, 100.0 * n + i, 0.1, 0.01 * i, 3.0, "RNA"[i % 3], "FO"[n % 2]) for n in range(30) for i in range(1, 6)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_extendedprice double, l_discount double, l_tax double, "
                          "l_quantity double, l_returnflag string, l_linestatus string").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = REGISTRY["stream_running_balance"].fn(spark, str(tmp_path))
    days = {(f"c{c}", str(day.date())) for _, c, day in orders} | {
        (f"s{s}", str(orders[n][2].date())) for n, i, s, *_, flag, status in lines if not (status == "F" and i % 3 == 0) or (flag == "R" and i % 4 == 0)}
    assert {(r.address, str(r.date)) for r in got.collect()} == days
    assert len(read) == 3 and all(files and not any("/lineitem.parquet" in f for f in files) for files in read)


def test_json_recursive_levels_nulls_and_empty_arrays(spark):
    doc = '{"n":1,"dt":{"itx":[{"n":2,"dt":{"itx":[]}},null,{"dt":{"itx":[{"n":4}]}},7]}}'
    df = spark.createDataFrame([(1, doc), (2, None), (3, '{"n":5,"dt":{"itx":3}}')], "id int, j string")
    nodes = jsonx.explode_recursive(df.select("id", F.try_parse_json("j").alias("v")), "v", ["id"], {"n": ("$.n", "int")})
    assert sorted(((r.id, r.path, r.n) for r in nodes.collect()), key=str) == sorted([
        (1, "", 1), (1, "dt.itx[0]", 2), (1, "dt.itx[1]", None), (1, "dt.itx[2]", None), (1, "dt.itx[2].dt.itx[0]", 4),
        (1, "dt.itx[3]", None), (2, "", None), (3, "", 5)], key=str)


def test_missing_columns_reads_the_schema_only(spark):
    df = spark.createDataFrame([], "a int, b int")
    assert rows(quality.missing_columns(spark, df, ["a", "c"]), "column_name", "problem") == [("c", "missing")]


def test_bucket_stats_and_medians_keep_null_keys(spark):
    from tidemark.operators import pricing
    df = spark.createDataFrame([(None, "h", 1.0), (None, "h", 3.0), ("x", "h", 1.0), ("x", "h", 5.0), ("x", "h", 5.0), ("y", "h", None)],
                               "asset string, hour string, price double")
    got = pricing.with_bucket_stats(df, ["asset", "hour"], n=F.count("price"))
    got = pricing.with_bucket_median(got, ["asset", "hour"], "price", "med")
    assert sorted(((r.asset, r.price, r.n, r.med) for r in got.collect()), key=str) == sorted(
        [(None, 1.0, 2, 2.0), (None, 3.0, 2, 2.0), ("x", 1.0, 3, 5.0), ("x", 5.0, 3, 5.0), ("x", 5.0, 3, 5.0), ("y", None, 0, None)],
        key=str)


def test_trade_price_thin_hour_uses_swap_shares(spark):
    from tidemark.operators import pricing
    h = [dt.datetime(2024, 1, 1, i) for i in range(6)]
    rows_ = [(h[0], 7, 1.0, 1, 10.0, "A"), (h[0], 7, 1.0, 1, 10.0, "A"), (h[0], 7, 1.0, 1, 16.0, "B"),
             (h[0], 7, 1.0, 1, 500.0, "B"), (h[3], 7, 2.0, 1, 30.0, "A"), (h[5], 7, 1.0, 1, 99.0, "A")]
    df = spark.createDataFrame(rows_, "hour timestamp_ntz, from_asset long, from_amount double, to_asset long, to_amount double, venue string")
    got = pricing.price_from_trades(df, [1], 0).orderBy("hour").collect()
    # 500 is beyond twice the median; shares are by swaps (2 of 4 each); the newest hour is open
    assert [(r.hour.hour, r.price, r.swaps) for r in got] == [(0, 13.0, 4), (1, 13.0, None), (2, 13.0, None), (3, 15.0, 1)]
    assert got[0].max_price == 500.0 and got[0].volume == 4.0 * 13.0


def test_new_rows_first_run_and_lookback(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, h),) for h in range(10)], "ts timestamp_ntz")
    assert incremental.new_rows(df, "ts", None).count() == 10
    hwm = dt.datetime(2024, 1, 1, 8)
    assert incremental.new_rows(df, "ts", hwm).count() == 2
    assert incremental.new_rows(df, "ts", hwm, "4 HOURS").count() == 6


def test_lookup_key_sentinels(spark):
    dim = spark.createDataFrame([("k1", 1)], "key string, nat int")
    fact = spark.createDataFrame([(1,), (2,), (None,)], "nat int")
    out = dims.lookup_key(fact, dim, "nat", "nat", "key", "dim_id")
    assert rows(out.fillna(-9, ["nat"]), "nat", "dim_id") == [(-9, "-2"), (1, "k1"), (2, "-1")]


def test_inferred_members(spark):
    dim = spark.createDataFrame([("m1", 1, "one")], "k string, nat int, name string")
    seen = spark.createDataFrame([(1,), (2,), (2,), (None,)], "nat int")
    out = dims.inferred_members(dim, seen, "nat", "k")
    assert rows(out, "nat", "inferred") == [(1, False), (2, True)]


def test_shape_filter_and_two_pass(spark):
    legs = spark.createDataFrame([(1, "R", "p"), (1, "N", "q"), (2, "A", "p"), (2, "R", "r"),
                                  (3, "R", "z"), (3, "N", "q"), (3, "N", "w")], "g int, kind string, pool string")
    shape = groups.shape_filter(legs, "g", "kind", {"R": 1}, min_legs=2, absent=("A",))
    assert rows(shape, "g") == [(1,), (3,)]
    tp = groups.two_pass_match(legs, "g", "pool", 2)
    assert rows(tp, "g", "pool", "pass") == [(1, "p", "pass1"), (1, "q", "pass1"), (2, "p", "pass1"),
                                             (2, "r", "pass1"), (3, "q", "pass2")]


def test_direction_tag(spark):
    tr = spark.createDataFrame([("c", "x"), ("x", "c"), ("a", "b")], "sender string, receiver string")
    cust = spark.createDataFrame([("c",)], "address string")
    out = groups.direction_tag(tr, cust)
    assert rows(out, "sender", "direction") == [("c", "outbound"), ("x", "inbound")]


# ---------------------------------------------------------------- json / codec

def test_json_recursive_and_presence(spark):
    doc = '{"txn":{"type":"appl"},"dt":{"itx":[{"txn":{"type":"pay"}},{"txn":{"type":"axfer"},' \
          '"dt":{"itx":[{"txn":{"type":"pay"}}]}}]},"close":null}'
    df = spark.createDataFrame([(1, doc)], "id int, j string").select("id", F.parse_json("j").alias("v"))
    nodes = jsonx.explode_recursive(df, "v", ["id"], {"kind": ("$.txn.type", "string")})
    assert sorted((r.path, r.kind) for r in nodes.collect()) == [
        ("", "appl"), ("dt.itx[0]", "pay"), ("dt.itx[1]", "axfer"), ("dt.itx[1].dt.itx[0]", "pay")]
    r = df.select(jsonx.present("v", "$.close").alias("p"), jsonx.is_json_null("v", "$.close").alias("n"),
                  jsonx.present("v", "$.nope").alias("q")).first()
    assert (r.p, r.n, r.q) == (True, True, False)


def test_json_recursive_has_no_depth_or_row_bound(spark):
    deep = '{"n":0}'
    for i in range(1, 20):
        deep = f'{{"n":{i},"dt":{{"itx":[{deep}]}}}}'
    df = spark.createDataFrame([(1, deep)], "id int, j string").select("id", F.parse_json("j").alias("v"))
    nodes = jsonx.explode_recursive(df, "v", ["id"], {"n": ("$.n", "int")}).collect()
    assert sorted(r.n for r in nodes) == list(range(20)) and max(r.path.count("itx") for r in nodes) == 19
    wide = spark.range(510_000).select("id", F.parse_json(F.lit('{"n":1,"dt":{"itx":[{"n":2},{"n":3}]}}')).alias("v"))
    assert jsonx.explode_recursive(wide, "v", ["id"], {"n": ("$.n", "int")}).count() == 3 * 510_000


def test_bad_address_keys_are_null(spark):
    df = spark.createDataFrame([("zz",), ("00",), ("00" * 33,), ("0" * 63,), (None,)], "pk string")
    assert [r.addr for r in address.encode_addresses(df, "pk", "addr").collect()] == [None] * 5
    good = address.encode_one(bytes(range(32)))
    assert address.decode_one(good) == bytes(range(32)).hex().upper()
    assert address.decode_one(good[:-1] + "A") is None and address.decode_one("!") is None and address.decode_one(None) is None


def test_address_encoding_known_vector():
    # public fact of the address format: the all-zero key encodes to this 58-char text
    assert address.encode_one(bytes(32)) == "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAY5HFKQ"


def test_encode_addresses_job_distinct_keys(spark):
    df = spark.createDataFrame([("00" * 32,), ("00" * 32,), (None,)], "pk string")
    out = address.encode_addresses(df, "pk", "addr")
    got = [r.addr for r in out.collect()]
    assert got.count("AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAY5HFKQ") == 2 and None in got


def test_encode_addresses_from_base64_keys(spark):
    import base64
    zero = base64.b64encode(bytes(32)).decode()
    df = spark.createDataFrame([(zero,), ("not base64!",), (base64.b64encode(b"short").decode(),)], "pk string")
    got = sorted((r.pk, r.addr) for r in address.encode_addresses(df, "pk", "addr", kind="b64").collect())
    assert dict(got)[zero] == "AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAY5HFKQ"
    assert sum(a is None for _, a in got) == 2


def test_sequence_gaps_null_partition_key_is_a_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (None, 9), ("a", 1), ("a", 5)], "g string, n long")
    out = quality.sequence_gaps(df, ["g"], "n")
    assert rows(out.fillna("<null>", ["g"]), "g", "prev_n", "n") == [("<null>", 2, 9), ("a", 1, 5)]


def test_daily_balance_with_a_hot_address_matches_brute_force(spark):
    import random

    import pandas as pd
    rnd = random.Random(7)
    rows_ = []
    for i in range(3000):
        addr = "hot" if i % 3 == 0 else f"a{rnd.randrange(200)}"
        day = dt.datetime(2024, 1, 1) + dt.timedelta(days=rnd.randrange(60), hours=rnd.randrange(24))
        rows_.append((addr, day, float(rnd.randrange(-500, 500))))
    legs = spark.createDataFrame(rows_, "address string, ts timestamp_ntz, amount double")
    got = {(r.address, r.date): r.balance for r in ledger.daily_balance(legs).collect()}
    pdf = pd.DataFrame(rows_, columns=["address", "ts", "amount"])
    pdf["date"] = pdf.ts.dt.date
    want = {}
    for addr, g in pdf.groupby("address"):
        daily = g.groupby("date").amount.sum().sort_index().cumsum()
        days = pd.date_range(daily.index.min(), daily.index.max(), freq="D").date
        filled = daily.reindex(days).ffill()
        want.update({(addr, d): float(v) for d, v in filled.items()})
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-6 for k in want)
