import random

from tidemark.llm import url_rules

U = "verdict string, host string, path string"


def brute(url, rules, default):
    host, path = url_rules.split_url(url)
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for v, h, p in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    if not fits:
        return host, path, None, default
    *_, rule, verdict = max(fits)
    return host, path, rule, verdict


def test_split_url():
    assert url_rules.split_url(None) == url_rules.split_url("no scheme/x") == ("", "")
    assert url_rules.split_url("HTTP://A.Example.NET?x=/en/") == ("a.example.net", "")
    assert url_rules.split_url("a://b#c://d") == ("b", "")
    assert url_rules.split_url("http://É.net/en/1?p#q") == ("É.net", "/en/1")


def test_sweep_equals_brute_force(spark):
    rnd = random.Random(3)
    labels = ["a", "b", "net", "example", "é", ""]
    paths = ["/", "/en/", "/en/x", "/de/", "", "/en"]
    host = lambda: ".".join(rnd.choice(labels) for _ in range(rnd.randint(1, 4)))
    rules = list({(h, p): (rnd.choice(["block", "allow"]), h, p) for h, p in
                  ((host(), rnd.choice(paths)) for _ in range(60))}.values())
    urls = [f"http://{host()}{rnd.choice(paths)}{rnd.choice(['', '1', '?q', '#f'])}" for _ in range(1500)]
    urls += [None, "", "plain", "x://"] + ["http://a.net/en/1"] * 500
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    df = spark.createDataFrame(rules + [(None, "a", "/"), ("block", None, "/"), ("allow", "b", None)], U)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict)
           for r in url_rules.judge_pages(pages.repartition(5), df, ranges=13).collect()}
    for i, u in enumerate(urls):
        want = brute(u, rules, "allow")
        assert got[i][:2] == want[:2] and got[i][3] == want[3], (u, got[i], want)
        assert got[i][2] == want[2] or len(got[i][2]) == len(want[2])


def test_conflicting_rules_block_and_rows_repeat(spark):
    pages = spark.createDataFrame([(None, "http://x.a/"), (1, "http://x.a/"), (1, "http://x.a/")], "page_id long, url string")
    rules = spark.createDataFrame([("allow", "A", "/"), ("block", "a", "/"), ("allow", "a", "/")], U)
    got = url_rules.judge_pages(pages, rules).collect()
    assert [(r.rule, r.verdict) for r in got] == [("a/", "block")] * 3


def test_empty_tables(spark):
    none = spark.createDataFrame([], U)
    pages = spark.createDataFrame([(1, "http://a/")], "page_id long, url string")
    assert [r.verdict for r in url_rules.judge_pages(pages, none).collect()] == ["allow"]
    assert url_rules.judge_pages(pages.limit(0), none).count() == 0
