import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from tidemark.llm import components, simhash


def brute_fingerprint(text, n=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    sh = [b" ".join(words[i:i + n]) for i in range(len(words) - n + 1)] or [b" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hs) > len(hs))


def brute_components(ids, fps, d=4):
    low = list(range(len(ids)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i, j in combinations(range(len(ids)), 2):
        if (fps[i] ^ fps[j]).bit_count() <= d:
            a, b = find(i), find(j)
            low[max(a, b)] = min(a, b)
    groups = {}
    for i in range(len(ids)):
        groups.setdefault(find(i), []).append(i)
    return {i: min((ids[k] for k in g if ids[k] is not None), default=None) for g in groups.values() for i in g}


def signed(x):
    return x - (1 << 64) if x >> 63 else x


TEXTS = ["", "  \n", None, "One two", "one\ttwo", "ONE TWO", "a b c d", "a b c d e f g h", "é É ü x\x0by",
         "long " * 70_000, "tie a b c d e"]


def test_fingerprint_is_the_bitwise_majority():
    for t in TEXTS:
        assert simhash.fingerprint(t or "", 4) == brute_fingerprint(t)


def test_rows_nulls_repeats_and_extra_columns(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)] + [(3, "One two", "x", 1), (None, "one two", "y", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string, component_id int")
    got = simhash.simhash_components(docs).collect()
    fps = [brute_fingerprint(r[1]) for r in rows]
    want = brute_components([r[0] for r in rows], fps)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint, r.component_id) for r in got) == \
        sorted((r[0] if r[0] is not None else -1, f"{f:016x}", want[i]) for i, (r, f) in enumerate(zip(rows, fps)))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.simhash_components(docs).count() == 0


@pytest.mark.parametrize("dense", [8, 2048])
def test_links_connect_what_all_pairs_connect(spark, dense):
    """Dense clusters (many values around one centre), chains and lone values."""
    rnd, fps = random.Random(5), set()
    for _ in range(6):
        c = rnd.getrandbits(64)
        for _ in range(40):
            f = c
            for _ in range(rnd.randint(0, 3)):
                f ^= 1 << rnd.randrange(64)
            fps.add(f)
    f = rnd.getrandbits(64)
    for _ in range(30):
        f ^= sum(1 << b for b in rnd.sample(range(64), 4))
        fps.add(f)
    fps |= {rnd.getrandbits(64) for _ in range(300)}
    fps = sorted(fps)
    df = spark.createDataFrame([(signed(x),) for x in fps], "fp long")
    links = simhash.fingerprint_links(df, dense=dense)
    assert all(((r.a ^ r.b) & (2 ** 64 - 1)).bit_count() <= 4
               for r in links.collect())
    roots = {r.node: r.root for r in components.connected_components(links).collect()}
    want = brute_components([signed(x) for x in fps], fps)
    assert {signed(x): roots.get(signed(x), signed(x)) for x in fps} == {signed(x): want[i] for i, x in enumerate(fps)}


def test_block_masks_cover_every_close_pair():
    masks = [m & (2 ** 64 - 1) for m in simhash.block_masks(7, 4)]
    assert len(masks) == 35
    rnd = random.Random(1)
    for _ in range(500):
        diff = sum(1 << b for b in rnd.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


def test_odd_distance_is_refused(spark):
    with pytest.raises(ValueError):
        simhash.fingerprint_links(spark.createDataFrame([(1,)], "fp long"), max_bits=3)


def test_components_of_a_long_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(100, 400)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5, 5), (7, None)]
    random.Random(2).shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    assert got == {i: 100 for i in range(101, 401)} | {1000 + i: 1000 for i in range(1, 300)}


def test_group_links_span_the_group():
    fps = np.array([0, 1, 3, 2 ** 63, 2 ** 40 - 1], np.uint64)
    links = simhash.group_links(fps.view(np.int64), 4)
    assert {frozenset(x) for x in links} == {frozenset({0, 1}), frozenset({0, 3}), frozenset({0, -2 ** 63})}
