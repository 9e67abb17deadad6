import hashlib
import os
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import align

os.environ["TOKENIZERS_PARALLELISM"] = "false"


@pytest.fixture(scope="module")
def tools():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(align.TOKENIZER_A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=align.TOKENIZER_B), align.Tokenizers()


def tokens(tools, text):
    """(id, start, end) under A and B, by the two libraries themselves; None where bytes differ."""
    a, b, own = tools
    out = []
    for ids, parts in ((a.encode(" " + text, add_special_tokens=False).ids, own.a_bytes), (b.encode(text), own.b_bytes)):
        if b"".join(parts[i] for i in ids) != (" " + text).encode():
            return None
        ends = np.cumsum([len(parts[i]) for i in ids]).tolist()
        out.append(list(zip(ids, [0, *ends], ends)))
    return out


def brute(tools, texts):
    both = [tokens(tools, t) if t else None for t in texts]
    links = [[(x, y) for x in ab[0] for y in ab[1] if x[1] < y[2] and y[1] < x[2]] if ab else [] for ab in both]
    count = Counter((x[0], y[0]) for own in links for x, y in own)
    best = {}
    for (_, b), n in count.items():
        best[b] = max(n, best.get(b, 0))
    rows = []
    for ab, own in zip(both, links):
        if not ab:
            rows.append((0, 0, 0, 0, 0, 0, ""))
            continue
        cuts = sorted({t[2] for t in ab[0]} & {t[2] for t in ab[1]})
        groups = [["", ""] for _ in cuts]
        for side in (0, 1):
            for n, (low, high) in enumerate(zip([0, *cuts], cuts)):
                groups[n][side] = ",".join(str(i) for i, _, e in ab[side] if low < e <= high)
        text = ";".join("|".join(g) for g in groups)
        n = [count[x[0], y[0]] for x, y in own]
        rows.append((len(ab[0]), len(ab[1]), len(cuts), len(own), sum(c == best[y[0]] for c, (_, y) in zip(n, own)), sum(n),
                     hashlib.sha256(text.encode()).hexdigest()))
    return rows


TEXTS = [None, "", " ", "a", "the  end\n\n", "a\tb  c <|endoftext|> it's </s> <0x41>", "\nx y", "日本語。テスト! ok", "x▁y", "😀😀 é!", "don't, won't. I'll",
         "un deux trois un deux trois"]


def some_texts(n):
    rnd = random.Random(5)
    words = ["the", "retition", "ouen", "ndert.", "x,", "é", "Größe", "\n", "  ", "1234", "😀", "日本", "it's"]
    return TEXTS + [rnd.choice([" ", "\n", " "]).join(rnd.choice(words) for _ in range(rnd.randrange(80))) for _ in range(n)] + ["same text"] * 30


@pytest.mark.parametrize("common,long,size", [(1 << 20, 1 << 16, 1 << 15), (7, 1 << 16, 1 << 15), (40, 60, 23), (1 << 20, 0, 9)])
def test_documents_equal_brute_force(spark, tools, common, long, size):
    """All broadcast, most pairs joined, most texts in ranges, and every text in tiny ranges."""
    texts = some_texts(60)
    rows = [(i if i % 5 else None, t, "x", i) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, part int").repartition(3)
    got = align.linked_documents(docs, common=common, long=long, size=size).collect()
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = sorted((r[0] or -1, *w) for r, w in zip(rows, brute(tools, texts)))
    assert sorted((r.doc_id if r.doc_id else -1, *(r[c] for c in names)) for r in got) == want


def test_fragments_join_in_any_order(tools):
    own = tools[2]
    rnd = random.Random(1)
    for text in [t for t in some_texts(20) if t and t.strip() and "▁" not in t]:
        parts = [own.fragment(" " + text, *r) for r in own.ranges(" " + text, 7)]
        while len(parts) > 1:
            i = rnd.randrange(len(parts) - 1)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        at = align.Pieces(own).of([text])[0]
        whole = align.Pieces(own)
        (at,) = whole.of([text])
        assert parts[0].whole().text() == ";".join(whole.texts[i] for i in at)


def test_remembered_pieces_change_nothing(spark, monkeypatch, tools):
    monkeypatch.setattr(align, "REMEMBERED", 3)
    texts = some_texts(40)
    held = align.Pieces(tools[2])
    for t in texts:
        if held.full():
            held.clear()
        (at,) = held.of([t])
        if t and (ab := tokens(tools, t)):
            assert held.numbers[at].sum(0)[:2].tolist() == [len(ab[0]), len(ab[1])]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align.linked_documents(docs).collect() == []
