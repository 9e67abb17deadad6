import random

import pytest

from tidemark.llm import token_tree as K


@pytest.fixture(scope="module")
def counter():
    return K.TokenCounter()


def same_as_fresh(tree, counter):
    want = K.TokenTree.of(tree.text, counter)
    assert tree.flat() == want.flat()
    assert tree.n_tokens == want.n_tokens == len(counter.encoding.encode_ordinary(tree.text))
    assert tree.chars[1] == len(tree.text)


def test_random_edits_equal_full_encoding(counter):
    rnd = random.Random(6)
    bits = ["a", "word", " ", "  ", "\n", "'", "'r", "e", "'ll", "12", "é", "漢", "😀", "!?", "don't", "\t", "s", " \n "]
    for case in range(60):
        tree = K.TokenTree.of("".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 5, 60, 900]))), counter)
        for _ in range(25):
            n = len(tree.text)
            a = rnd.randint(0, n)
            b = min(n, a + rnd.choice([0, 0, 1, 2, 9, 70]))
            tree.edit(a, b, "".join(rnd.choice(bits) for _ in range(rnd.choice([0, 1, 2, 8, 40]))))
            same_as_fresh(tree, counter)


def test_only_the_region_is_encoded_again(counter):
    text = "some words in a row, " * 5000
    tree = K.TokenTree.of(text, counter)
    tree.edit(50_000, 50_003, "new")
    assert 0 < tree.reencoded < 60
    same_as_fresh(tree, counter)
    tree.edit(10, 10, "word " * 30_000)  # crowds a leaf: the tree is rebuilt
    same_as_fresh(tree, counter)


def test_prefix_sums(counter):
    tree = K.TokenTree.of("one two, three\n\nfour " * 50, counter)
    lens, counts = tree.flat()
    at, total = 0, 0
    for n, c in zip(lens, counts):
        assert tree.tokens_before(at) == total
        at, total = at + n, total + c
    assert tree.tokens_before(at) == tree.n_tokens == total


def test_documents(spark, counter):
    rows = [(1, "Hello there, don't stop. " * 9, 5), (2, None, 5), (3, "", 5), (None, "x", 5), (1, "again", 5), (1, "again", 5),
            (4, " " * 9000 + "é" * 3000, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, counts int")
    got = K.edited_counts(docs).collect()
    assert len(got) == len(rows)

    def edited(t):
        t = t or ""
        n = len(t)
        for s, e, i in ((n // 3, n // 3, t[:40]), (n // 2, n // 2 + 17, ""), (2 * n // 3, 2 * n // 3 + 5, "'re 42\n x")):
            t = t[:s] + i + t[e:]
        return t
    enc = counter.encoding.encode_ordinary
    want = sorted((str(d), len(enc(t or "")), len(enc(edited(t))), len(edited(t))) for d, t, _ in rows)
    assert sorted((str(r.doc_id), r.n_tokens, r.edited_tokens, r.edited_chars) for r in got) == want
    assert K.edited_counts(docs.limit(0)).count() == 0


def test_edits_from_a_table(spark, counter):
    trees = K.token_trees(spark.createDataFrame([(1, "abc def"), (2, "left alone")], "doc_id long, text string"))
    edits = spark.createDataFrame([(1, 2, 0, 1, "X"), (1, 1, 3, 3, "!!"), (9, 1, 0, 0, "?"), (1, 3, None, 99, None),
                                   (None, 1, 0, 0, "n")], "doc_id long, seq int, start int, end int, insert string")
    got = {r.doc_id: r for r in K.apply_edits(K.attach_edits(trees, edits)).collect()}
    assert got[1].text == "" and got[1].n_tokens == 0 and got[1].n_tokens_before == 2
    assert got[2].text == "left alone" and got[2].reencoded_chars == 0
