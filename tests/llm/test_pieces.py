import numpy as np
import pytest
import sentencepiece

from tidemark.llm import pieces
from tidemark.llm.common import table

TEXTS = ["hello World", "  two  spaces   here ", "line\nend\n\n x", "Ünïcode ñ 梦 😀 ▁mark", "", "a", " ", "\n",
         "tab\tand\x0bmore\x00zero", "x" * 500, "abc" * 300 + " tail", "ciónñrrciez osóción é"]


@pytest.fixture(scope="module")
def sp():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)


def ids_of(encoder, texts):
    offsets, ids = encoder.encode(texts)
    return [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])]


def test_without_dropout_it_is_the_tokenizers_own(spark, sp):
    docs = [r.text for r in table(spark, "/root/testdata/sf0.001", "documents", "text").collect()]
    enc = pieces.Encoder(dropout=0)
    texts = docs + [t for t in TEXTS if "▁" not in t]
    got = ids_of(enc, texts)
    assert all(g == sp.encode(t) for g, t in zip(got, texts))


@pytest.mark.parametrize("dropout", [0, 0.1, 0.5, 1])
def test_every_rate_decodes_to_the_text(dropout):
    enc = pieces.Encoder(dropout=dropout)
    for ids, t in zip(ids_of(enc, TEXTS), TEXTS):
        assert pieces.decode_ids(enc.vocab.surface, ids) == t


def test_heap_and_in_step_agree():
    vocab = pieces.Vocabulary(pieces.MODEL)
    for chunk in [" hello", "internationalisation", " einschließlich", "a", " ñé梦", "aaaaaaaaaaaaaaaa"]:
        for dropout in (0, 0.1, 0.5):
            for key in range(20):
                key = np.uint64(key * 7919)
                chars = np.frombuffer(chunk.encode("utf-32-le"), np.uint32)[None, :]
                ((_, sym),) = [d for d in pieces.segment_in_step(vocab, chars, np.array([key]), dropout) if len(d[0])]
                assert sym[0].tolist() == pieces.segment_one(vocab, chunk, key, dropout)


def test_dropout_rate_and_seed():
    t = ["the international organisation of standard measures " * 40 + str(i) for i in range(20)]
    lens = [sum(map(len, ids_of(pieces.Encoder(dropout=d), t))) for d in (0, 0.1, 0.5, 1)]
    assert lens == sorted(lens) and lens[0] < lens[1] < lens[2] < lens[3]
    a, b, c = (ids_of(pieces.Encoder(dropout=0.3, seed=s), t) for s in (1, 1, 2))
    assert a == b and a != c
    h = pieces.dropped(np.arange(200_000, dtype=np.uint64), 0, 1, 2, 0.1)
    assert abs(h.mean() - 0.1) < 0.005


def test_memory_bound_changes_nothing(monkeypatch):
    want = ids_of(pieces.Encoder(), TEXTS)
    monkeypatch.setattr(pieces, "REMEMBERED", 3)
    enc = pieces.Encoder()
    assert [ids_of(enc, [t])[0] for t in TEXTS] == want


def test_documents(spark):
    rows = [(i, t, 9) for i, t in enumerate(TEXTS)] + [(None, None, 1), (3, TEXTS[3], 1), (3, TEXTS[3], 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_ids int")
    got = pieces.encoded_documents(docs).collect()
    assert len(got) == len(rows) and all(r.lossless for r in got)
    assert len({tuple(r.ids) for r in got if r.doc_id == 3}) == 1
    assert pieces.encoded_documents(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        pieces.encode(docs, column="n_ids")
    back = pieces.decode(spark.createDataFrame([(None,), ([],)], "ids array<int>")).collect()
    assert [r.decoded for r in back] == [None, ""]


def test_every_occurrence_has_its_own_dropout(monkeypatch):
    """One word repeated in one text is segmented in many ways, each as merging it alone gives."""
    monkeypatch.setattr(pieces, "TOGETHER", 37)
    enc, plain = pieces.Encoder(), pieces.Encoder(dropout=0)
    word = "internationalisation"
    ids = ids_of(enc, [" ".join([word] * 400)])[0]
    assert pieces.decode_ids(enc.vocab.surface, ids) == " ".join([word] * 400)
    ways, now = set(), []
    for i in [*ids, None]:
        if i is None or now and enc.vocab.surface[i][:1] == b" ":
            ways.add(tuple(now))
            now = []
        now.append(i)
    assert len(ways) > 20 and tuple(ids_of(plain, [word])[0]) in ways
    chunks, keys = [" the", " standard", " measures", " a", " ñé"] * 50, np.arange(250, dtype=np.uint64) * np.uint64(7919)
    enc._learn(sorted(set(chunks) - set(enc.known)))
    at = np.array([enc.known[c] for c in chunks])
    other = enc._differs(at, keys, np.array([len(c) for c in chunks]))
    assert 0 < other.sum() < len(other)
    for c, k, a, o in zip(chunks, keys, at, other):
        if not o:
            own = [x for y in pieces.segment_one(enc.vocab, c, k, enc.dropout) for x in enc.vocab.bytes_of(y)]
            assert own == enc.flat[enc.starts[a]:enc.starts[a] + enc.lens[a]].tolist()
