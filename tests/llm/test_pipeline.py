import sentencepiece

import corpus_pipeline
from tidemark.llm import pieces, simhash, toxicity
from tidemark.llm.common import table

from .test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    """Scores from the operator; duplicates, leaks and decoding by brute force."""
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    docs = table(spark, SF, "documents", "doc_id", "text")
    bad = {r.doc_id for r in toxicity.score_documents(docs, table(spark, SF, "labels", "doc_id", "toxic")).collect()
           if r.predicted}
    ids = sorted(set(rows) - bad)
    comp = brute_components(ids, [brute_fingerprint(rows[i].text) for i in ids])
    ids = [d for i, d in enumerate(ids) if comp[i] == d]
    ws = lambda t: b" " + b" ".join(t.encode().lower().split()) + b" "
    items = [ws(r.text) for r in table(spark, SF, "benchmark", "text").collect()]
    ids = [d for d in ids if not any(q in ws(rows[d].text) for q in items)]
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(got) == ids
    sp = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    for d, r in got.items():
        assert r.text == rows[d].text == sp.decode(r.ids) and r.n_ids == len(r.ids)
        assert (r.lang, r.source, r.n_chars) == (rows[d].lang, rows[d].source, rows[d].n_chars)


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).columns == docs.columns


def test_keep_one_with_nulls_and_repeats(spark):
    rows = [(None, "a b c d e"), (3, "a b c d e"), (3, "a b c d e"), (2, None), (5, ""), (None, "lone text of its own"),
            (9, "other words here now")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.text) for r in simhash.keep_one(docs).collect()}
    assert got == {(3, "a b c d e"), (2, None), (None, "lone text of its own"), (9, "other words here now")}
    assert simhash.keep_one(docs).count() == 4


def test_stages_with_clashing_columns(spark):
    rows = [(i, f"one two three four five {i // 2}", "en", "s", 9, "own", 7, 3.5, [1]) for i in range(8)]
    names = "doc_id long, text string, lang string, source string, n_chars int, id string, kept_fp int, score double, keep array<int>"
    docs = spark.createDataFrame(rows, names)
    got = simhash.keep_one(docs).collect()
    assert len(got) < 8 and all((r.id, r.kept_fp, r.score, r.keep) == ("own", 7, 3.5, [1]) for r in got)
