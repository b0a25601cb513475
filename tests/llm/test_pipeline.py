import corpus_pipeline
from hearthstream.llm import queries
from tests.llm import cases


def test_stages_against_brute_force(spark, folder):
    rows = list(cases.texts().items()) + [(None, "no id"), (30, "@@ ## %% !! " * 40)]
    docs = cases.documents(spark, rows)
    kept = corpus_pipeline.quality(spark, docs, folder)
    assert kept.columns == corpus_pipeline.COLUMNS
    kept = kept.cache()
    ids = {r.doc_id for r in kept.collect()}
    assert 30 not in ids and {1, 2, 3, 11, 12} <= ids

    from tests.llm.test_minhash import brute

    texts = {r.doc_id: r.text for r in kept.collect()}
    single = corpus_pipeline.near_duplicates(spark, kept, folder)
    assert single.columns == corpus_pipeline.COLUMNS
    want = {i for i, (_, c) in brute(texts, 5, 80).items() if i == c}
    single = single.cache()
    assert {r.doc_id for r in single.collect()} == want

    cut = corpus_pipeline.repeated_passages(spark, single, folder)
    assert cut.columns == corpus_pipeline.COLUMNS
    after = {r.doc_id: r for r in cut.collect()}
    assert set(after) == want
    assert all(r.n_chars == len(r.text) for r in after.values())
    shared = texts[11].split()[10:60]
    assert " ".join(shared) in texts[12]
    assert not any(" ".join(shared) in r.text for r in after.values())
    assert after[16].text == texts[16]

    packed = corpus_pipeline.pack(spark, cut, folder).collect()
    assert {r.doc_id for r in packed} == want
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "repeated_passages", "packing"]


def test_every_operator_is_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 11))
