import random

import numpy as np

from hearthstream.llm import minhash
from tests.llm import cases


def brute(texts: dict, size: int, percent: int) -> dict[int, tuple[int, int]]:
    sets = {}
    for i, t in texts.items():
        w = (t or "").encode().lower().split()
        sets[i] = {tuple(w[k : k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    part = {i: i for i in sets}

    def root(i):
        while part[i] != i:
            i = part[i]
        return i

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                part[y] = x
    return {i: (len(s), root(i)) for i, s in sets.items()}


def check(spark, texts, size, percent, df=None):
    df = cases.documents(spark, texts.items()) if df is None else df
    got = minhash.near_duplicates(df, size=size, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    want = brute(texts, size, percent)
    rows = got.collect()
    for r in rows:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r
        assert r.kept == (r.doc_id == r.component_id)
    return rows


def test_cases(spark):
    texts = cases.texts()
    rows = check(spark, texts, 2, 80, cases.documents(spark))
    assert len(rows) == len(texts) + 1  # the repeated row; the row without id is left out


def test_chains_and_groups_of_loose_copies(spark):
    """Links that the centre of a bucket does not see are found as well."""
    rng = random.Random(11)
    texts, n = {}, 0
    for _ in range(6):
        base = cases.words(rng, 60, 10**6)
        for _ in range(12):
            copy = list(base)
            for k in rng.sample(range(60), rng.randrange(0, 9)):
                copy[k] = f"n{rng.randrange(10**6)}"
            texts[n] = " ".join(copy)
            n += 1
    check(spark, texts, 2, 80)


def test_empty(spark):
    assert check(spark, {}, 5, 80) == []


def test_sketch_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (3, 40, 2000):
        a = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2))
        assert (minhash.sketch(a) == minhash.sketch(a.copy())).all()
    a = np.unique(minhash.mix64(np.arange(2000, dtype=np.uint64)))
    b = np.unique(minhash.mix64(np.arange(500, 2500, dtype=np.uint64)))
    same = (minhash.sketch(a) == minhash.sketch(b)).mean()
    assert abs(same - 0.6) < 0.12
