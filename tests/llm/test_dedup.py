"""Repeated windows of words and repeated byte strings, against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hearthstream.llm import sketch, suffix_dedup, suffix_sort, window_dedup
from tests.llm import cases


def many_texts():
    rng = random.Random(9)
    passages = [cases.words(rng, 80, 10**6) for _ in range(3)]
    out = {}
    for i in range(40):
        t = cases.words(rng, rng.randrange(5, 150), 10**6)
        for p in passages:
            if rng.random() < 0.4:
                a, b = sorted(rng.sample(range(81), 2))
                k = rng.randrange(len(t) + 1)
                t[k:k] = p[a:b]
        out[100 - i] = " ".join(t)
    return out


def test_words(spark):
    for texts, df in ((cases.texts(), cases.documents(spark)), (many_texts(), None)):
        df = cases.documents(spark, texts.items()) if df is None else df
        first: dict = {}
        lists = {i: (t or "").encode().split() for i, t in texts.items()}
        for i in sorted(lists):
            for k in range(len(lists[i]) - 49):
                first.setdefault(tuple(lists[i][k : k + 50]), i)
        rows = window_dedup.remove_repeats(df, texts=True).collect()
        for r in rows:
            w = lists[r.doc_id]
            gone = [False] * len(w)
            for k in range(len(w) - 49):
                if first[tuple(w[k : k + 50])] < r.doc_id:
                    gone[k : k + 50] = [True] * 50
            kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
            assert (r.n_words, r.n_removed, r.kept) == (len(w), sum(gone), kept.decode()), r.doc_id
            assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()
        assert {r.doc_id for r in rows} == set(lists)
    assert window_dedup.remove_repeats(cases.documents(spark, [])).count() == 0


def test_windows_over_the_edge_of_a_common_passage_are_spread(spark, monkeypatch):
    monkeypatch.setattr(window_dedup, "BUCKET_WORDS", 1 << 10)
    rng = random.Random(4)
    passage = cases.words(rng, 60, 10**6)
    texts = [
        (i, " ".join(cases.words(rng, 60, 10**6) + passage + cases.words(rng, 60, 10**6)))
        for i in range(300)
    ]
    packed, buckets = window_dedup.packed_windows(
        cases.documents(spark, texts), "doc_id", "text", window_dedup.WINDOW, window_dedup.GRAM
    )
    sizes = Counter()
    for r in packed.collect():
        if r.bucket < buckets:
            sizes[r.bucket] += len(r.a) // 8
    assert buckets > 30 and sum(sizes.values()) > 300 * 20
    assert max(sizes.values()) < 3 * sum(sizes.values()) / buckets


def test_bytes(spark):
    for texts, df, again in (
        (cases.texts(), cases.documents(spark), [(8, "one")]), (many_texts(), None, []),
    ):
        df = cases.documents(spark, texts.items()) if df is None else df
        raw = [(i, (t or "").encode()) for i, t in list(texts.items()) + again]
        times = Counter(b[k : k + 200] for _, b in raw for k in range(len(b) - 199))
        want = {}
        for i, b in raw:
            gone = bytearray(len(b))
            for k in range(len(b) - 199):
                if times[b[k : k + 200]] > 1:
                    gone[k : k + 200] = b"\1" * 200
            left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
            spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
            want[i] = (len(b), sum(gone), spans, hashlib.sha256(left).hexdigest())
        rows = suffix_dedup.remove_repeated_spans(df).collect()
        for r in rows:
            assert tuple(r)[1:] == want[r.doc_id], r.doc_id
        assert len(rows) == len(raw)
    assert suffix_dedup.remove_repeated_spans(cases.documents(spark, [])).count() == 0


def test_bytes_with_frequent_anchors(spark, monkeypatch):
    # Every anchor found twice takes the way of the frequent ones.
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 1)
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 2)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 13)
    test_bytes(spark)
    # Some do.
    monkeypatch.setattr(suffix_dedup, "FREQUENT", 8)
    test_bytes(spark)


def test_contexts_at_the_edge_of_a_common_passage_do_not_meet(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 1 << 14)
    monkeypatch.setattr(suffix_dedup, "SAMPLE", 8)
    rng = random.Random(4)
    passage = " ".join(cases.words(rng, 60, 10**6))
    texts = [
        (i, " ".join([*cases.words(rng, 30, 10**6), passage, *cases.words(rng, 30, 10**6)]))
        for i in range(1500)
    ]
    packed, buckets = suffix_dedup.packed_contexts(
        cases.documents(spark, texts), "doc_id", "text", suffix_dedup.LENGTH, suffix_dedup.GRAM
    )
    contexts, windows = Counter(), Counter()
    for r in packed.collect():
        if r.bucket < buckets:
            contexts[r.bucket] += len(r.lefts) // 2
        elif r.bucket < 2 * buckets:
            windows[r.bucket] += len(r["keys"]) // 16
    assert buckets > 40 and max(contexts.values(), default=0) < 1500
    # Windows with an anchor that the sample finds often, spread over the buckets.
    assert sum(windows.values()) > 1500 * buckets / 4
    assert max(windows.values()) < 2 * sum(windows.values()) / buckets


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2), st.binary(max_size=30).map(lambda b: bytes(x % 3 for x in b)))))
def test_deep_shallow_sort(rows):
    groups = np.array([g for g, _ in rows], np.int64)
    strings = [s for _, s in rows]
    order, prefixes = suffix_sort.deep_shallow_sort(groups, strings, 8)
    assert [rows[i] for i in order] == sorted(rows)
    for k in range(1, len(rows)):
        (g, a), (h, b) = rows[order[k - 1]], rows[order[k]]
        n = next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))
        assert prefixes[k] == (n if g == h else -1)


def test_sketch_never_underestimates(spark):
    rng = np.random.default_rng(2)
    twice = rng.integers(0, 2**63, 500, dtype=np.uint64)
    once = rng.integers(0, 2**63, 5000, dtype=np.uint64)
    parts = [np.concatenate([twice, once[:2500]]), np.concatenate([twice[:250], once[2500:]]), twice[250:]]
    batches = [sketch.partial_sketch(p, 20).to_pandas() for p in parts]
    frame = spark.createDataFrame(
        [(int(s), bytes(c)) for b in batches for s, c in zip(b.part, b.cells, strict=True)],
        "part int, cells binary",
    )
    bits = sketch.merge_sketches(frame, 20)
    assert sketch.repeated(bits, twice, 20).all()
    assert sketch.repeated(bits, once, 20).mean() < 0.01


@given(st.lists(st.integers(0, 50), max_size=60), st.integers(1, 9))
def test_sliding(values, width):
    x = np.array(values, np.uint64)
    n = len(values) - width + 1
    assert sketch.sliding(x, width).tolist() == [min(values[k : k + width]) for k in range(max(0, n))]
    assert sketch.sliding(x, width, np.maximum).tolist() == [max(values[k : k + width]) for k in range(max(0, n))]
