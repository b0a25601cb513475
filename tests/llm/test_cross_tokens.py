"""Alignment of two tokenizers, against the libraries and all pairs of byte ranges."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from hearthstream.llm import cross_tokens
from hearthstream.llm.bpe import byte_alphabet
from hearthstream.llm.queries import piece_model_path, vocabulary_path
from tests.llm import cases

NUMBERS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum"]
AWKWARD = {
    20: " ", 21: "\n", 22: "▁", 23: "a▁b", 24: "Ａ full width", 25: "<s> </s> <unk> <|endoftext|>",
    26: "é combined", 27: "\t tab\x00nul", 28: "日本語 ☃ 😀", 29: "<0x41>", 30: "x  y z",
    31: "one", 32: "one two", 33: "two", 34: " leading", 35: "trailing ",
}


@pytest.fixture(scope="module")
def libraries():
    first = Tokenizer.from_file(vocabulary_path())
    first.encode_special_tokens = True
    return first, sentencepiece.SentencePieceProcessor(model_file=piece_model_path())


def tokens(libraries, text):
    """(id, bytes) of both tokenizers, or two empty lists."""
    first, second = libraries
    if not text:
        return [], []
    back = {c: b for b, c in enumerate(byte_alphabet())}
    a = [(i, bytes(back[c] for c in first.id_to_token(i)))
         for i in first.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
          else second.id_to_piece(i).replace("▁", " ").encode()) for i in second.encode(text)]
    want = (" " + text).encode()
    return (a, b) if want == b"".join(x for _, x in a) == b"".join(x for _, x in b) else ([], [])


def ranges(tokens):
    at, out = 0, []
    for i, raw in tokens:
        out.append((i, at, at + len(raw)))
        at += len(raw)
    return out


def brute(libraries, rows):
    texts = {t for _, t in rows}
    linked, groups, sizes = {}, {}, {}
    for t in texts:
        a, b = (ranges(x) for x in tokens(libraries, t))
        linked[t] = [(x[0], y[0]) for x in a for y in b if x[1] < y[2] and y[1] < x[2]]
        cuts = sorted({x[2] for x in a} & {y[2] for y in b})
        start, parts = 0, []
        for end in cuts:
            parts.append("|".join(",".join(str(i) for i, s, e in side if start <= s and e <= end) for side in (a, b)))
            start = end
        groups[t] = (len(parts), hashlib.sha256(";".join(parts).encode()).hexdigest() if parts else "")
        sizes[t] = (len(a), len(b))
    count = Counter(p for _, t in rows for p in set(linked[t]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return sorted(
        ((i, *sizes[t], groups[t][0], len(linked[t]), sum(count[p] == best[p[0]] for p in linked[t]),
          sum(count[p] for p in linked[t]), groups[t][1]) for i, t in rows),
        key=repr,
    )


def small(texts):
    return {i: (t if i != 16 else t[:2000]) for i, t in texts.items()}


def test_documents(spark, libraries, monkeypatch):
    monkeypatch.setattr(cross_tokens, "CHUNK_BYTES", 1000)
    monkeypatch.setattr(cross_tokens, "PIECE_BYTES", 300)
    rows = list(small(cases.texts()).items()) + list(AWKWARD.items()) + [(None, "no id here"), (8, "one"), (40, "one")]
    got = cross_tokens.align_documents(cases.documents(spark, rows), vocabulary_path(), piece_model_path())
    assert got.columns == ["doc_id", *NUMBERS, "groups_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(libraries, rows)
    assert sum(r.n_a > 0 for r in got.collect()) > 20


def test_one_chunk_gives_the_same(spark, libraries):
    rows = [(k, t) for k, t in small(cases.texts()).items() for _ in range(1 + (k or 0) % 3)]
    got = cross_tokens.align_documents(cases.documents(spark, rows), vocabulary_path(), piece_model_path())
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(libraries, rows)


def test_nothing_to_align(spark):
    for rows in ([], [(1, None), (2, "")]):
        got = cross_tokens.align_documents(cases.documents(spark, rows), vocabulary_path(), piece_model_path())
        assert [tuple(r) for r in got.orderBy("doc_id").collect()] == [(i, 0, 0, 0, 0, 0, 0, "") for i, _ in rows]


def test_groups_and_links_of_one_text(libraries):
    found = cross_tokens.aligner(vocabulary_path(), piece_model_path()).align(["naïve words", "", "x"])
    a, b = tokens(libraries, "naïve words")
    assert found.n_a.tolist()[0] == len(a) and found.n_b.tolist()[0] == len(b)
    assert (found.n_links == found.n_a + found.n_b - found.n_groups).all()
    assert np.bincount(found.text, minlength=3).tolist() == found.n_links.tolist()
