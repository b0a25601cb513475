"""Encoding, token files and packing, against the library itself."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from hearthstream.llm import bpe, packing, repair
from hearthstream.llm.queries import VOCABULARY_SIZE, vocabulary_path
from hearthstream.llm.tokens import token_bytes
from tests.llm import cases

PATH = vocabulary_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_ids_equal_the_library(library):
    rng = random.Random(1)
    parts = ["a", "b", " ", "  ", "\n", "\t", "'s", "'ll", "é", "中", "1", "23", "!", "<|endoftext|>",
             "<|endof", "\x0b", "\x85", "\xa0", "😀", "\x1c", "word", "WORD"]
    for text in ["".join(rng.choices(parts, k=rng.randrange(15))) for _ in range(3000)] + [
        t for t in cases.texts().values() if t
    ]:
        want = library.encode(text, add_special_tokens=False).ids
        assert bpe.encode_text(PATH, text) == want, text
        assert np.frombuffer(token_bytes(PATH, [text])[0], "<u4").tolist() == want
        assert bpe.decode_ids(PATH, want) == library.decode(want, skip_special_tokens=False)


def test_word_cache_forgets_nothing_it_needs():
    calls = []
    encode = bpe.WordwiseEncoder(lambda s: calls.append(s) or s, {}, size=3)
    text = "a b c d e a b c d e f"
    assert "".join(encode(text)) == text and "".join(encode(text)) == text
    assert len(encode.rest) <= 3 and len(encode.rest.older) <= 3


def test_encode_decode(spark, library):
    rows = bpe.encode_decode(cases.documents(spark), PATH, ids=True).collect()
    texts = cases.texts()
    assert len(rows) == len(texts) + 2
    for r in rows:
        text = "no id here" if r.doc_id is None else texts[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.decoded == text
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.encode_decode(cases.documents(spark, []), PATH).count() == 0


@pytest.mark.parametrize("size", [0, 1, 2, 50, 20_000])
def test_grammar_round_trip(size):
    rng = np.random.default_rng(size)
    ids = np.concatenate([rng.zipf(1.3, size) % 300, np.zeros(size, np.int64), rng.integers(0, 9, size)])
    grammar = repair.compress(ids.astype("<u4"), 300)
    assert (repair.expand(grammar["symbols"], grammar, 300) == ids).all()
    for start, stop in [(0, 0), (0, len(ids)), (len(ids) // 3, len(ids) // 2)]:
        assert (repair.decode_range(grammar, 300, start, stop) == ids[start:stop]).all()
    if size > 1000:
        assert len(grammar["symbols"]) < 0.7 * len(ids) and len(grammar["left"])


def test_token_files(spark, library, folder):
    docs = cases.documents(spark)
    repair.write_token_files(docs, f"{folder}/t", PATH, VOCABULARY_SIZE, block_ids=500)
    rows = repair.read_documents(spark, f"{folder}/t", ids=True).collect()
    texts = list(cases.texts().items()) + [(8, "one")]
    at = 0
    for r, (i, t) in zip(sorted(rows, key=lambda r: r.start), sorted(texts, key=lambda x: x[0]), strict=True):
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        assert (r.doc_id, r.start, r.n_tokens, r.ids) == (i, at, len(ids), ids)
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
    assert repair.token_file_digests(cases.documents(spark, []), PATH, VOCABULARY_SIZE).count() == 0


def pieces_fit(rows, capacity):
    bins = {}
    for r in rows:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= capacity
    return len(bins)


def test_packing(spark, library):
    rows = packing.pack_documents(cases.documents(spark), PATH, capacity=256).collect()
    total = 0
    for i, t in list(cases.texts().items()) + [(8, "one")]:
        ids = np.array(library.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        mine = sorted((r.piece, r.start, r.length, r.ids_crc32) for r in rows if r.doc_id == i)
        want = [
            (k, s, n, zlib.crc32(ids[s : s + n].tobytes()))
            for k, (s, n) in enumerate(packing.cut_points(len(ids), 256))
        ]
        assert mine == sorted(want * (2 if i == 8 else 1))
        total += len(ids)
    assert pieces_fit(rows, 256) <= -(-(total + 2) // 256) + 1
    assert packing.pack_documents(cases.documents(spark, []), PATH).count() == 0


def test_packing_in_several_shards(spark):
    rng = random.Random(2)
    lengths = [(k, rng.randrange(1, 1500)) for k in range(600)]
    frame = spark.createDataFrame(lengths, "key bigint, length bigint")
    rows = packing.pack_lengths(frame, 2048, shard_pieces=64).collect()
    assert sorted(r.key for r in rows) == [k for k, _ in lengths]
    fill = {}
    for r in rows:
        place = (r.level, r.shard, r.bin)
        fill[place] = fill.get(place, 0) + dict(lengths)[r.key]
    assert max(fill.values()) <= 2048
    assert len(fill) <= 1.01 * sum(n for _, n in lengths) / 2048 + 1


def test_cut_points():
    assert packing.cut_points(1, 4) == [(0, 1)]
    assert packing.cut_points(4, 4) == [(0, 4)]
    assert packing.cut_points(9, 4) == [(0, 1), (1, 4), (5, 4)]


def test_crossover_keeps_every_document_once():
    rng = random.Random(7)
    lengths = [rng.randrange(1, 900) for _ in range(200)]
    first = packing.best_fit(list(range(200)), lengths, 2048)
    second = packing.mutate(first, [], lengths, 2048, rng)
    for _ in range(5):
        child = packing.crossover(first, second, lengths, 2048, rng)
        assert sorted(i for b in child for i in b) == list(range(200))
        assert all(sum(lengths[i] for i in b) <= 2048 for b in child)
        first, second = second, child


def test_subset_fill_is_as_full_as_any_subset():
    rng = random.Random(8)
    for _ in range(60):
        lengths = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 11))]
        items = list(range(len(lengths)))
        bins = packing.subset_fill(items, lengths, 60)
        assert sorted(i for b in bins for i in b) == items
        longest = max(items, key=lambda i: (lengths[i], -i))
        sums = {lengths[longest]}
        for i in items:
            if i != longest:
                sums |= {s + lengths[i] for s in sums if s + lengths[i] <= 60}
        assert packing.load(bins[0], lengths) == max(sums)


def test_search_beats_packing_longest_first():
    """Lengths that fill every bin exactly: longest first misses it, the search from random orders finds it."""
    rng = random.Random(5)
    lengths = []
    for _ in range(60):
        a, b = rng.randrange(300, 1100), rng.randrange(200, 600)
        lengths += [a, b, 2048 - a - b]
    plain = packing.best_fit(list(range(len(lengths))), lengths, 2048)
    found = packing.evolve(lengths, 2048, 1)
    assert len(found) <= len(plain) and len(found) <= 61
    assert sorted(i for b in found for i in b) == list(range(len(lengths)))


@pytest.mark.parametrize("least", [2, 3, 16])
def test_grammar_goes_on_until_no_pair_pays(least):
    rng = np.random.default_rng(least)
    for size in (1, 5, 100, 30_000, 200_000):
        ids = np.concatenate([rng.zipf(1.2, size) % 3000, np.tile(rng.integers(0, 50, 7), size // 9), np.full(size // 3, 4)])
        grammar = repair.compress(ids.astype("<u4"), 3000, least=least)
        s = grammar["symbols"]
        assert (repair.expand(s, grammar, 3000) == ids).all()
        counts = {}
        last = None
        for k, pair in enumerate(zip(s[:-1].tolist(), s[1:].tolist())):
            if pair[0] == pair[1] and last == (pair, k - 1):
                last = None  # overlaps the one before
                continue
            counts[pair] = counts.get(pair, 0) + 1
            last = (pair, k)
        assert max(counts.values(), default=0) < least


def test_every_irregular_text_is_doubtful():
    import sys

    import pyarrow as pa
    import pyarrow.compute as pc

    from hearthstream.llm.tokens import DOUBTFUL

    spaces = [chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()]
    rng = random.Random(3)
    texts = ["a" + c + d + "b" for c in spaces for d in (*spaces, "")]
    texts += ["".join(rng.choices(["a", " ", "\n", "\n\n", *spaces], k=rng.randrange(6))) for _ in range(3000)]
    found = pc.match_substring_regex(pa.array(texts), DOUBTFUL).to_pylist()
    assert all(f for f, t in zip(found, texts, strict=True) if bpe.irregular(t))
    plain = "two words\nand a line\n\nand more\n"
    assert not pc.match_substring_regex(pa.array([plain]), DOUBTFUL)[0].as_py() and not bpe.irregular(plain)


def test_a_mark_after_a_word_is_learned_apart_from_it():
    import public_tokenizers
    from hearthstream.llm.tokens import BatchEncoder

    encode = BatchEncoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["One, two, één, it's, two; x2, we're: \"so\", two!\ntwo,\nend.", "two,, a.b, two ,", ",", "two,"]
    ids, counts = encode.batch(texts)
    want = [e.ids for e in encode.tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert counts.tolist() == [len(w) for w in want] and ids.tolist() == [i for w in want for i in w]
    assert {" two", " één", ","} <= encode.now.slots.keys() and not {" two,", " één,", " two;"} & encode.now.slots.keys()
