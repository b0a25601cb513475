import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from hearthstream.llm import merkle
from tests.llm import cases

TEXTS = st.lists(st.sampled_from(["one two. ", "three\n", "\n", "x" * 90, " ", "é!", "end? ", "wordd "])).map("".join)


@settings(max_examples=200, deadline=None)
@given(TEXTS, TEXTS)
def test_properties(a, b):
    assert "".join(merkle.leaves_of(a)) == a
    x, y = merkle.fingerprint(a), merkle.fingerprint(b)
    assert (x == y) == (a == b)
    assert (x.split("!")[0] == y.split("!")[0]) == (a == b)
    near = merkle.likeness(x, y)
    assert near == merkle.likeness(y, x) and 0 <= near <= 1 and (near == 1) >= (a == b)


def test_differing_branches_locate_the_edit():
    lines = [f"Line {k} says something of its own.\n" for k in range(60)]
    a = "".join(lines)
    lines[30] = "Line 30 was changed by an editor.\n"
    b = "".join(lines)
    spans = merkle.differing_spans(merkle.fingerprint(b), merkle.fingerprint(a))
    at = b.index("Line 30")
    assert spans and all(at <= s and e <= at + len(lines[30]) for s, e in spans)
    assert merkle.likeness(merkle.fingerprint(a), merkle.fingerprint(b)) > 0.95


def test_documents(spark):
    df = cases.documents(spark, repeat=False)
    got = cases.by_id(merkle.fingerprint_documents(df))
    texts = cases.texts()
    ids = sorted(texts)
    assert sorted(got) == ids
    for i, j in zip(ids, ids[1:] + ids[:1], strict=True):
        t, following = texts[i] or "", texts[j] or ""
        edited = t[: len(t) - len(t) // 4] + following[: len(t) // 4]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == merkle.fingerprint(t)
        assert r.edited_fingerprint == merkle.fingerprint(edited)
        assert r.near_next == merkle.likeness(r.fingerprint, merkle.fingerprint(following))
        assert r.near_edited == merkle.likeness(r.fingerprint, r.edited_fingerprint)


def test_repeats_and_small_tables(spark):
    twice = cases.documents(spark, [(1, "a b c d"), (1, "a b c d"), (2, "e")])
    assert sorted(r.doc_id for r in merkle.fingerprint_documents(twice).collect()) == [1, 1, 2]
    one = merkle.fingerprint_documents(cases.documents(spark, [(4, "alone here")])).first()
    assert one.near_next == 1.0
    assert merkle.fingerprint_documents(cases.documents(spark, [])).count() == 0
