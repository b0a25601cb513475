"""Substring dedup of word windows behind a count-min prefilter.

First pass: every part of the input counts, in a count-min sketch, the documents
that have a window's anchor; the partial sketches are added up.  Counts are never
too small, so a window that repeats is always estimated repeated.  Second pass:
only windows estimated repeated are grouped exactly, by their 64-bit hash and
their anchor's.  A part of the input first settles its own repeats and sends on
only the windows of the smallest document it knows, so the inside of a passage that
many documents share travels once for each part.  Windows over the edge of such a
passage differ in every document but share its anchors; the exact groups are
therefore dealt out by the window hash, which spreads them over all buckets.

Defined results: null and empty texts have no words; documents of fewer words
than a window lose nothing; rows without an id are left out; repeated rows of an
id do not remove each other; the empty table gives the empty table.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm import sketch
from hearthstream.llm.common import batch_of, map_batches, texts_of, with_id

WINDOW = 50
GRAM = 16
CHUNK_WORDS = 1 << 20
BUCKET_WORDS = 1 << 20


class Chunk:
    """Windows of some documents, in ascending order of the ids."""

    def __init__(self, ids: list[int], words: list[list[bytes]], window: int, gram: int):
        order = sorted(range(len(ids)), key=ids.__getitem__)
        sizes = np.array([len(words[k]) for k in order], np.int64)
        total = int(sizes.sum())
        codes = np.fromiter(
            map(xxhash.xxh3_64_intdigest, chain.from_iterable(words[k] for k in order)),
            np.uint64, total,
        )
        ends = np.cumsum(sizes)
        n = max(0, total - window + 1)
        doc = np.repeat(np.arange(len(order)), sizes)
        # A window must lie in one document.
        inside = doc[:n] == doc[window - 1 :]
        rolling = sketch.Rolling(codes)
        anchors = sketch.sliding(rolling.runs(gram), window - gram + 1)
        self.hash = rolling.runs(window)[inside]
        self.anchor = anchors[inside]
        self.doc = doc[:n][inside]
        self.at = (np.arange(n) - (ends - sizes)[doc[:n]])[inside]
        self.ids = np.array(ids, np.int64)[order]

    def anchors_by_document(self) -> np.ndarray:
        """Each anchor of a document once."""
        first = np.ones(len(self.anchor), bool)
        first[1:] = (self.anchor[1:] != self.anchor[:-1]) | (self.doc[1:] != self.doc[:-1])
        pairs = np.stack([self.doc[first].astype(np.uint64), self.anchor[first]], axis=1)
        return np.unique(pairs, axis=0)[:, 1] if len(pairs) else self.anchor[:0]


def _chunks(batches, window: int, gram: int):
    ids, words, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            found = t.encode().split()
            if len(found) < window:
                continue
            ids.append(i)
            words.append(found)
            held += len(found)
            if held >= CHUNK_WORDS:
                yield Chunk(ids, words, window, gram)
                ids, words, held = [], [], 0
    if ids:
        yield Chunk(ids, words, window, gram)


def runs_of(docs: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, first, last) of consecutive positions; both arrays in order."""
    if not len(docs):
        return docs, at, at
    new = np.ones(len(docs), bool)
    new[1:] = (docs[1:] != docs[:-1]) | (at[1:] != at[:-1] + 1)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(docs)) - 1
    return docs[starts], at[starts], at[ends]


_PACKED = pa.schema([("bucket", pa.int32()), *[(c, pa.binary()) for c in "abcd"]])
_RUNS = pa.schema([("doc", pa.int64()), ("first", pa.int32()), ("last", pa.int32())])


def _of_smallest(hashes: np.ndarray, anchors: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Whether a window is in the smallest document that has it; ascending documents."""
    order = np.argsort(hashes, kind="stable")
    h, a, d = hashes[order], anchors[order], docs[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (a[1:] != a[:-1])
    least = d[np.flatnonzero(new)][np.cumsum(new) - 1]
    smallest = np.empty(len(h), bool)
    smallest[order] = d == least
    return smallest


def packed_windows(
    documents: DataFrame, id_column: str, text: str, window: int, gram: int
) -> tuple[DataFrame, int]:
    """Windows estimated repeated, packed by bucket, and the number of buckets.

    Settled runs come in as many buckets again behind them.
    """
    spark = documents.sparkSession
    rows = with_id(documents, id_column, text)
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    # About six bytes a word, and two new anchors for every window minus gram words.
    words = size // 6
    bits = sketch.sketch_bits(2 * words // (window - gram + 2))
    buckets = max(1, words // BUCKET_WORDS)

    def count(batches):
        for chunk in _chunks(batches, window, gram):
            if len(chunk.hash):
                yield sketch.partial_sketch(chunk.anchors_by_document(), bits)

    twice = spark.sparkContext.broadcast(
        sketch.merge_sketches(map_batches(rows, count, "part int, cells binary"), bits)
    )

    def select(batches):
        for chunk in _chunks(batches, window, gram):
            keep = sketch.repeated(twice.value, chunk.anchor, bits)
            h, a, d, at = (x[keep] for x in (chunk.hash, chunk.anchor, chunk.ids[chunk.doc], chunk.at))
            smallest = _of_smallest(h, a, d)
            later = ~smallest
            rows: list[list] = [[] for _ in _PACKED]
            docs, first, last = runs_of(d[later], at[later])
            if len(docs):
                # Settled here: passed through the grouping as they are.
                for column, value in zip(rows, (
                    buckets + int(docs[0]) % buckets, docs.astype("<i8").tobytes(),
                    first.astype("<i4").tobytes(), last.astype("<i4").tobytes(), b"",
                ), strict=True):
                    column.append(value)
            h, a, d, at = h[smallest], a[smallest], d[smallest], at[smallest]
            bucket = (h % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            for b in np.flatnonzero(cuts[:-1] < cuts[1:]).tolist():
                part = order[cuts[b] : cuts[b + 1]]
                for column, value in zip(rows, (
                    b, h[part].tobytes(), a[part].tobytes(), d[part].astype("<i8").tobytes(),
                    at[part].astype("<i4").tobytes(),
                ), strict=True):
                    column.append(value)
            yield batch_of(_PACKED, rows)

    packed = map_batches(rows, select, "bucket int, a binary, b binary, c binary, d binary")
    return packed, buckets


def repeated_windows(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
    gram: int = GRAM,
) -> DataFrame:
    """Runs of windows that also start in a smaller document: ``doc``, ``first``, ``last``."""
    packed, buckets = packed_windows(documents, id_column, text, window, gram)

    def group(key, table):
        packed = table.select(list("abcd")).to_pydict()
        if key[0].as_py() >= buckets:
            d, first, last = (
                np.frombuffer(b"".join(packed[c]), t)
                for c, t in zip("abc", ("<i8", "<i4", "<i4"), strict=True)
            )
        else:
            h, a, d, at = (
                np.frombuffer(b"".join(packed[c]), t)
                for c, t in zip("abcd", ("<u8", "<u8", "<i8", "<i4"), strict=True)
            )
            order = np.lexsort((at, d))
            h, a, d, at = h[order], a[order], d[order], at[order]
            later = ~_of_smallest(h, a, d)
            d, first, last = runs_of(d[later], at[later])
        return pa.table([pa.array(d), pa.array(first), pa.array(last)], schema=_RUNS)

    return packed.groupBy("bucket").applyInArrow(group, "doc bigint, first int, last int")


def remove_repeats(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", window: int = WINDOW,
    texts: bool = False,
) -> DataFrame:
    """Per document: ``n_words``, ``n_removed``, ``kept_sha256`` (and the text ``kept``)."""
    runs = repeated_windows(documents, id_column, text, window).groupBy("doc").agg(
        F.collect_list(F.struct("first", "last")).alias("runs")
    )
    rows = with_id(documents, id_column, text)
    joined = rows.join(runs, rows[id_column] == runs["doc"], "left").select(
        rows[id_column].alias("id"), rows[text].alias("text"),
        F.col("runs.first").alias("first"), F.col("runs.last").alias("last"),
    )
    schema = pa.schema(
        [(id_column, pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()),
         ("kept_sha256", pa.string())] + ([("kept", pa.string())] if texts else [])
    )

    def work(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(len(schema) - 1)]
            for t, first, last in zip(
                texts_of(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                strict=True,
            ):
                words = t.encode().split()
                kept = words
                if first:
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, first, 1)
                    np.add.at(steps, np.array(last) + window, -1)
                    gone = np.cumsum(steps)[:-1] > 0
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
                joined_ = b" ".join(kept)
                values = [len(words), len(words) - len(kept), hashlib.sha256(joined_).hexdigest()]
                for column, value in zip(
                    out, values + [joined_.decode()] * texts, strict=True
                ):
                    column.append(value)
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), *out])

    extra = ", kept string" if texts else ""
    return map_batches(
        joined, work,
        f"`{id_column}` bigint, n_words bigint, n_removed bigint, kept_sha256 string{extra}",
    )
