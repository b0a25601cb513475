"""Repeated byte strings found with sparse suffix arrays.

Only suffixes at anchors are sorted: the anchor of a 200-byte window is its
smallest run hash, so equal windows have their anchor at the same place and meet
in the same bucket.  A count-min sketch first sets aside anchors that occur once.
In a bucket the texts to the right and, reversed, to the left of equal anchors are
put into suffix order by deep-shallow sorting; the common prefixes of neighbours
then tell for every offset of the anchor in the window which windows are equal.
No pair of occurrences is ever listed.

Anchors that are very frequent are not grouped: at the edge of a passage that many
documents share every occurrence has its own context, and all would meet in one
task.  The windows with such an anchor are counted by a 128-bit hash instead, which
spreads them over all buckets; a part of the input settles those that it has twice.
Which anchors are frequent is estimated from a sample; results do not depend on it.

Contexts that agree over the whole reach of an anchor are joined before they
leave a part of the input, and travel once with their places.

Defined results: null and empty texts have no bytes; texts shorter than the
length lose nothing; rows without an id are left out; repeated rows count as
occurrences of each other; the empty table gives the empty table.
"""

from __future__ import annotations

import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm import sketch
from hearthstream.llm.common import batch_of, map_batches, mix64, texts_of, with_id
from hearthstream.llm.suffix_sort import deep_shallow_sort
from hearthstream.llm.window_dedup import runs_of

LENGTH = 200
GRAM = 40
CHUNK_BYTES = 1 << 20
BUCKET_BYTES = 1 << 23
# An anchor is frequent from so many occurrences on, or from some in every chunk:
# then most of its windows are settled where they are.  The upper bound keeps the
# largest group small.
FREQUENT = 1 << 10
FREQUENT_MOST = 1 << 17
PER_CHUNK = 4
SAMPLE = 32

_CODES = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Chunk:
    """The anchors of some documents."""

    def __init__(self, ids: list[int], texts: list[bytes], length: int, gram: int):
        self.data = b"".join(texts)
        sizes = np.array([len(t) for t in texts], np.int64)
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.ids = np.array(ids, np.int64)
        reach = length - gram
        grams = sketch.Rolling(_CODES[np.frombuffer(self.data, np.uint8)]).runs(gram)
        self.least = least = sketch.sliding(grams, reach + 1)
        # Windows that cross documents have no anchor.
        for end in self.ends[:-1].tolist():
            least[max(0, end - length + 1) : end] = 0
        padded = np.zeros(len(least) + 2 * reach, np.uint64)
        padded[reach : reach + len(least)] = least
        of_window = sketch.sliding(padded, reach + 1, np.maximum)
        self.at = np.flatnonzero((of_window[: len(grams)] == grams) & (grams > 0))
        self.key = grams[self.at]
        self.doc = np.searchsorted(self.ends, self.at, side="right")


def _chunks(batches, length: int, gram: int):
    ids, texts, held = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column(0).to_pylist(), texts_of(batch.column(1)), strict=True):
            raw = t.encode()
            if len(raw) < length:
                continue
            ids.append(i)
            texts.append(raw)
            held += len(raw)
            if held >= CHUNK_BYTES:
                yield Chunk(ids, texts, length, gram)
                ids, texts, held = [], [], 0
    if ids:
        yield Chunk(ids, texts, length, gram)


_FIELDS = {
    "keys": "<u8", "lefts": "<u2", "rights": "<u2", "places": "<u4", "docs": "<i8", "at": "<u4",
}
_PACKED = pa.schema(
    [("bucket", pa.int32()), ("contexts", pa.binary()), *[(f, pa.binary()) for f in _FIELDS]]
)
_PACKED_DDL = "bucket int, contexts binary, " + ", ".join(f"{f} binary" for f in _FIELDS)
_SPANS = pa.schema([("doc", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _pack(chunk: Chunk, keep: np.ndarray, length: int, gram: int, buckets: int):
    """Rows of contexts by bucket; equal contexts once, with all their places."""
    at, key, doc = chunk.at[keep], chunk.key[keep], chunk.doc[keep]
    left = np.minimum(at - chunk.starts[doc], length - gram)
    right = np.minimum(chunk.ends[doc] - at, length)
    inner = at - chunk.starts[doc]
    bucket = (key % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    data = chunk.data
    out: list[list] = [[] for _ in _PACKED]
    for b in np.flatnonzero(cuts[:-1] < cuts[1:]).tolist():
        rows = order[cuts[b] : cuts[b + 1]]
        seen: dict[tuple[int, bytes], list[int]] = {}
        for row, a, x, y in zip(
            rows.tolist(), at[rows].tolist(), left[rows].tolist(), right[rows].tolist(), strict=True
        ):
            seen.setdefault((x, data[a - x : a + y]), []).append(row)
        first = np.array([m[0] for m in seen.values()])
        members = np.array([i for m in seen.values() for i in m])
        values = {
            "keys": key[first], "lefts": left[first], "rights": right[first],
            "places": np.array([len(m) for m in seen.values()]),
            "docs": chunk.ids[doc[members]], "at": inner[members],
        }
        out[0].append(b)
        out[1].append(b"".join(c for _, c in seen))
        for column, (f, kind) in zip(out[2:], _FIELDS.items(), strict=True):
            column.append(values[f].astype(kind).tobytes())
    return batch_of(_PACKED, out)


def _with_anchor(chunk: Chunk, anchors: np.ndarray) -> np.ndarray:
    """Starts of the windows whose anchor is one of these."""
    first = np.flatnonzero(np.diff(chunk.least, prepend=~chunk.least[:1]))
    sizes = np.diff(np.append(first, len(chunk.least)))
    return np.flatnonzero(np.repeat(np.isin(chunk.least[first], anchors), sizes))


def _pack_windows(chunk: Chunk, starts: np.ndarray, length: int, buckets: int):
    """Rows of window hashes by bucket, each once, and one of the spans settled here."""
    data = chunk.data
    hashes = np.frombuffer(
        b"".join([xxhash.xxh3_128_digest(data[a : a + length]) for a in starts.tolist()]), "<u8"
    ).reshape(-1, 2)
    doc = np.searchsorted(chunk.ends, starts, side="right")
    inner = starts - chunk.starts[doc]
    order, first, times = _equal_hashes(hashes)
    many = np.empty(len(starts), bool)
    many[order] = np.repeat(times > 1, times)
    out: list[list] = [[] for _ in _PACKED]

    def add(bucket: int, **values: np.ndarray) -> None:
        out[0].append(bucket)
        out[1].append(b"")
        for column, (f, kind) in zip(out[2:], _FIELDS.items(), strict=True):
            column.append(values[f].astype(kind).tobytes() if f in values else b"")

    d, low, high = runs_of(doc[many], inner[many])
    if len(d):
        add(
            2 * buckets + int(hashes[:, 0].sum()) % buckets,
            docs=chunk.ids[d], at=low, places=high + length,
        )
    rows = order[first]
    bucket = (hashes[rows, 0] % np.uint64(buckets)).astype(np.int64)
    by_bucket = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[by_bucket], np.arange(buckets + 1))
    for b in np.flatnonzero(cuts[:-1] < cuts[1:]).tolist():
        part = by_bucket[cuts[b] : cuts[b + 1]]
        add(
            buckets + b, keys=hashes[rows[part]], places=np.minimum(times[part], 2),
            docs=chunk.ids[doc[rows[part]]], at=inner[rows[part]],
        )
    return batch_of(_PACKED, out)


def _equal_hashes(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows, where in it equal ones begin, and how many there are."""
    order = np.lexsort((hashes[:, 1], hashes[:, 0]))
    found = hashes[order]
    new = np.ones(len(order), bool)
    new[1:] = (found[1:] != found[:-1]).any(axis=1)
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(order)))


def _classes(groups: np.ndarray, strings: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Rank of every string in suffix order, and the neighbours' common prefixes."""
    order, prefixes = deep_shallow_sort(groups, strings)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    return rank, prefixes


def equal_windows(
    keys: np.ndarray, lefts: list[bytes], rights: list[bytes], weights: np.ndarray,
    length: int, gram: int,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Offsets of the anchor at which a context's window occurs at least twice.

    As (context, lowest offset, highest offset).  ``lefts`` are reversed.
    """
    n = len(keys)
    reach = length - gram
    rank_r, prefix_r = _classes(keys, rights)
    rank_l, prefix_l = _classes(keys, lefts)
    size_r = np.array([len(x) for x in rights])
    size_l = np.array([len(x) for x in lefts])
    hit = np.zeros((reach + 2, n), bool)
    for offset in range(reach + 1):
        rows = np.flatnonzero((size_l >= offset) & (size_r >= length - offset))
        if not len(rows):
            continue
        # Strings with the same number agree on so many bytes.
        right = np.cumsum(prefix_r < length - offset)[rank_r[rows]]
        left = np.cumsum(prefix_l < offset)[rank_l[rows]]
        both = right * (n + 1) + left
        order = np.argsort(both)
        both = both[order]
        starts = np.flatnonzero(np.diff(both, prepend=-1))
        sums = np.add.reduceat(weights[rows][order], starts)
        many = np.repeat(sums >= 2, np.diff(np.append(starts, len(rows))))
        hit[offset + 1, rows[order[many]]] = True
    edges = np.diff(hit.astype(np.int8), axis=0, append=np.zeros((1, n), np.int8))
    context, low = np.nonzero(edges.T == 1)
    _, high = np.nonzero(edges.T == -1)
    return context, low, high - 1


def packed_contexts(
    documents: DataFrame, id_column: str, text: str, length: int, gram: int
) -> tuple[DataFrame, int]:
    """What has to be compared, packed by bucket, and the number of buckets.

    Contexts of anchors come in the first buckets, windows of frequent anchors in as
    many behind them, and settled spans in as many again.
    """
    spark = documents.sparkSession
    rows = with_id(documents, id_column, text)
    size = rows.agg(F.sum(F.octet_length(text))).first()[0] or 0
    bits = sketch.sketch_bits(2 * size // (length - gram + 2))
    buckets = max(1, size // BUCKET_BYTES)
    rate = SAMPLE
    many = min(FREQUENT_MOST, max(FREQUENT, PER_CHUNK * (size // CHUNK_BYTES)))

    def count(batches):
        for chunk in _chunks(batches, length, gram):
            if len(chunk.key):
                yield sketch.partial_sketch(chunk.key, bits)
                yield sketch.sample_rows(chunk.key, rate)

    found = spark.sparkContext.broadcast(
        sketch.merge_with_frequent(
            map_batches(rows, count, "part int, cells binary"), bits, max(1, many // rate)
        )
    )

    def select(batches):
        for chunk in _chunks(batches, length, gram):
            twice, frequent = found.value
            often = np.isin(chunk.key, frequent)
            keep = np.flatnonzero(sketch.repeated(twice, chunk.key, bits) & ~often)
            if len(keep):
                yield _pack(chunk, keep, length, gram, buckets)
            if often.any():
                yield _pack_windows(chunk, _with_anchor(chunk, frequent), length, buckets)

    return map_batches(rows, select, _PACKED_DDL), buckets


def repeated_spans(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Byte spans covered by strings of ``length`` bytes that occur elsewhere too."""
    packed_rows, buckets = packed_contexts(documents, id_column, text, length, gram)

    def group(key, table):
        packed = table.select(list(_FIELDS)).to_pydict()
        keys, left, right, places, docs, at = (
            np.frombuffer(b"".join(packed[f]), kind) for f, kind in _FIELDS.items()
        )
        if key[0].as_py() >= buckets:
            if key[0].as_py() >= 2 * buckets:
                doc, start, end = docs, at, places
            else:
                order, first, times = _equal_hashes(keys.reshape(-1, 2))
                sums = np.add.reduceat(places[order], first)
                rows = order[np.repeat(sums > 1, times)]
                rows = rows[np.lexsort((at[rows], docs[rows]))]
                doc, start, last = runs_of(docs[rows], at[rows].astype(np.int64))
                end = last + length
            return pa.table(
                [pa.array(doc), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
                schema=_SPANS,
            )
        flat = b"".join(table.column("contexts").to_pylist())
        sizes = left.astype(np.int64) + right
        ends = list(accumulate(sizes.tolist()))
        # Equal contexts of different parts of the input become one.
        number: dict[tuple[int, int, bytes], int] = {}
        which = np.empty(len(keys), np.int64)
        for k, (end, size_, x, y) in enumerate(
            zip(ends, sizes.tolist(), left.tolist(), keys.tolist(), strict=True)
        ):
            which[k] = number.setdefault((y, x, flat[end - size_ : end]), len(number))
        weights = np.bincount(which, weights=places, minlength=len(number)).astype(np.int64)
        distinct = list(number)
        own = np.array([d[0] for d in distinct], np.uint64)
        _, inverse, total = np.unique(own, return_inverse=True, return_counts=True)
        live = np.flatnonzero((total[inverse] > 1) | (weights > 1))
        if not len(live):
            return _SPANS.empty_table()
        context, low, high = equal_windows(
            inverse[live],
            [distinct[i][2][: distinct[i][1]][::-1] for i in live.tolist()],
            [distinct[i][2][distinct[i][1] :] for i in live.tolist()],
            weights[live], length, gram,
        )
        context = live[context]
        # Every place of a context gets the context's spans.
        per_place = np.repeat(which, places)
        order = np.argsort(context, kind="stable")
        context, low, high = context[order], low[order], high[order]
        begin = np.searchsorted(context, per_place, side="left")
        times = np.searchsorted(context, per_place, side="right") - begin
        place = np.repeat(np.arange(len(per_place)), times)
        nth = np.arange(len(place)) - np.repeat(np.cumsum(times) - times, times)
        span = begin[place] + nth
        start = at[place].astype(np.int64) - high[span]
        end = at[place].astype(np.int64) - low[span] + length
        doc = docs[place]
        # Spans of a document that touch become one.
        order = np.lexsort((start, doc))
        doc, start, end = doc[order], start[order], end[order]
        if len(doc):
            far = end + (np.cumsum(np.diff(doc, prepend=doc[0]) != 0) << 40)
            top = np.maximum.accumulate(far)
            new = np.ones(len(doc), bool)
            new[1:] = start[1:] + (far[1:] - end[1:]) > top[:-1]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(doc)) - 1
            doc, start, end = doc[first], start[first], (top[last] & ((1 << 40) - 1))
        return pa.table(
            [pa.array(doc), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            schema=_SPANS,
        )

    return packed_rows.groupBy("bucket").applyInArrow(group, "doc bigint, start int, end int")


def remove_repeated_spans(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", length: int = LENGTH,
    gram: int = GRAM, texts: bool = False, carry: list[str] | None = None,
) -> DataFrame:
    """Per document: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256`` (and ``kept``).

    ``kept`` is the remaining text without characters that lost some of their bytes.
    Columns named in ``carry`` come along unchanged.
    """
    carry = carry or []
    spans = repeated_spans(documents, id_column, text, length, gram).groupBy("doc").agg(
        F.collect_list(F.struct("start", "end")).alias("spans")
    )
    rows = with_id(documents, id_column, text, *carry)
    joined = rows.join(spans, rows[id_column] == spans["doc"], "left").select(
        rows[id_column].alias("id"), rows[text].alias("text"),
        F.col("spans.start").alias("start"), F.col("spans.end").alias("end"),
        *[rows[c] for c in carry],
    )
    own = pa.schema(
        [(id_column, pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
         ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
        + ([("kept", pa.string())] if texts else [])
    )

    def work(batches):
        for batch in batches:
            out: list[list] = [[] for _ in range(len(own) - 1)]
            for t, starts, ends in zip(
                texts_of(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist(),
                strict=True,
            ):
                raw = t.encode()
                parts, at, n = [], 0, 0
                for start, end in sorted(zip(starts or [], ends or [], strict=True)):
                    if start > at or not n:
                        parts.append(raw[at:start])
                        n += 1
                    at = max(at, end)
                parts.append(raw[at:])
                left = b"".join(parts)
                values = [len(raw), len(raw) - len(left), n, hashlib.sha256(left).hexdigest()]
                for column, value in zip(
                    out, values + [left.decode("utf-8", "ignore")] * texts, strict=True
                ):
                    column.append(value)
            along = range(4, 4 + len(carry))
            yield batch_of(
                pa.schema([*own, *(batch.schema.field(i) for i in along)]),
                [batch.column(0).cast(pa.int64()), *out, *(batch.column(i) for i in along)],
            )

    extra = ", kept string" if texts else ""
    extra += "".join(f", `{c}` {rows.schema[c].dataType.simpleString()}" for c in carry)
    return map_batches(
        joined, work,
        f"`{id_column}` bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
        f"kept_sha256 string{extra}",
    )
