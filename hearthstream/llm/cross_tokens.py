"""Alignment of two tokenizers over a corpus, each distinct text once.

Texts are shuffled as a whole: equal ones meet, and each distinct text is tokenised by both
tokenizers and aligned once, with its number of documents as its multiplicity.  Both
token sequences spell the same bytes.  Where tokens of both end at the same byte, a group
ends; tokens whose byte ranges overlap are linked.  Every stretch between two
neighbouring token ends belongs to exactly one link, so links are found by two
running sums over the bytes.

How many documents hold a pair of ids linked is a count over all documents.  A task works
through its texts in chunks of some megabytes and writes for a chunk the distinct
pairs with their multiplicities, and which pairs each text holds how often.  Spark sums
the chunks' pairs, finds the best count of every A id, and brings both numbers back to
the chunks that hold the pair: one narrow row for each pair of a chunk, never
one for each link or each pair of a document.  The measures of a text meet its
documents again by the SHA-256 of the text.

A frequent pair has one row for each chunk, and a text that a third of all documents
share one row for each map task, then one result.

Defined results: a text has no tokens (zeros, and an empty digest) if it is null or
empty, or if the bytes of one of the tokenizers are not a space and the text, as with
characters that the second one normalises.  Rows without an id and repeated rows
count as documents and get their row; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthstream.llm.bpe import Vocabulary
from hearthstream.llm.common import batch_of, map_batches, stage
from hearthstream.llm.tokens import encoder, gather

PIECE_BYTES = 1 << 20  # texts aligned at a time
CACHE_WORDS = 300_000  # words remembered in each of two generations
CHUNK_BYTES = 8 << 20  # texts whose pairs are written together


class ByteTable:
    """The bytes of every token id, in one array."""

    def __init__(self, strings: list[bytes]):
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(strings), np.uint8)

    def spell(self, ids: np.ndarray) -> bytes:
        return gather(self.bytes, self.starts[ids], self.lengths[ids]).tobytes()


def _ends(counts: np.ndarray) -> list[int]:
    return np.cumsum(counts).tolist()


class Aligner:
    """Both tokenizers of a worker, and the alignment of batches of texts."""

    def __init__(self, first: str, second: str):
        import sentencepiece

        self.a = encoder(first, plain=True, size=CACHE_WORDS)
        vocabulary = Vocabulary(first)
        self.a_bytes = ByteTable([vocabulary.strings.get(i, b"") for i in range(max(vocabulary.strings) + 1)])
        self.b = sentencepiece.SentencePieceProcessor(model_file=second)
        self.b_bytes = ByteTable([self._piece(i) for i in range(self.b.get_piece_size())])
        n_a, n_b = len(self.a_bytes.lengths), len(self.b_bytes.lengths)
        # Decimal ids with the character that follows them in a digest.
        self.written = (
            [b"%d," % i for i in range(n_a)] + [b"%d|" % i for i in range(n_a)]
            + [b"%d," % i for i in range(n_b)] + [b"%d;" % i for i in range(n_b)]
        )

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of both tokenizers, and how many each text has; none where the bytes differ."""
        a, n_a = self.a.batch([" " + t for t in texts])
        lists = self.b.encode(texts, num_threads=1)
        n_b = np.array([len(x) for x in lists], np.int64)
        b = np.fromiter((i for x in lists for i in x), np.int64, int(n_b.sum()))
        spelt = (self.a_bytes.spell(a), self.b_bytes.spell(b))
        widths = [
            np.diff(np.concatenate([[0], np.cumsum(table.lengths[ids])]).take(np.concatenate([[0], np.cumsum(n)])))
            for table, ids, n in ((self.a_bytes, a, n_a), (self.b_bytes, b, n_b))
        ]
        good = np.ones(len(texts), bool)
        at_a = at_b = 0
        for k, (t, w_a, w_b) in enumerate(zip(texts, *(w.tolist() for w in widths), strict=True)):
            want = b" " + t.encode()
            good[k] = spelt[0][at_a : at_a + w_a] == want and spelt[1][at_b : at_b + w_b] == want
            at_a, at_b = at_a + w_a, at_b + w_b
        if not good.all():
            a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
            n_a, n_b = n_a * good, n_b * good
        return a.astype(np.int64), n_a, b, n_b

    def align(self, texts: list[str]) -> Alignment:
        a, n_a, b, n_b = self.encode(texts)
        ends_a, ends_b = np.cumsum(self.a_bytes.lengths[a]), np.cumsum(self.b_bytes.lengths[b])
        size = int(ends_a[-1]) + 1 if len(a) else 1
        at_a, at_b = np.zeros(size, bool), np.zeros(size, bool)
        at_a[ends_a] = at_b[ends_b] = True
        # Token ends up to each byte, of either tokenizer and of both.
        upto_a, upto_b = np.cumsum(at_a, dtype=np.int32), np.cumsum(at_b, dtype=np.int32)
        both = np.flatnonzero(at_a & at_b)
        upto_both = np.cumsum(at_a & at_b, dtype=np.int32)
        stretches = np.flatnonzero(at_a | at_b)
        # A stretch that ends at a byte lies in the first token that does not end before it.
        i = upto_a[stretches] - at_a[stretches]
        j = upto_b[stretches] - at_b[stretches]
        text_ends = np.concatenate([[0], ends_a])[np.cumsum(n_a)]

        def per_text(places: np.ndarray) -> np.ndarray:
            return np.diff(np.searchsorted(places, text_ends, side="right"), prepend=0)

        # Written order: a group's A tokens, then its B tokens.
        last_a, last_b = at_b[ends_a], at_a[ends_b]
        group_a = upto_both[ends_a] - last_a
        group_b = upto_both[ends_b] - last_b
        before = np.concatenate([[0], both])
        codes = np.empty(len(a) + len(b), np.int64)
        n = len(self.a_bytes.lengths)
        codes[np.arange(len(a)) + upto_b[before[group_a]]] = a + n * last_a
        codes[np.arange(len(b)) + upto_a[both[group_b]]] = 2 * n + b + len(self.b_bytes.lengths) * last_b
        digests, start = [], 0
        for end in _ends(n_a + n_b):
            joined = b"".join(map(self.written.__getitem__, codes[start:end].tolist()))
            digests.append(hashlib.sha256(joined[:-1]).hexdigest() if joined else "")
            start = end
        links = per_text(stretches)
        return Alignment(n_a, n_b, per_text(both), links, digests, np.repeat(np.arange(len(texts)), links), (a[i] << 32) | b[j])


@dataclass
class Alignment:
    """Per text its numbers of tokens, groups and links and its digest; per link its text and pair of ids."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digests: list[str]
    text: np.ndarray
    pair: np.ndarray  # A id in the upper, B id in the lower 32 bits


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(first: str, second: str) -> Aligner:
    if (first, second) not in _aligners:
        _aligners[first, second] = Aligner(first, second)
    return _aligners[first, second]


# Chunks of aligned texts

_COUNTS = ("n_a", "n_b", "n_groups", "n_links")
_CHUNK = pa.schema(
    [("chunk", pa.int64()), ("keys", pa.list_(pa.string())), *[(c, pa.list_(pa.int64())) for c in _COUNTS],
     ("digests", pa.list_(pa.string())), ("pairs", pa.binary()), ("weights", pa.binary()),
     # Per distinct pair of each text: its place in pairs and its links.
     ("held", pa.list_(pa.int64())), ("places", pa.binary()), ("links", pa.binary())]
)
_CHUNK_DDL = (
    "chunk bigint, keys array<string>, " + ", ".join(f"{c} array<bigint>" for c in _COUNTS)
    + ", digests array<string>, pairs binary, weights binary, held array<bigint>, places binary, links binary"
)


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers as bytes, their length in front, compressed."""
    raw = values.astype("<i8" if values.dtype == np.int64 else "<i4").tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _restored(raw: bytes, kind: str) -> np.ndarray:
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], size, codec="zstd", asbytes=True), kind)


class _Chunk:
    """Aligned texts that have not been written yet."""

    def __init__(self):
        self.parts: list[Alignment] = []
        self.keys: list[str] = []
        self.copies: list[int] = []
        self.size = 0

    def add(self, alignment: Alignment, texts: list[str], copies: list[int]) -> None:
        self.parts.append(alignment)
        self.keys += [hashlib.sha256(t.encode()).hexdigest() for t in texts]
        self.copies += copies
        self.size += sum(map(len, texts))

    def row(self, number: int) -> pa.RecordBatch:
        offsets = np.cumsum([0] + [len(p.n_a) for p in self.parts])
        text = np.concatenate([p.text + o for p, o in zip(self.parts, offsets, strict=False)])
        pairs, place = np.unique(np.concatenate([p.pair for p in self.parts]), return_inverse=True)
        held, links = np.unique((text << 32) | place, return_counts=True)
        text, place = held >> 32, (held & 0xFFFFFFFF).astype(np.int32)
        weights = np.bincount(place, weights=np.array(self.copies, np.float64)[text], minlength=len(pairs))
        of_text = np.bincount(text, minlength=len(self.keys))
        # Places rise within a text: their steps are small numbers, which compress well.
        steps = np.diff(place, prepend=np.int32(0))
        first = (np.cumsum(of_text) - of_text)[of_text > 0]
        steps[first] = place[first]
        columns = [np.concatenate([getattr(p, c) for p in self.parts]).tolist() for c in _COUNTS]
        values = [
            number, self.keys, *columns, [d for p in self.parts for d in p.digests], _squeezed(pairs),
            _squeezed(weights.astype(np.int64)), of_text.tolist(), _squeezed(steps), _squeezed(links.astype(np.int32)),
        ]
        return batch_of(_CHUNK, [[v] for v in values])


def _pieces(texts: list[str], copies: list[int]) -> Iterator[tuple[list[str], list[int]]]:
    """Runs of texts of about ``PIECE_BYTES`` characters."""
    begin, held = 0, 0
    for k, t in enumerate(texts):
        held += len(t)
        if held >= PIECE_BYTES:
            yield texts[begin : k + 1], copies[begin : k + 1]
            begin, held = k + 1, 0
    if begin < len(texts):
        yield texts[begin:], copies[begin:]


def aligned_chunks(documents: DataFrame, first: str, second: str, text: str = "text") -> DataFrame:
    """Every distinct text aligned once; one row per chunk of texts."""
    distinct = (
        documents.select(F.col(text).alias("text")).where("text != ''")
        .groupBy("text").agg(F.count(F.lit(1)).alias("copies"))
    )

    def work(batches):
        both, chunk, number = aligner(first, second), _Chunk(), TaskContext.get().partitionId() << 32
        for batch in batches:
            for texts, copies in _pieces(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                chunk.add(both.align(texts), texts, copies)
                if chunk.size >= CHUNK_BYTES:
                    yield chunk.row(number)
                    chunk, number = _Chunk(), number + 1
        if chunk.keys:
            yield chunk.row(number)

    return map_batches(distinct, work, _CHUNK_DDL)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, count, best): documents that hold a pair of ids linked, and whether its A id has no higher count."""
    schema = pa.schema([("pair", pa.int64()), ("n", pa.int64())])

    def unpack(batches):
        for batch in batches:
            for pairs, weights in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield batch_of(schema, [pa.array(_restored(pairs, "<i8")), pa.array(_restored(weights, "<i8"))])

    counted = (
        map_batches(chunks.select("pairs", "weights"), unpack, "pair bigint, n bigint")
        .groupBy("pair").agg(F.sum("n").alias("count"))
    )
    # An A id has at most as many rows here as the other tokenizer has ids.
    own = Window.partitionBy(F.shiftright("pair", 32))
    return counted.select("pair", "count", (F.col("count") == F.max("count").over(own)).alias("best"))


def _known_pairs(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """(chunk, place, count, best) of every distinct pair of every chunk."""
    schema = pa.schema([("chunk", pa.int64()), ("place", pa.int32()), ("pair", pa.int64())])

    def unpack(batches):
        for batch in batches:
            for number, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                pairs = _restored(raw, "<i8")
                yield batch_of(
                    schema,
                    [pa.array(np.full(len(pairs), number)), pa.array(np.arange(len(pairs), dtype=np.int32)), pa.array(pairs)],
                )

    places = map_batches(chunks.select("chunk", "pairs"), unpack, "chunk bigint, place int, pair bigint")
    return places.join(counts, "pair").select("chunk", "place", "count", "best")


_MEASURES = pa.schema(
    [("key", pa.string()), *[(c, pa.int64()) for c in (*_COUNTS, "n_best", "count_sum")], ("groups_sha256", pa.string())]
)
_MEASURES_DDL = (
    "key string, " + ", ".join(f"{c} bigint" for c in (*_COUNTS, "n_best", "count_sum")) + ", groups_sha256 string"
)


def text_measures(chunks: DataFrame, counts: DataFrame) -> DataFrame:
    """The measures of every distinct text, by the SHA-256 of the text (``key``)."""

    def measure(key, left: pa.Table, right: pa.Table) -> pa.Table:
        (row,) = left.to_pylist()
        place = right.column("place").to_numpy()
        count, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        count[place] = right.column("count").to_numpy()
        best[place] = right.column("best").to_numpy()
        held = np.array(row["held"], np.int64)
        ends = np.cumsum(held)
        steps, links = _restored(row["places"], "<i4").astype(np.int64), _restored(row["links"], "<i4").astype(np.int64)
        rising = np.cumsum(steps)
        # Steps start anew in every text.
        at = rising - np.repeat(np.concatenate([[0], rising])[ends - held], held)

        def per_text(values: np.ndarray) -> np.ndarray:
            return np.diff(np.concatenate([[0], np.cumsum(values)])[ends], prepend=0)

        return pa.table(
            [row["keys"], *[row[c] for c in _COUNTS], pa.array(per_text(links * best[at])),
             pa.array(per_text(links * count[at])), row["digests"]],
            schema=_MEASURES,
        )

    wanted = chunks.select("chunk", "keys", *_COUNTS, "digests", "held", "places", "links")
    return wanted.groupBy("chunk").cogroup(_known_pairs(chunks, counts).groupBy("chunk")).applyInArrow(
        measure, _MEASURES_DDL
    )


def align_documents(
    documents: DataFrame, first: str, second: str, id_column: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Per document the alignment of its text: tokens, groups, links and their corpus-wide counts.

    ``first`` is the file of a byte-level tokenizer, ``second`` of a sentencepiece model.
    """
    chunks = stage(aligned_chunks(documents, first, second, text), "aligned-chunks")
    measures = text_measures(chunks, pair_counts(chunks))
    rows = documents.select(
        F.col(id_column).alias("_id"), F.when(F.col(text) != "", F.sha2(text, 256)).alias("key")
    )
    numbers = [*_COUNTS, "n_best", "count_sum"]
    return rows.join(measures, "key", "left").select(
        F.col("_id").alias(id_column),
        *[F.coalesce(c, F.lit(0).cast("bigint")).alias(c) for c in numbers],
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )
