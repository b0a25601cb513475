"""Near-duplicate documents by one-permutation hashing.

A document is the set of its distinct word shingles.  One permutation of the
shingle hashes is cut into K bins; the smallest hash of each bin is the
document's sketch, and optimal densification lets an empty bin borrow from a
bin chosen by its own hash sequence.  Runs of ROWS bins form bands; documents
that share a band are compared with one centre of that bucket, so a bucket of n
documents gives n - 1 candidate pairs instead of n * (n - 1) / 2.

A bucket whose members do not all end up in one group may hold a link between
two members that the centre does not see.  The members of such buckets go
through an exact set join: prefixes in order of rarity with the positional
bound, over pairs of different groups.  Every link is confirmed on the full sets.

Defined results: null and empty texts, and texts of white space, have the empty
set and stay alone; rows without an id are left out, as nothing can refer to
them; equal sets count as linked and are compared once; an id that occurs with
several texts is one node with the links of each; the empty table gives the
empty table.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, mix64, stage, texts_of, with_id
from hearthstream.llm.components import components

BANDS = 48
ROWS = 5
BINS = BANDS * ROWS
PROBES = 4096


def words_lower(text: str) -> list[bytes]:
    """Words as UTF-8, A-Z lower-cased; separators are space and 0x09-0x0D."""
    return text.encode().lower().split()


def shingle_set(words: list[bytes], size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles.

    Fewer words than ``size``: the whole sequence is the only shingle; no words:
    the empty set.
    """
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(h))
    n = len(h) - width + 1
    code = np.full(n, width, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(width):
            code = mix64(code * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(code)


@lru_cache(maxsize=4)
def probe_table(bins: int) -> np.ndarray:
    """probe_table()[t, b]: the bin that empty bin b tries at its t-th attempt."""
    cell = np.arange(PROBES * bins, dtype=np.uint64).reshape(PROBES, bins)
    return (mix64(cell + np.uint64(0x51ED270B)) % np.uint64(bins)).astype(np.int64)


def sketch(shingles: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Densified one-permutation sketch of a non-empty sorted set.

    The hashes are sorted, and the high bits choose the bin, so the first hash
    at or after a bin's lower bound is the smallest of that bin.
    """
    where = (((shingles >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    first = np.searchsorted(where, np.arange(bins + 1))
    have = first[:-1] < first[1:]
    values = np.zeros(bins, np.uint64)
    values[have] = shingles[first[:-1][have]]
    left = np.flatnonzero(~have)
    if len(left):
        source = np.arange(bins)
        for tried in probe_table(bins):
            candidate = tried[left]
            hit = have[candidate]
            source[left[hit]] = candidate[hit]
            left = left[~hit]
            if not len(left):
                break
        # After all probes the first full bin: the same rule for every document.
        source[left] = np.flatnonzero(have)[0]
        values = values[source]
    return values


def band_keys(values: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key per band, different between bands."""
    grid = values.reshape(bands, rows)
    key = np.arange(1, bands + 1, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for r in range(rows):
            key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + grid[:, r])
    return key


def shingle_sets(documents: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    """Per document the set's size, its 128-bit digest and the band keys."""
    schema = pa.schema(
        [("id", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
         ("bands", pa.binary())]
    )

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for t in texts_of(batch.column(1)):
                found = shingle_set(words_lower(t), size)
                digest = np.frombuffer(xxhash.xxh3_128_digest(found.tobytes()), np.int64)
                keys = band_keys(sketch(found)).tobytes() if len(found) else None
                for column, value in zip(
                    out, (len(found), int(digest[0]), int(digest[1]), keys), strict=True
                ):
                    column.append(value)
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), *out])

    return map_batches(
        with_id(documents, id_column, text), work,
        "id bigint, n bigint, h1 bigint, h2 bigint, bands binary",
    )


def _band_rows(representatives: DataFrame) -> DataFrame:
    """(key, id) for every band of every representative."""
    schema = pa.schema([("key", pa.int64()), ("id", pa.int64())])

    def work(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
            yield batch_of(schema, [pa.array(keys), pa.array(np.repeat(ids, BANDS))])

    return map_batches(representatives.select("id", "bands"), work, "key bigint, id bigint")


def _full_sets(documents: DataFrame, id_column: str, text: str, size: int) -> DataFrame:
    schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("hashes", pa.binary())])

    def work(batches):
        for batch in batches:
            sets = [shingle_set(words_lower(t), size) for t in texts_of(batch.column(1))]
            yield batch_of(
                schema,
                [batch.column(0).cast(pa.int64()), [len(x) for x in sets],
                 [x.tobytes() for x in sets]],
            )

    return map_batches(
        documents.select(id_column, text), work, "id bigint, n bigint, hashes binary"
    )


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union of the full sets."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def work(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                if len(x) > len(y):
                    x, y = y, x
                at = np.searchsorted(y, x)
                common = int((y[np.minimum(at, len(y) - 1)] == x).sum())
                keep.append(100 * common >= percent * (len(x) + len(y) - common))
            mask = pa.array(keep, pa.bool_())
            yield batch_of(schema, [batch.column(0).filter(mask), batch.column(1).filter(mask)])

    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return map_batches(joined, work, "a bigint, b bigint").distinct()


def _unseen_pairs(mixed: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of different groups, exactly: prefix filter with positions.

    Shingles are ordered by rarity.  Two sets that reach the similarity share a
    shingle in their prefixes, and the first one they share leaves room for the
    required overlap behind it; both conditions lose no pair.  Shingles that no
    other of these sets has fill a prefix without matching anything, which is
    what keeps loosely related texts apart cheaply.
    """
    schema = pa.schema(
        [("id", pa.int64()), ("part", pa.int64()), ("n", pa.int64()), ("token", pa.int64())]
    )

    def spread(batches):
        for batch in batches:
            sizes = batch.column(2).to_numpy(zero_copy_only=False)
            tokens = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.int64)
            yield batch_of(
                schema,
                [pa.array(np.repeat(batch.column(i).to_numpy(zero_copy_only=False), sizes))
                 for i in range(3)] + [pa.array(tokens)],
            )

    rows = stage(
        map_batches(
            mixed.join(sets, "id").select("id", "part", "n", "hashes"), spread,
            "id bigint, part bigint, n bigint, token bigint",
        ),
        "unseen",
    )
    shared = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    own = Window.partitionBy("id")
    prefixes = (
        rows.join(shared, "token")
        .withColumn("at", F.row_number().over(own.orderBy("df", "token")))
        .withColumn("at", F.col("n") - F.count(F.lit(1)).over(own) + F.col("at") - 1)
        .where(f"at < n - ceil(n * {percent} / 100) + 1")
        .select("token", "id", "part", "n", "at")
    )
    prefixes = stage(prefixes, "prefixes")
    left = prefixes.select("token", *[F.col(c).alias(f"{c}_a") for c in ("id", "part", "n", "at")])
    right = prefixes.select("token", *[F.col(c).alias(f"{c}_b") for c in ("id", "part", "n", "at")])
    room = "(1 + least(n_a - 1 - at_a, n_b - 1 - at_b))"
    return (
        left.join(right, "token")
        .where("id_a < id_b AND part_a <> part_b")
        .where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)")
        .where(f"100 * {room} >= {percent} * (n_a + n_b - {room})")
        .select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
        .distinct()
    )


def near_duplicates(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", size: int = 5,
    percent: int = 80,
) -> DataFrame:
    """Per document: ``n_shingles``, ``component_id`` and ``kept``.

    ``size`` words make a shingle; documents are linked when 100 times the
    intersection of their sets is at least ``percent`` times the union.
    """
    rows = stage(shingle_sets(documents, id_column, text, size), "sets")
    # Copies: one representative per distinct set, chosen by a map-side minimum.
    classes = rows.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    members = stage(
        rows.join(classes, ["h1", "h2"], "left").select(
            "id", "n", F.coalesce("rep", "id").alias("rep"),
            F.when(F.col("id") == F.col("rep"), F.col("bands")).alias("bands"),
        ),
        "members",
    )
    bands = _band_rows(members.where("bands is not null"))
    full = bands.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("id").alias("centre"))
    buckets = stage(
        bands.join(full.where("m > 1").drop("m"), "key").select("key", "id", "centre"), "buckets"
    )
    candidates = buckets.select(F.col("id").alias(id_column)).distinct()
    sets = stage(
        _full_sets(
            with_id(documents, id_column, text).join(candidates, id_column, "left_semi"),
            id_column, text, size,
        ),
        "candidates",
    )
    star = buckets.where("id <> centre").select(
        F.col("centre").alias("a"), F.col("id").alias("b")
    ).distinct()
    links = stage(confirmed(star, sets, percent), "star")
    groups = components(links)
    parts = stage(
        buckets.select("key", "id")
        .join(groups, F.col("id") == F.col("node"), "left")
        .select("key", "id", F.coalesce("component", "id").alias("part")),
        "parts",
    )
    split = parts.groupBy("key").agg(F.min("part").alias("lo"), F.max("part").alias("hi"))
    mixed = parts.join(split.where("lo < hi"), "key", "left_semi").select("id", "part").distinct()
    more = confirmed(_unseen_pairs(mixed, sets, percent), sets, percent)
    groups = components(
        more.unionByName(groups.select(F.col("node").alias("a"), F.col("component").alias("b")))
    )
    return members.join(groups, F.col("rep") == F.col("node"), "left").select(
        F.col("id").alias(id_column),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "rep").alias("component_id"),
        (F.col("id") == F.coalesce("component", "rep")).alias("kept"),
    )
