"""Token-id files compressed by Re-Pair grammars.

Documents are dealt to shards by ranges of their id and written in id order.  A
shard is a series of blocks; a block holds whole documents.  In a block frequent
pairs of ids are replaced by nonterminals, until no pair is left that would pay for
its rule (``LEAST_COUNT``); the block stores the
rules, the expansion length of every rule, the final symbols and where each
document starts, so one document can be decoded without the others.

File format: Parquet files with one row per block: ``shard``, ``block``,
``n_ids``, ``docs`` and ``sizes`` (ids of the documents and their token counts,
in order), ``left``, ``right`` and ``spans`` (rule k, for symbol ``base`` + k,
and its expansion length), ``layers`` (number of rules after each round) and
``symbols``; arrays are little-endian binary.

Defined results: null and empty texts are the end id alone; rows without an id
are left out; repeated ids are stored one after the other, by text; the empty
table writes no block.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, range_bucket, texts_of
from hearthstream.llm.tokens import token_bytes
from hearthstream.session import scratch_dir

BLOCK_IDS = 1 << 20
SHARD_DOCUMENTS = 20_000
PAIRS_PER_ROUND = 6000
# A rule takes 12 bytes and saves two for each occurrence; with fewer occurrences than this
# the rules of a block would also outgrow two-byte symbols.
LEAST_COUNT = 16
HASH_BITS = 18
EXACT_BELOW = 1 << 16  # so few places are counted by sorting them


def _cells(left: np.ndarray, right: np.ndarray, turn: int) -> np.ndarray:
    """A hash of pairs; another one every turn, so that no two pairs share cells for long."""
    odd = np.uint32((2654435761 + 2246822507 * turn) & 0xFFFFFFFF | 1)
    mixed = left * odd
    mixed ^= mixed >> np.uint32(15)
    mixed += right
    mixed *= np.uint32(2246822507)
    return (mixed >> np.uint32(32 - HASH_BITS)).astype(np.int64)


def _compatible(left: np.ndarray, right: np.ndarray, most: int) -> list[int]:
    """Indices of pairs, the first ones first, of which no right symbol is another one's left.

    Different chosen pairs then never overlap in the sequence.
    """
    chosen, lefts, rights = [], set(), set()
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist(), strict=True)):
        if a in rights or b in lefts or a == b and (a in lefts or b in rights):
            continue
        chosen.append(k)
        lefts.add(a)
        rights.add(b)
        if len(chosen) == most:
            break
    return chosen


def _counted(
    symbols: np.ndarray, live: np.ndarray, most: int, least: int, turn: int, exact: bool
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Left and right symbols of frequent pairs, commonest first, and the places that stay in question.

    Counting by hash overestimates: it may name a pair that is not frequent, and hide one
    behind another of its cell, but drops no place of a frequent pair.
    """
    if exact:
        codes = symbols[live].astype(np.uint64) << np.uint64(32) | symbols[live + 1]
        pairs, group, counts = np.unique(codes, return_inverse=True, return_counts=True)
        frequent = np.flatnonzero(counts >= least)
        order = frequent[np.argsort(-counts[frequent], kind="stable")[: 4 * most]]
        left, right = (pairs[order] >> np.uint64(32)).astype(np.uint32), pairs[order].astype(np.uint32)
        return left, right, live[counts[group] >= least]
    cell = _cells(symbols[live], symbols[live + 1], turn)
    counts = np.bincount(cell, minlength=1 << HASH_BITS)
    frequent = np.flatnonzero(counts >= least)
    order = frequent[np.argsort(-counts[frequent], kind="stable")[: 4 * most]]
    stands = np.zeros(1 << HASH_BITS, np.int64)
    stands[cell] = live
    at = stands[order]
    return symbols[at], symbols[at + 1], live[counts[cell] >= least]


def compress(
    ids: np.ndarray, base: int, most: int = PAIRS_PER_ROUND, least: int = LEAST_COUNT
) -> dict[str, np.ndarray]:
    """The grammar of one block of ids below ``base``: no pair that is left occurs ``least`` times.

    A round replaces many pairs that cannot overlap.  Counts of old pairs only fall, so a
    place whose pair is rare is not looked at again until a neighbour is replaced.
    """
    symbols = ids.astype(np.uint32)
    left, right, layers = [], [], []
    size, turn, exact = base, 0, False
    live = np.arange(max(0, len(symbols) - 1))
    while len(live):
        turn += 1
        exact = exact or len(live) < EXACT_BELOW
        a, b, live = _counted(symbols, live, most, least, turn, exact)
        chosen = _compatible(a, b, most)
        a, b = a[chosen], b[chosen]
        # Where the chosen pairs stand: one pair for a cell, the others wait for another turn.
        place = np.full(1 << HASH_BITS, -1, np.int32)
        place[_cells(a, b, turn)[::-1]] = np.arange(len(a), dtype=np.int32)[::-1]
        which = place[_cells(symbols[live], symbols[live + 1], turn)]
        hit = np.flatnonzero(which >= 0)
        hits, which = live[hit], which[hit]
        same = (a[which] == symbols[hits]) & (b[which] == symbols[hits + 1])
        hits, which = hits[same], which[same]
        often = np.bincount(which, minlength=len(a)) >= least
        hits, which = hits[often[which]], which[often[which]]
        if not len(hits):
            if exact:
                break
            exact = True  # the cells named only rare pairs
            continue
        exact = False
        # Only a pair of equal symbols can overlap, with itself: every other one of a run.
        starts = np.flatnonzero(np.diff(hits, prepend=-2) != 1)
        odd = (np.arange(len(hits)) - np.repeat(starts, np.diff(np.append(starts, len(hits))))) % 2 == 1
        hits, which = hits[~odd], which[~odd]
        rule = np.cumsum(often) - 1
        symbols[hits] = size + rule[which]
        stay = np.ones(len(symbols), bool)
        stay[hits + 1] = False
        asked = np.zeros(len(symbols), bool)
        asked[live] = True
        asked[hits] = True
        asked[hits[hits > 0] - 1] = True
        # The place before a replaced pair may be the removed half of another one.
        before = hits[(hits > 1)]
        asked[before[~stay[before - 1]] - 2] = True
        symbols, asked = symbols[stay], asked[stay]
        live = np.flatnonzero(asked[:-1])
        left.append(a[often].astype(np.int64))
        right.append(b[often].astype(np.int64))
        size += int(often.sum())
        layers.append(size - base)
    symbols = symbols.astype(np.int64)
    rules = np.concatenate(left) if left else np.empty(0, np.int64)
    tails = np.concatenate(right) if right else np.empty(0, np.int64)
    spans = np.ones(size, np.int64)
    begin = 0
    for end in layers:
        spans[base + begin : base + end] = spans[rules[begin:end]] + spans[tails[begin:end]]
        begin = end
    return {
        "left": rules, "right": tails, "layers": np.array(layers, np.int64),
        "spans": spans[base:], "symbols": symbols,
    }


def expand(symbols: np.ndarray, grammar: dict[str, np.ndarray], base: int) -> np.ndarray:
    """Ids of some symbols: every rule is written out once, then copied where it stands."""
    rules = len(grammar["left"])
    written = np.concatenate([np.arange(base), _undo(np.arange(base, base + rules), grammar, base)])
    widths = np.concatenate([np.ones(base, np.int64), grammar["spans"]])
    starts = np.cumsum(widths) - widths
    n = widths[symbols]
    ends = np.cumsum(n)
    return written[np.repeat(starts[symbols] - ends + n, n) + np.arange(int(n.sum()))]


def _undo(symbols: np.ndarray, grammar: dict[str, np.ndarray], base: int) -> np.ndarray:
    """Ids of symbols by undoing the layers from the last to the first."""
    layers = [0, *grammar["layers"].tolist()]
    for begin, end in reversed(list(zip(layers[:-1], layers[1:], strict=True))):
        hit = symbols >= base + begin
        if not hit.any():
            continue
        place = np.cumsum(1 + hit) - 1 - hit
        wide = np.empty(len(symbols) + int(hit.sum()), np.int64)
        wide[place[~hit]] = symbols[~hit]
        rule = symbols[hit] - base
        wide[place[hit]] = grammar["left"][rule]
        wide[place[hit] + 1] = grammar["right"][rule]
        symbols = wide
    return symbols


def decode_range(grammar: dict[str, np.ndarray], base: int, start: int, stop: int) -> np.ndarray:
    """Ids ``start`` to ``stop`` of a block, expanding only the symbols that cover them."""
    symbols = grammar["symbols"].astype(np.int64)
    widths = np.concatenate([np.ones(base, np.int64), grammar["spans"]])[symbols]
    ends = np.cumsum(widths)
    first = int(np.searchsorted(ends, start, side="right"))
    last = int(np.searchsorted(ends, stop, side="left"))
    if start >= stop:
        return np.empty(0, np.int64)
    before = int(ends[first] - widths[first])
    return expand(symbols[first : last + 1], grammar, base)[start - before : stop - before]


_ARRAYS = ("left", "right", "layers", "spans")
_BLOCK = pa.schema(
    [("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("base", pa.int64()),
     ("docs", pa.binary()), ("sizes", pa.binary()), *[(a, pa.binary()) for a in _ARRAYS],
     ("symbols", pa.binary())]
)
_BLOCK_DDL = (
    "shard int, block int, n_ids bigint, base bigint, docs binary, sizes binary, left binary, "
    "right binary, layers binary, spans binary, symbols binary"
)


def _block(shard: int, number: int, base: int, docs: list[int], parts: list[bytes]) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), "<u4")
    grammar = compress(ids, base)
    values = [shard, number, len(ids), base, np.array(docs, "<i8").tobytes(),
              np.array([len(p) // 4 for p in parts], "<u4").tobytes(),
              *[grammar[a].astype("<u4").tobytes() for a in _ARRAYS],
              # Symbols of two bytes where they fit: base + rules stays below 65536.
              grammar["symbols"].astype("<u2" if base + len(grammar["left"]) <= 1 << 16 else "<u4").tobytes()]
    return batch_of(_BLOCK, [[v] for v in values])


def _grammar(row: dict) -> dict[str, np.ndarray]:
    grammar = {a: np.frombuffer(row[a], "<u4").astype(np.int64) for a in _ARRAYS}
    wide = row["base"] + len(grammar["left"]) > 1 << 16
    grammar["symbols"] = np.frombuffer(row["symbols"], "<u4" if wide else "<u2").astype(np.int64)
    return grammar


def write_token_files(
    documents: DataFrame, path: str, vocabulary: str, base: int, id_column: str = "doc_id",
    text: str = "text", end_id: int = 0, block_ids: int = BLOCK_IDS,
) -> None:
    """Write the ids of all documents, in ascending id order, below ``path``.

    ``base`` is the size of the vocabulary.  Shards are cut at quantiles of the ids, at
    least one per shuffle partition and one per ``SHARD_DOCUMENTS``, so a task does not
    grow with the table; it holds one block at a time.
    """
    docs = documents.select(
        F.col(id_column).cast("bigint").alias("id"), F.coalesce(text, F.lit("")).alias("text")
    ).where("id is not null")
    parts = max(
        2, int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions")),
        -(-docs.count() // SHARD_DOCUMENTS),
    )
    cuts = docs.agg(
        F.percentile_approx("id", [k / parts for k in range(1, parts)], 20 * parts)
    ).first()[0]
    rows = (
        docs.withColumn("shard", range_bucket(F.col("id"), cuts or []))
        .repartition(parts, "shard")
        .sortWithinPartitions("shard", "id", "text")
        .select("shard", "id", "text")
    )
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        now, number, docs_, ids, held = None, 0, [], [], 0
        for batch in batches:
            encoded = token_bytes(vocabulary, texts_of(batch.column(2)))
            for shard, i, found in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), encoded, strict=True
            ):
                if docs_ and (shard != now or held >= 4 * block_ids):
                    yield _block(now, number, base, docs_, ids)
                    docs_, ids, held, number = [], [], 0, number + 1
                if shard != now:
                    now, number = shard, 0
                docs_.append(i)
                ids.append(found + end)
                held += len(ids[-1])
        if docs_:
            yield _block(now, number, base, docs_, ids)

    map_batches(rows, work, _BLOCK_DDL).write.parquet(path)


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_BLOCK_DDL).parquet(path)


def block_starts(blocks: DataFrame) -> DataFrame:
    """``begin``: number of ids before each block.

    Blocks are summed within their shard; only one row per shard meets in one task.
    """
    sizes = blocks.select("shard", "block", "n_ids")
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("base_ids")
    )
    own = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        "shard", "block", F.coalesce(F.sum("n_ids").over(own), F.lit(0)).alias("inner")
    ).join(shards, "shard").select(
        "shard", "block", (F.col("base_ids") + F.col("inner")).alias("begin")
    )


def read_documents(
    spark: SparkSession, path: str, id_column: str = "doc_id", ids: bool = False
) -> DataFrame:
    """Per document from the files: ``start``, ``n_tokens``, ``ids_crc32`` (and ``ids``)."""
    blocks = read_blocks(spark, path)
    rows = blocks.join(block_starts(blocks), ["shard", "block"]).drop("shard", "block")
    schema = pa.schema(
        [(id_column, pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
         ("ids_crc32", pa.int64())] + ([("ids", pa.list_(pa.int32()))] if ids else [])
    )

    def work(batches):
        for batch in batches:
            for row in batch.to_pylist():
                grammar = _grammar(row)
                flat = expand(grammar["symbols"], grammar, row["base"]).astype("<u4")
                sizes = np.frombuffer(row["sizes"], "<u4").astype(np.int64)
                ends = np.cumsum(sizes)
                starts = ends - sizes
                raw = memoryview(flat.tobytes())
                columns = [
                    np.frombuffer(row["docs"], "<i8"), starts + row["begin"], sizes,
                    np.array([zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(starts, ends, strict=True)], np.int64),
                ]
                arrays = [pa.array(c) for c in columns]
                if ids:
                    arrays.append(pa.array([flat[a:b].tolist() for a, b in zip(starts, ends, strict=True)], pa.list_(pa.int32())))
                yield batch_of(schema, arrays)

    extra = ", ids array<int>" if ids else ""
    return map_batches(
        rows, work, f"`{id_column}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint{extra}"
    )


def token_file_digests(documents: DataFrame, vocabulary: str, base: int, **options) -> DataFrame:
    """Write the files to the shared scratch folder and report what they hold."""
    path = scratch_dir(documents.sparkSession, "llm-token-files")
    write_token_files(documents, path, vocabulary, base, **options)
    return read_documents(documents.sparkSession, path, options.get("id_column", "doc_id"))
