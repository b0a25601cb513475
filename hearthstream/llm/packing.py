"""Best-fit packing of documents into token sequences by a grouping genetic algorithm.

Documents longer than a sequence are cut so that every piece but the first is
full; full pieces are sequences of their own.  The rest is dealt by hash into
shards of bounded size, each with the corpus' mix of lengths.  Every shard is
evolved by several islands: a chromosome is a set of bins; crossover injects
whole well-filled bins of one parent into the other, removes the bins that now
hold documents twice, and puts the displaced documents back best fit.  Between
epochs the elite of an island migrates to the next island of its shard.  A shard
stops when it needs no more bins than its total length demands.

The worst-filled bins of all shards are opened again and packed together in the
next level, which is many times smaller, until one shard is left.

Only lengths, ids and checksums travel; token ids stay where they are computed.

Defined results: null and empty texts are one end token; repeated rows are
packed once for each row (``row`` tells them apart); rows without an id are left
out; an empty table gives no sequences.
"""

from __future__ import annotations

import random
import zlib
from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, stage, texts_of, with_id
from hearthstream.llm.tokens import token_bytes

CAPACITY = 2048
SHARD_PIECES = 4096
ISLANDS = 2
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
SUBSET_BINS = 160  # bins that are opened at a time to be filled by subset sums
REOPEN = 0.97  # bins filled less than this are packed again on the next level

Bins = list[list[int]]


def cut_points(n: int, capacity: int = CAPACITY) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: only the first may be short."""
    first = n % capacity or min(n, capacity)
    return [(0, first)] + [(s, capacity) for s in range(first, n, capacity)]


def load(b: list[int], lengths: list[int]) -> int:
    """Tokens in a bin."""
    return sum(map(lengths.__getitem__, b))


def best_fit(
    items: list[int], lengths: list[int], capacity: int, bins: Bins | None = None, in_order: bool = False
) -> Bins:
    """Put items, longest first or in their order, into the fullest bin that takes them."""
    bins = [list(b) for b in bins or []]
    space: list[tuple[int, int]] = sorted(
        (capacity - load(b, lengths), k) for k, b in enumerate(bins)
    )
    for i in items if in_order else sorted(items, key=lambda x: (-lengths[x], x)):
        at = bisect_left(space, (lengths[i], -1))
        if at < len(space):
            room, k = space.pop(at)
            bins[k].append(i)
        else:
            room, k = capacity, len(bins)
            bins.append([i])
        if room > lengths[i]:
            insort(space, (room - lengths[i], k))
    return bins


def fitness(bins: Bins, lengths: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then the mean squared filling, higher is better."""
    fill = [load(b, lengths) / capacity for b in bins]
    return -len(bins), sum(f * f for f in fill) / max(1, len(bins))


def crossover(
    mother: Bins, father: Bins, lengths: list[int], capacity: int, rng: random.Random
) -> Bins:
    """The mother's bins with whole well-filled bins of the father injected."""
    well = [b for b in father if load(b, lengths) >= 0.99 * capacity]
    well = well or [max(father, key=lambda b: load(b, lengths))]
    injected = rng.sample(well, max(1, len(well) // 3))
    taken = {i for b in injected for i in b}
    child, displaced = [], []
    for b in mother:
        if taken.isdisjoint(b):
            child.append(b)
        else:
            displaced += [i for i in b if i not in taken]
    return mutate(child + injected, displaced, lengths, capacity, rng)


def subset_fill(items: list[int], lengths: list[int], capacity: int) -> Bins:
    """Fill one bin after the other as full as a subset with the longest item left can.

    Reachable sums are the bits of a number; the subset is read off backwards.
    """
    left = sorted(items, key=lambda x: (-lengths[x], x))
    bins: Bins = []
    while left:
        first = left[0]
        room = capacity - lengths[first]
        # Longest first; what is longer than the room cannot help.
        rest = left[max(1, bisect_left(left, -room, key=lambda i: -lengths[i])) :]
        mask = (1 << (room + 1)) - 1
        sums = [1]
        for i in rest:
            if sums[-1] >> room & 1:
                break  # filled to the last place
            sums.append((sums[-1] | sums[-1] << lengths[i]) & mask)
        total = sums[-1].bit_length() - 1
        taken = [first]
        for k in range(len(sums) - 1, 0, -1):
            if not sums[k - 1] >> total & 1:
                taken.append(rest[k - 1])
                total -= lengths[rest[k - 1]]
        gone = set(taken)
        left = [i for i in left if i not in gone]
        bins.append(taken)
    return bins


def mutate(
    bins: Bins, displaced: list[int], lengths: list[int], capacity: int, rng: random.Random
) -> Bins:
    """Put displaced items back best fit; then fill anew, by subset sums, the emptiest bins and some others.

    The others are well-filled ones drawn at random: they lend the lengths that the
    emptiest bins lack.
    """
    bins = best_fit(displaced, lengths, capacity, bins) if displaced else [list(b) for b in bins]
    bins.sort(key=lambda b: load(b, lengths))
    some = min(len(bins), SUBSET_BINS // 2)
    opened, bins = bins[:some], bins[some:]
    for _ in range(min(len(bins), SUBSET_BINS - some)):
        k = rng.randrange(len(bins))
        bins[k], bins[-1] = bins[-1], bins[k]
        opened.append(bins.pop())
    filled = subset_fill([i for b in opened for i in b], lengths, capacity)
    return bins + (filled if len(filled) <= len(opened) else opened)


def evolve(
    lengths: list[int], capacity: int, seed: int, elite: Bins | None = None,
    generations: int = GENERATIONS, population: int = POPULATION,
) -> Bins:
    """One island's epoch: the best set of bins found.

    The population starts from random orders, so the bins come from injection and
    repair.  Packing longest first is compared with what was found at the end, and
    taken only if it needs fewer bins.
    """
    rng = random.Random(seed)
    everything = list(range(len(lengths)))
    least = -(-sum(lengths) // capacity)
    if elite and len(elite) <= least:
        return elite
    pool = [elite] if elite else []
    while len(pool) < population:
        pool.append(best_fit(rng.sample(everything, len(everything)), lengths, capacity, in_order=True))
    for _ in range(generations):
        pool.sort(key=lambda b: fitness(b, lengths, capacity), reverse=True)
        half = pool[: max(1, population // 2)]
        children = []
        while len(half) + len(children) < population and (not children or len(children[-1]) > least):
            children.append(crossover(rng.choice(half), rng.choice(pool), lengths, capacity, rng))
        pool = half + children
        if min(map(len, pool)) <= least:
            break
    best = max(pool, key=lambda b: fitness(b, lengths, capacity))
    if len(best) > least:
        plain = best_fit(everything, lengths, capacity)
        best = plain if len(plain) < len(best) else best
    return best


def _flat(bins: Bins, n: int) -> np.ndarray:
    bin_of = np.empty(n, np.int32)
    for k, b in enumerate(bins):
        bin_of[b] = k
    return bin_of


def _bins(bin_of: np.ndarray) -> Bins:
    out: Bins = [[] for _ in range(int(bin_of.max()) + 1)] if len(bin_of) else []
    for i, k in enumerate(bin_of.tolist()):
        out[k].append(i)
    return out


_ISLAND = (
    "level int, shard bigint, island int, keys array<bigint>, lengths array<int>, bins array<int>"
)


def _epoch(islands: DataFrame, capacity: int, epoch: int) -> DataFrame:
    """Evolve every island once; ``bins`` is the elite it starts from and leaves."""

    def work(frames):
        for frame in frames:
            found = []
            for row in frame.itertuples():
                lengths = [int(x) for x in row.lengths]
                elite = _bins(np.asarray(row.bins)) if row.bins is not None else None
                seed = (row.level * 1_000_003 + row.shard) * 97 + row.island * 7 + epoch
                found.append(_flat(evolve(lengths, capacity, seed, elite), len(lengths)))
            yield frame.assign(bins=found)

    return islands.mapInPandas(work, _ISLAND)


def _best(islands: DataFrame) -> DataFrame:
    """The island with the fewest bins of every shard."""
    return islands.groupBy("level", "shard").agg(
        F.min_by(
            F.struct("keys", "lengths", "bins"), F.struct(F.array_max("bins"), "island")
        ).alias("b")
    ).select("level", "shard", "b.*")


def pack_lengths(
    pieces: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES
) -> DataFrame:
    """``key``, ``level``, ``shard`` and ``bin`` for pieces with ``key`` and ``length``.

    ``key`` is unique; (level, shard, bin) names a sequence.
    """
    level, done = 0, []
    open_pieces = pieces.select("key", F.col("length").cast("int").alias("length"))
    while True:
        n = open_pieces.count()
        shards = max(1, -(-n // shard_pieces))
        islands = (
            open_pieces.withColumn("shard", F.pmod(F.xxhash64("key", F.lit(level)), F.lit(shards)))
            .groupBy("shard")
            .agg(F.sort_array(F.collect_list(F.struct("key", "length"))).alias("p"))
            .select(
                F.lit(level).alias("level"), "shard",
                F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"),
                F.col("p.key").alias("keys"), F.col("p.length").alias("lengths"),
                F.lit(None).cast("array<int>").alias("bins"),
            )
            .repartition(max(1, min(shards * ISLANDS, 10_000)), "shard", "island")
        )
        for epoch in range(EPOCHS):
            islands = stage(_epoch(islands, capacity, epoch), "islands")
            if epoch + 1 < EPOCHS:
                # Ring migration: an island goes on from its neighbour's elite.
                guests = islands.select(
                    "level", "shard", F.pmod(F.col("island") + 1, F.lit(ISLANDS)).alias("island"),
                    F.col("bins").alias("guest"),
                )
                islands = islands.join(guests, ["level", "shard", "island"]).select(
                    "level", "shard", "island", "keys", "lengths",
                    F.when(
                        F.array_max("guest") <= F.array_max("bins"), F.col("guest")
                    ).otherwise(F.col("bins")).alias("bins"),
                )
        packed = stage(
            _best(islands).select(
                "level", "shard", F.explode(F.arrays_zip("keys", "lengths", "bins")).alias("p")
            ).select(
                "level", "shard", F.col("p.bins").alias("bin"), F.col("p.keys").alias("key"),
                F.col("p.lengths").alias("length"),
            ),
            "packed",
        )
        if shards == 1:
            done.append(packed)
            break
        fill = packed.groupBy("shard", "bin").agg(F.sum("length").alias("fill"))
        split = packed.join(fill, ["shard", "bin"])
        keep = F.col("fill") >= int(REOPEN * capacity)
        again = stage(split.where(~keep).select("key", "length"), "again")
        if again.count() * 2 > n:  # nothing left to gain
            done.append(packed)
            break
        done.append(split.where(keep).select(*packed.columns))
        open_pieces, level = again, level + 1
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("key", "level", "shard", "bin")


def document_pieces(
    documents: DataFrame, vocabulary: str, id_column: str, text: str, capacity: int, end_id: int
) -> DataFrame:
    """Pieces of every document: row, piece, start, length and crc32 of their ids."""
    schema = pa.schema(
        [("doc", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()),
         ("length", pa.int64()), ("crc", pa.int64())]
    )
    end = np.array([end_id], "<u4").tobytes()

    def work(batches):
        for batch in batches:
            out: list[list] = [[] for _ in schema]
            encoded = token_bytes(vocabulary, texts_of(batch.column(1)))
            for i, ids in zip(batch.column(0).to_pylist(), encoded, strict=True):
                ids += end
                for piece, (start, n) in enumerate(cut_points(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + n)])
                    for column, value in zip(out, (i, piece, start, n, crc), strict=True):
                        column.append(value)
            yield batch_of(schema, out)

    return map_batches(
        with_id(documents, id_column, text), work,
        "doc bigint, piece int, start bigint, length bigint, crc bigint",
    )


def pack_documents(
    documents: DataFrame, vocabulary: str, id_column: str = "doc_id", text: str = "text",
    capacity: int = CAPACITY, end_id: int = 0, shard_pieces: int = SHARD_PIECES,
) -> DataFrame:
    """Per piece its place: ``sequence_id`` and gapless ``offset``, with its ids' crc32."""
    pieces = stage(
        document_pieces(documents, vocabulary, id_column, text, capacity, end_id).withColumn(
            "key", F.monotonically_increasing_id()
        ),
        "pieces",
    )
    short = pieces.where(F.col("length") < capacity)
    placed = pack_lengths(short, capacity, shard_pieces)
    named = short.join(placed, "key")
    within = Window.partitionBy("level", "shard", "bin").orderBy("key")
    named = named.withColumn(
        "offset", F.sum("length").over(within.rowsBetween(Window.unboundedPreceding, 0)) - F.col("length")
    ).withColumn(
        # Level, shard and bin (at most one per piece of a shard) in one number, not
        # negative; a full piece's sequence is its own negative key.
        "sequence_id",
        F.col("level").cast("bigint") * F.lit(1 << 56) + F.col("shard") * F.lit(1 << 16) + F.col("bin"),
    )
    columns = ["doc", "piece", "start", "length", "crc", "sequence_id", "offset"]
    whole = pieces.where(F.col("length") == capacity).select(
        "doc", "piece", "start", "length", "crc",
        (-F.col("key") - 1).alias("sequence_id"), F.lit(0).cast("bigint").alias("offset"),
    )
    return named.select(*columns).unionByName(whole).select(
        F.col("doc").alias(id_column), "piece", "start", "length",
        F.col("crc").alias("ids_crc32"), "sequence_id", "offset",
    )
