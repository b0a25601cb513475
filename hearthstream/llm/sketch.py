"""Rolling hashes, window anchors, and a count-min sketch of what repeats.

The anchor of a window is the smallest hash among the short runs inside it.
Equal windows have equal anchors, and neighbouring windows mostly share theirs, so
a count of anchors never underestimates a count of windows and needs a fraction
of the cells.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, mix64, stage

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
DEPTH = 2
# The sketch is added up in so many parts, whatever its size, so that the rows of a
# partial sketch grow with the input and not with its square.
PARTS_BITS = 6
LEAST_BITS = 20
# The sketch sent to every task has at most this many cells a row, one bit each:
# 2 rows of 2**30 bits are 256 MB.  Beyond it the estimates get looser and more
# windows go through the exact pass; none is lost.
MOST_BITS = 30

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = 1 << max(16, n - 1).bit_length()
        for k, base in enumerate((_BASE, _INVERSE)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            _powers[k] = np.cumprod(table, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


class Rolling:
    """Hashes of all runs of a sequence of 64-bit codes, of any length."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        up, self.down = _power_tables(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * up[:n], out=self.sums[1:])

    def runs(self, length: int) -> np.ndarray:
        """Hash of every run of ``length`` codes."""
        n = len(self.sums) - length
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix64((self.sums[length:] - self.sums[:n]) * self.down[:n])


def sliding(values: np.ndarray, width: int, best=np.minimum) -> np.ndarray:
    """Minimum (or maximum) of every ``width`` neighbours, in linear time."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    worst = np.iinfo(values.dtype).max if best is np.minimum else np.iinfo(values.dtype).min
    padded = np.full(-(-len(values) // width) * width, worst, values.dtype)
    padded[: len(values)] = values
    grid = padded.reshape(-1, width)
    ahead = best.accumulate(grid, axis=1).ravel()
    behind = best.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[:n], ahead[width - 1 : width - 1 + n])


def cells(anchors: np.ndarray, bits: int) -> np.ndarray:
    """One cell per row of the sketch, rows numbered through: shape (DEPTH, n)."""
    rows = []
    for d in range(DEPTH):
        salt = np.uint64((d + 1) * int(_INVERSE) % (1 << 64))
        h = mix64(anchors + salt) >> np.uint64(64 - bits)
        rows.append(h + (np.uint64(d) << np.uint64(bits)))
    return np.array(rows)


def sketch_bits(size: int) -> int:
    """Cells (as a power of two) for about ``size`` distinct anchors."""
    return min(MOST_BITS, max(LEAST_BITS, int(8 * size).bit_length()))


def _part_bits(bits: int) -> int:
    return bits + (DEPTH - 1).bit_length() - PARTS_BITS


def merge_sketches(partial: DataFrame, bits: int) -> np.ndarray:
    """The sketch of ``merge_with_frequent`` alone."""
    return merge_with_frequent(partial, bits, 1)[0]


def merge_with_frequent(partial: DataFrame, bits: int, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Add partial sketches and return the packed bits "counted twice or more".

    ``partial`` has rows (part, cells): the cells of one part of the sketch that a
    piece of the input has counted, a cell twice if it was counted more than once
    there.  A part is added up as its rows stream by.  The result has
    DEPTH * 2**bits bits at most, whatever the size of the input.

    Also returns the sorted anchors found ``least`` times or more in the rows of
    ``sample_rows``, which ``partial`` may have besides.
    """
    schema = pa.schema([("part", pa.int32()), ("twice", pa.binary())])
    width = 1 << _part_bits(bits)

    def work(batches):
        now, counts = None, None

        def done():
            if now >= 1 << PARTS_BITS:
                found, times = np.unique(np.concatenate(counts), return_counts=True)
                return batch_of(schema, [[now], [found[times >= least].tobytes()]])
            return batch_of(schema, [[now], [np.packbits(counts >= 2).tobytes()]])

        for batch in batches:
            for part, found in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True
            ):
                if part != now:
                    if now is not None:
                        yield done()
                    now = part
                    counts = [] if part >= 1 << PARTS_BITS else np.zeros(width, np.uint8)
                if part >= 1 << PARTS_BITS:
                    counts.append(np.frombuffer(found, "<u8"))
                    continue
                # Cells come sorted, an equal one right behind.
                flat = np.frombuffer(found, "<u4")
                again = flat[1:][flat[1:] == flat[:-1]]
                counts[flat] = np.minimum(counts[flat] + 1, 2)
                counts[again] = 2
        if now is not None:
            yield done()

    merged = stage(
        map_batches(
            partial.repartition(F.col("part")).sortWithinPartitions("part"), work,
            "part int, twice binary",
        ),
        "sketch",
    )
    total = np.zeros((DEPTH << bits) >> 3, np.uint8)
    frequent = [np.empty(0, np.uint64)]
    for row in merged.toLocalIterator():
        if row.part >= 1 << PARTS_BITS:
            frequent.append(np.frombuffer(row.twice, "<u8"))
            continue
        total[row.part * (width >> 3) : (row.part + 1) * (width >> 3)] = np.frombuffer(row.twice, np.uint8)
    return total, np.sort(np.concatenate(frequent))


def sample_rows(anchors: np.ndarray, rate: int) -> pa.RecordBatch:
    """Rows (part, cells) with about one in ``rate`` of the anchors themselves.

    Drawn by a generator whose seed is a hash of the anchors and of their places, so that
    a repeated task, and a second pass over the same piece, draw the same ones.
    """
    schema = pa.schema([("part", pa.int32()), ("cells", pa.binary())])
    seed = np.bitwise_xor.reduce(mix64(anchors ^ mix64(np.arange(1, len(anchors) + 1)))) if len(anchors) else 0
    taken = anchors[np.random.default_rng(int(seed)).random(len(anchors)) * rate < 1]
    part = (taken % np.uint64(1 << PARTS_BITS)).astype(np.int64)
    return batch_of(
        schema,
        [
            [(1 << PARTS_BITS) + k for k in np.unique(part).tolist()],
            [taken[part == k].astype("<u8").tobytes() for k in np.unique(part)],
        ],
    )


def partial_sketch(anchors: np.ndarray, bits: int) -> pa.RecordBatch:
    """Rows (part, cells) of one piece; ``anchors`` once per document that has them."""
    schema = pa.schema([("part", pa.int32()), ("cells", pa.binary())])
    found, times = np.unique(cells(anchors, bits).ravel(), return_counts=True)
    flat = np.repeat(found, np.minimum(times, 2))
    part = (flat >> np.uint64(_part_bits(bits))).astype(np.int64)
    inner = (flat & np.uint64((1 << _part_bits(bits)) - 1)).astype("<u4")
    starts = np.flatnonzero(np.diff(part, prepend=-1))
    ends = np.append(starts[1:], len(flat))
    return batch_of(
        schema,
        [part[starts].tolist(), [inner[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]],
    )


def repeated(twice: np.ndarray, anchors: np.ndarray, bits: int) -> np.ndarray:
    """Which anchors the sketch estimates at two or more."""
    keep = np.ones(len(anchors), bool)
    for row in cells(anchors, bits):
        byte = twice[(row >> np.uint64(3)).astype(np.int64)]
        keep &= (byte >> (np.uint8(7) - (row & np.uint64(7)).astype(np.uint8))) & 1 == 1
    return keep
