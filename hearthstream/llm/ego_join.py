"""Similar vectors by an epsilon grid order join.

Unit vectors within an angle are within a distance epsilon of each other.  The
vectors are turned onto their principal axes, cut into grid cells of width epsilon
on the leading ones, and sorted by cell, first axis first.  The sorted sequence is
cut into intervals; pairs of intervals are joined by halving them, and a pair whose
bounding boxes are more than epsilon apart is skipped.

Equal vectors are joined first and carry their number.  An interval pair returns
one row per linked vector, its number of links and the smallest vector of its
group there, never a list of pairs, so a cluster with a third of all vectors costs
comparisons but no rows.

Interval pairs are dealt out in blocks of neighbouring intervals, so an interval travels
once for each block and not once for each pair.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components have no links; vectors of different lengths are not linked with each
other, each length is joined for itself; very large and very small components count by their
ratio to the largest one; rows without an id are left out; an id that occurs with several vectors is one node; the empty
table gives the empty table.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, stage, with_id
from hearthstream.llm.components import components

AXES = 8  # grid cells are cut on so many leading axes
BOX_AXES = 24  # bounding boxes cover so many
INTERVAL = 4096
BLOCK = 8  # most intervals of a side that a task holds
LEAF = 128
SLACK = 1e-9


def local_groups(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``n`` nodes."""
    label = np.arange(n)
    while True:
        least = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, least)
        np.minimum.at(label, b, least)
        label = label[label]
        if (label == before).all():
            return label


class Interval:
    """Part of the sequence: unit vectors, their leading coordinates and weights."""

    def __init__(self, vectors: np.ndarray, axes: np.ndarray, weights: np.ndarray):
        self.unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
        self.lead = self.unit @ axes
        self.weights = weights


def _apart(x: np.ndarray, y: np.ndarray) -> float:
    """Squared distance of two bounding boxes."""
    gap = np.maximum(0, np.maximum(x.min(0) - y.max(0), y.min(0) - x.max(0)))
    return float((gap * gap).sum())


def join_intervals(
    left: Interval, right: Interval, same: bool, cosine: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Links between two intervals: weights of partners per side, and group edges.

    ``same`` joins an interval with itself, every pair once and no vector with
    itself.
    """
    reach = 2 - 2 * cosine + SLACK
    n_left = np.zeros(len(left.unit), np.int64)
    n_right = np.zeros(len(right.unit), np.int64)
    edges_a: list[np.ndarray] = []
    edges_b: list[np.ndarray] = []

    def halves(a: int, b: int) -> list[tuple[int, int]]:
        return [(a, b)] if b - a <= LEAF else [(a, (a + b) // 2), ((a + b) // 2, b)]

    todo = [(0, len(left.unit), 0, len(right.unit))]
    while todo:
        a, b, c, d = todo.pop()
        if same and c < a:
            continue  # the mirrored pair is taken
        if _apart(left.lead[a:b], right.lead[c:d]) > reach:
            continue
        if b - a > LEAF or d - c > LEAF:
            todo += [(*x, *y) for x in halves(a, b) for y in halves(c, d)]
            continue
        hit = left.unit[a:b] @ right.unit[c:d].T >= cosine
        if same and a == c:
            hit = np.triu(hit, 1)
        i, j = np.nonzero(hit)
        if not len(i):
            continue
        n_left[a:b] += hit @ right.weights[c:d]
        n_right[c:d] += left.weights[a:b] @ hit
        # One edge per linked vector is enough to keep the groups of this leaf.
        group = local_groups(b - a + d - c, i, j + (b - a))
        node = np.flatnonzero(group != np.arange(len(group)))
        place = np.concatenate([np.arange(a, b), len(left.unit) + np.arange(c, d)])
        edges_a.append(place[node])
        edges_b.append(place[group[node]])
    none = np.empty(0, np.int64)
    return (
        n_left, n_right,
        np.concatenate(edges_a) if edges_a else none, np.concatenate(edges_b) if edges_b else none,
    )


_PLAIN = pa.schema([("id", pa.int64()), ("raw", pa.binary()), ("dim", pa.int32())])


def _plain(vectors: DataFrame, id_column: str, vector: str) -> DataFrame:
    """Id, components as bytes (null if unusable) and length of every vector."""

    def work(batches):
        for batch in batches:
            raws, dims = [], []
            for v in batch.column(1):
                x = None
                if v.is_valid and len(v.values) and not v.values.null_count:
                    x = v.values.to_numpy(zero_copy_only=False).astype("<f8")
                    most = np.abs(x).max()
                    x = x if np.isfinite(most) and most > 0 else None
                    if x is not None and not 1e-100 < most < 1e100:
                        x = x / most  # squares would overflow or vanish
                raws.append(None if x is None else x.tobytes())
                dims.append(0 if x is None else len(x))
            yield batch_of(_PLAIN, [batch.column(0).cast(pa.int64()), raws, dims])

    return map_batches(with_id(vectors, id_column, vector), work, "id bigint, raw binary, dim int")


def principal_axes(classes: DataFrame, dim: int) -> np.ndarray:
    """Eigenvectors of the second moments of all unit vectors, largest first.

    Tasks add up dim x dim matrices; only their partial sums travel.
    """

    def add(batches):
        total = np.zeros((dim, dim))
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<f8").reshape(-1, dim)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    total = np.zeros((dim, dim))
    for row in map_batches(classes.select("raw"), add, "m binary").toLocalIterator():
        total += np.frombuffer(row.m).reshape(dim, dim)
    return np.linalg.eigh(total)[1][:, ::-1]


def _grid_order(classes: DataFrame, axes: np.ndarray, dim: int, epsilon: float) -> DataFrame:
    """Vectors with their rank in epsilon grid order."""
    n = min(AXES, dim)
    lead = axes[:, :n]
    schema = pa.schema(
        [("rep", pa.int64()), ("m", pa.int64()), ("raw", pa.binary()), ("cell", pa.list_(pa.int32()))]
    )

    def cell(batches):
        for batch in batches:
            x = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<f8").reshape(-1, dim)
            x = x / np.sqrt((x * x).sum(axis=1))[:, None]
            grid = np.floor(x @ lead / epsilon).astype(np.int32)
            yield batch_of(schema, [*(batch.column(i) for i in range(3)), grid.tolist()])

    ordered = stage(
        map_batches(classes.select("rep", "m", "raw"), cell,
                    "rep bigint, m bigint, raw binary, cell array<int>")
        .orderBy("cell", "rep").withColumn("mark", F.monotonically_increasing_id()),
        "grid",
    )
    part = F.shiftright("mark", 33)
    sizes = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    before, total = {}, 0
    for r in sizes:  # one row per partition
        before[r.part] = total
        total += r["count"]
    offsets = F.create_map(*[F.lit(x) for item in before.items() for x in item])
    rank = offsets[part] + F.col("mark").bitwiseAND(F.lit((1 << 33) - 1))
    return ordered.withColumn("interval", F.floor(rank / INTERVAL).cast("int")).withColumn(
        "place", rank % INTERVAL
    )


def _intervals(ordered: DataFrame, axes: np.ndarray, dim: int) -> DataFrame:
    """One row per interval: its vectors in order, and its bounding box."""
    box = axes[:, : min(BOX_AXES, dim)]

    def build(key, table):
        table = table.sort_by("place")
        x = np.frombuffer(b"".join(table.column("raw").to_pylist()), "<f8").reshape(-1, dim)
        y = (x / np.sqrt((x * x).sum(axis=1))[:, None]) @ box
        reps = np.array(table.column("rep").to_pylist(), "<i8")
        weights = np.array(table.column("m").to_pylist(), "<i8")
        # Single precision holds most tables' vectors without loss, at half the size.
        small = x.astype("<f4")
        data = small if (small == x).all() else x
        return pa.table({
            "interval": pa.array([key[0].as_py()], pa.int32()),
            "reps": [reps.tobytes()], "weights": [weights.tobytes()], "data": [data.tobytes()],
            "lo": pa.array([y.min(0).tolist()], pa.list_(pa.float64())),
            "hi": pa.array([y.max(0).tolist()], pa.list_(pa.float64())),
        })

    return ordered.groupBy("interval").applyInArrow(
        build,
        "interval int, reps binary, weights binary, data binary, lo array<double>, hi array<double>",
    )


def _near_intervals(intervals: DataFrame, reach: float, epsilon: float) -> DataFrame:
    """Pairs of intervals (a <= b) whose boxes are not provably apart.

    They meet on the cells of the first axis that they cover, give or take one.
    """
    boxes = intervals.select("interval", "lo", "hi")
    first = F.floor(F.col("lo")[0] / epsilon), F.floor(F.col("hi")[0] / epsilon)
    left = boxes.select(
        F.col("interval").alias("a"), F.col("lo").alias("lo_a"), F.col("hi").alias("hi_a"),
        F.explode(F.sequence(*first)).alias("cell"),
    )
    right = boxes.select(
        F.col("interval").alias("b"), F.col("lo").alias("lo_b"), F.col("hi").alias("hi_b"),
        F.explode(F.sequence(first[0] - 1, first[1] + 1)).alias("cell"),
    )
    gaps = F.zip_with(
        F.zip_with("lo_a", "hi_b", lambda x, y: x - y),
        F.zip_with("lo_b", "hi_a", lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)),
    )
    apart = F.aggregate(gaps, F.lit(0.0), lambda s, g: s + g * g)
    return left.join(right, "cell").where("a <= b").where(apart <= reach).select("a", "b").distinct()


def _links(
    pairs: DataFrame, intervals: DataFrame, axes: np.ndarray, dim: int, cosine: float, block: int
) -> DataFrame:
    """Rows (rep, n, part): links of a vector in one interval pair, and its group there.

    Pairs of ``block`` by ``block`` neighbouring intervals meet in one group, with each
    of their intervals once.
    """
    box = axes[:, : min(BOX_AXES, dim)]
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("part", pa.int64())])

    def unpack(reps: bytes, weights: bytes, data: bytes) -> tuple[np.ndarray, Interval]:
        ids = np.frombuffer(reps, "<i8")
        kind = "<f4" if len(data) == 4 * dim * len(ids) else "<f8"
        vectors = np.frombuffer(data, kind).reshape(-1, dim).astype(np.float64)
        return ids, Interval(vectors, box, np.frombuffer(weights, "<i8"))

    def joined(ids_a, left, ids_b, right, same) -> pa.RecordBatch:
        n_a, n_b, x, y = join_intervals(left, right, same, cosine)
        ids = np.concatenate([ids_a, ids_b])
        n = np.concatenate([n_a, n_b])
        if same:
            half = len(ids_a)
            n = np.concatenate([n_a + n_b, np.zeros(half, np.int64)])
            x, y = x % half, y % half
        # Groups by the smallest id, not by the place in the sequence.
        order = np.argsort(ids, kind="stable")
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        group = np.empty(len(ids), np.int64)
        group[order] = local_groups(len(ids), place[x], place[y])
        some = np.flatnonzero(n)
        return batch_of(
            schema, [pa.array(ids[some]), pa.array(n[some]), pa.array(ids[order][group[some]])]
        )

    def work(key, todo: pa.Table, held: pa.Table) -> pa.Table:
        rows = {r["interval"]: unpack(r["reps"], r["weights"], r["data"]) for r in held.to_pylist()}
        out = [
            joined(*rows[a], *rows[b], a == b)
            for a, b in sorted(zip(todo.column("a").to_pylist(), todo.column("b").to_pylist(), strict=True))
        ]
        return pa.Table.from_batches(out, schema)

    block_of = [F.floor(F.col(c) / block).cast("int").alias(f"block_{c}") for c in "ab"]
    dealt = pairs.select("a", "b", *block_of)
    keys = ["block_a", "block_b"]
    needed = dealt.select(*keys, F.explode(F.array("a", "b")).alias("interval")).distinct()
    # Other names on this side: both come from the same pairs.
    held = needed.join(intervals.select("interval", "reps", "weights", "data"), "interval").select(
        F.col("block_a").alias("held_a"), F.col("block_b").alias("held_b"), "interval", "reps", "weights", "data"
    )
    return dealt.groupBy(*keys).cogroup(held.groupBy("held_a", "held_b")).applyInArrow(
        work, "rep bigint, n bigint, part bigint"
    )


def _classes_with_links(classes: DataFrame, dim: int, cosine: float) -> DataFrame:
    """(dim, raw, n_links, component) of the distinct vectors of one length."""
    axes = principal_axes(classes, dim)
    reach = 2 - 2 * cosine + SLACK
    epsilon = float(np.sqrt(reach))
    intervals = stage(_intervals(_grid_order(classes, axes, dim, epsilon), axes, dim), "intervals")
    pairs = stage(_near_intervals(intervals, reach, epsilon), "pairs")
    # Blocks only where there are enough of them to keep a cluster busy.
    block = max(1, min(BLOCK, intervals.count() // 16))
    links = stage(_links(pairs, intervals, axes, dim, cosine, block), "links")
    groups = components(links.select(F.col("rep").alias("a"), F.col("part").alias("b")))
    counts = links.groupBy("rep").agg(F.sum("n").alias("n"))
    return (
        classes.join(counts, "rep", "left")
        .join(groups, F.col("rep") == F.col("node"), "left")
        .select(
            F.lit(dim).alias("dim"), "raw",
            (F.coalesce("n", F.lit(0)) + F.col("m") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )


def similar_vectors(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", cosine: float = 0.95
) -> DataFrame:
    """Per vector: ``n_links``, ``component_id`` and ``kept``."""
    rows = stage(_plain(vectors, id_column, vector), "vectors")
    classes = stage(
        rows.where("dim > 0").groupBy("dim", "raw").agg(
            F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")
        ),
        "classes",
    )
    # One join for each length of vectors that occurs.
    lengths = [r.dim for r in classes.select("dim").distinct().orderBy("dim").collect()]
    parts = [_classes_with_links(classes.where(F.col("dim") == d).drop("dim"), d, cosine) for d in lengths]
    if not parts:
        return rows.select(
            F.col("id").alias(id_column), F.lit(0).cast("bigint").alias("n_links"),
            F.col("id").alias("component_id"), F.lit(True).alias("kept"),
        )
    of_class = reduce(DataFrame.unionByName, parts)
    return rows.join(of_class, ["dim", "raw"], "left").select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0).cast("bigint")).alias("n_links"),
        F.coalesce("component", "id").alias("component_id"),
        (F.coalesce("component", "id") == F.col("id")).alias("kept"),
    )
