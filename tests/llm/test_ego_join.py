import numpy as np

from hearthstream.llm import ego_join
from hearthstream.llm.ego_join import Interval, join_intervals, similar_vectors


def brute(rows, cosine=0.95):
    ok = {}
    for i, v in rows:
        if v and all(x is not None and np.isfinite(x) for x in v) and any(v):
            w = np.array(v) / np.abs(v).max()
            ok[i] = w / np.sqrt(np.dot(w, w))
    ids = sorted(ok)
    near = {i: [j for j in ids if j != i and len(ok[i]) == len(ok[j]) and ok[i] @ ok[j] >= cosine] for i in ids}
    out = {}
    for i, _ in rows:
        seen, todo = {i}, [i]
        while todo:
            for j in near.get(todo.pop(), []):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        out[i] = (len(near.get(i, [])), min(seen))
    return out


def test_cases(spark):
    rng = np.random.default_rng(3)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [(len(rows) + k, (centre + rng.normal(size=8) * 0.22).tolist()) for k in range(25)]
    n = len(rows)
    rows += [(n, rows[0][1]), (n + 1, rows[0][1]), (n + 2, [2 * x for x in rows[0][1]])]
    rows += [(n + 3, None), (n + 4, []), (n + 5, [0.0] * 8), (n + 6, [1.0, None] + [0.0] * 6),
             (n + 7, [float("nan")] * 8), (n + 8, [float("inf")] * 8), (n + 9, [1.0, 2.0])]
    df = spark.createDataFrame(
        [(i, v, 1, "r") for i, v in rows + [(None, [1.0] * 8)]],
        "vec_id bigint, embedding array<double>, label int, rep string",
    )
    got = similar_vectors(df.repartition(3))
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    found = {r.vec_id: (r.n_links, r.component_id) for r in got.collect()}
    assert found == brute(rows)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.collect())


def test_rarer_lengths_and_extreme_sizes_are_linked(spark):
    rng = np.random.default_rng(9)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(40)]
    rows += [(50, [1.0, 2.0]), (51, [1.0, 2.0]), (52, [2.0, 4.1]), (53, [-1.0, 2.0])]
    rows += [(60, [3e300] * 8), (61, [1e-300] * 8), (62, [1.0] * 8), (63, [5e-324] + [0.0] * 7), (64, [1.0] + [0.0] * 7)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = {r.vec_id: (r.n_links, r.component_id) for r in similar_vectors(df.repartition(3)).collect()}
    assert found == brute(rows) and found[52] == (2, 50) and found[61] == (2, 60) and found[64] == (1, 63)


def test_blocks_of_intervals_give_the_same(spark, monkeypatch):
    rng = np.random.default_rng(10)
    rows = [(k, (rng.normal(size=6) * [3, 1, 1, 1, 1, 1]).tolist()) for k in range(900)]
    monkeypatch.setattr(ego_join, "INTERVAL", 16)
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(4)
    found = {r.vec_id: (r.n_links, r.component_id) for r in similar_vectors(df).collect()}
    assert found == brute(rows)


def test_nothing_usable(spark):
    schema = "vec_id bigint, embedding array<float>, label int"
    assert similar_vectors(spark.createDataFrame([], schema)).count() == 0
    row = similar_vectors(spark.createDataFrame([(5, None, 1)], schema)).first()
    assert tuple(row) == (5, 0, 5, True)


def test_intervals_find_every_pair():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 6))
    w = np.ones(700, np.int64)
    one = Interval(x, np.eye(6), w)
    hit = one.unit @ one.unit.T >= 0.9
    np.fill_diagonal(hit, False)
    a, b, _, _ = join_intervals(one, one, True, 0.9)
    assert (a + b == hit.sum(1)).all()
    left, right = Interval(x[:300], np.eye(6), w[:300]), Interval(x[300:], np.eye(6), w[300:])
    a, b, _, _ = join_intervals(left, right, False, 0.9)
    assert (a == hit[:300, 300:].sum(1)).all() and (b == hit[:300, 300:].sum(0)).all()
