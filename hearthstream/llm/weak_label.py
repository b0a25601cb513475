"""Document quality from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every text.
Expectation-maximisation finds, without any given label, how often each labeller
is right on good and on bad texts and how many texts are good; it needs only the
number of texts per pattern of votes.  The posterior of each pattern then labels a
bounded sample, on which a linear scorer over hashed word shapes is trained, and
the scorer judges every text.

Bad votes need ``SHORT`` words, those on marks and repeats five, those on how often words
occur forty.

Defined results: null, empty and shorter texts get no bad vote and are kept
unless their shapes speak against them; rows without an id are left out; repeated
rows are judged alike; the empty table gives the empty table.
"""

from __future__ import annotations

import re
from collections import Counter
from functools import lru_cache
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hearthstream.llm.common import batch_of, map_batches, stage, texts_of, with_id

DIMENSIONS = 1 << 16
SAMPLE = 20_000  # most texts the scorer is trained on
GOOD, BAD, SILENT = 1, -1, 0
# Texts of fewer words say too little for a bad vote: a number or a name weighs too much in
# them.  Marks behind words speak earlier.
SHORT = 16
SHORTEST = {"marks": 5, "repeats": 5}

_CLASS = bytes(
    ord("X") if 65 <= b <= 90 else ord("9") if 48 <= b <= 57
    else ord("x") if 97 <= b <= 122 or b >= 128 else b
    for b in range(256)
)
_RUN = re.compile(rb"(.)\1+", re.S)


@lru_cache(maxsize=1 << 16)
def _shape(word: bytes) -> tuple[bytes, int, int, bool]:
    """A word's shape: runs shortened; its letters, capitals; whether it ends in marks."""
    letters = sum(word.count(c) for c in (b"x", b"X"))
    bare = word.rstrip(b".,;:!?\"')]}-")
    marks = bool(bare) and bare[-1:] not in b"xX9" or word.endswith((b"!!", b"??", b".." b"."))
    return _RUN.sub(rb"\1\1", word)[:24], letters, word.count(b"X"), bool(marks)


class Profile:
    """Figures of one text that the labellers look at, and its hashed features."""

    def __init__(self, text: str):
        raw = text.encode()
        words = raw.split()
        n = self.n = len(words)
        shapes = Counter(raw.translate(_CLASS).split())
        self.shapes: Counter = Counter()
        letters = capitals = marks = bare = inked = 0
        for word, k in shapes.items():
            shape, a, c, m = _shape(word)
            self.shapes[shape] += k
            letters += a * k
            capitals += c * k
            marks += m * k
            bare += (a == 0) * k
            inked += len(word) * k
        n = max(1, n)
        self.capitals = capitals / max(1, letters)
        self.marks = marks / n
        self.bare = bare / n  # words without letters
        self.unlettered = 1 - letters / max(1, inked)
        self.repeats = sum(map(eq, words, words[1:])) / n
        times = Counter(words)
        self.distinct = len(times) / n
        self.commonest = max(times.values(), default=0) / n
        lines = [x for x in raw.split(b"\n") if x.strip()]
        self.lines = 1 - len(set(lines)) / max(1, len(lines))

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features and their values."""
        n = max(1, self.n)
        values = {b"shape " + s: (k / n) ** 0.5 for s, k in self.shapes.items()}
        for name in ("capitals", "marks", "bare", "unlettered", "repeats", "commonest", "lines"):
            # Thermometer steps let a linear scorer find its own thresholds.
            x = getattr(self, name)
            for step in (0.05, 0.1, 0.2, 0.4, 0.6, 0.8):
                if x >= step:
                    values[f"{name} {step}".encode()] = 1.0
        for step in (0.05, 0.1, 0.2, 0.3, 0.5):
            if self.distinct < step:
                values[f"distinct {step}".encode()] = 1.0
        values[b"bias"] = 1.0
        where = np.fromiter(
            (xxhash.xxh3_64_intdigest(f) % DIMENSIONS for f in values), np.uint32, len(values)
        )
        return where, np.fromiter(values.values(), np.float32, len(values))


def _between(x: float, good: float, bad: float) -> int:
    """Good up to one bound, bad from the other, silent between."""
    return GOOD if x <= good else BAD if x >= bad else SILENT


# Each looks at one figure; together they overlap.
LABELLERS = {
    "capitals": lambda p: _between(p.capitals, 0.12, 0.35),
    "marks": lambda p: _between(p.marks, 0.04, 0.25),
    "bare": lambda p: _between(p.bare, 0.05, 0.25),
    "unlettered": lambda p: _between(p.unlettered, 0.12, 0.3),
    "repeats": lambda p: _between(p.repeats, 0.03, 0.15),
    "commonest": lambda p: SILENT if p.n < 40 else _between(p.commonest, 0.12, 0.3),
    "distinct": lambda p: SILENT if p.n < 40 or p.n > 4000 else _between(1 - p.distinct, 0.6, 0.85),
    "lines": lambda p: _between(p.lines, 0.1, 0.5),
}


def votes(p: Profile) -> list[int]:
    return [
        SILENT if v == BAD and p.n < SHORTEST.get(name, SHORT) else v
        for name, v in ((name, f(p)) for name, f in LABELLERS.items())
    ]


def fit_label_model(
    patterns: np.ndarray, counts: np.ndarray, rounds: int = 200
) -> tuple[np.ndarray, np.ndarray]:
    """Posterior of "good" for every pattern of votes, and the labellers' accuracies.

    ``patterns`` has one row per distinct pattern with votes -1, 0 and 1.
    accuracy[y, labeller] is the chance that a vote cast on a bad (0) or good (1)
    text is right; silence says nothing.  The start is a weighted majority in
    which bad votes, which are rarer, weigh more.
    """
    counts = np.asarray(counts, np.float64)
    says = [np.asarray(patterns) == vote for vote in (BAD, GOOD)]
    good = 1 / (1 + np.exp(-(says[1].sum(1) * 0.5 - says[0].sum(1) * 3.0)))
    accuracy = np.zeros((2, says[0].shape[1]))
    for _ in range(rounds):
        weight = np.stack([1 - good, good]) * counts
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        for y in range(2):
            right, wrong = weight[y] @ says[y] + 1, weight[y] @ says[1 - y] + 1
            accuracy[y] = right / (right + wrong)
        odds = (
            np.log(prior[1] / prior[0])
            + says[1] @ np.log(accuracy[1] / (1 - accuracy[0]))
            + says[0] @ np.log((1 - accuracy[1]) / accuracy[0])
        )
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        if np.abs(new - good).max() < 1e-9:
            break
        good = new
    return good, accuracy


def fit_scorer(
    where: list[np.ndarray], values: list[np.ndarray], target: np.ndarray, rounds: int = 400,
    rate: float = 2.0, decay: float = 1e-5,
) -> np.ndarray:
    """Weights of a logistic scorer on soft labels; the two classes weigh the same."""
    weights = np.zeros(DIMENSIONS)
    if not len(target):
        return weights
    row = np.repeat(np.arange(len(where)), [len(x) for x in where])
    column, value = np.concatenate(where).astype(np.int64), np.concatenate(values).astype(np.float64)
    share = np.clip(target.mean(), 1e-3, 1 - 1e-3)
    importance = target / (2 * share) + (1 - target) / (2 * (1 - share))
    squares = np.full(DIMENSIONS, 1e-8)
    for _ in range(rounds):
        score = np.bincount(row, value * weights[column], minlength=len(where))
        error = (1 / (1 + np.exp(-np.clip(score, -50, 50))) - target) * importance / len(where)
        slope = np.bincount(column, value * error[row], minlength=DIMENSIONS) + decay * weights
        squares += slope * slope
        weights -= rate * 0.1 * slope / np.sqrt(squares)
    return weights


def profiles(documents: DataFrame, id_column: str, text: str) -> DataFrame:
    """Votes and hashed features of every text."""
    schema = pa.schema(
        [("id", pa.int64()), ("votes", pa.string()), ("features", pa.binary()), ("values", pa.binary())]
    )

    def work(batches):
        for batch in batches:
            out: list[list] = [[], [], []]
            for t in texts_of(batch.column(1)):
                p = Profile(t)
                where, values = p.features()
                out[0].append(",".join(map(str, votes(p))))
                out[1].append(where.astype("<u4").tobytes())
                out[2].append(values.astype("<f4").tobytes())
            yield batch_of(schema, [batch.column(0).cast(pa.int64()), *out])

    return map_batches(
        with_id(documents, id_column, text), work,
        "id bigint, votes string, features binary, values binary",
    )


def judge_quality(
    documents: DataFrame, id_column: str = "doc_id", text: str = "text", sample: int = SAMPLE,
    threshold: float = 0.5,
) -> DataFrame:
    """Per document: ``votes``, the label model's ``posterior``, ``score`` and ``kept``.

    Vote patterns are counted over all documents; their number is bounded by 3 to
    the number of labellers.  Only the scorer is trained on a sample: at most about
    ``sample`` documents, chosen by a hash of the id.
    """
    spark = documents.sparkSession
    rows = stage(profiles(documents, id_column, text), "profiles")
    seen = rows.groupBy("votes").count().orderBy("votes").collect()
    total = sum(r["count"] for r in seen)
    good: dict[str, float] = {}
    if seen:
        posterior, _ = fit_label_model(
            np.array([[int(v) for v in r.votes.split(",")] for r in seen]),
            np.array([r["count"] for r in seen]),
        )
        good = dict(zip((r.votes for r in seen), posterior.tolist(), strict=True))
    slots = 1 << 30
    drawn = rows.where(
        F.pmod(F.xxhash64("id"), F.lit(slots)) < int(slots * min(1.0, sample / max(1, total)))
    ).orderBy("id").collect()
    weights = fit_scorer(
        [np.frombuffer(r.features, "<u4") for r in drawn],
        [np.frombuffer(r["values"], "<f4") for r in drawn],
        np.array([good[r.votes] for r in drawn]),
    )
    model = spark.sparkContext.broadcast((weights.astype(np.float32), good))
    schema = pa.schema(
        [(id_column, pa.int64()), ("votes", pa.string()), ("posterior", pa.float64()),
         ("score", pa.float64()), ("kept", pa.bool_())]
    )

    def work(batches):
        w, table = model.value
        for batch in batches:
            scores = []
            for where, values in zip(
                batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True
            ):
                s = float(w[np.frombuffer(where, "<u4")] @ np.frombuffer(values, "<f4"))
                scores.append(1 / (1 + np.exp(-np.clip(s, -50, 50))))
            patterns = batch.column(1).to_pylist()
            yield batch_of(
                schema,
                [batch.column(0), patterns, [table[v] for v in patterns], scores,
                 [bool(s >= threshold) for s in scores]],
            )

    return map_batches(
        rows, work,
        f"`{id_column}` bigint, votes string, posterior double, score double, kept boolean",
    )
