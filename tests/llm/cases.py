"""Small tables with the awkward rows every operator must take."""

import random

from pyspark.sql import Row

DOCUMENTS = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, "
    # Names that operators use inside.
    "id bigint, rep bigint, key string, component_id bigint, kept boolean, bucket int, start int"
)
_EXTRA = (None, 7, "k", 1, None, 3, 9)


def words(rng: random.Random, n: int, size: int = 400) -> list[str]:
    return [f"w{rng.randrange(size)}" for _ in range(n)]


def texts() -> dict[int | None, str | None]:
    rng = random.Random(5)
    base = words(rng, 120)
    passage = words(rng, 70, 4000)
    near = list(base)
    near[60] = "changed"
    far = [w if k % 3 else "x" + w for k, w in enumerate(base)]
    return {
        1: " ".join(base),
        2: " ".join(base),
        3: " ".join(near),
        4: " ".join(far),
        5: None,
        6: "",
        7: " \n\t ",
        8: "one",
        9: "Two words",
        10: "two WORDS",
        11: "intro here " + " ".join(passage) + " tail",
        12: " ".join(words(rng, 40, 4000)) + "  " + " ".join(passage) + "\nend é",
        13: "again " * 300,
        14: "ab" * 500,
        15: "Zoë <|endoftext|> 東京 😀 naïve don't we'll x  \n  y\x0bz\x1c.",
        16: " ".join(words(rng, 9000, 10**9)),
    }


def documents(spark, rows=None, repeat=True):
    """All cases, a row without id, and (with ``repeat``) one row twice."""
    found = list(texts().items()) if rows is None else list(rows)
    if rows is None:
        found += [(None, "no id here")] + ([(8, "one")] if repeat else [])
    return spark.createDataFrame(
        [(i, t, None, None, None, *_EXTRA) for i, t in found], DOCUMENTS
    ).repartition(3)


def by_id(df, key="doc_id") -> dict:
    return {r[key]: r for r in df.collect()}


def rows_of(df) -> list[Row]:
    return df.collect()
