"""Training-data pipeline over ``documents``: quality, copies, repeats, packing.

Every stage takes ``(spark, docs, sf_dir)`` and all but the last return the columns
of ``documents``:

* ``quality``: documents that the weak-label classifier rejects go;
* ``near_duplicates``: five-word shingles, similarity 0.8; the document with the
  smallest id of each group stays;
* ``repeated_passages``: every string of 200 bytes that occurs more than once is cut
  out of the texts; no document goes, one without anything left has the empty text;
* ``packing``: sequences of 2048 tokens.

Documents without an id cannot be referred to by a decision and leave in the first
stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream.llm import minhash, packing, suffix_dedup, weak_label
from hearthstream.llm.common import prepare, stage
from hearthstream.llm.queries import vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    good = weak_label.judge_quality(docs).where("kept").select("doc_id").distinct()
    return docs.select(*COLUMNS).join(good, "doc_id", "left_semi")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    first = minhash.near_duplicates(docs, size=5, percent=80).where("kept")
    return docs.select(*COLUMNS).join(first.select("doc_id").distinct(), "doc_id", "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeated_spans(docs, texts=True, carry=["lang", "source"])
    return cut.select(
        "doc_id", F.col("kept").alias("text"), "lang", "source",
        F.length("kept").cast("bigint").alias("n_chars"),
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("packing", pack),
]

# Training, sketches and the genetic search have no SQL form; tests/llm holds the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again by the next."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
