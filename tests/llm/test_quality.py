import numpy as np
from pyspark.sql import functions as F

from hearthstream.llm import weak_label
from tests.llm import cases

SF = "/root/testdata/sf0.01"


def test_labels_of_held_out_documents(spark):
    """No label is used in training, so all of them are held out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    got = weak_label.judge_quality(docs).join(labels, "doc_id").select("kept", "quality").collect()
    right = np.mean([r.kept == (r.quality == 1) for r in got])
    lost = np.mean([not r.kept for r in got if r.quality == 1])
    assert right > 0.97 and lost < 0.02, (right, lost)


def test_cases(spark):
    rows = weak_label.judge_quality(cases.documents(spark)).collect()
    assert sorted(r.doc_id for r in rows) == sorted([*cases.texts(), 8])
    assert all(0 <= r.posterior <= 1 and 0 <= r.score <= 1 for r in rows)
    assert weak_label.judge_quality(cases.documents(spark, [])).count() == 0


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(5)
    truth = rng.random(20_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.8])
    votes = np.where(rng.random((20_000, 4)) < right, truth[:, None], ~truth[:, None]) * 2 - 1
    votes[rng.random(votes.shape) < 0.2] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good, accuracy = weak_label.fit_label_model(patterns, counts)
    assert np.abs(accuracy - right).max() < 0.05
    assert ((good[inverse] >= 0.5) == truth).mean() > 0.94


def test_short_junk_is_found_and_short_prose_kept(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    short = docs.withColumn("n", F.size(F.split(F.trim("text"), r"\s+"))).where("n between 5 and 15").select("doc_id")
    got = weak_label.judge_quality(docs).join(short, "doc_id").join(labels, "doc_id").collect()
    bad, good = [[not r.kept for r in got if r.quality == q] for q in (0, 1)]
    # Of the nine, one is plain prose and one prose with numbers such as good texts have.
    assert len(bad) >= 9 and sum(bad) >= len(bad) - 2 and np.mean(good) < 0.02, (bad, np.mean(good))
