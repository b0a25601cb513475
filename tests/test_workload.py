import importlib
import sys
from pathlib import Path

import pytest

from workload import all_queries
from workload.check import compare

SMALL = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SMALL).exists(), reason="no test data")


def test_every_query_has_a_twin():
    assert len(all_queries()) > 120
    assert [n for n, q in all_queries().items() if q.sql is None] == []


def test_entry_module():
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    entry = importlib.import_module("__spark_entry__")
    assert set(entry.oracle_sql()) <= set(entry.queries())


@needs_data
def test_flagship(spark):
    entry = importlib.import_module("__spark_entry__")
    assert entry.entry(spark).count() == 20


@needs_data
@pytest.mark.parametrize("name", [
    "first_wins", "records_view", "recent_records", "tag_record_counts", "integrity_audit", "enrich_tags",
    "shaped_snapshots", "ingest_counts", "camera_event_messages", "state_change_log", "coalesce_sessions",
    "frames_in_sessions", "best_detection", "metric_deltas", "metadata_messages",
])
def test_query_equals_its_twin(spark, name):
    q = all_queries()[name]
    assert compare(spark, SMALL, name, q.build, q.sql).startswith("ok")


def test_stages_can_be_dropped(spark):
    from hearthstream.session import cut_lineage, drop_stages

    drop_stages(spark)
    assert cut_lineage(spark.range(3)).count() == 3
    assert drop_stages(spark) == 1
    # The cached tag tables of the workload were stages as well.
    from workload import feeds

    feeds._built.clear()


@needs_data
def test_percentages_of_all_rows(spark):
    from workload import feeds

    q = all_queries()["confidence_percent"]
    assert compare(spark, SMALL, "confidence_percent", q.build, q.sql).startswith("ok")
    assert q.build(spark, SMALL).count() == feeds.observations(spark, SMALL).count()
