"""Headline timings; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from hearthstream.operators import sessions as S  # noqa: E402
from hearthstream.plans import reports  # noqa: E402
from hearthstream.plans.materialize import batch_tables, materialize  # noqa: E402
from hearthstream import schemas  # noqa: E402
from hearthstream.session import configure, scratch_dir  # noqa: E402
from hearthstream.sources import files  # noqa: E402
from hearthstream.sources.tables import Tables  # noqa: E402
from hearthstream.streaming.tables import materialize_stream  # noqa: E402
from workload import all_queries, feeds  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARM = "/root/testdata/sf0.001"

# Queries of the workload timed as they are.
LISTED = [
    "first_wins", "records_view", "recent_records", "tag_record_counts", "table_stats",
    "integrity_audit", "orphan_summary", "shaped_snapshots", "camera_event_messages",
    "state_change_log", "coalesce_sessions", "frames_in_sessions", "best_detection",
    "upsert_devices", "enrich_tags", "numeric_text",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


class Bench:
    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf
        self.seconds: dict[str, float] = {}
        self.rates: dict[str, float] = {}

    def timed(self, name: str, work, rows: int | None = None):
        began = time.perf_counter()
        result = work()
        spent = time.perf_counter() - began
        self.seconds[name] = round(spent, 3)
        if rows:
            self.rates[name] = round(rows / spent)
        return result

    def envelope(self, name: str, df) -> str:
        """Messages written once, so that timings start from stored envelopes."""
        path = scratch_dir(self.spark, name)
        df.repartition(16).write.parquet(path)
        return path

    def tables(self, devices) -> Tables:
        tables = Tables(self.spark, scratch_dir(self.spark, "tables"))
        tables.replace_dimension("devices", devices)
        return tables

    def run(self) -> None:
        spark, sf = self.spark, self.sf
        lineitem = self.envelope("lineitem", feeds.bench_messages(spark, sf))
        events = self.envelope("events", feeds.messages(spark, sf))
        suppliers = self.tables(feeds.bench_devices(spark, sf)).dimension("devices")
        users = feeds.devices(spark, sf)
        items = files.read_envelope_files(spark, lineitem)
        values = items.count() * 6
        none = schemas.empty(spark, schemas.TAGS_DDL), schemas.empty(spark, schemas.CATALOG_DDL)

        self.timed(
            "lineitem_to_records",
            lambda: consume(batch_tables(items, suppliers, *none)["records"]),
            values,
        )
        tables = self.tables(users)
        messages = files.read_envelope_files(spark, events)
        count = messages.count() * 5
        done = self.timed("materialize_events", lambda: materialize(messages, tables), count)
        # Fields count every value read; this one counts what was inserted.
        inserted = sum(done[k] for k in ("numeric", "text", "null"))
        self.rates["materialize_events_inserted"] = round(inserted / self.seconds["materialize_events"])
        self.timed("materialize_events_again", lambda: materialize(messages, tables), count)
        self.timed("recent_stored", lambda: reports.recent_stored(tables).collect())
        dims = tables.dimension("tags"), tables.dimension("devices")
        self.timed(
            "recent_records_stored",
            lambda: reports.recent_records(tables.records(), *dims).collect(),
        )
        self.timed(
            "tag_record_counts_stored",
            lambda: consume(reports.tag_record_counts(dims[1], dims[0], tables.records())),
        )
        live = self.tables(users)
        stream = files.read_envelope_files(spark, events, stream=True)
        self.timed(
            "materialize_stream",
            lambda: materialize_stream(stream, live, scratch_dir(spark, "offsets"))
            .trigger(availableNow=True).start().awaitTermination(),
            count,
        )
        self.timed(
            "sessions_and_frames",
            lambda: consume(
                S.frames_in_sessions(
                    feeds.frames(spark, sf), S.coalesce_sessions(feeds.session_events(spark, sf))
                )
            ),
        )
        for name in LISTED:
            self.timed(name, lambda: consume(all_queries()[name].build(spark, sf)))


def main() -> None:
    spark = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if Path(WARM).exists():
        Bench(spark, WARM).run()
    bench = Bench(spark, SF)
    bench.run()
    scale = re.search(r"sf([0-9.]+)", SF)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(bench.seconds.values()), 3),
                "unit": "sec",
                "queries": bench.seconds,
                "sf": float(scale.group(1)) if scale else None,
                "rows_per_second": bench.rates,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
