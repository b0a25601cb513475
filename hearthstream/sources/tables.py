"""The table folder: dimension snapshots, the orphan log and the fact table."""

from __future__ import annotations

import threading
import time
import uuid
from collections import defaultdict
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators.days import day_filter
from hearthstream.operators.orphans import latest_versions

DIMENSIONS = {
    "devices": schemas.DEVICES_DDL,
    "tags": schemas.TAGS_DDL,
    "sensor_catalog": schemas.CATALOG_DDL,
}

CLAIM_LAPSES_MS = 60_000
READERS_DONE_MS = 6 * 3600 * 1000

_turns: defaultdict[str, threading.RLock] = defaultdict(threading.RLock)


def _turn(path: str) -> threading.RLock:
    return _turns[path]


class Tables:
    """Parquet tables below one root folder.

    A dimension is a series of snapshot folders ``version=N``; the newest
    complete one counts, so a table can be rewritten while it is being read and
    a half-written snapshot is never seen.  Facts have one writer at a time:
    two streams that append the same records at once would both insert them.  Orphans are an append-only log.  Facts
    are one table partitioned by kind and day.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- folders ----------------------------------------------------------

    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.root, *parts]))

    def _fs(self):
        return self._path("x").getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _children(self, *parts: str) -> list[str]:
        fs, path = self._fs(), self._path(*parts)
        return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []

    def _exists(self, *parts: str) -> bool:
        return self._fs().exists(self._path(*parts))

    def _delete(self, *parts: str) -> None:
        self._fs().delete(self._path(*parts), True)

    # -- dimensions -------------------------------------------------------

    def _versions(self, name: str) -> list[int]:
        found = [c for c in self._children(name) if c.startswith("version=")]
        done = [c for c in found if self._exists(name, c, "_SUCCESS")]
        return sorted(int(c.split("=")[1]) for c in done)

    def dimension(self, name: str) -> DataFrame:
        """The newest snapshot, or an empty table."""
        versions = self._versions(name)
        if not versions:
            return schemas.empty(self.spark, DIMENSIONS[name])
        return self._snapshot(name, versions[-1])

    def update_dimension(
        self, name: str, change: Callable[[DataFrame], DataFrame], keep: int = 3
    ) -> DataFrame:
        """Replace a dimension by ``change`` of its newest snapshot; returns the new one.

        The one way to change a dimension.  Writers of this process take turns.
        Between processes the version number is claimed by creating a file, which
        only one can do; the other starts over from the winner's snapshot.  So no
        update is lost, and ids taken from the snapshot are never given twice.
        """
        columns = schemas.empty(self.spark, DIMENSIONS[name]).columns
        with _turn(f"{self.root}/{name}"):
            while True:
                versions = self._versions(name)
                base = versions[-1] if versions else 0
                current = (
                    self._snapshot(name, base) if versions
                    else schemas.empty(self.spark, DIMENSIONS[name])
                )
                draft = f"draft-{uuid.uuid4().hex}"
                change(current).select(*columns).write.parquet(f"{self.root}/{name}/{draft}")
                # A rename onto a folder would move the draft inside it: then another writer,
                # whose claim had lapsed, was late but first.
                if self._claim(name, base + 1) and not self._exists(name, f"version={base + 1}"):
                    target = self._path(name, f"version={base + 1}")
                    if not self._fs().rename(self._path(name, draft), target):
                        raise OSError(f"cannot publish {target}")
                    break
                self._delete(name, draft)
            self._drop_old(name, versions, keep)
            return self._snapshot(name, base + 1)

    def _snapshot(self, name: str, version: int) -> DataFrame:
        return self.spark.read.schema(DIMENSIONS[name]).parquet(
            f"{self.root}/{name}/version={version}"
        )

    def _claim(self, name: str, version: int) -> bool:
        """Take a version number; a claim that was never used lapses after a while."""
        claim = self._path(name, f"_claim-{version}")
        fs = self._fs()
        if fs.createNewFile(claim):
            return True
        age = time.time() * 1000 - fs.getFileStatus(claim).getModificationTime()
        if age > CLAIM_LAPSES_MS and not self._exists(name, f"version={version}"):
            fs.delete(claim, False)
        return False

    def _drop_old(self, name: str, versions: list[int], keep: int) -> None:
        """Delete snapshots beyond ``keep`` that no running job should still read."""
        for old in versions[: max(0, len(versions) + 1 - keep)]:
            newer = self._path(name, f"version={old + 1}")
            replaced = self._fs().getFileStatus(newer).getModificationTime() if self._fs().exists(newer) else 0
            if time.time() * 1000 - replaced > READERS_DONE_MS:
                self._delete(name, f"version={old}")
                self._delete(name, f"_claim-{old}")

    def replace_dimension(self, name: str, df: DataFrame, keep: int = 3) -> DataFrame:
        """Write a new snapshot whatever the old one holds, and return it as read back."""
        return self.update_dimension(name, lambda _: df, keep)

    # -- orphans ----------------------------------------------------------

    def append_orphans(self, rows: DataFrame) -> None:
        """Append dead letters; a later version of a position replaces an earlier one."""
        columns = schemas.empty(self.spark, schemas.ORPHANS_DDL).columns
        rows.select(*columns).write.mode("append").parquet(f"{self.root}/orphaned_messages")

    def orphans(self, columns: list[str] | None = None) -> DataFrame:
        """Current orphans: all columns, or the position and ``columns`` only."""
        if not self._exists("orphaned_messages"):
            log = schemas.empty(self.spark, schemas.ORPHANS_DDL)
        else:
            log = self.spark.read.schema(schemas.ORPHANS_DDL).parquet(
                f"{self.root}/orphaned_messages"
            )
        return latest_versions(log, columns)

    # -- facts ------------------------------------------------------------

    @property
    def records_path(self) -> str:
        return f"{self.root}/records"

    def records(self) -> DataFrame:
        """The fact table with its partition columns ``kind`` and ``dt``."""
        if not self._exists("records"):
            return schemas.empty(self.spark, schemas.RECORDS_DDL)
        return self.spark.read.schema(schemas.RECORDS_DDL).parquet(self.records_path)

    def records_of_days(self, bitmap: bytes | None, outside: bool) -> DataFrame:
        """Stored records of the days a batch touches (see :mod:`operators.days`)."""
        return self.records().where(day_filter(F.col("dt"), bitmap, outside))

    def record_counts(self, records: DataFrame) -> dict[str, int]:
        """Rows per kind.  Only partition columns and file footers are read."""
        return {r.kind: r.n for r in records.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}

    def append_records(self, records: DataFrame) -> None:
        """Append in one job, files by kind and day.

        REBALANCE splits a day that is too big for one task and merges days that
        are too small for one file each.  Sorting inside files lets readers skip
        row groups by tag and time.
        """
        (
            records.hint("rebalance", "kind", "dt")
            .sortWithinPartitions("kind", "dt", "tag_id", "ts")
            .write.mode("append")
            .partitionBy("kind", "dt")
            .parquet(self.records_path)
        )

    def record_days(self) -> list[str]:
        """Days with records, newest first, from folder names only."""
        days = {
            d.split("=", 1)[1]
            for kind in self._children("records")
            if kind.startswith("kind=")
            for d in self._children("records", kind)
            if d.startswith("dt=")
        }
        return sorted((d for d in days if not d.startswith("__")), reverse=True)

    def expire_days(self, table: str, cutoff: str) -> list[str]:
        """Delete whole day partitions ``dt < cutoff``; returns what was deleted."""
        doomed = []
        for first in self._children(table):
            if first.startswith("dt="):
                candidates = [(first,)]
            else:
                candidates = [(first, d) for d in self._children(table, first)]
            for parts in candidates:
                day = parts[-1]
                if day.startswith("dt=") and day[3:] < cutoff and not day[3:].startswith("__"):
                    self._delete(table, *parts)
                    doomed.append("/".join(parts))
        return sorted(doomed)

    def expire_slots(self, table: str, below: int) -> list[str]:
        """Delete whole partitions ``slot < below``; returns what was deleted."""
        doomed = [
            c for c in self._children(table)
            if c.startswith("slot=") and not c[5:].startswith("__") and int(c[5:]) < below
        ]
        for name in doomed:
            self._delete(table, name)
        return sorted(doomed)

    def replace_records(self, rows: DataFrame, partitions: list[tuple[str, str | None]]) -> None:
        """Put ``rows``, staged before, in place of all that the named (kind, day) partitions hold."""
        rows.hint("rebalance", "kind", "dt").sortWithinPartitions("kind", "dt", "tag_id", "ts").write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("kind", "dt").parquet(self.records_path)
        filled = {(r.kind, r.dt) for r in rows.select("kind", "dt").distinct().collect()}
        for kind, day in partitions:
            if (kind, day) not in filled:
                self._delete("records", f"kind={kind}", f"dt={day or '__HIVE_DEFAULT_PARTITION__'}")

    def truncate(self) -> None:
        """Empty facts and dimensions; orphans stay."""
        self._delete("records")
        for name in ("tags", "devices", "sensor_catalog"):
            self.replace_dimension(name, schemas.empty(self.spark, DIMENSIONS[name]))

    def counts(self) -> DataFrame:
        """(table_name, count) of all emptied tables, for verification."""
        from hearthstream.operators.audit import counted
        from hearthstream.operators.records import records_null, records_numeric, records_text

        records = self.records()
        return counted(
            devices=self.dimension("devices"),
            tags=self.dimension("tags"),
            sensor_catalog=self.dimension("sensor_catalog"),
            records_numeric=records_numeric(records),
            records_text=records_text(records),
            records_null=records_null(records),
        )


