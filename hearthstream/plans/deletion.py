"""Deleting a device from the stored tables."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import functions as F

from hearthstream.session import cut_lineage
from hearthstream.sources.tables import Tables


def delete_device(tables: Tables, lsid: int) -> int:
    """Delete a device, its tags and their records; returns how many partitions were rewritten.

    The facts are scanned once for the partitions that hold a doomed tag; only these are
    written again, from a staged copy of what stays.  Records go first, the device last, so a
    run that fails half-way is repeated to the end.
    """
    devices, tags = tables.dimension("devices"), tables.dimension("tags")
    device = devices.where(F.col("lsid") == lsid).select(F.col("id").alias("device_id"))
    doomed = cut_lineage(
        tags.join(device, "device_id", "left_semi").select(F.col("id").alias("tag_id"))
    )
    records = tables.records()
    touched = [
        (r.kind, r.dt)
        for r in records.join(doomed, "tag_id", "left_semi").select("kind", "dt").distinct().collect()
    ]  # at most one row per kind and day
    if touched:
        inside = reduce(or_, [
            (F.col("kind") == kind)
            & (F.col("dt").isin([d for k, d in touched if k == kind and d is not None])
               | (F.col("dt").isNull() if (kind, None) in touched else F.lit(False)))
            for kind in {k for k, _ in touched}
        ])
        tables.replace_records(
            cut_lineage(records.where(inside).join(doomed, "tag_id", "left_anti").select(*records.columns)), touched
        )
    tables.update_dimension("tags", lambda old: old.join(device, "device_id", "left_anti"))
    tables.update_dimension("devices", lambda old: old.where(~F.col("lsid").eqNullSafe(F.lit(lsid))))
    return len(touched)
