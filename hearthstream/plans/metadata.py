"""Metadata and catalog messages into the dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.operators import dimensions as D
from hearthstream.operators.records import as_orphans
from hearthstream.session import cut_lineage
from hearthstream.sources.tables import Tables


def _dead(invalid: DataFrame, tables: Tables, now: Column) -> None:
    plain = invalid.withColumns(
        {"lsid": F.lit(0).cast("bigint"), "record_ts": F.lit(0).cast("bigint")}
    )
    rows = as_orphans(plain, F.col("reason"), now)
    if not rows.isEmpty():
        tables.append_orphans(rows)


def apply_metadata(messages: DataFrame, tables: Tables, now: Column | None = None) -> None:
    """Device messages are upserted, then station messages update their devices."""
    now = F.current_timestamp() if now is None else now
    # Staged by class: the messages are parsed once, and each step reads its own.
    split = D.staged_metadata(messages)
    # Staged: the upsert refers to its input several times.
    rows = cut_lineage(D.latest_devices(split.devices))
    if not rows.isEmpty():
        tables.update_dimension("devices", lambda old: D.upsert_devices(old, rows, now))
    updates = cut_lineage(D.station_updates(split.stations))
    if not updates.isEmpty():
        tables.update_dimension("devices", lambda old: D.update_station_info(old, updates, now))
    _dead(split.invalid, tables, now)


def apply_catalog(
    messages: DataFrame, tables: Tables, enrich: bool = True, now: Column | None = None
) -> None:
    """Upsert catalog entries, then fill in tags that lack a description."""
    now = F.current_timestamp() if now is None else now
    entries, invalid = D.flatten_catalog(messages)
    entries = cut_lineage(entries)
    if not entries.isEmpty():
        tables.update_dimension("sensor_catalog", lambda old: D.upsert_catalog(old, entries, now))
        if enrich:
            # The raw definitions of this batch enrich the metadata; stored
            # entries have none.
            enrich_stored_tags(tables, D.latest_catalog(entries), now)
    _dead(invalid, tables, now)


def enrich_stored_tags(
    tables: Tables, fresh: DataFrame | None = None, now: Column | None = None
) -> None:
    """Enrich the stored tags from the stored catalog, ``fresh`` entries first."""
    now = F.current_timestamp() if now is None else now
    stored = tables.dimension("sensor_catalog").select(
        *D.CATALOG_KEYS, "field_type", "units", "description",
        F.lit(None).cast("map<string,variant>").alias("raw_definition"),
    )
    catalog = stored
    if fresh is not None:
        rest = stored.join(fresh.select(*D.CATALOG_KEYS), D.CATALOG_KEYS, "left_anti")
        catalog = fresh.select(*stored.columns).unionByName(rest)
    tags, devices = tables.dimension("tags"), tables.dimension("devices")
    if not D.tags_needing_enrichment(tags, devices).isEmpty():
        tables.update_dimension("tags", lambda old: D.enrich_tags(old, devices, catalog, now))


def learn_structure_types(messages: DataFrame, tables: Tables) -> None:
    """Store the latest structure type of each device's messages."""
    tables.update_dimension("devices", lambda old: D.set_rt_type(old, messages))
