"""Snapshots to published messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearthstream.operators import ingest as I


def shape_snapshots(
    snapshots: DataFrame, sensors: DataFrame, published: DataFrame
) -> DataFrame:
    """Explode, look up, key, deduplicate inside the batch and against the published keys."""
    points = I.keyed_points(I.explode_points(snapshots))
    fresh = I.unpublished(I.dedup_keys(I.with_sensor(points, sensors)), published)
    return I.record_messages(fresh)


def shape_metadata(
    sensors: DataFrame,
    catalog: DataFrame,
    stations: DataFrame,
    station_id: str,
    published: DataFrame,
    now: Column,
) -> DataFrame:
    """All three metadata messages, one per key and week across restarts."""
    messages = (
        I.sensor_metadata_messages(sensors, now)
        .unionByName(I.catalog_messages(catalog, sensors, F.col("generated_at")))
        .unionByName(I.station_messages(stations, station_id, now))
    )
    return I.dedup_metadata(messages, published)
