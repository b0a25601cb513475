"""Small builders for literal rows."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from hearthstream import schemas

MESSAGE_SCHEMA = schemas.MESSAGE_DDL


def at(second: int) -> datetime:
    return datetime.fromtimestamp(second, tz=timezone.utc).replace(tzinfo=None)


def message(offset, body, headers=None, topic="weather.iss", partition=0, key=None, second=None):
    """One envelope row; body may be a dict, text or bytes."""
    if isinstance(body, dict):
        body = json.dumps(body)
    if isinstance(body, str):
        body = body.encode()
    if isinstance(headers, dict):
        headers = list(headers.items())
    encoded = [(k, str(v).encode()) for k, v in headers or []]
    return (topic, partition, offset, key, encoded, body, at(offset if second is None else second))


def record(offset, body, lsid=1, ts=1000, sensor_type=1, structure=1, **kw):
    headers = {
        "lsid": lsid,
        "timestamp": ts,
        "sensor_type": sensor_type,
        "data_structure_type": structure,
    }
    return message(offset, body, headers, **kw)


def messages(spark, *rows):
    return spark.createDataFrame(list(rows), MESSAGE_SCHEMA)


def devices(spark, *lsids, **columns):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(i,) for i in lsids], "lsid bigint").withColumn("id", F.col("lsid"))
    for name, value in columns.items():
        rows = rows.withColumn(name, F.lit(value))
    base = schemas.empty(spark, schemas.DEVICES_DDL)
    full = base.unionByName(rows, allowMissingColumns=True)
    return full.select(*[F.col(c).cast(base.schema[c].dataType).alias(c) for c in base.columns])


def catalog(spark, *rows):
    """Rows (sensor_type, structure, field, type, units, description)."""
    columns = "sensor_type int, data_structure_type string, field_name string, field_type string, units string, description string"
    return schemas.empty(spark, schemas.CATALOG_DDL).unionByName(
        spark.createDataFrame(list(rows), columns), allowMissingColumns=True
    )


def rows(df, *columns):
    """Sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
