"""Schemas of the tables and payloads, as Spark DDL text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def empty(spark: SparkSession, ddl: str) -> DataFrame:
    """An empty table that the optimizer knows to be empty."""
    columns = T.StructType.fromDDL(ddl)
    return (
        spark.range(0)
        .select(*[F.lit(None).cast(c.dataType).alias(c.name) for c in columns])
        .where(F.lit(False))
    )



# The column layout of Spark's own Kafka source with includeHeaders=true.
MESSAGE_DDL = (
    "topic string, partition int, offset bigint, key string, "
    "headers array<struct<key:string,value:binary>>, value binary, timestamp timestamp"
)

DEVICES_DDL = (
    "id bigint, lsid bigint, sensor_type int, category string, manufacturer string, "
    "product_name string, station_id int, station_id_uuid string, station_name string, "
    "latitude decimal(10,6), longitude decimal(10,6), elevation decimal(10,3), "
    "metadata string, created_at timestamp, updated_at timestamp, product_number string, "
    "rain_collector_type int, active boolean, tx_id int, port_number int, "
    "parent_device_type string, parent_device_name string, parent_device_id bigint, "
    "parent_device_id_hex string, rt_data_structure_type int, created_date bigint, "
    "modified_date bigint"
)

TAGS_DDL = (
    "id bigint, device_id bigint, tag_name string, data_type string, unit string, "
    "description string, metadata string, created_at timestamp, updated_at timestamp"
)

CATALOG_DDL = (
    "id bigint, sensor_type int, data_structure_type string, field_name string, "
    "field_type string, units string, description string, "
    "created_at timestamp, updated_at timestamp"
)

# One physical fact table for all three kinds of record.  ``kind`` and ``dt``
# are its partition columns, so each typed view reads only its own folders.
RECORDS_DDL = (
    "tag_id bigint, ts bigint, num_value double, text_value string, kind string, dt date"
)

ORPHANS_DDL = (
    "topic string, partition int, offset bigint, lsid bigint, record_ts bigint, "
    "tag_name string, reason string, message_headers map<string,string>, "
    "message_body string, created_at timestamp, reprocessed boolean"
)

FRAMES_DDL = "camera string, ts bigint, path string"

SESSIONS_DDL = (
    "camera string, detection_type string, start_ms bigint, end_ms bigint, "
    "event_count bigint, copy_after bigint, archive_base string"
)

# ---- API payloads -------------------------------------------------------

SNAPSHOT_DDL = (
    "station_id int, station_id_uuid string, generated_at bigint, "
    "sensors array<struct<lsid:bigint,sensor_type:int,data_structure_type:int,data:array<variant>>>"
)

SENSOR_DDL = (
    "lsid bigint, sensor_type int, category string, manufacturer string, product_name string, "
    "product_number string, rain_collector_type int, active boolean, created_date bigint, "
    "modified_date bigint, station_id int, station_id_uuid string, station_name string, "
    "parent_device_type string, parent_device_name string, parent_device_id bigint, "
    "parent_device_id_hex string, port_number int, latitude double, longitude double, "
    "elevation double, tx_id int"
)

SENSORS_DDL = f"sensors array<struct<{SENSOR_DDL}>>, generated_at bigint"

CATALOG_ENTRY_DDL = (
    "sensor_type int, manufacturer string, product_name string, product_number string, "
    "category string, data_structures array<struct<data_structure_type:string,"
    "description:string,data_structure:map<string,struct<type:string,units:string>>>>"
)

CATALOG_RESPONSE_DDL = (
    f"sensor_types array<struct<{CATALOG_ENTRY_DDL}>>, generated_at bigint"
)

STATIONS_DDL = (
    "stations array<struct<station_id:int,station_name:string,station_id_uuid:string>>, "
    "generated_at bigint"
)

STATE_STRUCT = (
    "struct<entity_id:string,state:string,attributes:map<string,variant>,"
    "last_changed:string,last_updated:string,"
    "context:struct<id:string,parent_id:string,user_id:string>>"
)

STATE_EVENT_DDL = (
    f"event_type string, data struct<entity_id:string,old_state:{STATE_STRUCT},"
    f"new_state:{STATE_STRUCT}>, origin string, time_fired string, "
    "context struct<id:string,parent_id:string,user_id:string>"
)

COMMAND_DDL = "domain string, service string, entity_id string, data map<string,variant>"

DETECTION_DDL = "ts bigint, image_path string, top array<struct<label:string,confidence:double>>"
