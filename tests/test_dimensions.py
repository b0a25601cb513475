import json

import pytest
from pyspark.sql import functions as F

from hearthstream import schemas
from hearthstream.operators import dimensions as D
from hearthstream.operators import keyed as K
from hearthstream.plans.metadata import apply_catalog, apply_metadata, learn_structure_types
from hearthstream.operators.envelope import with_header_columns
from hearthstream.sources.tables import Tables
from helpers import catalog, devices, message, messages, record, rows


def now():
    return F.lit("2026-01-01").cast("timestamp")


def meta(spark, *bodies):
    return messages(spark, *[message(i, b) for i, b in enumerate(bodies, 1)])


FULL = {"lsid": 5, "sensor_type": 43, "category": "ISS", "product_name": "P", "tx_id": 0, "port_number": -1,
        "latitude": 47.5, "longitude": 0, "active": True, "station_id": 0, "station_id_uuid": "", "created_date": 17}


def test_split_metadata(spark):
    split = D.split_metadata(meta(spark, FULL, {"stations": []}, {"lsid": "5"}, "{bad", "null", "[1]"))
    assert rows(split.devices, "offset") == [(1,)]
    assert rows(split.stations, "offset") == [(2,)]
    assert rows(split.invalid, "offset", "reason") == [
        (3, D.BAD_LSID), (4, D.BAD_METADATA), (5, D.BAD_LSID), (6, D.BAD_METADATA)]


def test_device_row_zero_and_empty_rules(spark):
    r = D.device_rows(D.split_metadata(meta(spark, FULL)).devices).first()
    assert (r.lsid, r.sensor_type, r.category, r.manufacturer) == (5, 43, "ISS", "")
    assert (r.tx_id, r.port_number, r.station_id, r.station_id_uuid, r.longitude) == (None, -1, None, None, None)
    assert (float(r.latitude), r.active, r.created_date) == (47.5, True, 17)
    assert json.loads(r.metadata)["category"] == "ISS"
    missing = D.device_rows(D.split_metadata(meta(spark, {"lsid": 6})).devices).first()
    assert (missing.active, missing.category, missing.sensor_type) == (False, "", 0)


def test_upsert_devices_overwrites_but_keeps_identity(spark):
    old = devices(spark, 5, 6, rt_data_structure_type=27, category="old", created_at="2020-01-01")
    incoming = D.device_rows(D.split_metadata(meta(spark, FULL | {"category": "first"}, FULL | {"category": ""}, FULL | {"lsid": 9})).devices)
    got = D.upsert_devices(old, incoming, now())
    assert rows(got.select("id", "lsid", "category", "rt_data_structure_type", F.year("created_at"))) == [
        (5, 5, "", 27, 2020), (6, 6, "old", 27, 2020), (7, 9, "ISS", None, 2026)]


def test_assign_ids_is_dense_and_repeatable(spark):
    fresh = spark.range(5000).select((F.col("id") * 7).alias("k"))
    numbered = K.assign_ids(fresh, ["k"], F.lit(100))
    assert numbered.agg(F.min("id"), F.max("id"), F.countDistinct("id")).first() == (101, 5100, 5000)
    again = K.assign_ids(fresh.repartition(13), ["k"], F.lit(100))
    assert numbered.exceptAll(again).isEmpty()


ENTRY = {"sensor_type": 1, "data_structures": [
    {"data_structure_type": "2", "description": "d", "data_structure": {"a": {"type": "float", "units": "m", "x": 1}, "bad": 5}},
    {"data_structure_type": 3, "data_structure": {"a": {}}}, "no object", {"data_structure_type": "4", "data_structure": []}]}


def test_flatten_catalog(spark):
    entries, invalid = D.flatten_catalog(meta(
        spark, ENTRY, {"sensor_types": [ENTRY | {"sensor_type": 7}, "junk", {"sensor_type": 8}]},
        {"sensor_type": "1"}, {"sensor_type": 1}, {"other": 1}, "{bad"))
    assert rows(entries, "offset", "sensor_type", "data_structure_type", "field_name", "field_type", "units", "description") == [
        (1, 1, "2", "a", "float", "m", "d"), (2, 7, "2", "a", "float", "m", "d")]
    assert rows(entries.select(F.to_json("raw_definition")).distinct()) == [('{"type":"float","units":"m","x":1}',)]
    assert rows(invalid, "offset", "reason") == [
        (3, D.NO_SENSOR_TYPE), (4, D.NO_STRUCTURES), (5, D.NO_SENSOR_TYPE), (6, D.BAD_CATALOG)]


def tags(spark, *values):
    ddl = "id bigint, device_id bigint, tag_name string, data_type string, unit string, description string, metadata string"
    return schemas.empty(spark, schemas.TAGS_DDL).unionByName(spark.createDataFrame(list(values), ddl), allowMissingColumns=True)


def test_tag_upsert_and_enrichment_coalesce_in_opposite_ways(spark):
    old = tags(spark, (1, 5, "a", "text", "kept", None, None), (2, 5, "b", "text", None, None, None))
    new = spark.createDataFrame([(5, "a", "numeric", "new", None, None), (5, "c", "text", None, "d", None)],
                                "device_id bigint, tag_name string, data_type string, unit string, description string, metadata string")
    got = D.upsert_tags(old, new, now())
    assert rows(got, "id", "tag_name", "data_type", "unit", "description") == [
        (1, "a", "numeric", "new", None), (2, "b", "text", None, None), (3, "c", "text", None, "d")]
    cat = catalog(spark, (43, "27", "a", "float", "unit", "desc"), (43, "27", "b", "int", "", "desc"))
    known = devices(spark, 5, sensor_type=43, rt_data_structure_type=27)
    enriched = D.enrich_tags(old, known, cat, now())
    assert rows(enriched, "tag_name", "unit", "description") == [("a", "kept", "desc"), ("b", "", "desc")]
    assert D.tags_needing_enrichment(old, devices(spark, 5, sensor_type=43)).isEmpty()
    assert rows(D.enrich_tag(old, known, cat, 2, now()), "tag_name", "unit") == [("b", "")]
    with pytest.raises(LookupError):
        D.enrich_tag(old, known, catalog(spark, (1, "1", "z", "", "", "")), 1, now())


def sequential(known, updates):
    """Station updates applied one after another, as a plain loop."""
    state = {d: [s, None] for d, s in known.items()}
    touched = []
    for station, name in updates:
        hit = [d for d, (s, _) in state.items() if s == station or s is None]
        for d in hit:
            state[d] = [station, name]
        touched.append(len(hit))
    return {d: tuple(v) for d, v in state.items()}, touched


@pytest.mark.parametrize("updates", [
    [[(1, "A")]], [[(2, "A"), (1, "B")]], [[(9, "X")], [(1, "A"), (9, "Y"), (1, "B")]], [],
])
def test_station_updates_equal_the_sequential_result(spark, updates):
    known = {10: 1, 11: 2, 12: None, 13: None, 14: 3}
    ddl = "lsid bigint, station_id int"
    base = devices(spark, *known).drop("station_id").join(spark.createDataFrame(list(known.items()), ddl), "lsid")
    bodies = [{"stations": [{"station_id": s, "station_name": n} for s, n in m]} for m in updates] or [{"stations": []}]
    found = D.station_updates(D.split_metadata(meta(spark, *bodies)).stations)
    expected, touched = sequential(known, [u for m in updates for u in m])
    got = D.update_station_info(base, found, now())
    assert {r.lsid: (r.station_id, r.station_name) for r in got.collect()} == expected
    counts = D.station_update_counts(base, found).orderBy("offset", "position")
    assert [r.updated for r in counts.collect()] == touched


def test_odd_stations_are_skipped(spark):
    body = {"stations": ["x", {"station_name": "no id"}, {"station_id": 4, "station_id_uuid": ""}]}
    assert rows(D.station_updates(D.split_metadata(meta(spark, body)).stations), "position", "station_id", "station_name", "station_id_uuid") == [(2, 4, "", None)]


def test_learned_structure_type_makes_enrichment_effective(spark, folder):
    tables = Tables(spark, folder)
    tables.replace_dimension("devices", devices(spark, 1, sensor_type=1))
    tables.replace_dimension("tags", tags(spark, (1, 1, "a", "numeric", None, None, None)))
    msgs = with_header_columns(messages(spark, record(1, "{}", structure=4), record(2, "{}", structure=2), record(3, "{}", structure=0)))
    learn_structure_types(msgs, tables)
    assert rows(tables.dimension("devices"), "rt_data_structure_type") == [(2,)]
    apply_catalog(meta(spark, ENTRY, "{bad"), tables)
    assert rows(tables.dimension("tags"), "unit", "metadata") == [
        ("m", '{"data_structure_type":"2","field_type":"float","sensor_type":1,"type":"float","units":"m","x":1}')]
    assert rows(tables.orphans(["reason"]), "offset", "reason") == [(2, D.BAD_CATALOG)]


def test_metadata_into_tables(spark, folder):
    tables = Tables(spark, folder)
    apply_metadata(meta(spark, FULL, {"stations": [{"station_id": 3, "station_name": "S"}]}, "{bad"), tables)
    assert rows(tables.dimension("devices"), "id", "lsid", "station_id", "station_name") == [(1, 5, 3, "S")]
    assert rows(tables.orphans(["reason"]), "offset", "reason") == [(3, D.BAD_METADATA)]


def test_delete_device_cascade(spark):
    t = tags(spark, (1, 5, "a", "text", None, None, None), (2, 6, "a", "text", None, None, None))
    facts = spark.createDataFrame([(1, 9), (2, 9), (1, 8)], "tag_id bigint, ts bigint")
    left = D.delete_device_cascade(devices(spark, 5, 6), t, facts, 5)
    assert [rows(left[0], "lsid"), rows(left[1], "id"), rows(left[2], "tag_id")] == [[(6,)], [(2,)], [(2,)]]


def test_deleting_a_device_rewrites_only_its_partitions(spark, folder):
    import os

    from hearthstream.plans.deletion import delete_device

    def table(ddl, *values):
        columns = [c.split()[0] for c in ddl.split(", ")]
        partial = spark.createDataFrame(*values)
        return schemas.empty(spark, ddl).unionByName(partial, allowMissingColumns=True).select(*columns)

    tables = Tables(spark, folder)
    tables.replace_dimension("devices", table(schemas.DEVICES_DDL, [(1, 10), (2, 20)], "id bigint, lsid bigint"))
    tables.replace_dimension("tags", table(schemas.TAGS_DDL, [(1, 1, "a"), (2, 2, "a"), (3, 2, "b")], "id bigint, device_id bigint, tag_name string"))
    facts = [(1, 5, 1.0, None, "numeric"), (2, 5, 2.0, None, "numeric"), (3, 90000, 3.0, None, "numeric"),
             (1, 200000, 4.0, None, "numeric"), (3, 5, None, None, "null"), (2, 1 << 50, 5.0, None, "numeric"), (1, 1 << 50, 6.0, None, "numeric")]
    tables.append_records(spark.createDataFrame(facts, "tag_id bigint, ts bigint, num_value double, text_value string, kind string")
                          .withColumn("dt", F.when(F.col("ts") < 1 << 40, F.to_date(F.timestamp_seconds("ts")))))

    def files(day):
        return sorted(os.listdir(f"{folder}/records/kind=numeric/dt={day}"))

    untouched = files("1970-01-03")
    assert delete_device(tables, 20) == 4
    left = sorted(map(tuple, tables.records().select("tag_id", "ts", "num_value").collect()))
    assert left == [(1, 5, 1.0), (1, 200000, 4.0), (1, 1 << 50, 6.0)]
    assert files("1970-01-03") == untouched and not os.path.exists(f"{folder}/records/kind=null/dt=1970-01-01")
    assert rows(tables.dimension("tags"), "id") == [(1,)] and rows(tables.dimension("devices"), "lsid") == [(10,)]
    assert delete_device(tables, 20) == 0


def test_metadata_is_parsed_once(spark, folder):
    from hearthstream import schemas
    from hearthstream.plans.metadata import apply_metadata
    from hearthstream.sources.tables import Tables

    bodies = ['{"lsid":1,"category":"a"}', '{"lsid":1,"category":"b"}', '{"stations":[{"station_id":4,"station_name":"s"}]}', "{broken", '{"x":1}']
    plain = spark.createDataFrame(
        [("t", 0, i, None, [], b.encode(), None) for i, b in enumerate(bodies)], schemas.MESSAGE_DDL)
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(len(batch))
            yield batch

    tables = Tables(spark, folder)
    apply_metadata(plain.mapInPandas(counted, plain.schema), tables, F.lit("2026-01-01").cast("timestamp"))
    assert read.value == len(bodies)
    device = tables.dimension("devices").first()
    assert (device.lsid, device.category, device.station_id, device.station_name) == (1, "b", 4, "s")
    assert sorted((r.offset, r.message_body) for r in tables.orphans().collect()) == [(3, "{broken"), (4, '{"x":1}')]
