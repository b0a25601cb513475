import pytest

from workload import materialization as M


class Filled(Exception):
    pass


def test_the_inbox_of_the_record_stream_has_as_many_files_as_its_source_has_tasks(spark, folder, monkeypatch):
    source = f"{folder}/events.parquet"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").repartition(6).write.parquet(source)

    def stop(spark, path, **_):
        raise Filled(path)

    monkeypatch.setattr(M.files, "read_envelope_files", stop)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        with pytest.raises(Filled) as found:
            M.materialize_streamed(spark, folder)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    inbox = spark.read.parquet(str(found.value))
    assert len(inbox.inputFiles()) > 6
