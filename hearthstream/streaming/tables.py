"""Streams into the table folder: records, metadata, catalog, orphans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from hearthstream.plans.materialize import Summary, materialize
from hearthstream.plans.metadata import apply_catalog, apply_metadata
from hearthstream.session import own_stages
from hearthstream.sources.tables import Tables


def _foreach(stream: DataFrame, checkpoint: str, apply: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    def batch(rows: DataFrame, batch_id: int) -> None:
        # What a batch stages is deleted with it, and only that.
        with own_stages(rows.sparkSession):
            apply(rows, batch_id)

    return stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)


def materialize_stream(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    on_batch: Callable[[int, Summary], None] | None = None,
    replay: bool = False,
) -> DataStreamWriter:
    """Continuous materialization; start it with the trigger of your choice.

    Batch size is bounded by the source (``maxOffsetsPerTrigger`` or
    ``maxFilesPerTrigger``), flush time by the trigger.  There is no watermark:
    a record may arrive arbitrarily late.  Every write of a batch is idempotent,
    so a batch repeated after a failure changes nothing.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        summary = materialize(batch, tables, replay=replay)
        if on_batch is not None:
            on_batch(batch_id, summary)

    return _foreach(messages, checkpoint, apply)


def metadata_stream(messages: DataFrame, tables: Tables, checkpoint: str) -> DataStreamWriter:
    """Device and station messages into the device table as they arrive."""
    return _foreach(messages, checkpoint, lambda batch, _: apply_metadata(batch, tables))


def catalog_stream(messages: DataFrame, tables: Tables, checkpoint: str) -> DataStreamWriter:
    """Catalog messages into the catalog table, then enrichment of the tags."""
    return _foreach(messages, checkpoint, lambda batch, _: apply_catalog(batch, tables))


class BatchMetrics:
    """Counters per micro-batch, appended to a table of (metric, tick, n) rows."""

    NAMES = ("processed", "errors", "numeric", "text", "null")

    def __init__(self, tables: Tables, path: str):
        self.tables, self.path = tables, path

    def __call__(self, batch_id: int, summary: Summary) -> None:
        rows = [(name, batch_id, summary[name]) for name in self.NAMES]
        frame = self.tables.spark.createDataFrame(rows, "metric string, tick bigint, n bigint")
        # One folder per batch: a repeated batch replaces its own counters.
        frame.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch={batch_id}")

    def read(self) -> DataFrame:
        schema = "metric string, tick bigint, n bigint, batch bigint"
        return self.tables.spark.read.schema(schema).parquet(self.path)
