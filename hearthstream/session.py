"""Session settings the operators rely on, and shared scratch space."""

from __future__ import annotations

import os
import re
import tempfile
import threading
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# All of these are runtime SQL settings, so they can be applied to a session
# that somebody else built.  Shuffle partitions and executor memory belong to the
# cluster.
SETTINGS = {
    # Epoch arithmetic and date partitions are defined in UTC.
    "spark.sql.session.timeZone": "UTC",
    # A JSON object may repeat a key; the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    # Re-plan with real sizes, and split a hot join key over several tasks even
    # where that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # Many paths are listed by so many tasks at most.  By default a micro-batch of
    # thousands of new files starts a task for each of them.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "128",
    # Keyed state of the session operator lives on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SETTINGS` to a session, ship the package, and return the session."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    ship(spark)
    return spark


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A new folder below the cluster's shared checkpoint folder.

    Only in local mode without ``spark.checkpoint.dir`` (a laptop, a unit test)
    is a temporary folder used; the executors of a cluster would not share it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        master = spark.conf.get("spark.master", "")
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all of {master} shares")
        base = tempfile.mkdtemp(prefix="spark-")
    return f"{base.rstrip('/')}/hearthstream-{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Run ``df`` once into a table in the shared scratch folder and return that.

    A written table survives lost executors and, unlike an RDD checkpoint, tells
    the optimizer its size, so later joins can still choose to broadcast it.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    _owned().append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_stages: list[str] = []
_scopes = threading.local()


def _owned() -> list[str]:
    """Where the current thread notes its stages: the innermost scope, else the process."""
    stack = getattr(_scopes, "stack", None)
    return stack[-1] if stack else _stages


def _delete(spark: SparkSession, paths: list[str]) -> int:
    dropped = 0
    while paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(paths.pop())
        dropped += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return dropped


def drop_stages(spark: SparkSession) -> int:
    """Delete the stage tables written outside any scope; returns how many.

    Call it when no DataFrame built on them is needed any more.
    """
    return _delete(spark, _stages)


@contextmanager
def own_stages(spark: SparkSession) -> Iterator[None]:
    """Delete the stages written inside when the block ends, and no others.

    For a micro-batch or any job that leaves nothing but written tables behind.
    """
    stack = _scopes.stack = getattr(_scopes, "stack", None) or []
    mine: list[str] = []
    stack.append(mine)
    try:
        yield
    finally:
        stack.remove(mine)
        _delete(spark, mine)


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Needed where they have not installed it: Python functions are pickled by
    reference to their module.
    """
    context = spark.sparkContext
    root = Path(__file__).resolve().parent
    on_path = str(root.parent) in os.environ.get("PYTHONPATH", "").split(os.pathsep)
    if context.applicationId in _shipped or on_path:
        return
    archive = Path(tempfile.mkdtemp(prefix="spark-")) / "hearthstream.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, str(file.relative_to(root.parent)))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


@contextmanager
def observing(spark: SparkSession) -> Iterator[None]:
    """Keep observed plan nodes in the plan while an observed action runs.

    Adaptive execution drops stages that turn out empty, and their observed
    metrics with them; the reader of the metrics would then wait forever.
    """
    name = "spark.sql.adaptive.optimizer.excludedRules"
    before = spark.conf.get(name, None)
    rule = "org.apache.spark.sql.execution.adaptive.AQEPropagateEmptyRelation"
    spark.conf.set(name, f"{before},{rule}" if before else rule)
    try:
        yield
    finally:
        if before:
            spark.conf.set(name, before)
        else:
            spark.conf.unset(name)
