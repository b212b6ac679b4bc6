"""Session settings shared by every job, and the reliable checkpoint folder."""

from __future__ import annotations

import math
import os
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job assumes. ANSI stays on (Spark 4 default), so parsing uses try_* forms.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast joins only below a checked size; the planner and AQE compare this with
    # the measured size of the build side, larger sides use a shuffled join.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.ui.enabled": "false",
    # the Python call site of every column expression is not recorded (errors name the
    # expression instead)
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # files of checkpoints that nothing refers to any more are deleted
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(
    master: str | None = None,
    app_name: str = "sheaf",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the defaults above.

    On a cluster leave ``master`` unset and let the submitter choose; size
    ``shuffle_partitions`` to the data (AQE coalesces small partitions at run time).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# of rows that Spark sends to a Python worker at once
BATCH_BYTES = 4 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches of about ``BATCH_BYTES`` in this session, unless it names a size of its own.
    Spark's 10,000 rows or 64 MB are a whole partition of long texts, which an executor and its
    Python worker then hold next to each other. Only the size of batches changes: lazy results
    run later, so it stays."""
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, str(BATCH_BYTES))


def scale_settings(
    input_bytes: int,
    cores: int,
    split_bytes: int = 256 * 1024 * 1024,
    shuffle_bytes_per_partition: int = 128 * 1024 * 1024,
    shuffle_ratio: float = 0.25,
    most_reducers: int | None = None,
) -> dict[str, str]:
    """Partition settings for a large run, to pass as ``extra`` to ``get_session``.

    Scan splits of ``split_bytes``; the initial shuffle width sized so that the expected
    shuffle volume (``shuffle_ratio`` of the input, after partial aggregation and
    pruning) lands near ``shuffle_bytes_per_partition`` per reducer, and at least two waves
    of tasks. ``most_reducers`` bounds the width where the cluster's shuffle service cannot
    serve map x reduce blocks beyond it (reducers then hold more each); by default nothing
    does. AQE coalesces small reducers to the advisory size and splits skewed ones.
    """
    expected_shuffle = input_bytes * shuffle_ratio
    reducers = max(2 * cores, math.ceil(expected_shuffle / shuffle_bytes_per_partition))
    if most_reducers is not None:
        reducers = min(reducers, most_reducers)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(reducers),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(reducers),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(shuffle_bytes_per_partition),
        # size reducers by the advisory size rather than maximising their number: on a
        # shared cluster that avoids many tiny tasks
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * shuffle_bytes_per_partition),
    }


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or an earlier ``setCheckpointDir``).
    Only a local-mode session without the setting gets one, below its warehouse folder; a
    cluster must name a shared folder, because a machine-local one does not survive
    executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder before running on a cluster")
        configured = os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "_checkpoints")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage.

    Used where one result feeds several actions; unlike a cache, a lost executor
    does not force the upstream joins to run again.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and its path object."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


class Scope:
    """The tables that ``stored`` has written for one piece of work."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def drop(self) -> None:
        """Delete the tables; what a failed write has left goes too."""
        while self.paths:
            fs, target = file_system(self.spark, self.paths[-1])
            fs.delete(target, True)
            self.paths.pop()


_open_scopes = threading.local()


@contextmanager
def storage_scope(spark: SparkSession) -> Iterator[Scope]:
    """Tables that ``stored`` writes inside belong to this scope (the innermost one of the
    thread) and are dropped when it ends, also after an error. Results that are needed
    longer must have been written elsewhere by then, or stored for an outer scope."""
    scopes = _open_scopes.__dict__.setdefault("scopes", [])
    scope = Scope(spark)
    scopes.append(scope)
    try:
        yield scope
    finally:
        scopes.remove(scope)
        scope.drop()


def own_path(spark: SparkSession, scope: Scope | None = None) -> str:
    """A new path for a table below the checkpoint folder.

    It belongs to ``scope`` or else to the innermost open one. Outside of any scope it lasts as
    long as the application, as a lazy result may read it at any time."""
    folder = os.path.join(checkpoint_dir(spark), f"table-{uuid.uuid4()}")
    scopes = _open_scopes.__dict__.get("scopes", [])
    owner = scope or (scopes[-1] if scopes else None)
    if owner is not None:
        owner.paths.append(folder)
    else:
        fs, target = file_system(spark, folder)
        fs.mkdirs(target)  # only what is there is noted for deletion
        fs.deleteOnExit(target)
    return os.path.join(folder, "rows")


def stored(df: DataFrame, scope: Scope | None = None) -> DataFrame:
    """``df`` written to a new Parquet table at an ``own_path``, and read back: like
    ``cut_lineage``, but compressed, and later reads take only the columns they need."""
    path = own_path(df.sparkSession, scope)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
