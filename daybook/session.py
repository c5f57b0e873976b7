"""Session helper and the shared output folder.

Jobs that write intermediate or round-trip output put it under the folder the
cluster names in ``spark.checkpoint.dir`` (a shared file system on a cluster).
Only when that setting is absent — local runs and tests — a folder of our own
is created and set.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "daybook", event_log_dir: str | None = None) -> SparkSession:
    """A local session for tests and the benchmark.

    ``event_log_dir``: write Spark's event log there (stage and task times
    without the web UI; read it with ``scripts/stage_times.py``).
    """
    b = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for k, v in _LOCAL_DEFAULTS.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = b.config("spark.driver.memory", "16g")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    shared_dir(spark)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for written tables: ``spark.checkpoint.dir``.

    Read from the session; set to a fresh local folder only when unset.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 — sessions without a local SparkContext
        pass
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else ""
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="daybook-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


def new_output_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared folder, in its file system."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


class Scope:
    """Frames saved once in the shared folder for as long as the scope is open.

    ``save`` writes a frame that is used more than once and reads it back: it is
    computed once, its lineage is cut for recovery, and the planner knows its true
    size.  ``close`` (or the end of a ``with`` block) deletes everything that the
    scope saved; a frame that is still to be read must be consumed before.  The
    file system deletes a scope that was never closed when the program ends, also
    after ``spark.stop()``.
    """

    def __init__(self, spark: SparkSession, name: str = "scope"):
        self.spark, self.path, self._n = spark, new_output_path(spark, name), 0
        jvm = spark._jvm
        self._folder = jvm.org.apache.hadoop.fs.Path(self.path)
        self._fs = self._folder.getFileSystem(spark._jsc.hadoopConfiguration())
        self._fs.mkdirs(self._folder)
        self._fs.deleteOnExit(self._folder)

    def new_path(self, name: str) -> str:
        """A fresh location inside the scope."""
        self._n += 1
        return f"{self.path}/{self._n:03d}-{name}"

    def save(self, df: DataFrame, name: str, *partition_by: str) -> DataFrame:
        path = self.new_path(name)
        w = df.write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def close(self) -> None:
        self._fs.delete(self._folder, True)
        self._fs.cancelDeleteOnExit(self._folder)

    def __enter__(self) -> Scope:
        return self

    def __exit__(self, *_) -> None:
        self.close()


_SCOPES: dict[str, Scope] = {}


def program_scope(spark: SparkSession) -> Scope:
    """The scope of results that are read after the call that made them (the
    registered queries): it is deleted when the program ends."""
    app = spark.sparkContext.applicationId
    if app not in _SCOPES:
        _SCOPES[app] = Scope(spark, "program")
    return _SCOPES[app]


def cluster_conf(input_bytes: int, total_cores: int,
                 partition_bytes: int = 256 * 1024 * 1024) -> dict[str, str]:
    """Suggested SQL settings for a cluster run over ``input_bytes`` of source
    data on ``total_cores`` executor cores.

    Initial shuffle partitions are sized so each holds about
    ``partition_bytes`` of the input (AQE then coalesces small ones and splits
    skewed join partitions); file splits use the same size.  Apply with
    ``for k, v in cluster_conf(...).items(): spark.conf.set(k, v)``.
    """
    shuffle = max(2 * total_cores, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
