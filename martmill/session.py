"""Session settings and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Skewed joins are split at run time, also where the split costs an extra shuffle:
# one key may hold a third of all rows, and one task must never own it.
RUNTIME_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Adaptive execution merges shuffle partitions up to this size, and a task sorts or groups what it reads in memory:
# well compressed keys need some twenty times their stored bytes there. A smaller setting of the session stays.
ADVISORY_CONF, ADVISORY_BYTES = "spark.sql.adaptive.advisoryPartitionSizeInBytes", 8 * 2**20

# Rows go to Python workers in batches that are held whole on both sides, beside the heap: whole texts come in batches
# of this size, however long they are. A smaller setting of the session stays.
BATCH_CONF, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 * 2**20

CHECKPOINT_CONF = "spark.checkpoint.dir"

_local_scratch: dict[str, str] = {}


def build_session(app: str, cores: str = "*", shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """A local session for tests and the benchmark; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings the plans rely on."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    for key, most in ((ADVISORY_CONF, ADVISORY_BYTES), (BATCH_CONF, BATCH_BYTES)):
        if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > most:
            spark.conf.set(key, f"{most}b")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` session without that setting falls back to a temporary
    folder; on a cluster a machine-local folder would lose data with its machine.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_scratch:
        _local_scratch[app] = tempfile.mkdtemp(prefix="martmill-")
    return _local_scratch[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, grouped by application for later clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/martmill/{app}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage and freezes values that a re-run task could assign
    differently (positions in a range-partitioned frame). The copy outlives any
    executor, and readers still prune its columns.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_counted(df: DataFrame, path: str, **aggregates: Column) -> dict[str, object]:
    """Write ``df`` to a path and return aggregates over it, taken while writing."""
    seen = Observation()
    df.observe(seen, *[c.alias(name) for name, c in aggregates.items()]).write.mode("errorifexists").parquet(path)
    return seen.get


def release_scratch(spark: SparkSession) -> None:
    """Delete this application's stored intermediates, once their results have been used."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/martmill/{spark.sparkContext.applicationId}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
