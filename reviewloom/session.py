"""Session settings, the shared working folder, and written cut points."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the results or the plans rely on; all can be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # What goes to Python at once: texts and their hits take some ten times as much there, and
    # each core has a worker of its own.
    "spark.sql.execution.arrow.maxBytesPerBatch": "2m",
}

# Cleaning costs far more than reading, so scan tasks are kept small.
SCAN_SPLIT_BYTES = 64 << 20
SHUFFLE_TARGET_BYTES = 128 << 20


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Shuffle partitions for an input: about 128 MB each, and never fewer than the
    cores. Adaptive execution merges the ones that turn out small."""
    return max(cores, -(-input_bytes // SHUFFLE_TARGET_BYTES))


def build(app: str = "reviewloom", input_bytes: int | None = None, **conf: str) -> SparkSession:
    """A session for a job over about ``input_bytes`` of input."""
    builder = SparkSession.builder.appName(app)
    settings = {
        **RUNTIME,
        "spark.ui.enabled": "false",
        "spark.sql.files.maxPartitionBytes": str(SCAN_SPLIT_BYTES),
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if input_bytes is not None:
        n = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism)
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that somebody else built."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor can reach.

    Taken from ``spark.checkpoint.dir``. Only a local session may go without it; then
    the folder is a temporary one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir"
    )
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="reviewloom-")
    return _local_folders[app]


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several jobs read, and go on from the written table.

    Unlike a cache it outlives executors, and it ends the lineage.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame) -> DataFrame:
    """Spread a small input over all cores ahead of costly projections.

    Only where the scan has fewer splits than the cluster has cores, as with a table in
    one small file; large tables are split enough and are left as they are.
    """
    if df.isStreaming:
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
