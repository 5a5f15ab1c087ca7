"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

_own_folder: dict[str, str] = {}


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, memory: str = "16g") -> SparkSession:
    """A session for tests and benches on one machine; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("aisleframe")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: Partitions that a shuffle starts with; AQE joins the small ones.
STARTING_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def apply_settings(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    if partitions:
        spark.conf.set(STARTING_PARTITIONS, str(partitions))
    return spark


def starting_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get(STARTING_PARTITIONS, None) or spark.conf.get("spark.sql.shuffle.partitions"))


def work_folder(spark: SparkSession) -> str:
    """Where written tables go: the folder in spark.checkpoint.dir or given to setCheckpointDir, which all executors share.

    Without one, only a session on a single machine gets an own temporary folder; elsewhere that is an error.
    """
    context = spark.sparkContext
    app = context.applicationId
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if shared:
        return f"{shared.rstrip('/')}/aisleframe/{app}"
    if context.master != "local" and not context.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if app not in _own_folder:
        _own_folder[app] = tempfile.mkdtemp(prefix="aisleframe-")
    return _own_folder[app]


def written(df: DataFrame) -> DataFrame:
    """df written once to the work folder and read again, for values that must not be computed twice."""
    spark = df.sparkSession
    path = f"{work_folder(spark)}/written/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
