"""Where intermediate tables of this subpackage live, and how they are written."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark ends an Arrow batch by its rows alone (10,000), which may be all texts of a task; memory outside the heap follows it.
BATCH = 2 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only a local session without the setting gets an own temporary one."""
    given = spark.conf.get(SETTING, None)
    if given:
        return given.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"{SETTING} must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set(SETTING, own)
    return own


def bound_batches(spark: SparkSession) -> None:
    """From now on the session's Arrow batches end at some bytes too; a bound that the user has set stays. A longer row goes alone."""
    if spark.conf.get(BATCH_BYTES, None) is None:
        spark.conf.set(BATCH_BYTES, str(BATCH))


def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}"


_part = "queries"


@contextmanager
def part(name: str) -> Iterator[None]:
    """Inside, stashes go to a part of the folder that can be deleted by itself."""
    global _part
    before, _part = _part, name
    try:
        yield
    finally:
        _part = before


def stash(df: DataFrame) -> DataFrame:
    """df written as Parquet to the shared folder and read again: lineage ends here, lost executors reread files."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{_part}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_stashes(spark: SparkSession, name: str | None = None) -> None:
    """Deletes what this application has written, or a part of it; results that still need it must be written out before."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{_folder(spark)}/{name}" if name else _folder(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
