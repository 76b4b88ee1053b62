"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

WORK_DIR_KEY = "docsift.work.dir"

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # File contents travel to Python in Arrow batches cut by bytes. A worker holds a batch several times over (as it came, as
    # values, as results), and a task has a worker for each function in a row, so batches are small.
    "spark.sql.execution.arrow.maxBytesPerBatch": "8MB",
    # A reader holds this many rows of a table at once, contents included.
    "spark.sql.parquet.columnarReaderBatchSize": "512",
    # Level tables are written to four folders by kind of record; open writers spare a sort of the contents.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

# Deletes the files of an execution's shuffles when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# Row groups of tables with contents are small, whatever the size of a row: a reader holds few contents at a time, and a
# table can be split over all cores without a shuffle. They are most of what lies in the shared folder, so they are packed well.
CONTENT_TABLE = {
    "compression": "zstd",
    "parquet.block.size": str(8 << 20),
    "parquet.page.size.row.check.min": "1",
    "parquet.page.size.row.check.max": "100",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def work_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a local folder only for a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(WORK_DIR_KEY, None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="docsift-")
        spark.conf.set(WORK_DIR_KEY, base)
    return base.rstrip("/")


# The folders made by the runs that ``temporary_runs`` stands around, one list for each, the innermost last.
_MADE: list[list[str]] = []


def new_run_dir(spark: SparkSession, label: str, kept: bool = False) -> str:
    """A folder of its own for one run's tables. ``kept`` is for what results point to: it outlives ``temporary_runs``."""
    path = f"{work_dir(spark)}/docsift/{label}-{uuid.uuid4().hex}"
    for made in [] if kept else _MADE:
        made.append(path)
    return path


@contextmanager
def temporary_runs(spark: SparkSession) -> Iterator[None]:
    """Delete the folders that runs within make, when they are done: their lazy results are of no use after it."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield
    finally:
        # By identity: two lists that hold the same are still two.
        _MADE[:] = [other for other in _MADE if other is not made]
        jvm = spark.sparkContext._jvm
        for path in made:
            folder = jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def own_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes within delete their shuffles' files when they are done, not when the driver happens to collect garbage.

    A write is planned anew, so no other run reads its shuffles.
    """
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)


def written(df: DataFrame, path: str) -> DataFrame:
    """Write a DataFrame to a folder and read it back."""
    spark = df.sparkSession
    with own_shuffles(spark):
        df.write.options(**CONTENT_TABLE).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write a DataFrame to the shared folder and read it back.

    Cuts the lineage in a way that survives the loss of executors, and splits big partitions again on reading.
    """
    return written(df, new_run_dir(df.sparkSession, label))


def spread(df: DataFrame, *keys: str, per_core: int = 1) -> DataFrame:
    """Repartition a plain scan by unique keys when it has fewer partitions than the cluster has cores, or a multiple of them.

    For work that costs CPU time out of proportion to its bytes. Spark splits a scan into as many partitions as there
    are cores once each gets a few megabytes, so at most about one input split per core is moved, and a scan of much
    data is returned unchanged. Few more tasks than cores take two rounds, so long work asks for several per core.
    """
    tasks = per_core * df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= tasks:
        return df
    return df.repartition(tasks, *keys)
