"""Helpers the operators of this subpackage share: tables, texts in Arrow batches, and ranks over a whole table."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from docsift.session import new_run_dir

SETTINGS = {
    # Batches are cut by bytes, so that some very long texts do not fill a Python worker.
    "spark.sql.execution.arrow.maxBytesPerBatch": "16MB",
    "spark.sql.parquet.columnarReaderBatchSize": "1024",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def prepared(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/labels.parquet")


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/embeddings.parquet")


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write to the shared folder and read again: cuts the lineage in a way that outlives executors."""
    path = new_run_dir(df.sparkSession, label)
    df.write.options(**{"compression": "zstd"} | options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until the table has no such columns."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, text`` alone, whatever else the table holds; a null text becomes an empty one."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("text"))


def utf8(column: pa.Array) -> list[bytes]:
    """A batch's texts as UTF-8; null becomes empty."""
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def extended(schema: T.StructType, **columns: T.DataType) -> T.StructType:
    return T.StructType([*schema.fields, *(T.StructField(name, kind) for name, kind in columns.items())])


def in_fold(id_col: Column, modulus: int, remainder: int) -> Column:
    """Whether crc32 of the id as text leaves the remainder; false for a null id."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % modulus == remainder, F.lit(False))


def globally_ranked(df: DataFrame, order: Iterable[Column], rank: str, label: str = "ranked") -> DataFrame:
    """The table, written, with each row's place from 0 in the total order, without sorting it in one task.

    Rows are range-partitioned and sorted within partitions; the id that Spark gives them holds partition and place in
    it. The partitions' first ranks are a running sum over one row per partition, the only thing that is broadcast.
    Ties get different ranks in any order, the same wherever the result is read, as it is written once.
    """
    order = list(order)
    (place,) = fresh(df, "_place")
    spark = df.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    rows = saved(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn(place, F.monotonically_increasing_id()), label
    )
    part = F.shiftright(place, 33)
    sizes = rows.groupBy(part.alias("_part")).agg((F.max(F.col(place).bitwiseAND((1 << 33) - 1)) + 1).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    joined = rows.join(F.broadcast(starts), part == F.col("_part"))
    return joined.withColumn(rank, F.col("_start") + F.col(place).bitwiseAND((1 << 33) - 1)).drop("_part", "_start", place)
