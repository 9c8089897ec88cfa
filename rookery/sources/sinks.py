"""File sources and sinks.

Sinks write under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp folder, so files
written by executors are visible to every task that reads them back.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.session import scratch_root

TRACE_ROW_SCHEMA = T.StructType([
    T.StructField("fen", T.StringType()),
    T.StructField("valid_moves", T.ArrayType(T.StringType())),
    T.StructField("reasoning_trace", T.StringType()),
    T.StructField("chosen_move", T.StringType()),
])


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/io/{name}-{uuid.uuid4().hex}"


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("sep", "\t").option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path)


def write_jsonl(df: DataFrame, path: str, max_records_per_file: int | None = None) -> None:
    """One JSON object per line, UTF-8, non-ASCII kept as is."""
    w = df.write.mode("overwrite")
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    w.json(path)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType = TRACE_ROW_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).json(path)


def jsonl_to_parquet(spark: SparkSession, src: str, dst: str,
                     schema: T.StructType = TRACE_ROW_SCHEMA) -> DataFrame:
    read_jsonl(spark, src, schema).write.mode("overwrite").parquet(dst)
    return spark.read.parquet(dst)


def write_bucketed(df: DataFrame, name: str, keys: list[str], buckets: int = 16) -> DataFrame:
    """Write ``df`` as a table of the session's catalog in ``buckets`` of ``keys``,
    sorted by them, its files in the shared folder. Tables of the same buckets join
    on the keys without a shuffle. Rows go to their bucket before they are written,
    so a bucket is one file."""
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex}"
    (df.repartition(buckets, *keys).write.bucketBy(buckets, *keys).sortBy(*keys)
     .option("path", scratch_path(spark, table)).format("parquet").saveAsTable(table))
    return spark.table(table)
