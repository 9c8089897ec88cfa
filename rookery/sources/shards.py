"""Sealed JSON-lines shards.

A shard is written under a temporary name first and sealed by a rename to
``split-%06d.jsonl``; then the batch's manifest names the sealed shards with
their rows. Readers take what manifests name, so a shard half written, or sealed
without a manifest, is never read. Names follow from the batches before, so a
batch that is run again after a failure writes the same names; one that has a
manifest seals nothing.
"""

from __future__ import annotations

import re
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RENAMES = 16  # at a time
MANIFEST = "batch int, name string, rows long, reason string"


class ShardSink:
    """Shards of one folder. ``rows`` of :meth:`seal` carry ``shard`` (from 0 within
    the batch) and ``line`` (order in the shard); the other columns are exported."""

    def __init__(self, spark: SparkSession, root: str, split: str = "split"):
        self.spark, self.root, self.split = spark, root.rstrip("/"), split
        jvm = spark.sparkContext._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def manifest(self) -> DataFrame:
        if not self.fs.exists(self.path(f"{self.root}/_manifest")):
            return self.spark.createDataFrame([], MANIFEST)
        return self.spark.read.schema(MANIFEST).option("recursiveFileLookup", True).json(f"{self.root}/_manifest")

    def write_open(self, rows: DataFrame) -> str:
        """Step one: a file a shard, in a folder of its own. Rows of a shard are in
        one task, and a shard's lines are bounded by who numbered them."""
        path = f"{self.root}/_open/{uuid.uuid4().hex}"
        (rows.repartition("shard").sortWithinPartitions("shard", "line").drop("line")
         .write.partitionBy("shard").option("ignoreNullFields", False).json(path))
        return path

    def rename(self, path: str, first: int) -> list[str]:
        """Step two: names in the order of the shards, a rename a shard."""
        # Spark lists all folders at once, in tasks if they are many
        files = self.spark.read.option("recursiveFileLookup", True).text(path).inputFiles()
        shards = [int(re.search(r"/shard=(\d+)/", f).group(1)) for f in files]
        if len(set(shards)) != len(shards):
            raise ValueError("a shard has more than one file")

        def seal(i: int, file: str) -> str:
            name = f"{self.split}-{first + i:06d}.jsonl"
            target = self.path(f"{self.root}/{name}")
            self.fs.delete(target, False)  # left by a run that had no manifest yet
            if not self.fs.rename(self.path(file), target):
                raise OSError(f"cannot seal {name}")
            return name

        with ThreadPoolExecutor(RENAMES) as pool:
            return list(pool.map(seal, *zip(*sorted(zip(shards, files))))) if files else []

    def seal(self, rows: DataFrame, batch: int = 0, reason: str = "max_lines") -> list[str]:
        """Seal the shards of a batch; names of what was sealed now."""
        known = self.manifest()
        if not known.where(F.col("batch") == batch).isEmpty():
            return []
        first = known.where(F.col("batch") < batch).count()
        path = self.write_open(rows)
        names = self.rename(path, first)
        if not names:
            return []
        number = F.regexp_extract("name", r"-(\d+)\.jsonl$", 1).cast("int")
        counts = (self.spark.read.text(self.root).select(F.col("_metadata.file_name").alias("name"))
                  .where(F.startswith("name", F.lit(f"{self.split}-")) & number.between(first, first + len(names) - 1))
                  .groupBy("name").agg(F.count(F.lit(1)).alias("rows")))
        done = counts.select(F.lit(batch).alias("batch"), "name", "rows", F.lit(reason).alias("reason"))
        done.coalesce(1).write.mode("overwrite").json(f"{self.root}/_manifest/batch-{batch:09d}")
        self.fs.delete(self.path(path), True)  # written above, empty by now
        return names

    def read(self, schema: str) -> DataFrame:
        """Rows of the sealed shards, with ``shard_name``."""
        sealed = self.manifest().select(F.col("name").alias("shard_name"))  # a row a shard
        if sealed.isEmpty():
            return self.spark.createDataFrame([], f"{schema}, shard_name string")
        rows = self.spark.read.schema(schema).json(self.root).withColumn("shard_name", F.col("_metadata.file_name"))
        return rows.join(F.broadcast(sealed), "shard_name", "left_semi").select(*rows.columns)


def by_lines(df: DataFrame, pos: str, lines: int) -> DataFrame:
    """``shard`` and ``line`` from a dense 1-based position: a shard every ``lines``."""
    return df.withColumn("shard", F.floor((F.col(pos) - 1) / lines).cast("int")).withColumn("line", ((F.col(pos) - 1) % lines).cast("int"))


def by_interval(df: DataFrame, pos: str, ts: str, width: str, lines: int) -> DataFrame:
    """A new shard at each interval of ``ts``, and within one every ``lines`` rows.
    ``pos`` is a dense 1-based position in the order of ``ts``. The table of
    intervals has a row an interval that occurs."""
    d = df.withColumn("_at", F.window(ts, width).getField("start"))
    spans = d.groupBy("_at").agg((F.min(pos) - 1).alias("_begin"), F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.select("_at", "_begin", F.coalesce(F.sum(F.ceil(F.col("_n") / lines)).over(before), F.lit(0)).alias("_first"))
    inside = F.col(pos) - 1 - F.col("_begin")
    return (d.join(spans, "_at").withColumn("shard", (F.col("_first") + F.floor(inside / lines)).cast("int"))
            .withColumn("line", (inside % lines).cast("int")).drop("_at", "_begin", "_first"))
