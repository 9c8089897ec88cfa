"""Spark session builder and shared-storage helpers."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rookery") -> SparkSession:
    """Session used by tests and the bench.

    AQE is on so joins against data-derived sides are re-planned from runtime
    shuffle statistics (broadcast only when the measured side is small),
    skewed partitions are split and small partitions are coalesced.
    """
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(master or f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or int(cpus)))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the deployment sets it, and without it this raises: a folder
    of one machine would lose what other executors write. Only a local master,
    whose tasks all see this machine's disk, gets a scratch folder of its own
    (removed when the process ends)."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="rookery-ckpt-")
        atexit.register(shutil.rmtree, path, True)
        spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def scratch_root(spark: SparkSession) -> str:
    """This application's part of the checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/rookery-{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete the tables this application wrote to the checkpoint folder. Call
    it when results that read them have been written out."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(scratch_root(spark))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a parquet table in the shared checkpoint folder
    and continue from the table.

    This cuts the lineage like a reliable ``checkpoint()`` (survives lost
    executors; never a local checkpoint) but computes the plan once -- an
    un-persisted RDD checkpoint recomputes it for the write -- and later
    reads get column pruning and predicate pushdown."""
    import uuid

    spark = df.sparkSession
    path = f"{scratch_root(spark)}/cut/{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
