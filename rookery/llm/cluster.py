"""Helpers that tie the operators to a Spark cluster."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = 8 << 20  # bytes of a batch that a task works on at a time
#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once a session, as ``--py-files``
    would), so that tasks import it and keep their tables between batches."""
    sc = spark.sparkContext
    if getattr(sc, "_rookery_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    tmp = tempfile.mkdtemp(prefix="rookery-pkg-")  # read by Spark's file server while the session lives
    atexit.register(shutil.rmtree, tmp, True)
    path = os.path.join(tmp, "rookery_pkg.zip")
    with zipfile.ZipFile(path, "w") as z:
        for d, _, names in os.walk(root):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(d, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    sc._rookery_shipped = True


def word_count(text: Column) -> Column:
    """Words of a text as long; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def map_texts(df: DataFrame, text_col: str, fields: T.StructType, fn: Callable[[pa.Array], list[pa.Array]],
              keep: list[str] | None = None) -> DataFrame:
    """Add to each row the columns ``fields`` that ``fn`` makes of a batch of
    texts (Arrow batches, one task a partition, no shuffle). ``keep``: the
    columns to return besides (default: all). A column of the input that has
    the name of a new one is replaced, as ``withColumn`` does."""
    ship(df.sparkSession)
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema if (keep is None or f.name in keep) and f.name.lower() not in new]
    names = [f.name for f in kept]
    # positions, since the text may have the name of a new column
    wanted = df.select(*[F.col(f"`{n}`") for n in names], F.col(f"`{text_col}`").cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            step = max(1, int(whole.num_rows * SLICE / max(1, whole.nbytes)))
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                own = [b.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(own + fn(b.column(len(names))), names=names + fields.names)

    return wanted.mapInArrow(run, T.StructType(kept + list(fields)))
