"""Structured Streaming operators.

Sources are file streams; every sink is written through ``foreachBatch``
into a folder keyed by the micro-batch id, overwritten on replay, so a batch
re-run after a failure never duplicates output (exactly-once by
idempotence). Queries run with ``trigger(availableNow=True)`` and their
checkpoints live under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import re
import threading
import time
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.operators.sampling import dense_order
from rookery.sources.sinks import scratch_path


BATCH_PARTITIONS = 8
FILE_MANAGER = "spark.sql.streaming.checkpointFileManagerClass"
STREAMING = "org.apache.spark.sql.execution.streaming.checkpointing"
LANES = (1, 2, 5, 10)  # the last digit of an append's number tells its lane
RENAMES = 16  # at a time


def lanes_of(appends: int) -> int:
    """Lanes for a source of so many appends: each is to have four of them at least."""
    return max(n for n in LANES if n == 1 or 4 * n <= appends)


def global_id(batch_id: int, lane: int, lanes: int) -> int:
    return batch_id * lanes + lane


def stage_files(df: DataFrame, path: str, order: list[str], rows_per_trigger: int, files_per_trigger: int = 4,
                by: Column | None = None, lanes: int = 1) -> int:
    """Let ``df`` arrive in ``path`` in ``order``, as a producer would: appends of
    exactly ``rows_per_trigger`` rows (the last has what is left), each of
    ``files_per_trigger`` files. A stream that takes ``files_per_trigger`` files a
    trigger takes one append a trigger, so a batch has a bound in rows. Returns the
    number of appends.

    The rows are sorted by range and numbered once, and one job writes the files of
    all appends, so its tasks and results do not grow with rows times appends. A
    stream takes files by their time: each file is renamed into ``path`` with a time
    in the order of the appends (a rename a file on the driver).

    With ``by``, a whole number, rows of one value are all in appends of lane
    ``by % lanes``, which are in ``order`` and of that size by themselves."""
    spark = df.sparkSession
    if by is None:
        d = dense_order(df, order, "_pos")
        i = F.col("_pos") - 1
        d = d.withColumn("_append", F.floor(i / rows_per_trigger).cast("long"))
    else:
        d = dense_order(df.withColumn("_lane", F.pmod(by, F.lit(lanes)).cast("int")), ["_lane", *order], "_pos")
        firsts = d.groupBy("_lane").agg(F.min("_pos").alias("_first"))  # a row a lane
        d = d.join(F.broadcast(firsts), "_lane")
        i = F.col("_pos") - F.col("_first")
        d = d.withColumn("_append", F.floor(i / rows_per_trigger).cast("long") * lanes + F.col("_lane"))
    d = d.withColumn("_file", (i % files_per_trigger).cast("int")).select(*df.columns, "_pos", "_append", "_file")
    made = scratch_path(spark, "appends")
    (d.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_append").sortWithinPartitions("_append", "_file", "_pos")
     .drop("_pos").write.partitionBy("_append", "_file").parquet(made))
    written = spark.read.schema(df.schema).option("recursiveFileLookup", True).parquet(made).inputFiles()
    if not written:
        df.limit(0).write.mode("append").parquet(path)
        return 0
    names = {f: re.search(r"_append=(\d+)/_file=(\d+)/", f).groups() for f in written}
    batches = 1 + max(int(a) for a, _ in names.values())
    to_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = to_path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(to_path(path))
    begin = int(time.time() * 1000) - batches

    def append_file(f: str) -> None:
        append, file = (int(x) for x in names[f])
        target = to_path(f"{path}/append-{append:09d}-{file:03d}.parquet")
        if not fs.rename(to_path(f), target):
            raise OSError(f"cannot append {target}")
        fs.setTimes(target, begin + append, -1)

    with ThreadPoolExecutor(RENAMES) as pool:
        list(pool.map(append_file, names))
    return batches


def read_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 4,
                lane: int = 0, lanes: int = 1) -> DataFrame:
    r = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    if lanes > 1:
        digits = "".join(str(i) for i in range(10) if i % lanes == lane)
        r = r.option("pathGlobFilter", f"append-*[{digits}]-*.parquet")
    return r.parquet(path)


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Settings of the session for the time of the block."""
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def start_batches(stream: DataFrame, handler, name: str, mode: str = "append", partitions: int = BATCH_PARTITIONS):
    spark = stream.sparkSession
    ckpt = scratch_path(spark, f"ckpt-{name}")
    # a query takes its settings when it starts: state and shuffles of a batch, which
    # is bounded in rows, have few partitions, as each costs time in every batch
    values = {"spark.sql.shuffle.partitions": str(min(int(spark.conf.get("spark.sql.shuffle.partitions")), partitions))}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(ckpt)
    if path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme() == "file":
        # for each file of the log Hadoop's FileContext runs about ten commands (chmod,
        # stat) on a local folder; a FileSystem runs two, and one driver writes here
        values[FILE_MANAGER] = f"{STREAMING}.FileSystemBasedCheckpointFileManager"
    with settings(spark, values):
        return (stream.writeStream.outputMode(mode).foreachBatch(handler)
                .option("checkpointLocation", ckpt).trigger(availableNow=True).start())


def run_batches(stream: DataFrame, handler, name: str, mode: str = "append", done: threading.Event | None = None) -> None:
    """Drive ``stream`` to completion with ``foreachBatch(handler)``, or until
    ``done`` is set, which ends the query before the rest is read."""
    q = start_batches(stream, handler, name, mode)
    while not q.awaitTermination(1 if done is not None else 3600):
        if done is not None and done.is_set():
            q.stop()
            return


def run_lanes(of_lane, lanes: int, name: str, mode: str = "append") -> None:
    """Drive the streams of all lanes to completion, side by side. ``of_lane(lane)``
    gives a lane's stream and handler; the lanes share the partitions of state."""
    queries = []
    try:
        for lane in range(lanes):
            stream, handler = of_lane(lane)
            queries.append(start_batches(stream, handler, f"{name}-{lane}", mode, max(1, BATCH_PARTITIONS // lanes)))
        for q in queries:
            while not q.awaitTermination(3600):
                pass
    finally:
        for q in queries:  # those of other lanes, if one failed
            if q.isActive:
                q.stop()


def write_batch(df: DataFrame, path: str) -> None:
    """Overwrite a batch's folder, without a marker file: the stream's log says which
    batches are done."""
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)


def batch_writer(sink: str, lane: int = 0, lanes: int = 1):
    """Idempotent per-batch sink: ``sink/batch_id=<id>`` is overwritten."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        write_batch(batch_df, f"{sink}/batch_id={global_id(batch_id, lane, lanes)}")
    return write


def stream_append(spark: SparkSession, src: str, schema: T.StructType, transform, name: str, lanes: int = 1) -> DataFrame:
    sink = scratch_path(spark, f"sink-{name}")

    def of_lane(lane: int):
        # a batch is bounded and has no shuffle: one task, one file
        return transform(read_stream(spark, src, schema, lane=lane, lanes=lanes)).coalesce(1), batch_writer(sink, lane, lanes)

    run_lanes(of_lane, lanes, name)
    return spark.read.parquet(sink)


def event_time(df: DataFrame, col: str = "ts") -> DataFrame:
    """Watermarks need TIMESTAMP (the tables carry TIMESTAMP_NTZ)."""
    return df.withColumn(col, F.col(col).cast("timestamp"))


def stream_window_counts(spark: SparkSession, src: str, schema: T.StructType, name: str,
                         width: str = "15 minutes", delay: str = "1 hour", lanes: int = 1) -> DataFrame:
    """Tumbling-window counts in update mode with a watermark (bounded
    state); each batch upserts the windows it changed, and the final answer
    is the latest version of every window, summed over the lanes."""
    sink = scratch_path(spark, f"sink-{name}")

    def of_lane(lane: int):
        s = event_time(read_stream(spark, src, schema, lane=lane, lanes=lanes)).withWatermark("ts", delay)
        agg = s.groupBy(F.window("ts", width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
        return agg.select(F.col("w.start").alias("shard_start"), "n"), batch_writer(sink, lane, lanes)

    run_lanes(of_lane, lanes, name, mode="update")
    out = spark.read.parquet(sink)
    latest = out.groupBy("shard_start", (F.col("batch_id") % lanes).alias("_lane")).agg(F.max_by("n", "batch_id").alias("n"))
    return latest.groupBy("shard_start").agg(F.sum("n").alias("n"))


def stream_quota(spark: SparkSession, src: str, schema: T.StructType, targets: dict[str, int], name: str,
                 order: tuple[str, ...] = ("ts", "id")) -> DataFrame:
    """Per-source quota with early stop across micro-batches.

    Each batch ranks its rows per source and accepts only what is left of the
    target. The counts so far are a row a source, committed with each batch in a
    folder of its id, so a batch reads the counts of the batch before it and
    nothing of the sink, and a replay gives the same answer. Once all sources are
    full the query ends; a batch that has begun by then is not read."""
    from rookery.operators.sampling import bucketed_rank
    sink, state = scratch_path(spark, f"sink-{name}"), scratch_path(spark, f"counts-{name}")
    tgt = spark.createDataFrame(list(targets.items()), "source STRING, target BIGINT")
    full = threading.Event()

    def handle(batch_df: DataFrame, batch_id: int) -> None:
        if full.is_set():
            return
        session = batch_df.sparkSession
        done = dict(session.read.parquet(f"{state}/batch_id={batch_id - 1}").collect()) if batch_id else {}  # a row a source
        left = session.createDataFrame([(k, v - done.get(k, 0)) for k, v in targets.items()], "source STRING, room BIGINT")
        b = batch_df.join(F.broadcast(left), "source").where("room > 0")
        # exact per-source rank by (ts, id) without a one-task-per-source
        # window: event time (microseconds, time-zone free) normalised to
        # [0, 1) over the batch feeds the bucketed rank
        t = F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)").cast("double")
        b = b.withColumn("_t", t)
        bounds = F.broadcast(b.agg(F.min("_t").alias("_lo"), F.max("_t").alias("_hi")))
        b = b.crossJoin(bounds).withColumn("_u", (F.col("_t") - F.col("_lo")) / (F.col("_hi") - F.col("_lo") + 1.0))
        r = bucketed_rank(b, "_u", list(order), ["source"], limit=F.col("room"), n_buckets=4096,
                         small_groups=True)  # the targets are a fixed list
        out = f"{sink}/batch_id={batch_id}"
        r.drop("_t", "_lo", "_hi", "_u", "rank", "room").write.mode("overwrite").parquet(out)
        new = dict(session.read.schema(schema).parquet(out).groupBy("source").count().collect())
        counts = [(k, done.get(k, 0) + new.get(k, 0)) for k in targets]
        session.createDataFrame(counts, "source STRING, done BIGINT").coalesce(1).write.mode("overwrite").parquet(f"{state}/batch_id={batch_id}")
        if all(c >= targets[k] for k, c in counts):
            full.set()

    if any(v > 0 for v in targets.values()):
        run_batches(read_stream(spark, src, schema), handle, name, done=full)
        return spark.read.parquet(sink)
    return spark.createDataFrame([], schema)


KEY_BUCKETS = 64
MERGE_EVERY = 16  # batches


def key_bucket(key: str, buckets: int = KEY_BUCKETS):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def key_history(spark: SparkSession, sink: str, written: T.StructType, batch_id: int) -> DataFrame:
    """What batches before ``batch_id`` wrote: the index merged last before it, a file
    a bucket, and the batches since, fewer than ``MERGE_EVERY`` files."""
    keys = T.StructType([f for f in written if f.name != "batch_id"])
    merged = (batch_id - 1) // MERGE_EVERY * MERGE_EVERY
    prior = spark.read.schema(keys).parquet(f"{sink}/_index/upto={merged}").select(*keys.names)
    since = [f"{sink}/batch_id={i}" for i in range(merged + 1, batch_id)]
    return prior.unionAll(spark.read.schema(keys).parquet(*since)) if since else prior


def touched_history(spark: SparkSession, sink: str, written: T.StructType, buckets: list[int], batch_id: int) -> DataFrame:
    """What batches before ``batch_id`` wrote to these buckets: the only folders of
    the index that are read."""
    return key_history(spark, sink, written, batch_id).where(F.col("bucket").isin(buckets))


def stream_dedup(spark: SparkSession, src: str, schema: T.StructType, key: str, name: str,
                 delay: str = "1 day", buckets: int = KEY_BUCKETS, lanes: int = 1) -> DataFrame:
    """Drop repeats of ``key``.

    Repeats within the watermark delay are dropped by the streaming state, which
    holds only that span; older repeats are dropped against the sink, a file a
    batch, of which an index in ``buckets`` of the key's hash is merged every
    ``MERGE_EVERY`` batches: a batch meets the buckets of the index that its own new
    keys fall into (at most ``buckets`` numbers on the driver) and none of the
    others. Only batches before this one count, and a batch overwrites its own
    folders, so a replay gives the same answer: it finds the index before the one
    that it merges. Lanes must be staged by the key's bucket, so that a key is in one
    lane only."""
    sink = scratch_path(spark, f"sink-{name}")
    written = T.StructType([schema[key], T.StructField("bucket", T.IntegerType()), T.StructField("batch_id", T.IntegerType())])
    keys = T.StructType([f for f in written if f.name != "batch_id"])
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(sink).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def of_lane(lane: int):
        s = event_time(read_stream(spark, src, schema, lane=lane, lanes=lanes)).withWatermark("ts", delay)
        own = f"{sink}/lane={lane}"

        def handle(batch_df: DataFrame, batch_id: int) -> None:
            session = batch_df.sparkSession
            write_batch(batch_df.dropDuplicates([key]).withColumn("bucket", key_bucket(key, buckets)), f"{own}/_new")
            new = session.read.schema(keys).parquet(f"{own}/_new").coalesce(1)  # a batch is bounded
            if batch_id > 0:
                touched = new.agg(F.collect_set("bucket")).first()[0]
                if touched:
                    # the history is streamed past the batch's keys and stays where it is
                    prior = touched_history(session, own, written, touched, batch_id).select(*keys.names)
                    seen = prior.join(F.broadcast(new), ["bucket", key], "left_semi")
                    new = new.join(F.broadcast(seen), ["bucket", key], "left_anti")
            write_batch(new.select(*keys.names), f"{own}/batch_id={batch_id}")
            if batch_id % MERGE_EVERY == 0:
                merged = session.read.schema(keys).parquet(f"{own}/batch_id={batch_id}")
                if batch_id > 0:
                    merged = merged.unionAll(key_history(session, own, written, batch_id))
                merged.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{own}/_index/upto={batch_id}")
                fs.delete(path(f"{own}/_index/upto={batch_id - 2 * MERGE_EVERY}"), True)

        return s.dropDuplicatesWithinWatermark([key]).select(key), handle

    run_lanes(of_lane, lanes, name)
    return spark.read.schema(written).parquet(sink).select(key)


def stream_batch_sizes(spark: SparkSession, src: str, schema: T.StructType, name: str,
                       files_per_trigger: int = 4, lanes: int = 1) -> DataFrame:
    """Rate limit: at most ``files_per_trigger`` files per micro-batch, and so at
    most the rows that the producer puts into so many files; ``lanes`` batches at
    most are in flight."""
    sink = scratch_path(spark, f"sink-{name}")

    def of_lane(lane: int):
        write = batch_writer(sink, lane, lanes)

        def handle(batch_df: DataFrame, batch_id: int) -> None:
            # a batch is bounded, so one task counts it, without a shuffle
            write(batch_df.coalesce(1).agg(F.count(F.lit(1)).alias("n_rows")), batch_id)
        return read_stream(spark, src, schema, files_per_trigger, lane, lanes), handle

    run_lanes(of_lane, lanes, name)
    return spark.read.parquet(sink)


def stream_running_stats(spark: SparkSession, src: str, schema: T.StructType, group: str, value: str,
                         name: str) -> DataFrame:
    """Stateful running aggregate (update mode); the final state per group
    is the last version written."""
    from pyspark.sql import Window
    s = read_stream(spark, src, schema)
    agg = s.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total"))
    sink = scratch_path(spark, f"sink-{name}")
    run_batches(agg, batch_writer(sink), name, mode="update")
    out = spark.read.parquet(sink)
    w = Window.partitionBy(group).orderBy(F.col("batch_id").desc())
    return out.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", "batch_id")
