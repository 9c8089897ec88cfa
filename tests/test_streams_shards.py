"""Early stop, bounded history, row limits and sealed shards."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.sources import shards
from rookery.sources.sinks import scratch_path
from rookery.streaming import streams as ST

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("source", T.StringType()), T.StructField("ts", T.TimestampNTZType())])


def staged(spark, n, rows, name, source=lambda i: "game" if i % 3 else "puzzle"):
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i, source(i), start + dt.timedelta(minutes=i)) for i in range(n)], SCHEMA)
    path = scratch_path(spark, name)
    return path, ST.stage_files(df.repartition(5), path, ["ts", "id"], rows)


def test_batches_have_a_bound_in_rows_and_come_in_order(spark):
    path, batches = staged(spark, 105, 20, "bound")
    assert batches == 6
    sizes = {r.batch_id: r.n_rows for r in ST.stream_batch_sizes(spark, path, SCHEMA, "bound").collect()}
    assert sizes == {0: 20, 1: 20, 2: 20, 3: 20, 4: 20, 5: 5}
    files = spark.read.parquet(path).inputFiles()
    assert len(files) >= 4 * 5  # as many tasks as files wrote each append


def test_quota_stops_early(spark, monkeypatch):
    path, _ = staged(spark, 400, 20, "early")
    read = []
    run = ST.run_batches

    def counted(stream, handler, name, mode="append", done=None):
        def watch(df, batch_id):
            before = done.is_set()
            handler(df, batch_id)
            read.append((batch_id, before))
        run(stream, watch, name, mode, done)

    monkeypatch.setattr(ST, "run_batches", counted)
    got = ST.stream_quota(spark, path, SCHEMA, {"game": 30, "puzzle": 9}, "early")
    rows = sorted((r.source, r.id) for r in got.collect())
    assert rows == sorted([("game", i) for i in range(400) if i % 3][:30] + [("puzzle", i) for i in range(400) if i % 3 == 0][:9])
    assert [b for b, late in read if not late] == [0, 1, 2]  # 45 rows hold the quota
    assert set(got.select("batch_id").distinct().toPandas()["batch_id"]) <= {0, 1, 2}


def test_quota_counts_survive_a_restart(spark):
    """A batch reads the counts of the one before it only."""
    path, _ = staged(spark, 100, 10, "counts")
    got = ST.stream_quota(spark, path, SCHEMA, {"game": 1000, "puzzle": 5}, "counts")
    assert got.where("source = 'puzzle'").count() == 5 and got.where("source = 'game'").count() == 66


def test_dedup_meets_only_the_buckets_of_its_keys(spark, monkeypatch):
    path, _ = staged(spark, 120, 20, "dedup")
    seen = []
    history = ST.touched_history

    def watch(s, sink, written, buckets, batch_id):
        prior = history(s, sink, written, buckets, batch_id)
        plan = prior._jdf.queryExecution().executedPlan().toString()
        filters = [line for line in plan.splitlines() if "PartitionFilters" in line][0].split("PartitionFilters: [")[1] if buckets else "bucket"
        assert "bucket" in filters.split("]")[0]  # other folders are not read
        seen.append(prior.select("bucket").distinct().count())
        assert seen[-1] <= len(buckets)
        return prior

    monkeypatch.setattr(ST, "touched_history", watch)
    df = spark.read.schema(SCHEMA).parquet(path).withColumn("id", F.col("id") % 7)
    again = scratch_path(spark, "dedup-again")
    ST.stage_files(df, again, ["ts", "id"], 20)
    got = ST.stream_dedup(spark, again, SCHEMA, "id", "dedup", delay="1 minute", buckets=16)
    assert sorted(r.id for r in got.collect()) == list(range(7))
    assert max(seen) > 0


def test_all_appends_are_staged_by_as_many_jobs_as_one(spark, monkeypatch):
    """Jobs of the staging do not grow with the appends; settings of the session
    are as they were once a stream has begun."""
    from pyspark.sql import DataFrameWriter

    parquet, calls = DataFrameWriter.parquet, []
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, path, *a, **k: (calls.append(path), parquet(self, path, *a, **k))[1])
    counts = []
    for rows in (100, 10):
        calls.clear()
        path, batches = staged(spark, 100, rows, f"jobs{rows}")
        counts.append(len(calls))
        assert batches == 100 // rows
    assert counts[0] == counts[1]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    sizes = {r.batch_id: r.n_rows for r in ST.stream_batch_sizes(spark, path, SCHEMA, "jobs").collect()}
    assert sizes == {i: 10 for i in range(10)} and spark.conf.get("spark.sql.shuffle.partitions") == before


def rows_of(spark, n, lines):
    df = spark.range(1, n + 1).select(F.col("id").alias("pos"), F.concat(F.lit("é"), F.col("id").cast("string")).alias("text"))
    return shards.by_lines(df.repartition(4), "pos", lines).select("shard", "line", "text")


def names(sink):
    return sorted(f.getPath().getName() for f in sink.fs.listStatus(sink.path(sink.root)) if f.isFile())


def test_shards_are_sealed_once(spark):
    sink = shards.ShardSink(spark, scratch_path(spark, "sealed"))
    assert sink.seal(rows_of(spark, 25, 10), 0) == ["split-000000.jsonl", "split-000001.jsonl", "split-000002.jsonl"]
    assert sink.seal(rows_of(spark, 12, 10), 1, "interval") == ["split-000003.jsonl", "split-000004.jsonl"]
    assert sink.seal(rows_of(spark, 25, 10), 0) == [] and sink.seal(rows_of(spark, 12, 10), 1) == []  # replayed
    assert names(sink) == [f"split-{i:06d}.jsonl" for i in range(5)]
    assert {(r.name, r.rows, r.reason) for r in sink.manifest().collect()} >= {("split-000002.jsonl", 5, "max_lines"), ("split-000004.jsonl", 2, "interval")}
    lines = spark.read.text(f"{sink.root}/split-000001.jsonl").collect()
    assert [r.value for r in lines] == [f'{{"text":"é{i}"}}' for i in range(11, 21)]


def test_a_shard_without_a_manifest_is_not_read_and_is_written_again(spark, monkeypatch):
    sink = shards.ShardSink(spark, scratch_path(spark, "crash"))
    sink.seal(rows_of(spark, 10, 10), 0)
    path = sink.write_open(rows_of(spark, 30, 10))
    sink.rename(path, 1)  # the driver is lost before the manifest
    assert len(names(sink)) == 4
    assert sink.read("text string").count() == 10
    assert sink.seal(rows_of(spark, 30, 10), 1) == [f"split-{i:06d}.jsonl" for i in (1, 2, 3)]
    assert sink.read("text string").count() == 40 and len(names(sink)) == 4


@pytest.mark.parametrize("lines,want", [(100, [0, 0, 0, 1, 1, 3]), (2, [0, 0, 1, 2, 2, 4])])
def test_intervals(spark, lines, want):
    start = dt.datetime(2024, 1, 1)
    at = [0, 5, 14, 15, 29, 3000]
    df = spark.createDataFrame([(i + 1, start + dt.timedelta(minutes=m)) for i, m in enumerate(at)], "pos long, ts timestamp_ntz")
    got = shards.by_interval(df, "pos", "ts", "15 minutes", lines).orderBy("pos").collect()
    dense = {s: i for i, s in enumerate(sorted(set(want)))}
    assert [r.shard for r in got] == [dense[s] for s in want]
    assert max(r.line for r in got) < lines


def test_empty(spark):
    sink = shards.ShardSink(spark, scratch_path(spark, "none"))
    assert sink.seal(rows_of(spark, 0, 10)) == [] and sink.read("text string").count() == 0
    path = scratch_path(spark, "none-stream")
    assert ST.stage_files(spark.createDataFrame([], SCHEMA), path, ["ts", "id"], 10) == 0


def test_dedup_reads_a_bounded_number_of_files(spark, monkeypatch):
    """Files of the history do not grow with the batches, and repeats from any of
    them are dropped, also by a batch that is run again."""
    start = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(i if i < 150 else i - 150, "game", start + dt.timedelta(minutes=i)) for i in range(200)], SCHEMA)
    path = scratch_path(spark, "bounded-files")
    assert ST.stage_files(df, path, ["ts", "id"], 5) == 40
    seen = []
    history = ST.touched_history

    def watch(*args):
        prior = history(*args)
        seen.append(len(prior.inputFiles()))
        return prior

    start_batches = ST.start_batches
    again = lambda handler: lambda df, batch_id: [handler(df, batch_id) for _ in range(1 + (batch_id in (16, 17)))]
    monkeypatch.setattr(ST, "touched_history", watch)
    monkeypatch.setattr(ST, "start_batches", lambda stream, handler, *a, **k: start_batches(stream, again(handler), *a, **k))
    got = ST.stream_dedup(spark, path, SCHEMA, "id", "bounded-files", delay="1 minute", buckets=2)
    assert sorted(r.id for r in got.collect()) == list(range(150))
    assert 0 < max(seen) <= 2 + ST.MERGE_EVERY


def test_appends_by_key_keep_a_key_in_its_lane(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("game").alias("source"), (F.lit(dt.datetime(2024, 1, 1)).cast("timestamp_ntz")).alias("ts"))
    path = scratch_path(spark, "by-key")
    ST.stage_files(df, path, ["ts", "id"], 20, by=F.col("id") % 7, lanes=5)
    rows = spark.read.schema(SCHEMA).parquet(path).select("id", F.regexp_extract(F.input_file_name(), r"append-(\d+)-", 1).cast("int").alias("append"))
    rows = [(r.id, r.append) for r in rows.collect()]
    assert sorted(i for i, _ in rows) == list(range(1000))
    assert all(a % 5 == i % 7 % 5 for i, a in rows)
    for lane in range(5):
        own = sorted((a, i) for i, a in rows if a % 5 == lane)
        assert [i for _, i in own] == sorted(i for _, i in own)  # in order
        assert [a // 5 for a, _ in own] == [n // 20 for n in range(len(own))]  # of 20 rows, the last of what is left


def events(spark, n):
    """A table folder with ``n`` events, a minute apart, of ``n // 3`` users."""
    root = scratch_path(spark, "own-tables")
    kind = F.element_at(F.array(*(F.lit(x) for x in ("view", "click", "purchase", "signup"))), (F.col("id") % 4 + 1).cast("int"))
    (spark.range(n).select(F.col("id").alias("event_id"), F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, cast(id as int))").alias("ts"),
                           (F.col("id") % (n // 3)).alias("user_id"), kind.alias("event_type"), (F.col("id") * 1.5).alias("value"))
     .write.parquet(f"{root}/events.parquet"))
    return root


@pytest.fixture
def streams(monkeypatch):
    """Streams that are started, and appends of ten rows."""
    from pyspark.sql.streaming import DataStreamWriter

    from rookery.plans import q_streaming

    begun, start = [], DataStreamWriter.start
    monkeypatch.setattr(DataStreamWriter, "start", lambda self, *a, **k: (begun.append(1), start(self, *a, **k))[1])
    monkeypatch.setattr(q_streaming, "ROWS", 10)
    return begun


def test_long_dedup_runs_in_lanes(spark, streams):
    from rookery.plans import q_streaming

    got = q_streaming.q_stream_dedup(spark, events(spark, 450))
    assert sorted(r.user_id for r in got.collect()) == list(range(150))
    assert len(streams) == 10


def test_long_shards_run_in_lanes(spark, streams):
    from rookery.plans import q_streaming

    got = q_streaming.q_stream_shards(spark, events(spark, 450)).collect()
    assert {(r.shard_start, r.n) for r in got} == {((dt.datetime(2024, 1, 1) + dt.timedelta(minutes=15 * i)).isoformat(" "), 15) for i in range(30)}
    assert len(got) == 30 and len(streams) == 10


def test_long_append_runs_in_lanes(spark, streams):
    from rookery.plans import q_streaming

    got = q_streaming.q_stream_append(spark, events(spark, 450)).collect()
    ratings = [(i, 600 + i * 15 % 2400) for i in range(450)]
    assert sorted((r.puzzle_id, r.rating) for r in got) == [(i, x) for i, x in ratings if 1000 <= x <= 2500]
    assert len(streams) == 10


def test_long_rate_runs_in_lanes(spark, streams):
    from rookery.plans import q_streaming

    got = q_streaming.q_stream_rate(spark, events(spark, 455)).collect()
    assert sorted((r.batch_id, r.n_rows) for r in got) == [(i, 10 if i < 45 else 5) for i in range(46)]
    assert len(streams) == 10
