"""Streaming queries. Each stages its input from the
driver tables as ordered files, runs a Structured Streaming query to
completion and returns the sink; the oracle is the equivalent batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.functions.text import tokens
from rookery.plans import sqlfrag as S
from rookery.plans.registry import register
from rookery.sources.fixtures import fx_puzzles, with_fx
from rookery.sources.sinks import scratch_path
from rookery.sources.tables import table
from rookery.streaming import streams as ST

EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("puzzle_id", T.LongType()),
    T.StructField("rating", T.IntegerType()), T.StructField("themes", T.StringType()),
    T.StructField("user_id", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
])
QUOTA = {"game": 700, "puzzle": 300}
ROWS = 4000  # of a trigger


def staged_events(spark, sf, by=None, lanes=1):
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type")
    p = fx_puzzles(spark, sf).join(e, F.col("puzzle_id") == F.col("event_id"))
    src = F.when(F.col("event_type").isin("purchase", "signup"), "puzzle").otherwise("game")
    p = p.select(F.col("event_id").alias("id"), "puzzle_id", "rating", "themes", "user_id", src.alias("source"),
                 "ts")
    path = scratch_path(spark, "events-stream")
    return path, ST.stage_files(p, path, ["ts", "id"], ROWS, by=by, lanes=lanes)


EVENTS_SQL = ("ev AS (SELECT p.puzzle_id AS id, p.puzzle_id, p.rating, p.themes, e.user_id, CASE WHEN e.event_type IN "
              "('purchase', 'signup') THEN 'puzzle' ELSE 'game' END AS source, p.ts FROM fx_puzzles p "
              "JOIN events e ON e.event_id = p.puzzle_id)")


@register("stream_append", with_fx(
    f"WITH {EVENTS_SQL} SELECT puzzle_id, rating, CAST(len({S.tokens('coalesce(themes, ' + chr(39) + chr(39) + ')')}) "
    "AS INT) AS n_themes FROM ev WHERE rating BETWEEN 1000 AND 2500", "fx_puzzles"))
def q_stream_append(spark, sf):
    """File source -> per-row annotation -> idempotent append sink."""
    src, appends = staged_events(spark, sf)

    def annotate(s):
        return s.filter(F.col("rating").between(1000, 2500)).select(
            "puzzle_id", "rating", F.size(tokens(F.coalesce(F.col("themes"), F.lit("")))).alias("n_themes"))
    return ST.stream_append(spark, src, EVENT_SCHEMA, annotate, "append", ST.lanes_of(appends)).drop("batch_id")


@register("stream_shards", with_fx(
    f"WITH {EVENTS_SQL} SELECT CAST(time_bucket(INTERVAL 15 minutes, ts) AS VARCHAR) AS shard_start, count(*) AS n "
    "FROM ev GROUP BY 1", "fx_puzzles"))
def q_stream_shards(spark, sf):
    """Timed shards: 15-minute tumbling windows, watermark-bounded state."""
    src, appends = staged_events(spark, sf)
    w = ST.stream_window_counts(spark, src, EVENT_SCHEMA, "shards", lanes=ST.lanes_of(appends))
    return w.select(F.date_format("shard_start", "yyyy-MM-dd HH:mm:ss").alias("shard_start"), "n")


@register("stream_quota", with_fx(
    f"WITH {EVENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY ts, id) AS rk FROM ev) "
    "SELECT source, id FROM r WHERE rk <= CASE source WHEN 'game' THEN " + str(QUOTA["game"]) + " ELSE "
    + str(QUOTA["puzzle"]) + " END", "fx_puzzles"))
def q_stream_quota(spark, sf):
    src, _ = staged_events(spark, sf)
    return ST.stream_quota(spark, src, EVENT_SCHEMA, QUOTA, "quota").select("source", "id")


@register("stream_dedup", with_fx(f"WITH {EVENTS_SQL} SELECT DISTINCT user_id FROM ev", "fx_puzzles"))
def q_stream_dedup(spark, sf):
    # a lane has the keys of its own buckets; the count, of the files' footers, only says how many lanes
    lanes = ST.lanes_of(table(spark, sf, "events").count() // ROWS)
    src, _ = staged_events(spark, sf, ST.key_bucket("user_id"), lanes)
    return ST.stream_dedup(spark, src, EVENT_SCHEMA, "user_id", "dedup", lanes=lanes)


@register("stream_rate", with_fx(
    f"WITH {EVENTS_SQL}, r AS (SELECT row_number() OVER (ORDER BY ts, id) AS rn FROM ev) "
    f"SELECT CAST((rn - 1) // {ROWS} AS INT) AS batch_id, count(*) AS n_rows FROM r GROUP BY 1", "fx_puzzles"))
def q_stream_rate(spark, sf):
    """A bound in rows a trigger: every batch but the last has exactly that many."""
    src, appends = staged_events(spark, sf)
    return ST.stream_batch_sizes(spark, src, EVENT_SCHEMA, "rate", lanes=ST.lanes_of(appends))


SCORED_SCHEMA = T.StructType([
    T.StructField("prompt_id", T.LongType()), T.StructField("sample_id", T.LongType()),
    T.StructField("outcome", T.StringType()), T.StructField("reward", T.DoubleType()),
])


def _stats_sql():
    from rookery.plans.q_rewards import SCORED_SQL
    return with_fx(f"WITH {SCORED_SQL} SELECT outcome, count(*) AS n, round(sum(reward_topn), 6) AS total "
                   "FROM scored GROUP BY outcome", "fx_rollouts", "fx_positions", "fx_valid_list", "fx_candidates")


@register("stream_stats", _stats_sql())
def q_stream_stats(spark, sf):
    """Running reward statistics over a stream of scored completions."""
    from rookery.plans.q_rewards import scored
    s = scored(spark, sf).select("prompt_id", "sample_id", "outcome", F.col("reward_topn").alias("reward"))
    path = scratch_path(spark, "rollouts-stream")
    ST.stage_files(s, path, ["prompt_id", "sample_id"], ROWS)
    out = ST.stream_running_stats(spark, path, SCORED_SCHEMA, "outcome", "reward", "stats")
    return out.select("outcome", "n", F.round("total", 6).alias("total"))
