"""JSONL / parquet sinks, shards and the evaluation report."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.operators import evaluation as EV
from rookery.operators import sampling as smp
from rookery.plans import sqlfrag as S
from rookery.plans.registry import register
from rookery.sources import shards, sinks
from rookery.sources.fixtures import fx_positions, fx_puzzles, with_fx

BFX = ("fx_positions", "fx_valid_list", "fx_candidates")
LINES_PER_SHARD = 1000


def _basic_sql():
    from rookery.plans.q_text import BASIC_SQL
    return BASIC_SQL


def trace_rows_basic(spark, sf):
    """Trace rows with the fallback trace (the sink is independent of the
    trace generator, which has its own keys)."""
    from rookery.plans.q_text import basic_rows
    b = basic_rows(spark, sf)
    return b.select("pos_id", "fen", "valid_moves", F.concat(F.lit("Play "), F.col("chosen_move"), F.lit("."))
                    .alias("reasoning_trace"), "chosen_move")


ROW_SQL = ("SELECT fen, array_to_string(valid_moves, ', ') AS valid_moves, 'Play ' || chosen_move || '.' "
           "AS reasoning_trace, chosen_move FROM basic")


@register("jsonl_roundtrip", with_fx(f"WITH {_basic_sql()} {ROW_SQL}", *BFX))
def q_jsonl_roundtrip(spark, sf):
    """4-column rows -> JSON lines (UTF-8, non-ASCII kept) -> read back with
    the fixed schema."""
    rows = trace_rows_basic(spark, sf).select("fen", "valid_moves", "reasoning_trace", "chosen_move")
    path = sinks.scratch_path(spark, "traces-jsonl")
    sinks.write_jsonl(rows, path)
    back = sinks.read_jsonl(spark, path)
    return back.select("fen", F.array_join("valid_moves", ", ").alias("valid_moves"), "reasoning_trace",
                       "chosen_move")


@register("jsonl_to_parquet", with_fx(f"WITH {_basic_sql()} {ROW_SQL}", *BFX))
def q_jsonl_to_parquet(spark, sf):
    rows = trace_rows_basic(spark, sf).select("fen", "valid_moves", "reasoning_trace", "chosen_move")
    src = sinks.scratch_path(spark, "traces-jsonl")
    dst = sinks.scratch_path(spark, "traces-parquet")
    sinks.write_jsonl(rows, src)
    p = sinks.jsonl_to_parquet(spark, src, dst)
    return p.select("fen", F.array_join("valid_moves", ", ").alias("valid_moves"), "reasoning_trace", "chosen_move")


@register("shard_by_lines", with_fx(
    f"WITH {_basic_sql()} SELECT printf('split-%06d.jsonl', CAST(floor((rn - 1) / {LINES_PER_SHARD}) AS BIGINT)) AS shard_name, "
    "fen, array_to_string(valid_moves, ', ') AS valid_moves, 'Play ' || chosen_move || '.' AS reasoning_trace, chosen_move "
    "FROM (SELECT *, row_number() OVER (ORDER BY pos_id) AS rn FROM basic)", *BFX))
def q_shard_by_lines(spark, sf):
    """Seal a shard every N lines: dense stream position (range-partitioned
    sort + per-partition offsets) -> sealed shards, and read back from those."""
    rows = trace_rows_basic(spark, sf)
    d = shards.by_lines(smp.dense_order(rows, ["pos_id"], "stream_pos"), "stream_pos", LINES_PER_SHARD)
    sink = shards.ShardSink(spark, sinks.scratch_path(spark, "shards"))
    sink.seal(d.select("shard", "line", "fen", "valid_moves", "reasoning_trace", "chosen_move"))
    back = sink.read("fen string, valid_moves array<string>, reasoning_trace string, chosen_move string")
    return back.select("shard_name", "fen", F.array_join("valid_moves", ", ").alias("valid_moves"), "reasoning_trace", "chosen_move")


INTERVAL_LINES = 200


@register("shard_by_interval", with_fx(
    "WITH w AS (SELECT puzzle_id, time_bucket(INTERVAL 6 hours, ts) AS w, row_number() OVER (PARTITION BY "
    "time_bucket(INTERVAL 6 hours, ts) ORDER BY ts, puzzle_id) - 1 AS i FROM fx_puzzles) "
    f"SELECT printf('split-%06d.jsonl', dense_rank() OVER (ORDER BY w, i // {INTERVAL_LINES}) - 1) AS shard_name, puzzle_id, "
    "CAST(w AS VARCHAR) AS shard_start FROM w", "fx_puzzles"))
def q_shard_by_interval(spark, sf):
    """Seal every six hours of event time, earlier if a shard is full."""
    # windows work on TIMESTAMP_NTZ directly, so the session time zone never shifts shard bounds
    p = smp.dense_order(fx_puzzles(spark, sf).select("puzzle_id", "ts"), ["ts", "puzzle_id"], "stream_pos")
    d = shards.by_interval(p, "stream_pos", "ts", "6 hours", INTERVAL_LINES)
    start = F.date_format(F.window("ts", "6 hours").getField("start"), "yyyy-MM-dd HH:mm:ss")
    sink = shards.ShardSink(spark, sinks.scratch_path(spark, "shards"))
    sink.seal(d.select("shard", "line", "puzzle_id", start.alias("shard_start")), reason="interval")
    return sink.read("puzzle_id long, shard_start string").select("shard_name", "puzzle_id", "shard_start")


def _report_sql():
    from rookery.plans.q_rewards import EVAL_SQL, METRICS_SQL
    return with_fx(
        f"WITH {EVAL_SQL}, m AS (SELECT {METRICS_SQL} FROM flags), "
        "c AS (SELECT *, CASE WHEN is_exact_match THEN 'exact' WHEN is_legal THEN 'legal' ELSE 'fail' END AS cls, "
        f"{S.uniform(42, 'prompt_id', 'sample_id')} AS u FROM flags), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY u, prompt_id, sample_id) AS pick FROM c), "
        "k AS (SELECT *, CASE cls WHEN 'exact' THEN 0 WHEN 'legal' THEN 1 ELSE 2 END AS cls_ord FROM r "
        "WHERE pick <= CASE cls WHEN 'exact' THEN 4 ELSE 3 END), "
        "s AS (SELECT prompt_id, sample_id, cls, row_number() OVER (ORDER BY cls_ord, u, prompt_id, sample_id) "
        "AS slot FROM k) "
        "SELECT CAST(to_json(struct_pack(config := struct_pack(seed := 42, top_n := 5), "
        "metrics := (SELECT struct_pack(num_samples := num_samples, tag_parse_rate := tag_parse_rate, "
        "legal_move_rate := legal_move_rate, exact_match_rate := exact_match_rate, avg_centipawn_loss := "
        "avg_centipawn_loss) FROM m), samples := (SELECT list(struct_pack(prompt_id := prompt_id, sample_id := "
        "sample_id, cls := cls) ORDER BY slot) FROM s))) AS VARCHAR) AS report",
        "fx_rollouts", "fx_positions", "fx_valid_list", "fx_candidates")


@register("eval_report_json", _report_sql())
def q_eval_report_json(spark, sf):
    """Nested results document: config, metrics, bounded example list."""
    from rookery.plans.q_rewards import eval_flags, metrics_frame
    flags = eval_flags(spark, sf)
    m = metrics_frame(flags)
    s = EV.class_mix_sample(flags).select("prompt_id", "sample_id", "cls", "slot")
    samples = s.agg(F.array_sort(F.collect_list(F.struct("slot", "prompt_id", "sample_id", "cls"))).alias("_s"))
    samples = samples.select(F.transform("_s", lambda x: F.struct(x["prompt_id"].alias("prompt_id"),
                                                                  x["sample_id"].alias("sample_id"),
                                                                  x["cls"].alias("cls"))).alias("samples"))
    doc = m.crossJoin(samples).select(F.to_json(F.struct(
        F.struct(F.lit(42).alias("seed"), F.lit(5).alias("top_n")).alias("config"),
        F.struct("num_samples", "tag_parse_rate", "legal_move_rate", "exact_match_rate",
                 "avg_centipawn_loss").alias("metrics"),
        F.col("samples"))).alias("report"))
    return doc
