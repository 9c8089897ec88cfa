"""Plan-shape checks: properties that matter at scale, read from the
physical plan (AQE off so the static plan is inspected)."""

from __future__ import annotations

import re

from conftest import SF_SMALL

import __spark_entry__ as E


def _plan(spark, key: str) -> str:
    df = E.queries()[key](spark, SF_SMALL)
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", prev)


def test_policy_never_shuffles_on_move_pairs(spark):
    """The floored softmax joins legal moves to a per-position score map on
    the position key only: no exchange on (pos_id, uci)."""
    for key in ("softmax_policy", "decision_profile"):
        plan = _plan(spark, key)
        assert not re.search(r"hashpartitioning\(pos_id#\d+L?, uci#", plan), key


def test_position_scan_prunes_columns(spark):
    """Positions only need the order key: the orders scan reads one column."""
    plan = _plan(spark, "fen_key")
    schemas = re.findall(r"orders\.parquet.*?ReadSchema: (struct<[^>]*>)", plan)
    assert schemas and all(s == "struct<o_orderkey:bigint>" for s in schemas), schemas


def test_quota_ranks_inside_draw_buckets(spark):
    """Exact quotas rank rows inside (source, draw bucket) partitions, so a
    source holding most rows is still spread over many tasks."""
    plan = _plan(spark, "source_quota")
    assert re.search(r"Window \[.*\], \[source#\d+, _b#\d+\]", plan), plan[:2000]


def test_rewards_join_without_the_text(spark):
    """Format and tag rewards come from the completion before the joins."""
    plan = _plan(spark, "reward_total")
    for line in plan.splitlines():
        if "Exchange hashpartitioning" in line:
            assert "completion#" not in line and "text#" not in line, line
    assert not re.search(r"SortMergeJoin[^\n]*\n[^\n]*Project \[[^\]]*RLIKE", plan)


def test_moves_join_by_position_only(spark):
    plan = _plan(spark, "edge_delta_motifs")
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_board_features_do_not_explode(spark):
    """A board's features are made in its row: one exchange for the distinct
    boards and those of the join back."""
    for key in ("material_balance", "hanging_pieces", "motif_rank"):
        plan = _plan(spark, key)
        assert "Generate" not in plan and plan.count("Exchange hashpartitioning") <= 3, key


def test_diversity_scans_documents_once(spark):
    assert _plan(spark, "group_diversity").count("documents.parquet") == 1
    assert _plan(spark, "class_mix_sample").count("documents.parquet") == 1


def test_score_tables_merge_without_a_shuffle(spark):
    """Three tables written apart, in the same buckets; moves are missing in two."""
    from pyspark.sql import functions as F

    from rookery.plans.q_selection import depth_merge
    from rookery.sources.sinks import write_bucketed

    moves = spark.range(300).select(F.col("id").alias("pos_id"), F.concat(F.lit("m"), (F.col("id") % 5).cast("string")).alias("uci"))
    tables = [write_bucketed(moves.where(keep).withColumn(c, F.col("pos_id") * k), f"probe_{c}", ["pos_id", "uci"], 4)
              for c, keep, k in (("cp", "true", 1), ("shallow_cp", "pos_id % 3 > 0", 2), ("confirm_cp", "pos_id % 2 > 0", 3))]
    merged = depth_merge(*tables)
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 2, plan
    rows = {r.pos_id: r for r in merged.collect()}
    assert len(rows) == 300 and rows[7].shallow_cp == 14 and rows[7].confirm_cp == 21
    assert rows[6].shallow_cp is None and rows[6].confirm_cp is None and rows[4].shallow_cp == 8 and rows[4].confirm_cp is None


def test_rewards_of_a_user_in_arrow(spark):
    import pyarrow.compute as pc

    from rookery.operators import rewards as R

    df = spark.createDataFrame([(1, 10.0, 2.0), (2, None, 1.0), (3, 4.0, 0.0)], "i int, a double, reward_format double")
    try:
        R.register_arrow_reward("double_a", lambda a: pc.multiply(a, 2), ["a"])
        R.register_arrow_reward("sum_of", lambda a, b: pc.add(a, b), ["a", "reward_format"])
        got = df.select("i", R.reward_total(["format", "double_a"]).alias("r"), R.reward_total(["sum_of"]).alias("s")).collect()
        assert {r.i: (r.r, r.s) for r in got} == {1: (22.0, 12.0), 2: (1.0, 0.0), 3: (8.0, 4.0)}
        R.register_arrow_reward("short", lambda a: a.slice(0, 1), ["a"])
        try:
            df.coalesce(1).select(R.reward_total(["short"])).collect()
            raise AssertionError("a reward of too few values passed")
        except Exception as ex:  # noqa: BLE001
            assert "returned 1 values" in str(ex)
    finally:
        for k in ("double_a", "sum_of", "short"):
            R.REWARDS.pop(k, None)


def test_traces_join_inside_buckets(spark, monkeypatch):
    """Traces are made from two tables in the same buckets of the position: one
    shuffle makes the candidates, few the positions, none comes after."""
    from rookery.plans import q_traces

    made = {}
    write = q_traces.write_bucketed

    def watch(df, name, keys, buckets):
        made[name] = df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
        return write(df, name, keys, buckets)

    monkeypatch.setattr(q_traces, "write_bucketed", watch)
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = E.queries()["trace_rows"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    # but for the one-row table of phrases
    assert set(re.findall(r"Exchange hashpartitioning\((\w+)#", plan)) <= {"slot"}, plan
    assert made["analysed"] == 1 and made["positions"] <= 12


def test_depth_merge_has_the_probes_of_all_moves(spark, tmp_path):
    """Both probes score every move of a position, however far down it ranks."""
    import datetime as dt

    rows = [(1, 10 + i, 3, i + 1, 10.0, 1000.5 + 40 * i, "N", dt.date(2024, 1, 1 + i)) for i in range(12)]
    spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber long, l_quantity double, "
                                "l_extendedprice double, l_returnflag string, l_shipdate date").write.parquet(str(tmp_path / "lineitem.parquet"))
    got = E.queries()["depth_merge"](spark, str(tmp_path)).collect()
    assert len(got) == 12 and all(r.shallow_cp is not None and r.confirm_cp is not None and r.shallow_wp is not None for r in got)


def test_traces_pass_no_positions_through_the_driver(spark):
    """Whatever sizes Spark estimates, what grows with the positions is merged
    inside the buckets: only the one row of phrases is broadcast."""
    prev = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    for key in ("candidate_order", "decision_frame", "failed_attempts", "line_explainer"):
        df = E.queries()[key](spark, SF_SMALL)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
        try:
            plan = df._jdf.queryExecution().executedPlan().toString()
        finally:
            for k, v in prev.items():
                spark.conf.set(k, v)
        assert "BroadcastHashJoin" not in plan and plan.count("BroadcastExchange") <= 1, (key, plan)


def test_boards_are_dealt_over_all_tasks(spark):
    """The features of the boards are much work on few bytes: as many tasks make
    them as a shuffle has, though AQE sees a few kilobytes only. A join by board
    does not make the edited boards twice."""
    from rookery.operators import board as BD
    from rookery.sources.fixtures import fx_positions

    pos = fx_positions(spark, SF_SMALL).select("pos_id", "fen")
    assert BD.boards(pos).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert not pos.schema["fen"].nullable
    plan = _plan(spark, "backward_pawns")
    assert not re.search(r"isnotnull\((CASE|fen#|coalesce)", plan), plan


def test_positions_meet_their_boards_without_a_broadcast(spark, monkeypatch):
    """Positions are small files of few boards, but a row each: written tables of the
    traces never send them through the driver, whatever Spark estimates."""
    from rookery.plans import q_traces as Q

    plans = {}

    def in_buckets(df, name):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        raise StopIteration

    monkeypatch.setattr(Q, "in_buckets", in_buckets)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1g")
    try:
        Q.position_table(spark, SF_SMALL)
    except StopIteration:
        pass
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert re.search(r"SortMergeJoin \[fen#", plans["positions"]), plans["positions"]
    assert "BuildLeft" not in plans["positions"]


def test_traces_draw_and_look_up_only_what_they_use(spark):
    """No draw is made before its gate, a slot is searched in the map once, for the row
    of phrases, and the sections are not gathered under a lambda."""
    df = E.queries()["assemble_sections"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "u_opp_phrase" not in plan and "u_walk_phrase" not in plan
    searched = re.findall(r"element_at\(phrases#\d+, (\w+)", plan)
    assert searched and len(searched) == len(set(searched)) and "element_at(phrases" not in plan[:plan.index("Join Cross")], plan
    assert not re.search(r"filter\(array\(concat_ws", plan)


def test_traces_read_the_candidates_once(spark, monkeypatch):
    """Policy, profile, picks and lines come from one scan of the analysed candidates,
    and a query writes no board features that it does not read."""
    from rookery.plans import q_traces

    written = {}
    write = q_traces.write_bucketed

    def watch(df, name, keys, buckets):
        written[name] = set(df.columns)
        return write(df, name, keys, buckets)

    monkeypatch.setattr(q_traces, "write_bucketed", watch)
    for key, board in (("capped_enrichment", False), ("conclusion_pool", False), ("pv_gate", False), ("context_hint", False),
                       ("phrase_pick", False), ("trace_rows", True)):
        plan = _plan(spark, key)
        assert len(re.findall(r"FileScan parquet \S*analysed_", plan)) == 1, key
        assert ("top_motif" in written["positions"]) == board, key


def test_boards_without_lines_of_sight(spark):
    """Forks and cues need the attacked squares only, not what stands on and behind them."""
    for key in ("fork_targets", "positional_cues"):
        plan = _plan(spark, key)
        assert "cells" in plan and "behind" not in plan, key
    assert "behind" in _plan(spark, "motif_rank")
