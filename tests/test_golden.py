"""Golden rows and properties (boundary values, replay, splits, quotas)."""

from __future__ import annotations

from pyspark.sql import functions as F

from rookery.functions.board import replay, replay_states
from rookery.functions.scores import categorize_move, win_probability
from rookery.functions.text import UCI_MOVE, parse_movetext, tokens, valid_prefix
from rookery.operators import evaluation as EV
from rookery.operators import rewards as R
from rookery.operators import sampling as smp
from rookery.operators.scoring import PolicyParams, softmax_policy
from rookery.sources.fixtures import LINES, START_FEN

from conftest import SF_SMALL


def test_replay_matches_golden_fens(spark):
    rows = [(i, u, f) for i, _, u, _, f in LINES if f is not None]
    df = spark.createDataFrame(rows, "id INT, uci STRING, fen STRING")
    df = df.withColumn("mv", valid_prefix(tokens("uci"), UCI_MOVE)).withColumn("s", F.lit(START_FEN))
    out = df.select("id", "fen", replay("s", "mv").alias("got"), replay_states("s", "mv").alias("st")).collect()
    assert len(out) == 12
    for r in out:
        assert r.got == r.fen, r.id
        assert r.st[-1] == r.fen and r.st[0] == START_FEN


def test_special_moves(spark):
    df = spark.createDataFrame([(u,) for i, _, u, _, _ in LINES if i in (12, 13, 14, 15)], "uci STRING")
    df = df.withColumn("mv", valid_prefix(tokens("uci"), UCI_MOVE)).withColumn("s", F.lit(START_FEN))
    got = [r[0] for r in df.select(replay("s", "mv")).collect()]
    assert got[0].startswith("r1bq1rk1/") and " w - - " in got[0]          # both sides castled
    assert got[1].startswith("rnbqkb1r/1p2pppp/p2p1n2/8/8/5N2/")         # en passant removed d5
    assert got[2].startswith("Qn1qkbnr/") and " KQk " in got[2]          # promotion on a8, q right lost
    assert got[3] == "rnbqkbnr/pppp1ppp/8/4p3/4P3/8/PPPP1PPP/RNBQKBNR w KQkq e6 0 2"  # stops before zzzz


def test_movetext_golden(spark):
    df = spark.createDataFrame([("1. e4 { [%clk 0:05:00] } e5 2. Nf3 Nc6 3. Bb5 a6 1-0",)], "m STRING")
    assert df.select(F.array_join(parse_movetext("m"), " ")).first()[0] == "e4 e5 Nf3 Nc6 Bb5 a6"


def test_category_edges(spark):
    vals = [(0, None, "best move"), (1, None, "excellent"), (10, None, "excellent"), (11, None, "good"),
            (30, None, "good"), (31, None, "slight inaccuracy"), (50, None, "slight inaccuracy"),
            (51, None, "inaccuracy"), (100, None, "inaccuracy"), (101, None, "mistake"), (200, None, "mistake"),
            (201, None, "blunder"), (5, 3, "winning mate"), (5, 0, "blunder"), (5, -2, "blunder"),
            (-5, None, "excellent")]
    df = spark.createDataFrame(vals, "l INT, m INT, want STRING")
    for r in df.select(categorize_move("l", "m").alias("got"), "want").collect():
        assert r.got == r.want


def test_histogram_edges(spark):
    edges = {10: "0-10", 11: "10-25", 25: "10-25", 26: "25-50", 50: "25-50", 51: "50-100", 100: "50-100",
             101: "100-200", 200: "100-200", 201: "200+"}
    df = spark.createDataFrame([(k, v) for k, v in edges.items()], "l INT, want STRING")
    for r in df.select(EV.cp_bucket("l").alias("got"), "want").collect():
        assert r.got == r.want


def test_wpd_reward_table(spark):
    table = [(0.0, 1.50), (0.02, 1.22), (0.05, 0.80), (0.10, 0.60), (0.25, 0.00), (0.50, -1.00)]
    df = spark.createDataFrame(table, "wpd DOUBLE, want DOUBLE").withColumn("outcome", F.lit("legal"))
    for r in df.select(R.reward_wpd().alias("got"), "want").collect():
        assert abs(r.got - r.want) < 1e-9


def test_win_probability(spark):
    r = spark.range(1).select(win_probability(F.lit(0)).alias("a"), win_probability(F.lit(400)).alias("b")).first()
    assert abs(r.a - 0.5) < 1e-12 and abs(r.b - 10 / 11) < 1e-12


def test_softmax_sums_to_one_and_respects_floor(spark):
    legal = spark.createDataFrame([(1, m) for m in "abcdefg"] + [(2, "x"), (2, "y")], "pos_id INT, uci STRING")
    scores = spark.createDataFrame([(1, "a", 50), (1, "b", 10), (1, "c", -300)], "pos_id INT, uci STRING, cp INT")
    p = softmax_policy(legal, scores, PolicyParams(100.0, 0.01))
    sums = {r.pos_id: r.s for r in p.groupBy("pos_id").agg(F.sum("prob").alias("s")).collect()}
    assert abs(sums[1] - 1) < 1e-9 and abs(sums[2] - 1) < 1e-9
    assert p.filter("prob < 0.01 - 1e-12").count() == 0
    uni = [r.prob for r in p.filter("pos_id = 2").collect()]
    assert all(abs(x - 0.5) < 1e-12 for x in uni)


def test_bucketed_rank_equals_row_number(spark):
    from rookery.functions.draws import hash_uniform
    from pyspark.sql import Window
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    df = df.withColumn("u", hash_uniform(7, F.col("k")))
    got = smp.bucketed_rank(df, "u", ["k"], ["g"], n_buckets=64).select("g", "k", "rank")
    want = df.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy("u", "k")).cast("bigint"))
    assert got.exceptAll(want.select("g", "k", "rank")).count() == 0
    assert got.count() == 5000


def test_quota_exact_and_partition_invariant(spark):
    from rookery.functions.draws import hash_uniform
    df = spark.range(3000).select(F.when(F.col("id") % 4 == 0, "puzzle").otherwise("game").alias("source"),
                                  F.col("id"), F.lit(0).alias("idx"))
    df = df.withColumn("u", hash_uniform(42, F.col("source"), F.col("id")))
    t = smp.quota_targets(spark, smp.QuotaParams(target_size=1000, games_ratio=0.7))
    a = smp.source_quota(df.repartition(1), t, "u", ["id"]).select("source", "id")
    b = smp.source_quota(df.repartition(7), t, "u", ["id"]).select("source", "id")
    counts = {r.source: r["count"] for r in a.groupBy("source").count().collect()}
    assert counts == {"game": 700, "puzzle": 300}
    assert a.exceptAll(b).count() == 0


def test_fraction_split_exact_and_disjoint(spark):
    df = spark.range(1001).select(F.col("id").alias("k"))
    s = smp.fraction_split(df, "k", test_fraction=0.05)
    assert s.filter("split = 'test'").count() == 51
    assert s.count() == 1001 and s.select("k").distinct().count() == 1001


def test_buffered_holdout_split_sizes(spark):
    df = spark.range(8000).select(F.col("id").alias("k"))
    s = smp.buffered_holdout_split(df, "k", holdout=500, extra=5000)
    c = {(r.split, r.segment): r["count"] for r in s.groupBy("split", "segment").count().collect()}
    assert c == {("eval", 0): 500, ("train", 0): 5000, ("train", 1): 2500}


def test_dense_order(spark):
    df = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("k"))
    d = smp.dense_order(df, ["k"], "pos")
    assert [r.pos for r in d.orderBy("k").collect()] == list(range(1, 3001))


def test_entry_smoke(spark):
    import __spark_entry__ as E
    assert E.entry(spark).count() > 0
    assert SF_SMALL.endswith("sf0.001")


def test_holdout_split_takes_all_rows(spark):
    """The held-out rows are the smallest draws of the whole table."""
    df = spark.range(8000).select(F.col("id").alias("k"))
    s = smp.holdout_split(df, "k", holdout=500)
    held = [r.k for r in s.where("split = 'eval'").collect()]
    assert s.count() == 8000 and len(held) == 500 and max(held) > 7000
    u = smp.hash_uniform_col(42, "k")
    assert set(held) == {r.k for r in df.orderBy(u, "k").limit(500).collect()}


def test_sample_n_takes_all_rows(spark):
    df = spark.range(9000).select(F.col("id").alias("k"))
    got = smp.sample_n(df, "k", 100).collect()
    assert sorted(r.pick for r in got) == list(range(1, 101)) and max(r.k for r in got) > 8000


def test_ratio_interleave_draws_from_the_whole_source(spark):
    rows = spark.range(6000).select(F.when(F.col("id") % 2 == 0, "game").otherwise("puzzle").alias("source"),
                                    F.col("id"), F.lit(0).alias("idx"))
    rows = rows.withColumn("u", smp.hash_uniform_col(1, "id"))
    got = smp.ratio_interleave(spark, rows, 500).collect()
    assert len(got) == 500 and max(r["id"] for r in got) > 5500 and len({(r.source, r["id"]) for r in got}) == 500


def test_phrases_come_from_a_table(spark):
    """Another version of the wording is used by its number; every slot has a phrase."""
    from pyspark.sql import functions as F

    from rookery.operators import assembly as A
    from rookery.operators.phrases import POOLS, phrase_table, with_phrases

    assert all(texts for texts in POOLS.values())
    both = phrase_table(spark).unionByName(phrase_table(spark, {"plan": ["Next: {plan}!"]}, version=9))
    row = spark.createDataFrame([(0.99, "castle")], "u double, p string")
    old = with_phrases(row, both).select(A.pick("plan", F.col("u"), plan=F.col("p")).alias("t")).first().t
    new = with_phrases(row, both, version=9).select(A.pick("plan", F.col("u"), plan=F.col("p")).alias("t"),
                                                    A.pick("plan", F.col("u"), plan=F.lit(None).cast("string")).alias("n")).first()
    assert old == "I would like to castle." and new.t == "Next: castle!" and new.n is None


def test_position_aggregates_equal_the_operators(spark):
    """Policy, profile, avoided move and picks as columns of the scored moves agree with
    the operators on whole tables: positions of one to fourteen moves, of equal and of
    missing scores."""
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from rookery.operators import scoring as SC
    from rookery.operators import selection as SEL

    rows = [(p, i + 1, f"a{i + 1}m{p}", None if p == 5 and i == 1 else 0 if p == 3 else (p * 37 + i * 61) % 401 - 200,
             (i * 97 + p * 13) % 301 - 150, None) for p in range(1, 40) for i in range(1 + p % 14)]
    a = SC.analyse_candidates(spark.createDataFrame(rows, "pos_id long, slot int, uci string, cp int, shallow_cp int, mate_in int"))
    others = ["x1", "x2", "x3"]
    legal = a.select("pos_id", "uci").unionByName(a.select("pos_id").distinct().select("pos_id", F.explode(F.array(*map(F.lit, others))).alias("uci")))
    policy = SC.softmax_policy(legal, a.select("pos_id", "uci", "cp"))
    w = Window.partitionBy("pos_id")
    m = SEL.with_picks(SC.with_policy(a, len(others)).withColumn("p", F.col("prob")).withColumn("bs", F.max("shallow_cp").over(w)))

    want = {(r.pos_id, r.uci): r.prob for r in policy.collect()}
    got = m.select("pos_id", "uci", "prob", "rest_prob", "picked").collect()
    assert all(abs(r.prob - want[r.pos_id, r.uci]) < 1e-12 and abs(r.rest_prob - want[r.pos_id, "x2"]) < 1e-12 for r in got)
    assert {(r.pos_id, r.uci) for r in got if r.picked} == {(r.pos_id, r.uci) for r in SEL.candidate_pool(a).collect()}

    prof = {r.pos_id: r for r in SC.decision_profile(None, None, analysed_df=a, policy_df=policy).collect()}
    g = m.groupBy("pos_id").agg(*[v.alias(k) for k, v in SC.profile_aggregates(len(others)).items()], SEL.avoided_move().alias("avoid"))
    for r in g.withColumns(SC.profile_columns()).collect():
        o = prof[r.pos_id]
        assert (r.best_uci, r.only_move, r.many_options, r.forced_mate, r.close_moves) == \
            (o.best_uci, o.only_move, o.many_options, o.forced_mate, o.close_moves)
        assert abs(r.entropy - o.entropy) < 1e-9 and abs(r.best_prob - o.best_prob) < 1e-12
    avoid = {r.pos_id: r.avoid_uci for r in SEL.avoid_blunder(a, policy, gate=1.1).collect()}
    assert avoid and {r.pos_id: r.avoid for r in g.where("avoid is not null").collect()} == avoid
