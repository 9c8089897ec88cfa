"""What only large inputs meet, forced by small parameters: a full sketch, a hot
host, large cells, repeated ids, a splitting tree that decides."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rookery.llm import cells, mixing, ngram_join, quality_model, substring_dedup, token_store, url_filter
from test_exact import _components, _sets

PIECE = public_tokenizers.path("word_bpe_49k.json")


def test_substring_dedup_beyond_the_broadcast(spark):
    """A sketch too large to be broadcast is joined by slot; the answer is the same."""
    rng = random.Random(8)
    shared = [" ".join(f"s{k}_{i}" for i in range(70)) for k in range(4)]
    rows = []
    for i in range(120):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([5, 60, 200]))]
        if i % 3 == 0:
            own[2:2] = shared[i % 4].split()
        rows.append((i if i % 40 else None, " ".join(own)))
    rows += [(7, rows[7][1]), (500, rows[9][1]), (501, None), (502, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    small = sorted(map(tuple, substring_dedup.substring_dedup(df, 50).collect()), key=str)
    large = sorted(map(tuple, substring_dedup.substring_dedup(df, 50, most_slots=1).collect()), key=str)
    assert small == large and sum(r[2] for r in large) > 1000


def test_url_filter_splits_a_hot_host(spark):
    """Nine pages of ten under one domain: no part of it has more than about its share."""
    rng = random.Random(3)
    pages = [(i, f"http://{'a%d.' % (i % 50) if i % 2 else ''}hot.org/{rng.choice(['x/', 'y/', ''])}{i}" if i % 10 else f"http://h{i}.net/{i}") for i in range(5000)]
    rules = [("hot.org", "/x/", "block"), ("org", "/", "allow"), ("hot.org", "/", "block"), ("net", "/1", "block")]
    df, rd = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(rules, "host string, path string, verdict string")
    whole = sorted(map(tuple, url_filter.url_filter(df, rd).collect()))
    split = sorted(map(tuple, url_filter.url_filter(df, rd, per_task=100).collect()))
    assert whole == split
    rows = df.select(F.col("page_id").alias("__id"), url_filter.host_of(F.col("url")).alias("full_host"))
    probes = url_filter.parents_of(rows, 2)
    parts = {r.host: r.parts for r in url_filter.parts_of(probes, rd.select("host").distinct(), 100).collect()}
    assert parts["org"] == parts["hot.org"] == 45 and parts["net"] == 5
    most = (probes.join(spark.createDataFrame(list(parts.items()), "host string, parts int"), "host")
            .groupBy("host", F.pmod(F.xxhash64("__id", "full_host"), F.col("parts"))).count().agg(F.max("count")).first()[0])
    assert most < 200


@pytest.mark.parametrize("most_counts", [1 << 25, 1])
def test_large_cells(spark, monkeypatch, most_counts):
    """Sets that share a passage and near copies in one cluster, in many blocks; the
    order by a sketch and the one by joined counts."""
    monkeypatch.setattr(cells, "BLOCK", 8)
    monkeypatch.setattr(cells, "PIVOTS", 2)
    rng = random.Random(12)
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(passage + [f"w{rng.randrange(300)}" for _ in range(40)])))
    base = passage + [f"c{i}" for i in range(60)]
    for i in range(60, 140):
        text = list(base)
        for k in range(rng.choice([1, 2, 3, 4])):
            text[rng.randrange(len(text))] = f"x{i}_{k}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.component_id for r in ngram_join.jaccard_components(df, n=4, percent=80, most_counts=most_counts).collect()}
    assert got == _components(_sets(rows, 4), 80)


def test_tokens_of_repeated_ids_keep_their_place(spark):
    rows = [(5, "b words here"), (5, "a longer text of words"), (5, None), (4, "first"), (6, "last one"), (5, "a longer text of words")]
    path = token_store.scratch(spark, "tokens")
    token_store.write_tokens(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), PIECE, path, end_id=2, shards=2)
    files = sorted(f for f in spark.read.parquet(path).inputFiles())
    at, place = 0, []
    for f in files:
        for r in spark.read.parquet(f).withColumn("i", F.col("_metadata.row_index")).orderBy("i").collect():
            place.append((r.doc_id, at, r.n_tokens))
            at += r.n_tokens
    assert sorted((r.doc_id, r.start, r.n_tokens) for r in token_store.describe_tokens(spark, path).collect()) == sorted(place)
    some = token_store.read_tokens(spark, path, ["doc_id", "ids"], first=5, last=5)
    assert some.count() == 4 and "PushedFilters: [IsNotNull(doc_id), GreaterThanOrEqual(doc_id,5), LessThanOrEqual(doc_id,5)]" in \
        some._jdf.queryExecution().executedPlan().toString().replace("\n", " ")


def test_other_tokenizers_are_refused(tmp_path):
    import json

    assert token_store.folds_case(PIECE)
    with open(PIECE) as f:
        spec = json.load(f)
    spec["normalizer"]["normalizers"] = [n for n in spec["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    cased = tmp_path / "cased.json"
    cased.write_text(json.dumps(spec))
    assert not token_store.folds_case(str(cased))
    for change in ({"pre_tokenizer": {"type": "Metaspace"}}, {"pre_tokenizer": None}, {"normalizer": {"type": "Precompiled"}}):
        other = tmp_path / "other.json"
        other.write_text(json.dumps(spec | change))
        with pytest.raises(ValueError):
            token_store.folds_case(str(other))


def test_cased_tokenizer(spark, tmp_path):
    import json

    from tokenizers import Tokenizer

    with open(PIECE) as f:
        spec = json.load(f)
    spec["normalizer"]["normalizers"] = [n for n in spec["normalizer"]["normalizers"] if n["type"] != "Lowercase"]
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(spec))
    texts = ["The the THE tHe", "Word word. Word, WORD!"]
    out = token_store.scratch(spark, "tokens")
    token_store.write_tokens(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), str(path), out, end_id=2)
    tok = Tokenizer.from_file(str(path))
    assert {r.doc_id: list(r.ids) for r in token_store.read_tokens(spark, out).collect()} == {
        i: tok.encode(t, add_special_tokens=False).ids + [2] for i, t in enumerate(texts)}


def test_the_splitting_tree_decides(spark):
    """Another seed of the tree deals the same draws to other shards."""
    rng = random.Random(9)
    rows = [(i, rng.choice("abc"), rng.randrange(1, 400)) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumns({c: F.lit("x") for c in ("__sid", "__block", "__size", "__cut")})
    one, two = (mixing.mix_sources(df, mix=mixing.Mix(shards=5, tree_seed=s)) for s in (1, 2))
    assert one.where("__sid = 'x' AND __block = 'x' AND __size = 'x' AND __cut = 'x'").count() == 600
    a, b = ({r.doc_id: r.draws for r in m.collect()} for m in (one, two))
    assert a != b
    assert {k: sorted((d["round"], d["words"]) for d in v) for k, v in a.items()} == {k: sorted((d["round"], d["words"]) for d in v) for k, v in b.items()}
    laid = mixing.mixture(one).withColumn("p", F.spark_partition_id()).select("p", "draw.shard").distinct().collect()
    assert len({r["shard"] for r in laid}) == 5 and len(laid) == 5  # a shard is in one partition


def test_pipeline_keeps_the_least_of_rows_that_repeat_a_document(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(1, text, "fr", "b", 1), (1, text, "en", "b", 1), (1, text, "en", "a", 2), (2, "other words " + text[:50], "en", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for parts in (1, 4):
        got = corpus_pipeline.one_of_each_group(spark, docs.repartition(parts), "").collect()
        assert sorted((r.doc_id, r.lang, r.source, r.n_chars) for r in got) == [(1, "en", "a", 2), (2, "en", None, None)]


def test_quality_model_reads_all_passages_of_what_it_chooses(spark):
    rows = [(i, " ".join(("good" if i % 2 else "bad ##") + f" w{j % 50}" for j in range(30))) for i in range(60)]
    rows.append((61, " ".join(f"w{j % 50}" for j in range(6000)) + " bad ## " * 60))
    docs, labels = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen = []
    fit = quality_model.fit
    try:
        quality_model.fit = lambda bags, y, **k: seen.append(sorted(len(b) for b in bags)) or fit(bags, y, **k)
        quality_model.train(docs, labels, F.lit(True))
        quality_model.train(docs, labels, F.lit(True), most_words=200)
    finally:
        quality_model.fit = fit
    assert len(seen[0]) == 61 and seen[0][-1] == -(-len(rows[-1][1].split()) // quality_model.PASSAGE)
    assert 3 <= len(seen[1]) <= 8
