"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing
names for every operator and pipeline stage."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rookery.llm import (byte_bpe, mixing, ngram_join, pii, quality_model, quality_rules, substring_dedup, token_store, topk,
                         url_filter)

BPE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PIECE = public_tokenizers.path("word_bpe_49k.json")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
PLAIN = " ".join(f"word{i}" for i in range(120))
LONG = " ".join(f"long{i % 9973}x{i}" for i in range(150_000))  # 2 MB
ROWS = [(1, PLAIN, "en", "a", 1), (2, PLAIN, None, "a", None), (2, PLAIN, None, "a", None), (3, None, None, None, None),
        (4, "", "en", "b", 0), (5, " \t\n", "en", "b", 3), (6, "one two", "en", "b", 7), (None, PLAIN + " end", "en", None, 1),
        (7, LONG, "en", "c", len(LONG)), (8, "x" * 300_000, "en", "c", 300_000), (9, "One TWO", "en", "b", 7)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda r: tuple((x is None, str(x)) for x in r))


def words(t):
    return (t or "").encode().split()


def test_quality_rules(docs, empty):
    clash = docs.withColumn("kept", F.lit("old")).withColumn("N_WORDS", F.lit(-1))
    got = quality_rules.quality_rules(clash)
    assert sorted(got.columns).count("kept") == 1 and got.count() == len(ROWS)
    want = sorted(((i, len(words(t)), len(words(t)) < 10) for i, t, *_ in ROWS), key=lambda r: (r[0] is None, str(r)))
    assert [r[:2] for r in rows(got, "doc_id", "n_words")] == [w[:2] for w in sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r[:2]))]
    assert {r.doc_id: r.kept for r in got.collect()}[7] is True
    assert quality_rules.quality_rules(empty).count() == 0


def test_repetition_is_found(spark):
    part = " ".join(f"w{i}" for i in range(30))
    rest = " ".join(f"v{i}" for i in range(200))
    line = "\n".join(["a b c d e f"] * 2 + [f"l{i} l l{i}" for i in range(40)])
    df = spark.createDataFrame([(1, f"{part} {rest}"), (2, f"{part} {rest} {part} {part} {part}"), (3, line)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.quality_rules(df).collect()}
    assert got[1].kept and got[1].n_repeat_words == 0 and got[1].dup_chars_5 == 0
    assert got[2].base_failed and got[2].n_repeat_words == 120 and got[2].dup_chars_10 == 3 * len(part.replace(" ", ""))
    assert got[3].n_dup_lines == 1 and got[3].dup_line_chars == 6


def test_bpe(docs, empty, spark):
    import tiktoken

    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.read_ranks(BPE), special_tokens={})
    got = byte_bpe.round_trip(docs.withColumn("IDS", F.lit(0)), BPE, public_tokenizers.PATTERN)
    assert [c.lower() for c in got.columns].count("ids") == 1
    for r in got.collect():
        assert bytes(r.decoded).decode() == (r.text or "")
        if len(r.text or "") < 100_000:
            assert r["ids"] == enc.encode_ordinary(r.text or "")
    assert byte_bpe.encode(empty, BPE, public_tokenizers.PATTERN).count() == 0
    back = byte_bpe.decode(spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>"), BPE).collect()
    assert [bytes(r.decoded) for r in back] == [b"", b""]


def test_token_store(docs, empty, spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(PIECE)
    path = token_store.scratch(spark, "tokens")
    token_store.write_tokens(docs, PIECE, path, end_id=2, shards=3)
    got = rows(token_store.describe_tokens(spark, path), "start", "n_tokens", "doc_id")
    got.sort()
    assert len(got) == len(ROWS) and got[0][2] is None and got[0][0] == 0
    at = 0
    for start, n, _ in got:
        assert start == at
        at += n
    assert [d for _, _, d in got[1:]] == sorted(d for _, _, d in got[1:])
    n = {d: n for _, n, d in got}
    assert n[3] == n[4] == n[5] == 1
    assert n[1] == len(tok.encode(PLAIN, add_special_tokens=False).ids) + 1
    assert token_store.read_tokens(spark, path, ["doc_id", "n_tokens"]).columns == ["doc_id", "n_tokens"]
    path = token_store.scratch(spark, "tokens")
    token_store.write_tokens(empty, PIECE, path, end_id=2)
    assert token_store.describe_tokens(spark, path).count() == 0


def test_token_files_have_the_encodings(docs, spark):
    import glob

    import pyarrow.parquet as pq

    path = token_store.scratch(spark, "tokens")
    token_store.write_tokens(docs.where("doc_id < 3"), PIECE, path, end_id=2, shards=1)
    meta = [m for m in (pq.ParquetFile(f).metadata for f in glob.glob(f"{path}/part-*")) if m.num_rows][0]
    cols = {meta.row_group(0).column(i).path_in_schema: meta.row_group(0).column(i) for i in range(meta.num_columns)}
    assert "DELTA_BINARY_PACKED" in cols["n_tokens"].encodings
    ids = next(c for n, c in cols.items() if n.startswith("ids"))
    assert ids.has_dictionary_page and ids.has_offset_index


def test_ngram_join(docs, empty):
    got = {(r.doc_id, r.n_shingles): r.component_id for r in ngram_join.jaccard_components(docs, n=5, percent=80).collect()}
    assert got[1, 116] == 1 and got[2, 116] == 1 and got[None, 117] == 1  # a copy, a repeated row, a near copy without id
    assert got[3, 0] == 3 and got[4, 0] == 4 and got[5, 0] == 5
    assert got[6, 1] == 6 and got[9, 1] == 6  # short texts, equal in lower case
    assert got[7, 149_996] == 7
    assert ngram_join.jaccard_components(empty).count() == 0


def test_substring_dedup(docs, empty):
    got = rows(substring_dedup.substring_dedup(docs.withColumn("kept", F.lit(1)), window=50), "doc_id", "n_words", "n_removed")
    want = [(i, len(words(t)), 120 if i == 2 else 0) for i, t, *_ in ROWS]
    assert got == sorted(want, key=lambda r: tuple((x is None, str(x)) for x in r))
    assert substring_dedup.substring_dedup(empty).count() == 0


def test_rows_that_share_an_id(spark):
    """Their positions are not mixed up, and neither removes the other's words."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    df = spark.createDataFrame([(1, a), (2, b), (2, f"x {a} y"), (2, f"z {b}")], "doc_id long, text string")
    got = sorted(tuple(r) for r in substring_dedup.substring_dedup(df, 50).select("n_words", "n_removed", "kept").collect())
    assert got == [(60, 0, a), (60, 0, b), (61, 0, f"z {b}"), (62, 60, "x y")]


def test_pii(docs, empty, spark):
    clash = docs.withColumn("N_entities", F.lit(9))
    for c in ("pieces", "map", "check", "id", "c0", "mention", "found_id"):
        clash = clash.withColumn(c, F.lit("kept"))
    got = pii.replace_pii(clash, "k")
    assert got.where("pieces = 'kept' AND map = 'kept' AND c0 = 'kept' AND found_id = 'kept'").count() == len(ROWS)
    assert [c.lower() for c in got.columns].count("n_entities") == 1
    assert rows(got, "doc_id", "text") == rows(docs, "doc_id", "text")
    assert pii.replace_pii(empty, "k").count() == 0


def test_topk(spark):
    v = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [float("nan"), 1.0]),
         (4, None), (5, [None, 1.0]), (6, [1.0]), (7, []), (None, [1.0, 1.0]), (8, [float("inf"), 0.0]), (9, [-1.0, 0.001])]
    df = spark.createDataFrame(v, "vec_id long, embedding array<float>").withColumn("score", F.lit(1))
    got = topk.top_k(df, F.col("vec_id") % 50 == 0, k=3).collect()
    assert sorted(tuple(r) for r in got if r.query_id == 0) == [(0, 1, 1, 65536), (0, 2, 2, 65536), (0, 3, 50, 32768)]
    assert sorted(tuple(r) for r in got if r.query_id == 50) == [(50, 1, 0, 32768), (50, 2, 1, 32768), (50, 3, 2, 32768)]
    assert topk.top_k(df.where("false"), F.col("vec_id") % 50 == 0).count() == 0


def test_url_filter(spark):
    pages = [(1, None), (2, "no scheme"), (3, "http://A.Example.ORG/es/1?x#y"), (3, "http://A.Example.ORG/es/1?x#y"),
             (4, "http://example.org"), (5, "x://example.org?q=/es/"), (6, "http://notexample.org/es/"), (None, "http://b.com/de/"),
             (7, "http:///p"), (8, "http://org/" + "y" * 100_000), (9, "http://example.org/en/12://z"), (10, "http://..org/")]
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "allow"), ("EXAMPLE.org", "/en/1", "block"),
             ("com", "/de/", "block"), (None, "/", "block"), ("", "", "block"), ("example.org", "/en/", "allow")]
    df = spark.createDataFrame(pages, "page_id long, url string").withColumn("host", F.lit("old")).withColumn("rule", F.lit(1))
    got = url_filter.url_filter(df, spark.createDataFrame(rules, "host string, path string, verdict string"))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and got.count() == len(pages)
    by = {r.page_id: (r.host, r.path[:20], r.rule, r.verdict) for r in got.collect()}
    assert by[1] == by[2] == ("", "", None, "allow")
    assert by[3] == ("a.example.org", "/es/1", "example.org/es/", "block")
    assert by[4] == ("example.org", "", None, "allow") and by[5] == ("example.org", "", None, "allow")
    assert by[6][2:] == ("org/", "allow") and by[None][2:] == ("com/de/", "block")
    assert by[7] == ("", "/p", None, "allow") and by[8][2] == "org/" and by[10][2] == "org/"
    assert by[9] == ("example.org", "/en/12://z", "example.org/en/1", "block")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_filter.url_filter(df, none, default="block").collect()} == {"block"}
    assert url_filter.url_filter(df.where("false"), spark.createDataFrame(rules, "host string, path string, verdict string")).count() == 0


def test_mixing(docs, empty):
    sized = docs.withColumn("size", F.when(F.col("text").isNotNull(), F.size(F.expr(r"regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+', 0)"))))
    got = mixing.mix_sources(sized.withColumn("draws", F.lit(1)))
    taken = got.select("doc_id", "source", "size", "source_size", "target", F.expr("aggregate(draws, 0L, (n, d) -> n + d.words)").alias("taken")).collect()
    assert len(taken) == len(ROWS)
    assert all(r.taken <= 2 * (r.size or 0) for r in taken)
    for source in {r.source for r in taken}:
        own = [r for r in taken if r.source == source]
        assert sum(r.taken for r in own) == round(own[0].target)
        assert own[0].source_size == sum(r.size or 0 for r in own)
    assert mixing.mix_sources(empty.withColumn("size", F.lit(1))).count() == 0


def test_quality_model(docs, empty, spark):
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4, 6, 7, 9)] + [(None, 1), (1, None)], "doc_id long, quality int")
    model = quality_model.train(docs, labels, F.lit(True))
    got = quality_model.score(docs.withColumn("Score", F.lit(1)), model).collect()
    assert len(got) == len(ROWS) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert len({r.score for r in got if r.text == PLAIN}) == 1
    only = quality_model.train(docs, labels.where("quality = 1"), F.lit(True))
    assert {r.predicted for r in quality_model.score(docs, only).collect()} == {1}
    nothing = quality_model.train(docs, labels.where("false"), F.lit(True))
    assert {r.score for r in quality_model.score(docs, nothing).collect()} == {0.5}
    assert quality_model.score(empty, model).count() == 0


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages(spark, docs, empty, name, stage):
    wide = docs.withColumn("extra", F.lit("kept"))
    out = stage(spark, wide, None)
    got = out.collect()
    assert stage(spark, empty, None).count() == 0
    if stage is not corpus_pipeline.tokens:
        assert out.columns == wide.columns
    ids = sorted((r.doc_id for r in got), key=lambda x: (x is None, x or 0))
    if name == "ngram_join":
        assert ids == [1, 3, 4, 5, 6, 7, 8]
    elif name == "quality_rules":
        assert ids == [1, 2, 2, 7, None]
    elif name == "mixing":
        assert set(ids) <= {i for i, *_ in ROWS} and not {3, 4, 5} & set(ids)
    else:
        assert len(got) == len(ROWS)
    if name == "byte_bpe":
        assert {r.doc_id: r.decoded_sha256 for r in got}[7] == hashlib.sha256(LONG.encode()).hexdigest()
