"""The conversation trie, MinHash dedup and hard negatives: brute force, odd rows,
and the paths that only larger inputs take, forced by small parameters."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rookery.llm import cells, hard_negatives, minhash, ngram_join, prefix_trie
from test_exact import _components, _sets

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TALK = "conv_id long, turn int, role string, text string"


# ---- conversation trie -------------------------------------------------------

def h(c):
    return zlib.crc32(str(c).encode()) % 4


def digest(role, text):
    return hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def rebuilt(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    own = {c: [x[2] for x in sorted(v, key=lambda x: x[:2])] for c, v in own.items()}
    return {c: own.get(c - int(np.fmod(c, 20)), [])[:h(c)] + own[c][h(c):] for c in own}


def brute_trie(rows):
    seqs = {c: tuple(s) for c, s in rebuilt(rows).items()}
    nodes = defaultdict(list)
    for c, s in seqs.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    kids = defaultdict(int)
    for s in nodes:
        if s:
            kids[s[:-1]] += 1
    out = []
    for s, members in nodes.items():
        below = [x for x in nodes if x[:len(s)] == s]
        saved = sum((len(nodes[x]) - 1) * (len(WORD.findall(x[-1][1])) if x else 0) for x in below)
        ends = ",".join(str(c) for c in sorted(c for c in members if seqs[c] == s))
        out.append((min(members), len(s), min(nodes[s[:-1]]) if s else None, len(members), kids[s],
                    sum(1 for x in below if not kids[x]), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(spark, rows, **sizes):
    df = spark.createDataFrame(rows, TALK).withColumn("conv", F.lit("x")).withColumn("key", F.lit(1))
    turns = prefix_trie.conversation_turns(df.repartition(5))
    shared = prefix_trie.share_heads(turns, 20, lambda c: F.crc32(c.cast("string").cast("binary")) % 4, most=4)
    got = prefix_trie.prefix_trie(*shared, **sizes)
    return sorted((tuple(r) for r in got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def talks(n, long=12, seed=5):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(rng.choice([1, 2, 3, 4, 6, long])):
            rows.append((c, t, rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randrange(2)))))
    return rows


ODD = [(None, 1, "user", "lost"), (7, None, None, None), (7, None, "user", "x y"), (7, 2, "user", ""), (7, 2, "user", ""), (7, 1, "user", "one"),
       (8, 1, "user", "t " * 3000), (20, 1, "a", "b"), (21, 1, "a", "b"), (21, 2, "a", "c"), (40, 0, "", "only"), (41, 0, "", "only"), (-3, 1, "a", "b"), (-3, 2, "z", "b")]


@pytest.mark.parametrize("sizes", [{}, {"segment": 3, "shard_rows": 8}, {"segment": 5, "shard_rows": 10}])
def test_trie(spark, sizes):
    rows = talks(70) + [(c + 1000, *r) for c, *r in ODD if c is not None] + ODD[:1] + [r for r in ODD if r[0] is not None and r[0] < 0]
    rng = random.Random(1)
    rng.shuffle(rows)
    assert trie(spark, rows, **sizes) == brute_trie(rows)


def test_trie_of_many_copies_and_one_long_conversation(spark):
    """Copies are one sequence; a conversation longer than a segment is never one row."""
    rows = [(c, t, "user", f"same {t}") for c in range(400, 520) for t in range(3)]
    rows += [(999, t, "user", f"turn {t % 7}") for t in range(150)] + [(998, t, "user", f"turn {t % 7}") for t in range(140)]
    assert trie(spark, rows, segment=16, shard_rows=8) == brute_trie(rows)


def test_empty_trie(spark):
    assert trie(spark, []) == [] and trie(spark, [(None, 1, "a", "b")]) == []


def test_double_array():
    rng = random.Random(2)
    seqs = sorted({tuple(rng.randrange(1, 9) for _ in range(rng.randrange(0, 6))) for _ in range(300)} | {(i,) for i in range(1, 200)})
    codes = np.array([x for s in seqs for x in s])
    first = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    da = prefix_trie.DoubleArray(codes, first, 200)
    at = {}
    for s in seqs:
        node = 0
        for i, c in enumerate(s):
            node = int(da.step(np.array([node]), np.array([c]))[0])
            assert at.setdefault(node, s[:i + 1]) == s[:i + 1]
    assert len(at) == len({s[:i] for s in seqs for i in range(1, len(s) + 1)})


def test_turns_are_numbered_over_borders(spark):
    rows = [(5, t, "u", str(t)) for t in range(1000)] + [(6, 0, "u", "x")]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = prefix_trie.conversation_turns(spark.createDataFrame(rows, TALK)).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sorted(r.pos for r in got if r.conv == 5) == list(range(1000)) and [r.pos for r in got if r.conv == 6] == [0]


# ---- MinHash -----------------------------------------------------------------

def families(n, seed=9):
    rng = random.Random(seed)
    rows = []
    boiler = [f"b{i}" for i in range(60)]
    for f in range(n):
        base = [f"w{rng.randrange(4000)}" for _ in range(rng.choice([30, 80, 160]))]
        if f % 3 == 0:
            base = boiler + base
        for _ in range(rng.choice([1, 1, 2, 6])):
            text = list(base)
            for _ in range(rng.choice([0, 1, 2, 3, 5])):
                text[rng.randrange(len(text))] = f"e{rng.randrange(9999)}"
            rows.append((len(rows), " ".join(text)))
    return rows


def found(df):
    return {r.doc_id: r.component_id for r in df.collect()}


@pytest.mark.parametrize("block", [192, 4])
def test_minhash(spark, monkeypatch, block):
    monkeypatch.setattr(cells, "BLOCK", block)
    monkeypatch.setattr(minhash, "BLOCK", block)
    rows = families(60)
    got = found(minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), n=5, percent=85))
    assert got == _components(_sets(rows, 5), 85)


def test_minhash_of_one_large_group(spark, monkeypatch):
    """Near copies of one text, some only linked through others, under every key."""
    monkeypatch.setattr(cells, "BLOCK", 16)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):
        text = list(base)
        for k in range(rng.choice([1, 2, 3, 4, 5, 6])):
            text[rng.randrange(150)] = f"x{i}_{k}"
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = _components(_sets(rows, 5), 85)
    assert len(set(want.values())) > 1
    assert found(minhash.near_duplicates(df, n=5, percent=85)) == want
    assert found(ngram_join.jaccard_components(df, n=5, percent=85)) == want


def test_minhash_odd_rows(spark):
    plain = " ".join(f"word{i}" for i in range(120))
    rows = [(1, plain), (2, plain), (2, plain), (3, None), (4, ""), (5, " \t\n"), (6, "one two"), (9, "One TWO"), (None, plain + " end"), (8, "x" * 300_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("g", F.lit(1)).withColumn("sig", F.lit("s")).withColumn("key", F.lit(0))
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(1, 116, 1), (2, 116, 1), (2, 116, 1), (None, 117, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (9, 1, 6), (8, 1, 8)], key=str)
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_signatures_guarantee():
    """Pairs within the radius share a key; the radius is rarely exceeded by linked sets."""
    rng = np.random.default_rng(3)
    r = minhash.radius(85)
    chunk = minhash.chunks(r)
    a = rng.integers(0, 1 << 16, (200, minhash.SLOTS)).astype(np.uint16)
    b = a.copy()
    for i in range(200):
        at = rng.choice(minhash.SLOTS, r, replace=False)
        b[i, at] ^= 1
    ka, kb = minhash.keys(a, chunk), minhash.keys(b, chunk)
    assert all(set(x.tolist()) & set(y.tolist()) for x, y in zip(ka, kb))
    base = rng.integers(0, 1 << 63, 1000, dtype=np.uint64)
    far = 0
    for i in range(60):
        other = np.unique(np.concatenate([base[:919], rng.integers(0, 1 << 63, 81, dtype=np.uint64)]))  # Jaccard 0.85
        far = max(far, int((minhash.signatures([np.sort(base)]) != minhash.signatures([other])).sum()))
    assert 10 < far <= r


# ---- hard negatives ----------------------------------------------------------

VECTORS = "vec_id long, embedding array<double>, label int"


def brute_negatives(rows, every=5, positives=5, negatives=3):
    best = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        item = ([int(np.floor(256 * x)) for x in v], lab)
        best[i] = min(best.get(i, item), item)
    out = []
    for a, (v, lab) in best.items():
        if a % every:
            continue
        scores = sorted((-int(np.dot(np.array(v, dtype=object), np.array(w, dtype=object))) if v else 0, i, x) for i, (w, x) in best.items() if i != a and len(w) == len(v))
        for s, p, _ in [x for x in scores if x[2] == lab][:positives]:
            inside = [(n, i) for n, i, x in scores if x != lab and 50 * -s <= 100 * -n <= 95 * -s]
            out += [(a, p, r + 1, i, -s, -n) for r, (n, i) in enumerate(inside[:negatives])]
    return sorted(out)


@pytest.mark.parametrize("block", [4096, 7])
def test_hard_negatives(spark, block):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5, 1.0]) for _ in range(6)], rng.randrange(4)) for i in range(120)]
    rows += [(200, None, 1), (205, [1.0, None, 0.0, 0.0, 0.0, 0.0], 1), (210, [float("nan")] * 6, 1), (215, [float("inf")] * 6, 1), (220, [1.0] * 6, None),
             (None, [1.0] * 6, 1), (225, [1.0, 0.5], 2), (226, [1.0, 0.5], 2), (227, [0.9, 0.4], 1), (230, [], 1), (10, [1.0] * 6, 0), (10, [1.0] * 6, 0), (235, [3.0e6] * 6, 1),
             (236, [2.9e6] * 6, 1), (237, [2.0e6] * 6, 2), (240, [0.0] * 6, 3)]
    df = spark.createDataFrame(rows, VECTORS).withColumn("id", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("vec", F.lit(2)).withColumn("dim", F.lit(3))
    got = hard_negatives.hard_negatives(df.repartition(3), F.col("vec_id") % 5 == 0, F.col("label"), block=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)


def test_hard_negatives_of_equal_vectors_and_none(spark):
    rows = [(i, [0.5, 0.5], i % 2) for i in range(60)] + [(100 + i, [0.4, 0.4], i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, VECTORS)
    got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0, F.col("label"), block=16)
    assert sorted(tuple(r) for r in got.collect()) == brute_negatives(rows)
    assert hard_negatives.hard_negatives(df.limit(0), F.col("vec_id") % 5 == 0, F.col("label")).count() == 0
    assert hard_negatives.hard_negatives(df, F.col("vec_id") < 0, F.col("label")).count() == 0
