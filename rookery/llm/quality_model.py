"""Quality classifier: attention-based multiple-instance learning.

A document is a bag of passages of ``PASSAGE`` words; every passage of the whole
text is encoded (hashed words and surface figures, then a hidden layer), gated
attention weighs the passages, and the weighted sum is scored. The weights are
learned from document labels alone.

Fitting uses a bounded sample: for each label the ``per_label`` training rows
that come first by a hash of the id, with all their passages. Scoring reads every
passage of every document.

Defined results: a null or blank text is one empty passage and has a score;
repeated rows get equal scores; a document with several label rows counts with
the smallest; with labels of one kind only the score is 0 or 1, without any 0.5;
an empty table gives an empty result; input columns named like a new one are
replaced. Only the text makes a score.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.llm import words as W
from rookery.llm.cluster import map_texts, word_count
from rookery.session import cut_lineage

PASSAGE = 64
BUCKETS = 128
SURFACE = 12
WIDTH = BUCKETS + SURFACE
HIDDEN, GATE = 16, 8

_KINDS = np.zeros((5, 256), dtype=bool)
_KINDS[0, list(b"#*$%&|<>")] = True
_KINDS[1, list(b"!?.,;:'\"()-")] = True
_KINDS[2, 48:58] = True
_KINDS[3, 65:91] = True
_KINDS[4, 128:] = True


def passages(t: W.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Features of each passage and the first passage of each text."""
    counts = t.counts
    per = np.maximum(1, -(-counts // PASSAGE))
    first = np.concatenate([[0], np.cumsum(per)])
    x = np.zeros((first[-1], WIDTH), dtype=np.float32)
    if len(t.starts):
        owner = t.owner
        of = first[owner] + (np.arange(len(owner)) - t.first[owner]) // PASSAGE
        h = t.hashes(lower=True)
        size = np.maximum(np.bincount(of, minlength=len(x)), 1).astype(np.float32)
        bucket = (h >> W.U(57)).astype(np.int64)
        x[:, :BUCKETS] = np.sqrt(np.bincount(of * BUCKETS + bucket, minlength=len(x) * BUCKETS).reshape(-1, BUCKETS) / size[:, None])
        length = (t.ends - t.starts).astype(np.float32)
        add = lambda v: np.bincount(of, weights=v, minlength=len(x)) / size
        for i, kind in enumerate(_KINDS):
            run = np.concatenate([[0], np.cumsum(kind[t.buf])])
            x[:, BUCKETS + i] = add(run[t.ends] - run[t.starts])
        x[:, BUCKETS + 5] = add(length)
        x[:, BUCKETS + 6] = add(length * length) ** 0.5
        same = np.zeros(len(h))
        same[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        x[:, BUCKETS + 7] = add(same)
        keyed = h ^ W.mix(of.astype(np.uint64))  # a word in its passage
        key = np.sort(keyed)
        twice = np.unique(key[1:][key[1:] == key[:-1]])
        x[:, BUCKETS + 8] = add(np.isin(keyed, twice)) if len(twice) else 0
        x[:, BUCKETS + 9] = add(length <= 2)
        caps = _KINDS[3][t.buf[t.starts]] & _KINDS[3][t.buf[np.maximum(t.ends - 2, t.starts)]]
        x[:, BUCKETS + 10] = add(caps)
        x[:, BUCKETS + 11] = np.log1p(np.bincount(of, minlength=len(x)))
    return x, first


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    w: dict[str, np.ndarray]

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if "constant" in self.w:
            return np.full(len(first) - 1, float(self.w["constant"]))
        return forward(self.w, (x - self.mean) / self.scale, first)[0].astype(np.float64)


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def forward(w: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray):
    at = first[:-1]
    h = np.tanh(x @ w["W"] + w["b"])
    tv, su = np.tanh(h @ w["V"]), _sigmoid(h @ w["U"])
    logit = (tv * su) @ w["a"]
    per = np.diff(first)
    e = np.exp(logit - np.repeat(np.maximum.reduceat(logit, at), per))
    attention = e / np.repeat(np.add.reduceat(e, at), per)
    z = np.add.reduceat(attention[:, None] * h, at, axis=0)
    return _sigmoid(z @ w["c"] + w["d"]), (h, tv, su, attention, z, per)


def gradients(w, x, first, y):
    p, (h, tv, su, attention, z, per) = forward(w, x, first)
    g = (p - y) / len(y)
    gz = np.repeat(g, per)[:, None] * w["c"][None, :]
    ga = (gz * h).sum(axis=1)
    gl = attention * (ga - np.repeat(np.add.reduceat(attention * ga, first[:-1]), per))
    gtv, gsu = gl[:, None] * w["a"] * su * (1 - tv * tv), gl[:, None] * w["a"] * tv * su * (1 - su)
    gh = (attention[:, None] * gz + gtv @ w["V"].T + gsu @ w["U"].T) * (1 - h * h)
    return {"W": x.T @ gh, "b": gh.sum(axis=0), "V": h.T @ gtv, "U": h.T @ gsu, "a": (tv * su).T @ gl,
            "c": z.T @ g, "d": g.sum(keepdims=True)}


def fit(bags: list[np.ndarray], y: np.ndarray, epochs: int = 40, batch: int = 64, rate: float = 0.01,
        decay: float = 1e-2, seed: int = 20) -> Model:
    """Adam over shuffled batches of documents."""
    if not len(y) or len(set(y.tolist())) < 2:
        return Model(np.zeros(1), np.ones(1), {"constant": np.array(float(y[0]) if len(y) else 0.5)})
    flat = np.concatenate(bags)
    mean, scale = flat.mean(axis=0), np.maximum(flat.std(axis=0), 0.02)
    bags = [(b - mean) / scale for b in bags]
    rng = np.random.default_rng(seed)
    size = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "a": (GATE,), "c": (HIDDEN,), "d": (1,)}
    w = {k: (rng.normal(0, 1 / np.sqrt(s[0]), s) if len(s) > 1 or k in "ac" else np.zeros(s)).astype(np.float32) for k, s in size.items()}
    m, v, step = {k: np.zeros_like(x) for k, x in w.items()}, {k: np.zeros_like(x) for k, x in w.items()}, 0
    for _ in range(epochs):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), batch):
            part = order[at:at + batch]
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in part])])
            g = gradients(w, np.concatenate([bags[i] for i in part]), first, y[part].astype(np.float32))
            step += 1
            for k in w:
                d = g[k] + decay * w[k]
                m[k] = 0.9 * m[k] + 0.1 * d
                v[k] = 0.999 * v[k] + 0.001 * d * d
                w[k] = (w[k] - rate * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)).astype(np.float32)
    return Model(mean, scale, w)


def train(docs: DataFrame, labels: DataFrame, fold: Column, per_label: int = 1500, most_words: int = 20_000_000,
          id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> Model:
    """Fit on at most ``per_label`` documents of each label among the label rows
    that ``fold`` (a condition on the id) takes, in the order of a hash. Of a
    document every passage counts; a document that begins after ``most_words`` words
    of others is not chosen, which bounds what is gathered."""
    known = (labels.where(fold & F.col(f"`{label_col}`").isin(0, 1) & F.col(f"`{id_col}`").isNotNull())
             .groupBy(F.col(f"`{id_col}`").alias("__id")).agg(F.min(f"`{label_col}`").alias("label")))
    order = [F.xxhash64(F.lit("sample"), "__id"), F.col("__id")]
    sample = known.where("label = 0").orderBy(*order).limit(per_label).union(known.where("label = 1").orderBy(*order).limit(per_label))
    # at most two times per_label small rows
    chosen = cut_lineage(docs.join(F.broadcast(sample), F.col(f"`{id_col}`") == F.col("__id")).select("__id", "label", F.col(f"`{text_col}`").alias("text")))
    sized = chosen.groupBy("__id").agg(F.sum(word_count(F.col("text"))).alias("words"))
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)  # two times per_label rows at most
    within = sized.withColumn("before", F.coalesce(F.sum("words").over(before), F.lit(0))).where(F.col("before") < most_words).select("__id")
    chosen = chosen.join(F.broadcast(within), "__id")

    def features(column: pa.Array) -> list[pa.Array]:
        out = []
        for t in W.texts(column):
            x, first = passages(t)
            out += [x[a:b].astype("<f4").tobytes() for a, b in zip(first[:-1], first[1:])]
        return [pa.array(out, pa.binary())]

    got = map_texts(chosen, "text", T.StructType([T.StructField("bag", T.BinaryType())]), features, ["__id", "label"]).toArrow()
    rows = sorted(zip(got.column("__id").to_pylist(), got.column("label").to_pylist(), got.column("bag").to_pylist()))
    bags = [np.frombuffer(b, dtype="<f4").reshape(-1, WIDTH) for _, _, b in rows]
    return fit(bags, np.array([y for _, y, _ in rows], dtype=np.int64))


def score(df: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns), ``score`` and ``predicted``."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    fields = T.StructType([T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def run(column: pa.Array) -> list[pa.Array]:
        p = np.concatenate([shared.value.score(*passages(t)) for t in W.texts(column)])
        return [pa.array(p), pa.array((p >= 0.5).astype(np.int32))]

    return map_texts(df, text_col, fields, run, keep)
