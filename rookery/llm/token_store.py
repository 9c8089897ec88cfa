"""Token ids as Parquet list columns that allow selective reads.

Texts are dealt by ascending document id into shards, encoded there and written
with bounded row groups and page indexes: dictionary encoding for the ids,
delta encoding for the document ids and lengths. A reader takes only the
columns, row groups and pages that it asks for. The offset of each document in
the whole token stream comes from the shard totals and the lengths before it in
its shard, read back from the files.

Words are encoded by the tokenizers library, each different one about once a
worker: its normaliser and its splitting never join what white space parts, nor
a letter and the punctuation behind it. A worker knows a word by a 64-bit hash.

Defined results: null counts as the empty text and holds the end id alone;
null document ids come first; rows that repeat a document id are kept, in the
order of their texts, and ``start`` is the place in the files; an empty table gives
an empty result. A tokenizer of another kind than the word-splitting ones that the
shortcuts hold for is refused.
"""

from __future__ import annotations

import itertools
import json
import os
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rookery.llm import words as W
from rookery.llm.cluster import map_texts, ship
from rookery.session import scratch_root

REMEMBERED = 1 << 19  # words a worker keeps; the first ones, so the frequent ones
POOLED = 1 << 22      # ids of those words
ENDING = np.zeros(256, dtype=bool)
ENDING[list(b".,;:!?")] = True
PLAIN = np.zeros(256, dtype=bool)  # bytes that are a letter or digit by themselves
PLAIN[[*range(48, 58), *range(65, 91), *range(97, 123)]] = True


def _parts(node: dict | None, of: str) -> list[dict]:
    return [] if node is None else [p for x in node[of] for p in _parts(x, of)] if node.get("type") == "Sequence" else [node]


def folds_case(path: str) -> bool:
    """Whether the tokenizer of a file lowers letters. Raises for one that might join
    what white space parts or a letter and the punctuation behind it: any but byte-level
    ones whose pattern takes letters, digits and the rest apart."""
    with open(path, encoding="utf-8") as f:
        found = json.load(f)
    normal, split = _parts(found.get("normalizer"), "normalizers"), _parts(found.get("pre_tokenizer"), "pretokenizers")
    patterns = [p["pattern"].get("Regex", "") for p in split if p["type"] == "Split"]
    if ([p["type"] for p in split] != ["Split", "ByteLevel"] or split[1].get("add_prefix_space") or split[1].get("use_regex")
            or not all(f"[{x}" in patterns[0] for x in (r"\p{L}]+", r"^\s\p{L}\p{N}]+"))):
        raise ValueError(f"{path}: words of this tokenizer cannot be coded apart")
    if any(p["type"] not in ("NFC", "NFKC", "NFD", "NFKD", "Lowercase", "Replace", "StripAccents") for p in normal):
        raise ValueError(f"{path}: a normalizer of this kind may reach over words")
    return any(p["type"] == "Lowercase" for p in normal)


class Words:
    """Ids of words by the words' 64-bit hashes: an open table in numpy."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.lower = folds_case(path)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self.slots = np.full(4 * REMEMBERED, -1, dtype=np.int32)
        self.shift = W.U(64 - (len(self.slots).bit_length() - 1))
        # of fixed size: arrays that grow by copies leave holes in the heap
        self.n, self.used = 0, 0
        self.keys = np.empty(REMEMBERED, dtype=np.uint64)
        self.begin, self.size = np.empty(REMEMBERED, dtype=np.int32), np.empty(REMEMBERED, dtype=np.int32)
        self.pool = np.empty(POOLED, dtype=np.int32)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Entry of each hash, or -1."""
        out = np.full(len(h), -1, dtype=np.int64)
        left, slot = np.arange(len(h)), (h >> self.shift).astype(np.int64)
        while len(left):
            entry = self.slots[slot]
            used = entry >= 0
            left, slot, entry = left[used], slot[used], entry[used]
            same = self.keys[entry] == h[left]
            out[left[same]] = entry[same]
            left, slot = left[~same], (slot[~same] + 1) % len(self.slots)
        return out

    def keep(self, h: np.ndarray, begin: np.ndarray, size: np.ndarray, pool: np.ndarray) -> None:
        """Remember new words while there is room."""
        n = min(len(h), REMEMBERED - self.n)
        if n <= 0 or self.used + len(pool) > POOLED:
            return
        base, to = self.n, self.n + n
        self.keys[base:to], self.begin[base:to], self.size[base:to] = h[:n], begin[:n] + self.used, size[:n]
        self.pool[self.used:self.used + len(pool)] = pool
        self.n, self.used = to, self.used + len(pool)
        left, slot = np.arange(n), (h[:n] >> self.shift).astype(np.int64)
        while len(left):
            free = self.slots[slot] < 0
            self.slots[slot[free]] = base + left[free]
            lost = self.slots[slot] != base + left
            left, slot = left[lost], (slot[lost] + 1) % len(self.slots)

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some words, end to end, and how many each has."""
        ids, size = [], []
        for at in range(0, len(words), 2048):
            part = [w.decode("utf-8", "replace") for w in words[at:at + 2048]]
            got = [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
            size.append(np.array([len(x) for x in got], dtype=np.int64))
            ids.append(np.fromiter(itertools.chain.from_iterable(got), dtype=np.int32))
        return np.concatenate(ids), np.concatenate(size)


def _pieces(t: W.Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words with a closing punctuation mark behind a letter or digit split off;
    starts, ends and the texts' first ones."""
    last = t.ends - 1
    cut = (t.ends - t.starts > 1) & ENDING[t.buf[last]] & PLAIN[t.buf[np.maximum(last - 1, 0)]]
    at = np.flatnonzero(cut)
    starts, ends = np.insert(t.starts, at + 1, last[at]), np.insert(np.where(cut, last, t.ends), at + 1, t.ends[at])
    return starts, ends, t.first + np.concatenate([[0], np.cumsum(cut)])[t.first]


_LOADED: dict[str, Words] = {}


def _encode(column: pa.Array, path: str, end_id: int) -> list[pa.Array]:
    if path not in _LOADED:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _LOADED[path] = Words(path)
    known, flat, lengths = _LOADED[path], [], []
    for t in W.texts(column):
        starts, ends, first = _pieces(t)
        # A-Z as a-z where the normaliser does that last; not where marks could combine before
        marks = bool(((t.buf == 0xCC) | (t.buf == 0xCD)).any())
        h = W.hash_spans(t.buf, starts, ends, lower=known.lower and not marks)
        entry = known.find(h)
        old = entry >= 0
        begin, size = np.where(old, known.begin[entry], 0), np.where(old, known.size[entry], 0)
        fresh = np.array([end_id], dtype=np.int32)  # ids not in the table; the end id is the first
        if not old.all():
            new, where, which = np.unique(h[~old], return_index=True, return_inverse=True)
            at = np.flatnonzero(~old)
            ids, n = known.encode([t.buf[starts[i]:ends[i]].tobytes() for i in at[where].tolist()])
            to = np.cumsum(n) - n
            begin[at], size[at] = to[which] + 1, n[which]
            fresh = np.concatenate([fresh, ids])
            known.keep(new, to, n, ids)
        # the end id follows each text's words
        begin, size, old = np.insert(begin, first[1:], 0), np.insert(size, first[1:], 1), np.insert(old, first[1:], False)
        until = np.cumsum(size, dtype=np.int64)
        at = np.repeat(begin - (until - size), size) + np.arange(until[-1])
        seen = np.repeat(old, size)
        out = np.empty(len(at), dtype=np.int32)
        out[seen], out[~seen] = known.pool[at[seen]], fresh[at[~seen]]
        flat.append(out)
        lengths.append(np.diff(np.concatenate([[0], until])[first + np.arange(len(first))]))
    offsets = np.concatenate([[0], np.cumsum(np.concatenate(lengths))])
    return [pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(np.concatenate(flat))),
            pa.array(np.diff(offsets))]


def write_tokens(df: DataFrame, tokenizer: str, path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text", shards: int | None = None, row_group_bytes: int = 16 << 20,
                 page_bytes: int = 256 << 10) -> None:
    """Write ``<id_col>, shard, n_tokens, ids`` in ascending ``id_col`` order.

    Texts are shuffled, not ids (they are smaller compressed). One shuffle."""
    spark = df.sparkSession
    folds_case(tokenizer)  # refuses a tokenizer of another kind before anything runs
    n = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    dealt = (df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
             .repartitionByRange(n, F.col("doc_id").asc_nulls_first())
             .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
             .withColumn("shard", F.spark_partition_id()))
    fields = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType())])
    (map_texts(dealt, "text", fields, lambda c: _encode(c, tokenizer, end_id), ["doc_id", "shard"])
     .write.mode("overwrite")
     .option("parquet.block.size", row_group_bytes)
     .option("parquet.page.size", page_bytes)
     .option("parquet.writer.version", "v2")                       # delta encoding for integers
     .option("parquet.enable.dictionary", "false")
     .option("parquet.enable.dictionary#ids.list.element", "true")
     .option("parquet.dictionary.page.size", 1 << 20)
     .option("compression", "zstd")
     .parquet(path))


def _checksums(column: pa.ListArray) -> pa.Array:
    offs = column.offsets.to_numpy()
    flat = np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False)).astype("<u4")
    data = memoryview(flat).cast("B")
    return pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], type=pa.int64())


def read_tokens(spark, path: str, columns: list[str] | None = None, first: int | None = None, last: int | None = None) -> DataFrame:
    """The written columns asked for, and the documents from ``first`` to ``last``.
    Other columns are not read, nor files, row groups and pages of other ids: the
    ids are in order, so the range is pushed down to their statistics."""
    df = spark.read.parquet(path)
    if first is not None:
        df = df.where(F.col("doc_id") >= first)
    if last is not None:
        df = df.where(F.col("doc_id") <= last)
    return df if columns is None else df.select(*columns)


def describe_tokens(spark, path: str) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``.

    ``start``: ids of all documents before it. Only one row a shard is
    gathered for the shards' offsets."""
    ship(spark)
    totals = read_tokens(spark, path, ["shard", "n_tokens"]).groupBy("shard").agg(F.sum("n_tokens").alias("__total"))
    before = (F.sum("__total").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)))
    offsets = totals.select("shard", F.coalesce(before, F.lit(0)).alias("__before"))
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("shard", T.IntegerType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("place", T.LongType()), T.StructField("ids_crc32", T.LongType())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = b.column(4)
                if lists.offset:
                    lists = pa.concat_arrays([lists])
                yield pa.RecordBatch.from_arrays([*b.columns[:4], _checksums(lists)],
                                                 names=schema.names)

    rows = (read_tokens(spark, path).select(F.col("doc_id").cast("long"), "shard", "n_tokens", F.col("_metadata.row_index").alias("place"), "ids")
            .mapInArrow(run, schema))
    inside = Window.partitionBy("shard").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)  # a shard is a file
    return (rows.withColumn("__inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(F.broadcast(offsets), "shard")  # one small row a shard, their number is set by the writer
            .select("doc_id", (F.col("__before") + F.col("__inside")).cast("long").alias("start"), "n_tokens", "ids_crc32"))


def scratch(spark, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
