"""Byte-level BPE encoding and decoding by prefix dynamic programming.

For every byte prefix of a piece one token is stored: the last token of that
prefix's encoding. A token that ends at a position is that one exactly if the
prefix before it is encoded with a last token that the merges keep apart from
it, and just one token fits. So a longer piece reuses the stored tokens of its
beginning (exact appends), and after an edit the tokens are computed anew only
until they agree with the old ones for as long as the longest token.

Text is first split by a pattern and each match is encoded by itself. Pieces
seen before are remembered in each worker, up to a bound.

Defined results: null counts as the empty text and gives no ids; repeated rows
are encoded alike; an empty table gives an empty result; input columns named
like a new one are replaced. Ids decode to the UTF-8 bytes of the text.
"""

from __future__ import annotations

import base64

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from rookery.llm.cluster import map_texts

NEVER = 1 << 60
REMEMBERED = 300_000  # pieces a worker keeps
PAIRS = 1_000_000     # token pairs a worker keeps


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class Vocabulary:
    """Tokens by rank, how the merges build each, and which may stand side by side."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.longest = max(map(len, ranks))
        self.halves: dict[int, tuple[int, int]] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        ends = ahocorasick.Automaton()
        for t, r in ranks.items():
            if len(t) > 1:
                parts = self._merged(t, r)
                if len(parts) != 2:
                    continue  # the merges never build it
                self.halves[r] = (ranks[parts[0]], ranks[parts[1]])
            ends.add_word(t.decode("latin-1"), r)
        ends.make_automaton()
        self.ends = ends

    def _merged(self, t: bytes, below: int) -> list[bytes]:
        """Parts of ``t`` when the merges of a rank less than ``below`` are done."""
        parts = [t[i:i + 1] for i in range(len(t))]
        while len(parts) > 2:
            best, at = below, -1
            for i in range(len(parts) - 1):
                r = self.ranks.get(parts[i] + parts[i + 1], NEVER)
                if r < best:
                    best, at = r, i
            if at < 0:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def apart(self, left: int, right: int) -> bool:
        """True if no merge crosses the seam when both are spelled out and merged.

        Walks back in time: the later of the two merges at the seam is undone,
        and a crossing merge would have had to come before it. Of equal ranks
        the left one comes first."""
        key = (left, right)
        known = self.pairs.get(key)
        if known is not None:
            return known
        before, ok = NEVER, True
        a, b = left, right
        while True:
            if self.ranks.get(self.token[a] + self.token[b], NEVER) < before:
                ok = False
                break
            made_a, made_b = (a if a in self.halves else -1), (b if b in self.halves else -1)
            if made_a < 0 and made_b < 0:
                break
            if made_a > made_b:
                before, a = a, self.halves[a][1]
            else:
                before, b = b + 1, self.halves[b][0]
        if len(self.pairs) >= PAIRS:
            self.pairs.clear()
        self.pairs[key] = ok
        return ok

    def extend(self, data: bytes, last: list[int], old: list[int] | None = None) -> int:
        """Store the last token of each prefix of ``data`` beyond those that
        ``last`` has (``last[i]``: of the first ``i`` bytes; ``last[0]`` unused).
        ``old``: tokens of the prefixes that end with ``data``, if its end was
        encoded before; they are taken over as soon as a whole longest token's
        worth of positions agrees. Returns the positions computed."""
        done = len(last) - 1
        begin = max(0, done - self.longest)  # a token that ends later may begin here
        last.extend([-1] * (len(data) - done))
        agree, shift = 0, (len(data) + 1 - len(old)) if old is not None else 0
        at = done
        for end, r in self.ends.iter(data[begin:].decode("latin-1")):
            i = begin + end + 1
            if i <= done or last[i] >= 0:
                continue
            if i > at + 1:
                raise ValueError("a byte has no token")
            j = i - self.length[r]
            if j and not self.apart(last[j], r):
                continue
            last[i] = r
            at = i
            if old is not None and i - shift > 0:
                agree = agree + 1 if old[i - shift] == r else 0
                if agree >= self.longest:
                    last[i + 1:] = old[i - shift + 1:]
                    return i - done
        if at < len(data):
            raise ValueError("a byte has no token")
        return at - done

    def walk(self, last: list[int]) -> list[int]:
        """Ids of the whole, from the stored last tokens."""
        ids, i = [], len(last) - 1
        while i > 0:
            ids.append(last[i])
            i -= self.length[last[i]]
        ids.reverse()
        return ids

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        last = [-1]
        self.extend(piece, last)
        return self.walk(last)

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


class Prefixes:
    """One piece under change: appends and edits that keep the stored tokens."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last, self.computed = vocabulary, b"", [-1], 0
        self.append(data)

    def append(self, data: bytes) -> None:
        self.data += data
        self.computed = self.vocabulary.extend(self.data, self.last)

    def replace(self, start: int, end: int, data: bytes) -> None:
        """Put ``data`` in the place of the bytes from ``start`` to ``end``."""
        tail = [-1] + self.last[end + 1:]
        self.data = self.data[:start] + data + self.data[end:]
        del self.last[start + 1:]
        self.computed = self.vocabulary.extend(self.data, self.last, tail)

    def ids(self) -> list[int]:
        whole = self.vocabulary.ranks.get(self.data)
        return [whole] if whole is not None else self.vocabulary.walk(self.last)


class Pieces(dict):
    """Ids of a piece as little-endian 32-bit integers, by its text."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        ids = np.array(self.vocabulary.encode(piece.encode("utf-8")), dtype="<i4").tobytes()
        if len(piece) <= 64:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = ids
        return ids


_LOADED: dict[str, Pieces] = {}


def pieces(path: str) -> Pieces:
    """The vocabulary file's pieces; a worker process reads it once."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(Vocabulary(read_ranks(path)))
    return _LOADED[path]


def _encode(column: pa.Array, path: str, pattern: str) -> list[pa.Array]:
    known, split = pieces(path), regex.compile(pattern).findall
    get = known.__getitem__
    ids = [b"".join(map(get, split(s))) if s else b"" for s in column.to_pylist()]
    ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
    flat = np.frombuffer(b"".join(ids), dtype="<i4")
    return [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]


def _decode(column: pa.ListArray, path: str) -> pa.Array:
    token = pieces(path).vocabulary.token.__getitem__
    offs = column.offsets.to_numpy()
    flat = column.values.to_numpy()
    return pa.array([b"".join(map(token, flat[a:b].tolist())) for a, b in zip(offs[:-1], offs[1:])], type=pa.binary())


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", out: str = "ids",
           keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns) and the ids of each whole text."""
    fields = T.StructType([T.StructField(out, T.ArrayType(T.IntegerType()))])
    return map_texts(df, text_col, fields, lambda c: _encode(c, path, pattern), keep)


def round_trip(df: DataFrame, path: str, pattern: str, text_col: str = "text", ids: str = "ids",
               decoded: str = "decoded", keep: list[str] | None = None) -> DataFrame:
    """:func:`encode`, and the bytes that the ids decode to, in one pass."""
    fields = T.StructType([T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.BinaryType())])

    def both(column: pa.Array) -> list[pa.Array]:
        encoded = _encode(column, path, pattern)
        return encoded + [_decode(encoded[0], path)]

    return map_texts(df, text_col, fields, both, keep)


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """All columns and the bytes of each row's ids (null: no bytes)."""
    names = [n for n in df.columns if n.lower() != out.lower()]
    schema = T.StructType([df.schema[n] for n in names] + [T.StructField(out, T.BinaryType())])

    def run(batches):
        for b in batches:
            if b.num_rows:
                lists = b.column(b.num_columns - 1)
                token = pieces(path).vocabulary.token.__getitem__
                data = [b"".join(map(token, x or [])) for x in lists.to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(i) for i in range(len(names))] + [pa.array(data, type=pa.binary())],
                                                 names=names + [out])

    return df.select(*[df[n] for n in names], df[ids_col].alias("__ids")).mapInArrow(run, schema)
