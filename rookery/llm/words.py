"""Words of whole texts as numpy arrays, taken from Arrow string columns.

A word is a longest run of bytes other than 0x20 and 0x09-0x0D. Texts are laid
end to end in buffers of about a megabyte (a longer text has one of its own),
so each numpy call handles hundreds of texts and memory stays bounded.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BUFFER = 1 << 20
U = np.uint64
ODD = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))  # bases of the two polynomial hashes

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

_codes = np.random.default_rng(20).integers(1, 1 << 63, size=256, dtype=np.uint64) * U(2) + U(1)
CODES = {False: _codes, True: _codes.copy()}
CODES[True][65:91] = _codes[97:123]  # A-Z hash as a-z


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _powers(n: int, base: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    inverse = U(pow(int(base), -1, 1 << 64))
    up, down = np.full(n, base), np.full(n, inverse)
    up[0] = down[0] = U(1)
    return np.cumprod(up), np.cumprod(down)


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def powers() -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES:
        _TABLES.append(_powers(BUFFER + 1, ODD[0]))
    return _TABLES[0]


def spans(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte buffer."""
    gap = np.ones(len(buf) + 2, dtype=bool)
    gap[1:-1] = SPACE[buf]
    edges = np.flatnonzero(gap[1:] != gap[:-1])
    return edges[0::2], edges[1::2]


def hash_spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each span; spans are in order and do not overlap."""
    up, down = powers()
    codes = CODES[lower]
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        s0 = starts[i]
        j = int(np.searchsorted(ends, s0 + BUFFER, side="right"))
        if j <= i:  # one word longer than a buffer
            h, shift = 0, 1
            for p in range(int(s0), int(ends[i]), BUFFER):
                part = codes[buf[p:min(p + BUFFER, int(ends[i]))]]
                h += int(np.sum(part * up[:len(part)], dtype=np.uint64)) * shift
                shift = shift * int(up[BUFFER]) % (1 << 64)
            out[i] = h % (1 << 64)
            i += 1
            continue
        part = codes[buf[s0:ends[j - 1]]]
        run = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum(part * up[:len(part)], out=run[1:])
        s, e = starts[i:j] - s0, ends[i:j] - s0
        out[i:j] = (run[e] - run[s]) * down[s]
        i = j
    lengths = (ends - starts).astype(np.uint64)
    return mix(out ^ (lengths * U(0xD6E8FEB86659FD93)))


def grams(h: np.ndarray, k: int, base: int = 0) -> np.ndarray:
    """Hash of every run of ``k`` consecutive values (by doubling)."""
    if len(h) < k:
        return np.empty(0, dtype=np.uint64)
    power, width, done, total = h if base == 0 else mix(h + U(base)), 1, None, 0
    scale = int(ODD[base])
    while True:
        if k & width:
            if done is None:
                done, total = power, width
            else:  # the longer run comes first
                done = power[:len(power) - total] * U(pow(int(ODD[base]), total, 1 << 64)) + done[width:]
                total += width
                done = done[:len(h) - total + 1]
        width *= 2
        if width > k:
            break
        power = power[:len(power) - width // 2] * U(scale) + power[width // 2:]
        scale = scale * scale % (1 << 64)
    return mix(done[:len(h) - k + 1])


@dataclass
class Texts:
    """Some texts of a batch, laid end to end. Text ``i`` of them is row
    ``row + i`` and has the words ``first[i]`` to ``first[i + 1]``."""
    row: int
    buf: np.ndarray
    offsets: np.ndarray  # bytes
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    def __len__(self) -> int:
        return len(self.first) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        """Text of each word."""
        return np.repeat(np.arange(len(self)), self.counts)

    def hashes(self, lower: bool = False) -> np.ndarray:
        return hash_spans(self.buf, self.starts, self.ends, lower)

    def inside(self, k: int) -> np.ndarray:
        """Word positions at which a run of ``k`` words of one text starts."""
        if len(self.starts) < k:
            return np.empty(0, dtype=np.int64)
        o = self.owner
        return np.flatnonzero(o[:len(o) - k + 1] == o[k - 1:])

    def bytes(self, i: int) -> bytes:
        return self.buf[self.offsets[i]:self.offsets[i + 1] - 1].tobytes()


def raw(column: pa.Array) -> tuple[memoryview, np.ndarray]:
    """Bytes and offsets of a string column."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()[:3]
    offs = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return memoryview(data if data is not None else b""), offs


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[Texts]:
    """The texts of a string column in buffers; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_string(column.type) and not pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    n = len(column)
    if not n:
        return
    if column.null_count:
        column = column.fill_null("")
    data, offs = raw(column)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offs, offs[at] + BUFFER, side="right")) - 1)
        to = min(to, n)
        parts = [data[offs[i]:offs[i + 1]] for i in range(at, to)]
        buf = np.frombuffer(b" ".join(parts) + b" ", dtype=np.uint8)
        offsets = offs[at:to + 1].astype(np.int64) - int(offs[at]) + np.arange(to - at + 1)
        starts, ends = spans(buf)
        first = np.searchsorted(starts, offsets)
        yield Texts(at, buf, offsets, starts, ends, first)
        at = to
