"""Count-min sketches and bit sets that tasks build and Spark merges.

The number of slots is chosen from the input's size. Up to ``MOST_SLOTS`` the
counted slots are broadcast as bits, a proven size; beyond that they stay a table
(``merged``) that rows are joined with, so a sketch stays as selective as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rookery.llm.words import U, mix

MOST_SLOTS = 1 << 27  # a bit each when broadcast: 16 MiB
FLUSH = 1 << 22       # slots a task holds before it hands over its counts
SEEDS = (U(0x243F6A8885A308D3), U(0x13198A2E03707344))


def slots_for(keys: int, each: int = 8, most: int | None = MOST_SLOTS) -> int:
    """A power of two, ``each`` times the keys or a little more, within bounds."""
    slots = max(1 << 16, 1 << max(0, int(keys) * each - 1).bit_length())
    return slots if most is None else min(slots, most)


def rows_of(keys: np.ndarray, slots: int) -> list[np.ndarray]:
    """Slot of each key in each of the sketch's two rows."""
    shift = U(64 - (slots.bit_length() - 1))
    return [(mix(keys ^ s) >> shift).astype(np.int64) + i * slots for i, s in enumerate(SEEDS)]


def partial_counts(keys: Iterator[np.ndarray], slots: int) -> Iterator[pa.RecordBatch]:
    """A task's sketch: its used slots and their counts."""
    held: list[np.ndarray] = []
    size = 0

    def flush() -> Iterator[pa.RecordBatch]:
        if held:
            slot, n = np.unique(np.concatenate(held), return_counts=True)
            for at in range(0, len(slot), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(slot[at:at + 100_000]), pa.array(n[at:at + 100_000].astype(np.int64))],
                                                 names=["slot", "n"])
            held.clear()

    for k in keys:
        held += rows_of(k, slots)
        size += 2 * len(k)
        if size >= FLUSH:
            yield from flush()
            size = 0
    yield from flush()


def merged(df: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], slots: int) -> DataFrame:
    """``slot, n`` of the slots counted twice or more, over the tasks' sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return partial_counts((k for b in batches if b.num_rows for k in keys(b)), slots)

    return df.mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).where("n >= 2")


def repeated(df: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], slots: int) -> np.ndarray:
    """The same as bits, for a number of slots that can be broadcast."""
    return bits(merged(df, keys, slots), F.col("slot"), 2 * slots)


CHUNK = 1 << 16       # slots of a row of merged counts
MOST_COUNTS = 1 << 25  # a byte each when broadcast: 32 MiB


def counts(df: DataFrame, keys: Callable[[pa.RecordBatch], Iterator[np.ndarray]], slots: int) -> np.ndarray:
    """Merged counts of a sketch of one row, at most 255 each. Tasks hand over the
    slots they used, packed by chunk; ``slots`` bytes come to the driver."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [k for b in batches if b.num_rows for k in keys(b)]
        if not held:
            return
        slot, n = np.unique(one_row(np.concatenate(held), slots), return_counts=True)
        starts = np.flatnonzero(np.concatenate([[True], slot[1:] // CHUNK != slot[:-1] // CHUNK]))
        ends = np.append(starts[1:], len(slot))
        yield pa.RecordBatch.from_arrays(
            [pa.array((slot[starts] // CHUNK).astype(np.int32)), pa.array([(slot[a:b] % CHUNK).astype("<u2").tobytes() for a, b in zip(starts, ends)], pa.binary()),
             pa.array([np.minimum(n[a:b], 255).astype(np.uint8).tobytes() for a, b in zip(starts, ends)], pa.binary())], names=["chunk", "at", "n"])

    def add(t: pa.Table) -> pa.Table:
        out = np.zeros(min(CHUNK, slots), dtype=np.int64)
        for at, n in zip(t.column("at").to_pylist(), t.column("n").to_pylist()):
            out[np.frombuffer(at, dtype="<u2")] += np.frombuffer(n, dtype=np.uint8)
        return pa.table({"chunk": pa.array([t.column("chunk")[0].as_py()], pa.int32()), "n": pa.array([np.minimum(out, 255).astype(np.uint8).tobytes()], pa.binary())})

    merged_rows = df.mapInArrow(run, "chunk int, at binary, n binary").groupBy("chunk").applyInArrow(add, "chunk int, n binary").toArrow()
    out = np.zeros(slots, dtype=np.uint8)
    for chunk, n in zip(merged_rows.column("chunk").to_pylist(), merged_rows.column("n").to_pylist()):
        out[chunk * CHUNK:chunk * CHUNK + len(n)] = np.frombuffer(n, dtype=np.uint8)
    return out


def one_row(keys: np.ndarray, slots: int) -> np.ndarray:
    return (mix(keys ^ SEEDS[0]) >> U(64 - (slots.bit_length() - 1))).astype(np.int64)


def bits(df: DataFrame, slot: Column, size: int) -> np.ndarray:
    """The bit set of the slots in ``df``: at most ``size / 64`` rows of two
    numbers come to the driver."""
    words = (df.select(slot.cast("long").alias("slot")).groupBy(F.shiftrightunsigned("slot", 6).alias("word"))
             .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 AS int)))").alias("bits")).toArrow())
    out = np.zeros(size // 64, dtype=np.uint64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return out


def has(bitset: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (bitset[slot >> 6] >> (slot & 63).astype(np.uint64)) & U(1) == U(1)


def maybe_repeated(bitset: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False only for keys that were counted once."""
    slots = len(bitset) * 64 // 2
    a, b = rows_of(keys, slots)
    return has(bitset, a) & has(bitset, b)
