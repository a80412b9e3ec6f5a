"""Whole-batch text work on Arrow buffers.

The texts of a batch are one byte array with row bounds. Word spans, word hashes and window hashes are array operations
over it, so the cost is a few passes over the bytes and no Python step per word. Batches are taken in chunks of whole
rows, so the arrays stay small; a text longer than a chunk is a chunk of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

# The byte classes of the two word definitions, and odd multipliers of the hashes.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[9:14] = NOT_SPACE[32] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0xD6E8FEB86659FD93)
_VALUES = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as a chunk needs them."""

    up = down = np.ones(1, np.uint64)

    @classmethod
    def to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) <= n:
            size = max(n + 1, CHUNK_BYTES + 1)
            cls.up, cls.down = (
                np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size, base, np.uint64))])
                for base in (_BASE, pow(_BASE, -1, 2**64))
            )
        return cls.up, cls.down


def slice_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each slice that depends on its bytes alone: differences of prefix sums of weighted byte values."""
    up, down = _Powers.to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUES[data] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts, and the bounds of each (null counts as empty)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def row_chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes; at least one row each."""
    low, rows = 0, len(bounds) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(bounds, bounds[low] + limit, side="right")) - 1)
        yield low, high
        low = high


class Words:
    """The words of some texts: byte spans, the first word of each text, and a hash of each word."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, classes: np.ndarray) -> None:
        self.data, self.bounds = LOWER[data], bounds
        inside = classes[self.data]
        before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        full = bounds[:-1] < bounds[1:]
        before[bounds[:-1][full]] = after[bounds[1:][full] - 1] = False
        self.starts = np.flatnonzero(inside & ~before)
        self.ends = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self.hashes = slice_hashes(self.data, self.starts, self.ends)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all runs of ``n`` words that stay inside one text."""
        last = np.repeat(self.first[1:], self.counts) - n
        starts = np.flatnonzero(np.arange(len(last)) <= last)
        total = np.zeros(len(starts), np.uint64)
        for k in range(n):
            total = total * _STEP + self.hashes[starts + k]
        return starts, mix(total)

    def run(self, start: int, n: int) -> bytes:
        """The words of a run, joined by single spaces."""
        return b" ".join(self.data[self.starts[k]:self.ends[k]].tobytes() for k in range(start, start + n))


def word_chunks(column: pa.Array, classes: np.ndarray) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) over a column of texts."""
    data, bounds = text_bytes(column)
    for low, high in row_chunks(bounds):
        yield low, high, Words(data[bounds[low]:bounds[high]], bounds[low:high + 1] - bounds[low], classes)


def gather(table: np.ndarray, table_bounds: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table entries of ``keys`` one after the other, and where each begins (and the end)."""
    lengths = np.diff(table_bounds)[keys]
    bounds = np.concatenate([np.zeros(1, np.int64), np.cumsum(lengths)])
    return table[np.repeat(table_bounds[:-1][keys] - bounds[:-1], lengths) + np.arange(bounds[-1])], bounds


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple[int, ...], pa.Table]]:
    """The runs of rows with equal integer ``keys`` of a sorted partition; one run at a time is held."""
    key, parts = None, []
    for batch in batches:
        values = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], axis=1)
        cuts = (np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist()
        for low, high in zip([0, *cuts], [*cuts, len(values)], strict=True):
            if low == high:
                continue
            own = tuple(values[low].tolist())
            if own != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = own
            parts.append(batch.slice(low, high - low))
    if parts:
        yield key, pa.Table.from_batches(parts)


def smallest_connected(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For each of ``n`` nodes the smallest node it is connected with by the links (u, v)."""
    label, before = np.arange(n), None
    while before is None or (before != label).any():
        before = label.copy()
        np.minimum.at(label, u, before[v])
        np.minimum.at(label, v, before[u])
        label = label[label]
    return label


def whole_runs(batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """Stretches of complete runs, of about ``least`` rows or one longer run, with the first row of each run (and the end)."""
    held: list[pa.RecordBatch] = []
    values: list[np.ndarray] = []

    def cut(end: int | None) -> tuple[np.ndarray, pa.Table] | None:
        nonlocal held, values
        table, matrix = pa.Table.from_batches(held), np.concatenate(values)
        changes = np.flatnonzero((matrix[1:] != matrix[:-1]).any(axis=1)) + 1
        if end is None:
            if not len(changes):
                return None
            end = int(changes[-1])
        held, values = table.slice(end).to_batches(), [matrix[end:]]
        return np.concatenate([[0], changes[changes < end], [end]]), table.slice(0, end)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            values.append(np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], axis=1))
            if sum(map(len, values)) >= least and (out := cut(None)) is not None:
                yield out
    if held:
        yield cut(sum(map(len, values)))


def pairs_of_runs(bounds: np.ndarray, limit: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (u, v), u before v, of rows in one run, some at a time."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    counts = ends - np.arange(len(ends)) - 1
    for low, high in row_chunks(np.concatenate([[0], np.cumsum(counts)]), limit):
        own = counts[low:high]
        u = np.repeat(np.arange(low, high), own)
        before = np.concatenate([[0], np.cumsum(own)])[:-1]
        yield u, u + 1 + np.arange(len(u)) - np.repeat(before, own)


def started_runs(batches: Iterator[pa.RecordBatch], starts: Callable[[pa.RecordBatch], np.ndarray]) -> Iterator[pa.Table]:
    """The runs of rows of a sorted partition, each from a starting row to the next; one run at a time is held."""
    parts: list[pa.RecordBatch] = []
    for batch in batches:
        low = 0
        for edge in np.flatnonzero(starts(batch)).tolist():
            if edge > low:
                parts.append(batch.slice(low, edge - low))
            if parts:
                yield pa.Table.from_batches(parts)
            parts, low = [], edge
        if low < batch.num_rows:
            parts.append(batch.slice(low))
    if parts:
        yield pa.Table.from_batches(parts)


def row_batches(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows as batches of at most ``size``."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), types, strict=True)], names)

    for row in rows:
        held.append(row)
        if len(held) == size:
            yield batch()
            held.clear()
    if held:
        yield batch()
