"""Benchmark decontamination: a broadcast hash set of normalised test n-grams, scanned over training token windows.

Words are runs of ASCII letters and digits and of non-ASCII characters, A-Z in lower case. A benchmark item gives every
run of ``n`` of its words; an item of fewer words, but not none, is one shorter window. Each document is scanned once:
the hashes of all its windows are looked up in the set, every hit is verified word by word, and the words inside verified
windows are *hit*. Documents are not shuffled.

Size of the broadcast: the windows are counted first. If they exceed ``block_windows`` or ``block_bytes`` they are dealt
into blocks under that bound by their hash, and the documents pass the blocks one after the other with a staged table in
between; nothing is left out and no broadcast is larger than a block.

Defined cases: a null or word-less text or item has no words; repeated items count once each by their item_id (a null
item_id is ignored); repeated documents are scanned each on its own; an empty benchmark hits nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.llm.batches import ALNUM, Words, word_chunks
from cohortmill.llm.staging import prepare, staged

WINDOW_WORDS = 10
BLOCK_WINDOWS = 400_000
BLOCK_BYTES = 64 << 20

_SPAN = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
_FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()),
    T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("items", T.ArrayType(T.StringType())),
])
_ARROW_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def benchmark_windows(benchmark: DataFrame, n: int, item_col: str, text_col: str) -> DataFrame:
    """(item, words, window): the windows of all items, the words joined by single spaces."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, words in word_chunks(batch.column(1), ALNUM):
                out = [
                    (batch.column(0)[row].as_py(), size, words.run(start, size))
                    for row in range(low, high)
                    if (size := min(n, int(words.counts[row - low])))
                    for start in range(words.first[row - low], words.first[row - low + 1] - size + 1)
                ]
                yield pa.RecordBatch.from_pydict({
                    "item": pa.array([x[0] for x in out], pa.string()), "words": pa.array([x[1] for x in out], pa.int64()),
                    "window": pa.array([x[2].decode() for x in out], pa.string()),
                })

    named = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return named.where("item is not null").mapInArrow(windows, "item string, words long, window string").distinct()


class WindowSet:
    """One block of windows: a bitmap in front of a dictionary of the exact windows, by window length."""

    BITS = 22

    def __init__(self, rows: list[tuple[str, int, str]]) -> None:
        self.items: dict[int, dict[bytes, list[str]]] = {}
        for item, size, window in rows:
            self.items.setdefault(size, {}).setdefault(window.encode(), []).append(item)
        self.bitmaps = {}
        for size, windows in self.items.items():
            column = pa.array([w.decode() for w in windows], pa.string())
            marks = np.zeros(1 << self.BITS, bool)
            for _, _, words in word_chunks(column, ALNUM):
                marks[words.windows(size)[1] >> np.uint64(64 - self.BITS)] = True
            self.bitmaps[size] = np.packbits(marks)

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
        """First word, end word and items of every window that occurs."""
        starts, ends, items = [], [], []
        for size, windows in self.items.items():
            at, hashes = words.windows(size)
            place = (hashes >> np.uint64(64 - self.BITS)).astype(np.int64)
            marked = (self.bitmaps[size][place >> 3] >> (7 - (place & 7)).astype(np.uint8)) & 1
            for start in at[marked.astype(bool)].tolist():
                if (found := windows.get(words.run(start, size))) is not None:
                    starts.append(start)
                    ends.append(start + size)
                    items.append(found)
        return np.array(starts, np.int64), np.array(ends, np.int64), items


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _found(windows: WindowSet, words: Words) -> dict[int, tuple[list[tuple[int, int]], set[str]]]:
    """By row of the chunk: the merged spans of hit words (counted within the text), and the items."""
    starts, ends, items = windows.hits(words)
    out: dict[int, tuple[list[tuple[int, int]], set[str]]] = {}
    rows = np.searchsorted(words.first, starts, side="right") - 1
    for row, start, end, own in zip(rows.tolist(), starts.tolist(), ends.tolist(), items, strict=True):
        spans, names = out.setdefault(row, ([], set()))
        spans.append((start - int(words.first[row]), end - int(words.first[row])))
        names.update(own)
    return {row: (_merged(spans), names) for row, (spans, names) in out.items()}


def _blocks(benchmark: DataFrame, n: int, item_col: str, text_col: str, block_windows: int, block_bytes: int):
    """Broadcast window sets, each under the bounds."""
    spark = benchmark.sparkSession
    windows = staged(benchmark_windows(benchmark, n, item_col, text_col), "windows")
    size = windows.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("window")), F.lit(0)).alias("b")).first()
    count = max(1, -(-size["n"] // block_windows), -(-size["b"] // block_bytes))
    for k in range(count):
        rows = windows.where(F.pmod(F.xxhash64("window"), F.lit(count)) == k).collect() if size["n"] else []
        yield k == count - 1, spark.sparkContext.broadcast(WindowSet([tuple(r) for r in rows]))


def overlaps(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW_WORDS, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS,
             block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Per document: id, n_words, n_hit, spans (hit word runs, end exclusive, merged) and items (ids as strings, sorted)."""
    prepare(docs.sparkSession)
    state = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_type = state.schema["id"].dataType
    first = True
    for last, block in _blocks(benchmark, n, item_col, item_text_col, block_windows, block_bytes):
        def scan(batches: Iterator[pa.RecordBatch], block=block, first=first, last=last) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low, high, words in word_chunks(batch.column(1), ALNUM):
                    part, found = batch.slice(low, high - low), _found(block.value, words)
                    spans = [found[k][0] if k in found else [] for k in range(high - low)]
                    items = [found[k][1] if k in found else set() for k in range(high - low)]
                    if not first:
                        spans = [_merged(x + [(s["start"], s["end"]) for s in y]) for x, y in
                                 zip(spans, part.column(3).to_pylist(), strict=True)]
                        items = [x.union(y) for x, y in zip(items, part.column(4).to_pylist(), strict=True)]
                    yield pa.RecordBatch.from_arrays([
                        part.column(0), part.column(1) if not last else pa.nulls(high - low, pa.string()),
                        pa.array(words.counts, pa.int64()),
                        pa.array([[{"start": s, "end": e} for s, e in x] for x in spans], _ARROW_SPANS),
                        pa.array([sorted(x) for x in items], pa.list_(pa.string())),
                    ], ["id", "text", "n_words", "spans", "items"])

        schema = T.StructType([T.StructField("id", id_type), T.StructField("text", T.StringType()),
                               _FOUND["n_words"], _FOUND["spans"], _FOUND["items"]])
        state = state.mapInArrow(scan, schema)
        if not last:
            state = staged(state, "overlaps")
        first = False
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, s: total + s["end"] - s["start"])
    return state.select(F.col("id").alias(id_col), "n_words", hit.alias("n_hit"), "spans", "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, mode: str = "documents", n: int = WINDOW_WORDS,
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_windows: int = BLOCK_WINDOWS, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, all columns, without contaminated documents (``documents``) or without the text from the first to
    the last word of each hit run (``spans``; texts without hits stay byte for byte)."""
    if mode not in ("documents", "spans"):
        raise ValueError(mode)
    prepare(docs.sparkSession)
    place, state = docs.columns.index(text_col), docs
    for last, block in _blocks(benchmark, n, item_col, item_text_col, block_windows, block_bytes):
        def clean(batches: Iterator[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low, high, words in word_chunks(batch.column(place), ALNUM):
                    part, found = batch.slice(low, high - low), _found(block.value, words)
                    if found and mode == "documents":
                        part = part.filter(pa.array([k not in found for k in range(high - low)]))
                    elif found:
                        texts = part.column(place).to_pylist()
                        for row, (spans, _) in found.items():
                            texts[row] = _without(texts[row].encode(), words, row, spans)
                        part = part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))
                    yield part

        state = state.mapInArrow(clean, docs.schema)
        if not last:
            state = staged(state, "decontaminated")
    return state


def _without(text: bytes, words: Words, row: int, spans: list[tuple[int, int]]) -> str:
    base, first, out, at = int(words.bounds[row]), int(words.first[row]), [], 0
    for start, end in spans:
        out.append(text[at:words.starts[first + start] - base])
        at = int(words.ends[first + end - 1]) - base
    return b"".join([*out, text[at:]]).decode()
