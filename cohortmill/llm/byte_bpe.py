"""Byte-level BPE encoding and decoding: vectorised pre-tokenisation, then cached pair merging of the slices.

Pre-tokenisation works on arrays, without a regular expression. Every code point has a class (letter, number, space,
other white space, anything else, and an apostrophe that one of the contractions ``s t m d re ve ll`` follows). A small
automaton says what the token at hand is; each class is a transition function on its states, the functions with their
compositions form a finite monoid, and composing is associative, so the state before every character comes from a prefix
scan of monoid elements over blocks. Boundaries follow from that state, the class and the class of the next character.

The slices between boundaries are made unique by hash and length; each unseen slice is merged by rank once and kept in a
bounded cache. Ids and the ends of the slices come out, decoding maps ids back to bytes. As a guard every chunk is decoded and
compared with its input; where a hash collision could have mixed up two slices, the chunk is encoded without hashes.

Defined cases: a null text is empty and gives no ids; special tokens are ordinary text; ids outside the vocabulary (or
null) cannot be decoded and raise an error.
"""

from __future__ import annotations

import base64
import functools
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.llm.batches import gather, row_chunks, slice_hashes, text_bytes
from cohortmill.llm.staging import prepare

# Classes of code points.
LETTER, NUMBER, SPACE, BLANK, OTHER, SHORT1, SHORT2 = range(7)
# States: what the characters so far end in. In SHORTn n more letters belong to a contraction.
FRESH, IN_LETTER, IN_NUMBER, IN_SPACE, IN_BLANK, IN_OTHER, IN_SHORT1, IN_SHORT2 = range(8)
FIRST = 7  # added to the class of the first character of a text

# Code points with the Unicode property White_Space, and the contractions of the pattern.
WHITE = [9, 10, 11, 12, 13, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]
ONE_LETTER = "stmd"
TWO_LETTERS = ("re", "ve", "ll")

CACHE = 500_000
_NONE = sys.maxsize
_STEP = np.uint64(0xD6E8FEB86659FD93)


def _step(state: int, kind: int) -> int:
    if state == IN_SHORT2:
        return IN_SHORT1
    if state == IN_SHORT1:
        return FRESH
    if kind in (SHORT1, SHORT2):
        starts_token = state not in (IN_SPACE, IN_OTHER)
        return (IN_SHORT1 if kind == SHORT1 else IN_SHORT2) if starts_token else IN_OTHER
    return {LETTER: IN_LETTER, NUMBER: IN_NUMBER, SPACE: IN_SPACE, BLANK: IN_BLANK, OTHER: IN_OTHER}[kind]


def _monoid() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(element of each class, composition table, states by element and start): all compositions of the classes."""
    functions = [tuple(_step(s, k) for s in range(8)) for k in range(7)]
    functions += [(f[FRESH],) * 8 for f in functions[:7]]
    elements = {tuple(range(8)): 0}
    for f in functions:
        elements.setdefault(f, len(elements))
    grown = True
    while grown:
        grown = False
        for a in list(elements):
            for f in functions:
                if (c := tuple(f[s] for s in a)) not in elements:
                    elements[c], grown = len(elements), True
    names = list(elements)
    table = np.array([[elements[tuple(b[s] for s in a)] for b in names] for a in names], np.uint16)
    return np.array([elements[f] for f in functions], np.uint16), table, np.array(names, np.uint8)


ELEMENT, COMPOSE, STATES = _monoid()


def scanned(elements: np.ndarray, block: int = 128) -> np.ndarray:
    """Inclusive prefix compositions. Blocks are scanned side by side, their totals by the same function, then joined."""
    if len(elements) <= block:
        out, total = np.empty(len(elements), np.uint16), 0
        for k, e in enumerate(elements.tolist()):
            total = out[k] = COMPOSE[total, e]
        return out
    n = -(-len(elements) // block)
    grid = np.zeros((block, n), np.uint16)
    padded = np.zeros(n * block, np.uint16)
    padded[:len(elements)] = elements
    grid[:] = padded.reshape(n, block).T
    for k in range(1, block):
        grid[k] = COMPOSE[grid[k - 1], grid[k]]
    before = np.zeros(n, np.uint16)
    before[1:] = scanned(grid[-1, :-1], block)
    return COMPOSE[before, grid].T.ravel()[:len(elements)]


@functools.cache
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(k))[0], OTHER) for k in range(sys.maxunicode + 1)),
                        np.uint8, sys.maxunicode + 1)
    table[WHITE] = BLANK
    table[32] = SPACE
    return table


def token_starts(points: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Whether a pre-token starts at each code point of some texts."""
    n = len(points)
    kinds = _classes()[points]
    starts_text = np.zeros(n + 1, bool)
    starts_text[bounds] = True
    after = np.concatenate([points[1:], [0, 0]]).astype(np.uint32)
    after[np.flatnonzero(starts_text[1:n + 1])] = 0  # the next text does not count
    quotes = np.flatnonzero(points == 39)
    following = after[quotes]
    one = np.isin(following, [ord(c) for c in ONE_LETTER])
    two = np.zeros(len(quotes), bool)
    for pair in TWO_LETTERS:
        two |= (following == ord(pair[0])) & (after[quotes + 1] == ord(pair[1]))
    kinds[quotes[one]] = SHORT1
    kinds[quotes[two]] = SHORT2

    prefix = scanned(ELEMENT[kinds + FIRST * starts_text[:n].astype(np.uint8)])
    before = np.zeros(n, np.uint16)
    before[1:] = STATES[prefix[:-1], FRESH]
    before[starts_text[:n]] = FRESH

    white = (kinds == SPACE) | (kinds == BLANK)
    next_black = np.zeros(n, bool)
    next_black[:-1] = ~white[1:]
    next_black &= ~starts_text[1:n + 1]
    in_white = (before == IN_SPACE) | (before == IN_BLANK)
    same = ((before == IN_LETTER) & (kinds == LETTER)) | ((before == IN_NUMBER) & (kinds == NUMBER)) | (
        (before == IN_OTHER) & (kinds >= OTHER)) | (before == IN_SHORT1) | (before == IN_SHORT2) | (before == IN_SPACE)
    return np.where(white, ~in_white | next_black, ~same) | starts_text[:n]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBPE:
    """Ranks, a bounded cache of merged slices, and the tables to decode."""

    def __init__(self, ranks: dict[bytes, int], cache: int = CACHE) -> None:
        self.ranks, self.limit = ranks, cache
        self.cache: dict[bytes, list[int]] = {}
        tokens = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            tokens[rank] = token
        self.bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.bounds = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)

    def merged(self, piece: bytes) -> list[int]:
        """The ids of one slice: of all neighbours the pair of lowest rank is joined, leftmost first, as long as there is one."""
        if (found := self.cache.get(piece)) is not None:
            return found
        if (whole := self.ranks.get(piece)) is not None:
            ids = [whole]
        elif len(piece) > 500:
            ids = self._merged_long(piece)
        else:
            ranks = self.ranks
            parts = [piece[k:k + 1] for k in range(len(piece))]
            pairs = [ranks.get(a + b, _NONE) for a, b in zip(parts, parts[1:])]  # noqa: B905
            while pairs and (low := min(pairs)) < _NONE:
                k = pairs.index(low)
                parts[k:k + 2] = [parts[k] + parts[k + 1]]
                del pairs[k]
                if k:
                    pairs[k - 1] = ranks.get(parts[k - 1] + parts[k], _NONE)
                if k < len(pairs):
                    pairs[k] = ranks.get(parts[k] + parts[k + 1], _NONE)
            ids = [ranks[p] for p in parts]
        if len(piece) <= 64:
            if len(self.cache) >= self.limit:
                self.cache.clear()
            self.cache[piece] = ids
        return ids

    def _merged_long(self, piece: bytes) -> list[int]:
        """The same in n log n steps: a heap of pairs over a linked list, stale entries skipped."""
        n, ranks = len(piece), self.ranks
        ends, left, live = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = []

        def offer(a: int) -> None:
            if (b := ends[a]) < n and (rank := ranks.get(piece[a:ends[b]])) is not None:
                heapq.heappush(heap, (rank, a, b, ends[b]))

        for k in range(n - 1):
            offer(k)
        while heap:
            _, a, b, end = heapq.heappop(heap)
            if not (live[a] and ends[a] == b and live[b] and ends[b] == end):
                continue
            ends[a], live[b] = end, False
            if end < n:
                left[end] = a
            offer(a)
            if left[a] >= 0:
                offer(left[a])
        out, a = [], 0
        while a < n:
            out.append(ranks[piece[a:ends[a]]])
            a = ends[a]
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids of all texts, bounds of each text in them, end of each pre-token in them)."""
        raw, raw_bounds = text_bytes(pa.array(texts, pa.large_string()))
        points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        if not len(points):
            return np.zeros(0, np.int32), np.zeros(len(texts) + 1, np.int64), np.zeros(0, np.int64)
        begin = np.flatnonzero((raw & 0xC0) != 0x80)[token_starts(points, bounds)]
        size = np.diff(np.append(begin, len(raw)))
        first, back = _unique_slices(raw, begin, size)
        data = raw.tobytes()
        pieces = [self.merged(data[b:b + s]) for b, s in zip(begin[first].tolist(), size[first].tolist(), strict=True)]
        table_bounds = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        table = np.fromiter((x for p in pieces for x in p), np.int32, int(table_bounds[-1]))
        ids, slices = gather(table, table_bounds, back)
        if self.decode(ids) != data:
            pieces = [self.merged(data[b:b + s]) for b, s in zip(begin.tolist(), size.tolist(), strict=True)]
            slices = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
            ids = np.fromiter((x for p in pieces for x in p), np.int32, int(slices[-1]))
        return ids, slices[np.searchsorted(begin, raw_bounds)], slices[1:]

    def decoded(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids, and where each begins."""
        if len(ids) and not (0 <= ids.min() and ids.max() < len(self.bounds) - 1):
            raise ValueError("an id is not in the vocabulary")
        return gather(self.bytes, self.bounds, ids)

    def decode(self, ids: np.ndarray) -> bytes:
        return self.decoded(ids)[0].tobytes()


def _unique_slices(data: np.ndarray, begin: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(an index of each distinct slice, the distinct slice of each), told apart by length and hash."""
    hashes = slice_hashes(data, begin, begin + size) + size.astype(np.uint64) * _STEP
    _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
    return first, back


_ENCODERS: list[ByteBPE] = []


def _encoder(ranks: dict[bytes, int]) -> ByteBPE:
    """One encoder, and so one cache, in each Python worker as long as the vocabulary is the same."""
    if not _ENCODERS or _ENCODERS[0].ranks is not ranks:
        _ENCODERS[:] = [ByteBPE(ranks)]
    return _ENCODERS[0]


def _chunks(column: pa.Array) -> Iterator[tuple[int, int, list[str]]]:
    texts = [t or "" for t in column.to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for low, high in row_chunks(bounds):
        yield low, high, texts[low:high]


def encode(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, ids (array of int), ends (after each pre-token, the number of ids so far)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(shared.value)
        for batch in batches:
            for low, high, texts in _chunks(batch.column(1)):
                ids, bounds, ends = bpe.encode(texts)
                cuts = np.searchsorted(ends, bounds[1:], side="right")
                starts = np.concatenate([[0], cuts[:-1]])
                ends = ends - np.repeat(bounds[:-1], cuts - starts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.ListArray.from_arrays(pa.array(np.append(starts, len(ends)), pa.int32()), pa.array(ends, pa.int32())),
                ], [id_col, "ids", "ends"])

    ints = T.ArrayType(T.IntegerType())
    return named.mapInArrow(run, T.StructType([named.schema[id_col], T.StructField("ids", ints), T.StructField("ends", ints)]))


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id, bytes (of the ids; null ids give no bytes)."""
    prepare(encoded.sparkSession)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)
    named = encoded.select(F.col(id_col), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(shared.value)
        for batch in batches:
            lists = [x or [] for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([bpe.decode(np.array(x, np.int64)) for x in lists], pa.binary())], [id_col, "bytes"])

    return named.mapInArrow(run, T.StructType([named.schema[id_col], T.StructField("bytes", T.BinaryType())]))


def tokenised(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, n_tokens, ids, and decoded_sha256 of the bytes these ids decode to."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(shared.value)
        for batch in batches:
            for low, high, texts in _chunks(batch.column(1)):
                ids, bounds, _ = bpe.encode(texts)
                plain, plain_at = bpe.decoded(ids)
                rows = zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(np.diff(bounds), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.int32())),
                    pa.array([sha256(plain[plain_at[a]:plain_at[b]]).hexdigest() for a, b in rows]),
                ], [id_col, "n_tokens", "ids", "decoded_sha256"])

    return named.mapInArrow(run, T.StructType([
        named.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("decoded_sha256", T.StringType())]))


def digests(docs: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row, from encoding and decoding its whole text in one pass: id, n_tokens, ids_sha256 (decimal ids joined by
    commas) and decoded_sha256 (the decoded bytes)."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(ranks)
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _encoder(shared.value)
        decimals = [b"%d," % k for k in range(len(bpe.bounds) - 1)]
        digits = np.frombuffer(b"".join(decimals), np.uint8)
        digit_bounds = np.concatenate([[0], np.cumsum([len(d) for d in decimals])]).astype(np.int64)
        for batch in batches:
            for low, high, texts in _chunks(batch.column(1)):
                ids, bounds, _ = bpe.encode(texts)
                listed, listed_at = gather(digits, digit_bounds, ids)
                plain, plain_at = bpe.decoded(ids)
                rows = list(zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(np.diff(bounds), pa.int64()),
                    pa.array([sha256(listed[listed_at[a]:max(listed_at[a], listed_at[b] - 1)]).hexdigest() for a, b in rows]),
                    pa.array([sha256(plain[plain_at[a]:plain_at[b]]).hexdigest() for a, b in rows]),
                ], [id_col, "n_tokens", "ids_sha256", "decoded_sha256"])

    return named.mapInArrow(run, T.StructType([
        named.schema[id_col], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType())]))
