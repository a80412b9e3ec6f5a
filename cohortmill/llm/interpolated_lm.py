"""Language-model scores by deleted interpolation.

The probability of a token is a chain of mixtures, from the longest context to none:

    P_k(w | h) = L_k(b) * count(h w) / count(h) + (1 - L_k(b)) * P_(k-1)(w | shorter h),    P_0 = 1 / (V + 1)

with maximum-likelihood estimates of each order and one weight L_k per order and bucket ``b`` of the context's frequency
(powers of two; a context never seen gives its estimate no weight). The weights are learned by expectation-maximisation:
the training rows are split, n-grams are counted on the *kept* part, and the weights are those that make the *deleted* part
most likely. Scores then use the counts of both parts. The probabilities of all V known tokens and of one unknown one sum
to 1 in every context.

**Counts without a shuffle of tokens.** Texts are taken in chunks of about ``CHUNK`` tokens; a chunk is one row of word
hashes and token numbers. Per order it asks for its distinct n-grams once, as sorted 64-bit hashes cut into buckets of the
hash range, with its own counts beside them. A task adds up one bucket over all chunks and answers each chunk with the
totals, in the order it asked. A frequent word or passage is one entry per chunk, so no n-gram is hot, nothing is
collected or broadcast, and what is shuffled grows in proportion to the corpus. The number of buckets follows the number
of tokens, so a bucket keeps its size.

**Memory of a task.** It holds one chunk or one bucket at a time. Chunks and answers are wide rows, so Arrow batches are
bounded in bytes (``BATCH``), parquet pages by their size after every row, and estimates are rows of ``SLICE`` tokens.

**Learning.** The deleted rows are chunks of their own. Their estimates are written once; each round of
expectation-maximisation is a pass over them that returns two sums per order and bucket (at most 65 buckets an order).

Bounds: the weights are smoothed by one event on each side, so none is 0 or 1; rounds end when the log likelihood grows by
less than ``GAIN`` of itself, after ``ROUNDS`` at most. Different n-grams share a 64-bit hash with probability 2 ** -64 a pair.

Defined cases: a null text is empty, so one end token; a null id is scored row by row as any other; without training rows
every token has probability 1 (score 0); an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import starmap

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortmill.llm.batches import NOT_SPACE, mix, row_batches, runs, word_chunks
from cohortmill.llm.staging import PACKED, WIDE, prepare, staged

ORDER = 2
CHUNK = 1 << 19
SLICE = 1 << 16
BATCH = "4m"
BUCKET = 1 << 22
ROUNDS = 20
GAIN = 1e-5
SCORED, KEPT, DELETED = range(3)

_STEP = np.uint64(0xD6E8FEB86659FD93)
_START, _END = np.uint64(0x53544152545F5F5F), np.uint64(0x454E445F5F5F5F5F)
_ZSTD = pa.Codec("zstd")


def pack(values: np.ndarray) -> bytes:
    """Integers, their bytes ordered by significance and compressed: most counts and the upper bytes are alike."""
    wide = np.ascontiguousarray(values.astype(np.int64) if values.dtype != np.uint64 else values)
    planes = wide.view(np.uint8).reshape(-1, 8).T
    return len(wide).to_bytes(8, "little") + _ZSTD.compress(np.ascontiguousarray(planes), asbytes=True)


def unpack(data: bytes, dtype: type = np.int64) -> np.ndarray:
    n = int.from_bytes(data[:8], "little")
    planes = np.frombuffer(_ZSTD.decompress(data[8:], n * 8, asbytes=True), np.uint8).reshape(8, n)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def pack_sorted(keys: np.ndarray) -> bytes:
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data, np.uint64), dtype=np.uint64)


class Tokens:
    """The tokens of some texts: hashes, and the first token of each text (and the end)."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes = hashes
        self.first = np.concatenate([[0], np.cumsum(counts)])
        self.begins = np.zeros(len(hashes), bool)
        self.begins[self.first[:-1]] = True

    def grams(self, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each order the sorted distinct n-grams, and the number of that of each token."""
        own = self.hashes
        for k in range(order):
            if k:
                before = np.concatenate([own[:1], own[:-1]])
                before[self.begins] = _START
                own = mix(before * _STEP + self.hashes)
            keys, which = np.unique(own, return_inverse=True)
            yield keys, which.reshape(-1)


@dataclass
class Totals:
    """What the whole training set has: tokens, distinct tokens and texts, of the kept part and of all."""

    tokens: list[int]
    types: list[int]
    texts: list[int]


@dataclass
class Weights:
    """Mixture weights: (order, bucket) -> weight of the order's estimate; others take the order's common one."""

    table: np.ndarray
    rounds: int = 0
    history: list[float] = field(default_factory=list)


def buckets(counts: np.ndarray) -> np.ndarray:
    """0 for a context never seen, else one more than the whole binary logarithm of its count."""
    return np.frexp(counts.astype(np.float64))[1]


def estimates(tokens: Tokens, found: list[np.ndarray], which: list[np.ndarray], totals: Totals, part: int) -> tuple[
        np.ndarray, np.ndarray]:
    """(bucket of the context, maximum-likelihood estimate) per order and token."""
    shape = len(found), len(tokens.hashes)
    bucket, estimate = np.zeros(shape, np.int8), np.zeros(shape)
    above = np.full(shape[1], totals.tokens[part])
    for k, (counts, own) in enumerate(zip(found, which, strict=True)):
        times = counts[own]
        bucket[k] = buckets(above)
        np.divide(times, above, out=estimate[k], where=above > 0)
        # The context of the next order ends on the token before.
        above = np.concatenate([times[:1], times[:-1]])
        above[tokens.begins] = totals.texts[part]
    return bucket, estimate


def mixed(bucket: np.ndarray, estimate: np.ndarray, weights: np.ndarray, floor: float) -> np.ndarray:
    """The probability by each order, lowest (the uniform one) first."""
    chain = [np.full(bucket.shape[1], floor)]
    for k in range(len(bucket)):
        own = weights[k, bucket[k]]
        chain.append(own * estimate[k] + (1 - own) * chain[-1])
    return np.stack(chain)


def _expected(bucket: np.ndarray, estimate: np.ndarray, weights: np.ndarray, floor: float) -> tuple[np.ndarray, float]:
    """Per order and bucket the expected times its estimate was chosen and was reached, and the log likelihood."""
    chain = mixed(bucket, estimate, weights, floor)
    sums, reached = np.zeros((2, *weights.shape)), np.ones(bucket.shape[1])
    for k in reversed(range(len(bucket))):
        own = weights[k, bucket[k]]
        chosen = reached * own * estimate[k] / chain[k + 1]
        sums[0, k] = np.bincount(bucket[k], chosen, minlength=weights.shape[1])
        sums[1, k] = np.bincount(bucket[k], reached, minlength=weights.shape[1])
        reached = reached - chosen
    return sums, float(np.log(chain[-1]).sum())


def _encoded(docs: DataFrame, id_type: T.DataType) -> DataFrame:
    """Chunks of whole texts: (chunk, deleted, ids, parts, counts, words, tokens)."""
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, nth = TaskContext.get().partitionId(), 0
        held: dict[bool, list[tuple]] = {False: [], True: []}

        def chunk(deleted: bool) -> Iterator[pa.RecordBatch]:
            nonlocal nth
            if not held[deleted]:
                return
            ids, parts, counts, hashes = zip(*held[deleted], strict=True)
            held[deleted] = []
            words, which = np.unique(np.concatenate(hashes), return_inverse=True)
            yield pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + nth], pa.int64()), pa.array([deleted]),
                pa.ListArray.from_arrays([0, sum(map(len, ids))], pa.concat_arrays(ids)),
                *[pa.array([x], pa.binary()) for x in (
                    pack(np.concatenate(parts)), pack(np.concatenate(counts)), pack_sorted(words), pack(which.reshape(-1)))],
                pa.array([len(which)], pa.int64()),
            ], names)
            nth += 1

        for batch in batches:
            parts = batch.column("part").to_numpy(zero_copy_only=False)
            for deleted in (False, True):
                own = batch.filter(pa.array((parts == DELETED) == deleted))
                for low, high, words in word_chunks(own.column("text"), NOT_SPACE):
                    counts = words.counts + 1
                    hashes = np.full(counts.sum(), _END, np.uint64)
                    inside = np.ones(len(hashes), bool)
                    inside[np.cumsum(counts) - 1] = False
                    hashes[inside] = words.hashes
                    rows = own.slice(low, high - low)
                    held[deleted].append((rows.column("id"), rows.column("part").to_numpy(zero_copy_only=False), counts, hashes))
                    if sum(len(x[3]) for x in held[deleted]) >= CHUNK:
                        yield from chunk(deleted)
        for deleted in (False, True):
            yield from chunk(deleted)

    names = ["chunk", "deleted", "ids", "parts", "counts", "words", "tokens", "n"]
    shape = T.StructType([
        T.StructField("chunk", T.LongType()), T.StructField("deleted", T.BooleanType()), T.StructField("ids", T.ArrayType(id_type)),
        *[T.StructField(c, T.BinaryType()) for c in ("parts", "counts", "words", "tokens")], T.StructField("n", T.LongType())])
    return docs.mapInArrow(encode, shape)


def _decoded(row: dict) -> tuple[Tokens, np.ndarray]:
    words, counts = unpack_sorted(row["words"]), unpack(row["counts"])
    return Tokens(words[unpack(row["tokens"])], counts), unpack(row["parts"])


def _single(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in names}


def _answers(chunks: DataFrame, order: int, bits: int) -> DataFrame:
    """(kind, bucket, chunk, kept, every, types, kept_types): per chunk and order the totals of the n-grams it asked for."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for row in _single(batches, ["chunk", "deleted", "parts", "counts", "words", "tokens"]):
                tokens, parts = _decoded(row)
                part = np.repeat(parts, np.diff(tokens.first))
                for k, (keys, which) in enumerate(tokens.grams(order)):
                    kept = np.bincount(which[part == KEPT], minlength=len(keys))
                    deleted = np.bincount(which[part == DELETED], minlength=len(keys))
                    edges = np.searchsorted(keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else [0]
                    for bucket, (low, high) in enumerate(zip(edges, [*edges[1:], len(keys)], strict=True)):
                        if low < high:
                            yield (k + 1, bucket, row["chunk"], row["deleted"], pack_sorted(keys[low:high]),
                                   pack(kept[low:high]), pack(deleted[low:high]))

        yield from row_batches(rows(), ["kind", "bucket", "chunk", "deleted", "keys", "kept", "every"],
                               [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), *[pa.binary()] * 3], 256)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for (kind, bucket), run in runs(batches, ["kind", "bucket"]):
                parts = [unpack_sorted(x) for x in run.column("keys").to_pylist()]
                kept = np.concatenate([unpack(x) for x in run.column("kept").to_pylist()])
                every = kept + np.concatenate([unpack(x) for x in run.column("every").to_pylist()])
                _, which = np.unique(np.concatenate(parts), return_inverse=True)
                kept, every = (np.bincount(which, x).astype(np.int64) for x in (kept, every))
                types = [int((every > 0).sum()), int((kept > 0).sum())]
                ends = np.cumsum([len(x) for x in parts])
                chunks, deleted = run.column("chunk").to_pylist(), run.column("deleted").to_pylist()
                for chunk, flag, own in zip(chunks, deleted, np.split(which, ends[:-1]), strict=True):
                    # A chunk without deleted rows needs the totals of all training rows alone.
                    yield kind, bucket, chunk, flag, pack(kept[own]) if flag else None, pack(every[own]), *types
                    types = [0, 0]

        yield from row_batches(rows(), ["kind", "bucket", "chunk", "deleted", "kept", "every", "types", "kept_types"],
                               [pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.int64()], 256)

    asked = chunks.select("chunk", "deleted", "parts", "counts", "words", "tokens").mapInArrow(
        ask, "kind int, bucket int, chunk long, deleted boolean, keys binary, kept binary, every binary")
    return asked.repartition("kind", "bucket").sortWithinPartitions("kind", "bucket", "chunk").mapInArrow(
        add, "kind int, bucket int, chunk long, deleted boolean, kept binary, every binary, types long, kept_types long")


def _with_answers(chunks: DataFrame, answers: DataFrame) -> DataFrame:
    """Each chunk (kind 0) followed by its answers, in the order of the n-grams."""
    rows = chunks.withColumn("kind", F.lit(0)).withColumn("bucket", F.lit(0)).unionByName(
        answers.drop("types", "kept_types"), allowMissingColumns=True)
    return rows.repartition("chunk").sortWithinPartitions("chunk", "kind", "bucket")


def _answered(batches: Iterator[pa.RecordBatch], order: int, column: str) -> Iterator[
        tuple[pa.Array, np.ndarray, Tokens, list[np.ndarray], list[np.ndarray]]]:
    """(ids, parts, tokens, totals of the distinct n-grams, n-gram of each token) of each chunk of a partition."""
    def answered(run: pa.Table) -> tuple[pa.Array, np.ndarray, Tokens, list[np.ndarray], list[np.ndarray]]:
        kinds = run.column("kind").to_numpy()
        row = {c: run.column(c)[0].as_py() for c in ("parts", "counts", "words", "tokens")}
        tokens, parts = _decoded(row)
        packed = run.column(column).to_pylist()
        found = [np.concatenate([unpack(packed[at]) for at in np.flatnonzero(kinds == k + 1)]) for k in range(order)]
        return run.column("ids")[0].values, parts, tokens, found, [which for _, which in tokens.grams(order)]

    # Nothing of a chunk is held while the next one is decoded.
    return (answered(run) for _, run in runs(batches, ["chunk"]))


def learned(chunks: DataFrame, answers: DataFrame, totals: Totals, order: int) -> Weights:
    """The weights that make the deleted rows most likely under the counts of the kept ones."""
    floor = 1 / (totals.types[0] + 1)
    table = np.full((order, 66), 0.5)
    table[:, 0] = 0

    def estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A row holds some tokens of a chunk, so every round reads rows of about 1 MB.
        rows = ((b[:, low:low + SLICE].tobytes(), e[:, low:low + SLICE].tobytes())
                for _, _, tokens, found, which in _answered(batches, order, "kept")
                for b, e in [estimates(tokens, found, which, totals, 0)] for low in range(0, b.shape[1], SLICE))
        yield from row_batches(rows, ["bucket", "estimate"], [pa.binary(), pa.binary()], 2)

    rows = staged(_with_answers(chunks.where("deleted"), answers.where("deleted")).mapInArrow(
        estimated, "bucket binary, estimate binary"), "estimates", WIDE)

    def one_round(weights: np.ndarray) -> tuple[np.ndarray, float]:
        def expect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums, likelihood = np.zeros((2, *weights.shape)), 0.0
            for row in _single(batches, ["bucket", "estimate"]):
                bucket = np.frombuffer(row["bucket"], np.int8).reshape(order, -1)
                own, part = _expected(bucket, np.frombuffer(row["estimate"]).reshape(order, -1), weights, floor)
                sums, likelihood = sums + own, likelihood + part
            where = np.argwhere(sums[1] > 0)
            yield pa.RecordBatch.from_arrays([
                pa.array([*where[:, 0], -1], pa.int32()), pa.array([*where[:, 1], -1], pa.int32()),
                pa.array([*sums[0][tuple(where.T)], 0.0], pa.float64()), pa.array([*sums[1][tuple(where.T)], likelihood], pa.float64()),
            ], ["k", "bucket", "chosen", "reached"])

        totals_of = rows.mapInArrow(expect, "k int, bucket int, chosen double, reached double").groupBy("k", "bucket").agg(
            F.sum("chosen"), F.sum("reached")).collect()
        sums, likelihood = np.zeros((2, *weights.shape)), 0.0
        for k, bucket, chosen, reached in totals_of:
            if k < 0:
                likelihood = reached
            else:
                sums[:, k, bucket] = chosen, reached
        return sums, likelihood

    weights = Weights(table)
    if rows.isEmpty():
        return weights
    for weights.rounds in range(1, ROUNDS + 1):
        (chosen, reached), likelihood = one_round(weights.table)
        weights.history.append(likelihood)
        common = (chosen.sum(axis=1) + 1) / (reached.sum(axis=1) + 2)
        weights.table = np.where(reached > 0, (chosen + 1) / (reached + 2), common[:, None])
        weights.table[:, 0] = 0
        if len(weights.history) > 1 and likelihood - weights.history[-2] <= GAIN * abs(likelihood):
            break
    return weights


def score(docs: DataFrame, part: Column, order: int = ORDER, id_col: str = "doc_id", text_col: str = "text") -> tuple[
        DataFrame, Totals, Weights]:
    """Per row: id, part, n_tokens, n_known, base_score, score; and what was learned.

    ``part`` says what a row is for: ``SCORED`` only, ``KEPT`` (counted) or ``DELETED`` (weights are learned on it, then it
    is counted); null counts as KEPT. ``base_score`` is the add-0.1 unigram score, ``score`` that of the mixture (log10).
    """
    prepare(docs.sparkSession, size=BATCH)
    named = docs.select(F.col(id_col).alias("id"), F.coalesce(part, F.lit(KEPT)).cast("int").alias("part"),
                        F.col(text_col).cast("string").alias("text"))
    id_type = named.schema["id"].dataType
    chunks = staged(_encoded(named, id_type), "chunks", PACKED)
    tokens = chunks.agg(F.sum("n")).first()[0] or 0
    bits = max(5, math.ceil(math.log2(max(tokens * order / BUCKET, 1))))
    answers = staged(_answers(chunks, order, bits), "answers", PACKED)

    per_part = {r["part"]: r for r in named.groupBy("part").agg(F.count("*").alias("texts")).collect()}
    texts = [per_part[p]["texts"] if p in per_part else 0 for p in (KEPT, DELETED)]
    types = answers.where("kind = 1").agg(F.sum("kept_types").alias("kept"), F.sum("types").alias("every")).first()
    kept, every = _training_tokens(chunks)
    totals = Totals([kept, every], [types["kept"] or 0, types["every"] or 0], [texts[0], sum(texts)])
    weights = learned(chunks, answers, totals, order)
    floor, n, v, table = 1 / (totals.types[1] + 1), totals.tokens[1], totals.types[1], weights.table

    def scored_chunk(ids: pa.Array, parts: np.ndarray, own: Tokens, found: list[np.ndarray], which: list[np.ndarray]) -> pa.RecordBatch:
        bucket, estimate = estimates(own, found, which, totals, 1)
        logs = np.concatenate([np.log10(mixed(bucket[:, low:low + SLICE], estimate[:, low:low + SLICE], table, floor)[-1])
                               for low in range(0, bucket.shape[1], SLICE)])
        times = found[0][which[0]]
        base = np.log10((times + 0.1) / (n + 0.1 * (v + 1)))
        at = own.first[:-1]
        return pa.RecordBatch.from_arrays([
            ids, pa.array(parts.astype(np.int32)), pa.array(np.diff(own.first)),
            *[pa.array(np.add.reduceat(x, at)) for x in ((times > 0).astype(np.int64), base, logs)],
        ], shape.names)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return starmap(scored_chunk, _answered(batches, order, "every"))

    shape = T.StructType([T.StructField(id_col, id_type), T.StructField("part", T.IntegerType())] + [
        T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known")] + [
        T.StructField(c, T.DoubleType()) for c in ("base_score", "score")])
    return _with_answers(chunks, answers).mapInArrow(scored, shape), totals, weights


def _training_tokens(chunks: DataFrame) -> tuple[int, int]:
    """Tokens of the kept rows, and of all training rows."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(3, np.int64)
        for row in _single(batches, ["parts", "counts"]):
            total += np.bincount(unpack(row["parts"]), unpack(row["counts"]), minlength=3).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total[KEPT]]), pa.array([total[KEPT] + total[DELETED]])], ["kept", "every"])

    found = chunks.select("parts", "counts").mapInArrow(add, "kept long, every long").agg(F.sum("kept"), F.sum("every")).first()
    return found[0] or 0, found[1] or 0
