"""MinHash near-duplicates: one-permutation hashing with optimal densification, banded buckets, star-shaped candidates.

Each document is hashed once per shingle. Its sorted shingle hashes fall into ``bands * rows`` bins; the smallest hash of
a bin is the bin's value, and an empty bin copies the first non-empty bin of its own fixed random probe order, so that two
documents agree in a bin with the probability of their Jaccard similarity. Bands of ``rows`` bins give bucket keys.

Documents with equal shingle sets are one node (the smallest id stands for the copies). Candidates are stars: in each
bucket every node is compared with the smallest id only, so a bucket of m nodes gives m - 1 pairs, and copies of one text
that share all buckets give the same pairs again. Candidates are confirmed on the full shingle sets of both texts:

1. every node against the smallest of its hubs;
2. the other star pairs whose ends are not yet in one component;
3. what stars cannot see: pairs of one bucket whose ends are still in different components. A link inside a component
   adds nothing, so after the stars these are the pairs that can still change the result. Such a bucket (one of those with
   the same members) is dealt into blocks by a hash; two blocks are a cell, whose intersections are products of the
   0/1 matrix of documents and shingles. A cell gives one row per linked document, never its pairs.

At 0.8 a pair misses all of 40 bands of 6 bins with probability 5e-6; size bounds (the smaller set has at least 0.8 of the
larger one) are exact.

Defined cases: a text without words has an empty set and links with nothing; fewer words than a shingle are one shingle;
a null id links with nothing, has a null component and is kept; rows that repeat an id are one document of several texts,
each row answered; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortmill.llm.batches import NOT_SPACE, Words, mix, runs, smallest_connected, word_chunks
from cohortmill.llm.components import components
from cohortmill.llm.staging import prepare, staged

BANDS = 40
ROWS = 6
# A block of an open bucket holds about so many documents, and shingles, at most.
BLOCK_DOCS = 512
BLOCK_SHINGLES = 500_000


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text; texts of fewer words give one shingle of all of them."""
    starts, hashes = words.windows(size)
    bounds = np.searchsorted(starts, words.first)
    for row, count in enumerate(words.counts.tolist()):
        if count >= size:
            yield np.unique(hashes[bounds[row]:bounds[row + 1]])
        elif count:
            run = words.hashes[words.first[row]:words.first[row + 1]]
            whole = np.full(1, count, np.uint64)
            for value in run:
                whole = mix(whole + value)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


class OnePermutation:
    """Bins, probe orders and band keys."""

    def __init__(self, bands: int, rows: int) -> None:
        self.bands, self.rows, bins = bands, rows, bands * rows
        self.edges = np.array([(k << 64) // bins for k in range(bins)], np.uint64)
        order = np.random.default_rng(6)
        self.probes = np.stack([order.permutation(bins) for _ in range(bins)])

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        """The bin values of one non-empty set of sorted hashes."""
        at = np.append(np.searchsorted(hashes, self.edges), len(hashes))
        full = at[:-1] < at[1:]
        values = hashes[np.minimum(at[:-1], len(hashes) - 1)]
        if not full.all():
            probes = self.probes[~full]
            values[~full] = values[probes[np.arange(len(probes)), full[probes].argmax(axis=1)]]
        return values

    def keys(self, signatures: np.ndarray) -> np.ndarray:
        """Bucket keys, by document and band."""
        parts = signatures.reshape(len(signatures), self.bands, self.rows)
        key = np.broadcast_to(np.arange(1, self.bands + 1, dtype=np.uint64), parts.shape[:2])
        for k in range(self.rows):
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
        return key


def signatures(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int) -> DataFrame:
    """(id, n, set_a, set_b, keys): set size, fingerprint of the set, bucket keys (no keys for an empty set)."""
    named = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = OnePermutation(bands, rows)
        for batch in batches:
            for low, high, words in word_chunks(batch.column(1), NOT_SPACE):
                sets = list(shingle_sets(words, size))
                marks = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
                full = [s for s in sets if len(s)]
                keys = hashing.keys(np.stack([hashing.signature(s) for s in full])) if full else np.zeros((0, bands), np.uint64)
                counts = np.array([bands if len(s) else 0 for s in sets])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([m and int.from_bytes(m[:8], "big", signed=True) for m in marks], pa.int64()),
                    pa.array([m and int.from_bytes(m[8:], "big", signed=True) for m in marks], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
                        pa.array(keys.view(np.int64).ravel()),
                    ),
                ], ["id", "n", "set_a", "set_b", "keys"])

    schema = T.StructType([
        T.StructField("id", named.schema["id"].dataType), T.StructField("n", T.LongType()),
        T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()),
        T.StructField("keys", T.ArrayType(T.LongType())),
    ])
    return named.mapInArrow(sign, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Of ``pairs`` (u, v), those whose shingle sets have 100 * intersection >= percent * union.

    The text of ``v`` travels once per pair; that of ``u`` meets its pairs in the join, whose hot hubs Spark can split."""
    left = texts.select(F.col("id").alias("u"), F.col("text").alias("text_u"))
    right = texts.select(F.col("id").alias("v"), F.col("text").alias("text_v"))
    id_type = texts.schema["id"].dataType

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hubs = batch.column("u").dictionary_encode()
            codes = hubs.indices.to_numpy()
            firsts = np.unique(codes, return_index=True)[1]
            hub_sets: list[np.ndarray] = []
            for _, _, words in word_chunks(batch.column("text_u").take(pa.array(firsts)), NOT_SPACE):
                hub_sets.extend(shingle_sets(words, size))
            keep = np.zeros(batch.num_rows, bool)
            for low, _, words in word_chunks(batch.column("text_v"), NOT_SPACE):
                for k, own in enumerate(shingle_sets(words, size), low):
                    small, large = sorted((own, hub_sets[codes[k]]), key=len)
                    if len(small):
                        at = np.minimum(np.searchsorted(large, small), len(large) - 1)
                        both = int((large[at] == small).sum())
                        keep[k] = 100 * both >= percent * (len(small) + len(large) - both)
            yield batch.select(["u", "v"]).filter(pa.array(keep))

    joined = pairs.join(right, "v").join(left, "u").select("u", "v", "text_u", "text_v")
    schema = T.StructType([T.StructField("u", id_type), T.StructField("v", id_type)])
    return joined.mapInArrow(compare, schema)


def intersections(sets: list[np.ndarray], width: int = 2048) -> np.ndarray:
    """Intersection sizes of all pairs of sets of hashes: products of the 0/1 matrix, ``width`` elements at a time."""
    total = np.zeros((len(sets), len(sets)), np.float32)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, element, times = np.unique(np.concatenate([np.zeros(0, np.uint64), *sets]), return_inverse=True, return_counts=True)
    place = np.cumsum(times > 1) - 1  # elements of one set only do not matter
    held = times[element] > 1
    element, owner = place[element[held]], owner[held]
    order = np.argsort(element, kind="stable")
    element, owner = element[order], owner[order]
    for low in range(0, int(element[-1]) + 1 if len(element) else 0, width):
        a, b = np.searchsorted(element, [low, low + width])
        part = np.zeros((len(sets), width), np.float32)
        part[owner[a:b], element[a:b] - low] = 1
        total += part @ part.T
    return total


def similar(both: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """Whether sets of ``n`` shingles with ``both`` in common (whole numbers of any type) are linked, in whole numbers."""
    both, n = both.astype(np.int64), n.astype(np.int64)
    return (100 * both >= percent * (n[:, None] + n[None, :] - both)) & (both > 0)


def open_pairs(open_rows: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (u, v) that connect what is linked between different components inside the buckets of ``open_rows``
    (bucket, id, n, component)."""
    mark = F.xxhash64("id")
    stats = open_rows.groupBy("bucket").agg(
        F.count("*").alias("docs"), F.sum("n").alias("shingles"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark)).alias("y"))
    blocks = F.greatest(F.ceil(F.col("docs") / F.lit(BLOCK_DOCS)), F.ceil(F.col("shingles") / F.lit(BLOCK_SHINGLES))).cast("int")
    chosen = staged(stats.groupBy("docs", "shingles", "x", "y").agg(F.min("bucket").alias("bucket"))
                    .select("bucket", blocks.alias("blocks")), "open-buckets")
    cells = ["bucket", "low", "high"]
    dealt = (
        open_rows.join(chosen, "bucket").withColumn("block", F.pmod(mark, F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("bucket", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"), "block", "id", "component")
    )
    id_type = open_rows.schema["id"].dataType

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, low, high), table in runs(batches, cells):
            sets: list[np.ndarray] = []
            for _, _, words in word_chunks(table.column("text").combine_chunks(), NOT_SPACE):
                sets.extend(shingle_sets(words, size))
            both = intersections(sets)
            n = np.array([len(s) for s in sets], np.int64)
            of = table.column("component").combine_chunks().dictionary_encode().indices.to_numpy()
            pairs = similar(both, n, percent) & (of[:, None] != of[None, :])
            if low != high:
                block = table.column("block").to_numpy()
                pairs &= block[:, None] != block[None, :]
            u, v = np.nonzero(np.triu(pairs, 1))
            if len(u):
                label, ids = smallest_connected(len(sets), u, v), table.column("id").combine_chunks()
                keep = np.flatnonzero(label != np.arange(len(sets)))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(label[keep])), ids.take(pa.array(keep))], ["u", "v"])

    filled = staged(dealt, "open-cells").join(texts, "id").select(*cells, "block", "id", "component", "text")
    schema = T.StructType([T.StructField("u", id_type), T.StructField("v", id_type)])
    return filled.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(compare, schema)


def _sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _different(pairs: DataFrame, named: DataFrame) -> DataFrame:
    """The pairs whose ends are not in one component; an id without links is its own component."""
    left = named.select(F.col("id").alias("u"), F.col("component").alias("of_u"))
    right = named.select(F.col("id").alias("v"), F.col("component").alias("of_v"))
    return (
        pairs.join(left, "u", "left").join(right, "v", "left")
        .where(F.coalesce("of_u", "u") != F.coalesce("of_v", "v")).select("u", "v")
    )


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text",
                    bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per document: id, n_shingles, component_id (smallest linked id, itself included), kept (id = component_id)."""
    prepare(docs.sparkSession)
    signed = staged(signatures(docs, id_col, text_col, size, bands, rows), "signatures")

    # One node for each shingle set.
    copies = staged(
        signed.where("n > 0 and id is not null").groupBy("set_a", "set_b")
        .agg(F.min("id").alias("node"), F.count("*").alias("n_rows")).where("n_rows > 1").drop("n_rows"),
        "copies",
    )
    nodes = staged(
        signed.join(copies, ["set_a", "set_b"], "left")
        .withColumn("node", F.when(F.col("id").isNotNull(), F.coalesce("node", "id")))
        .select("id", "n", "node", F.when(F.col("id") == F.col("node"), F.col("keys")).alias("keys")),
        "nodes",
    )

    # Buckets of at least two nodes, each with its hub. Only an id on rows of its own kind can meet a bucket twice, so only
    # the rows of such ids are made distinct.
    keyed = nodes.where("keys is not null").select("id", "n", F.array_distinct("keys").alias("keys"))
    several = staged(keyed.groupBy("id").agg(F.count("*").alias("n_rows")).where("n_rows > 1").select("id"), "several")
    in_bucket = ["id", "n", F.explode("keys").alias("bucket")]
    rows_of = keyed.join(several, "id", "left_anti").select(*in_bucket).union(
        keyed.join(several, "id", "left_semi").select(*in_bucket).distinct())
    hub = F.min(F.struct("id", "n"))
    hubs = staged(
        rows_of.groupBy("bucket").agg(hub.alias("hub"), F.max("id").alias("last")).where("last <> hub.id")
        .select("bucket", F.col("hub.id").alias("hub"), F.col("hub.n").alias("hub_n")),
        "hubs",
    )
    members = staged(rows_of.join(hubs, "bucket"), "members")
    stars = staged(
        members.where(F.col("id") != F.col("hub")).where(_sizes_allow(F.col("n"), F.col("hub_n"), percent))
        .select(F.col("hub").alias("u"), F.col("id").alias("v")).distinct(),
        "stars",
    )
    # A table of its own, so that Spark knows its size before it decides whether texts must be shuffled.
    wanted = staged(members.select("id").distinct(), "wanted")
    texts = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(wanted, "id", "left_semi"),
        "texts",
    )

    first = stars.groupBy("v").agg(F.min("u").alias("u")).select("u", "v")
    links = staged(confirmed(first, texts, size, percent), "confirmed")
    named = components(links)

    second = _different(stars.join(first, ["u", "v"], "left_anti"), named)
    more = staged(confirmed(second, texts, size, percent), "confirmed")
    links = links.union(more)
    named = components(links)

    own = members.where(F.col("id") != F.col("hub")).join(named, "id", "left").select(
        "bucket", "id", "n", F.coalesce("component", "id").alias("component"))
    mixed = staged(
        own.groupBy("bucket").agg(F.min("component").alias("a"), F.max("component").alias("b")).where("a <> b").select("bucket"),
        "mixed",
    )
    open_rows = staged(own.join(mixed, "bucket", "left_semi"), "open")
    more = staged(open_pairs(open_rows, texts, size, percent), "confirmed")
    named = components(links.union(more)) if more.limit(1).count() else named

    named = named.withColumnRenamed("id", "node")
    return (
        nodes.join(named, "node", "left").withColumn("component_id", F.coalesce("component", "node"))
        .select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id",
                F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))
    )


def without_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, id_col: str = "doc_id",
                            text_col: str = "text") -> DataFrame:
    """One document of each group, with all columns: that of the smallest id. Of rows that repeat an id one stays, if the
    id stays in any of its texts; rows with a null id stay.

    Most documents stay, so only the ids that lose rows meet the documents."""
    # Names that no column of the documents has.
    longest = max(map(len, docs.columns))
    own_id, rows, stays = "i" * (longest + 1), "r" * (longest + 1), "s" * (longest + 1)
    losing = staged(
        near_duplicates(docs, size, percent, id_col, text_col).where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).alias(own_id)).agg(F.bool_or("kept").alias(stays), F.count("*").alias(rows))
        .where(~F.col(stays) | (F.col(rows) > 1)).select(own_id, stays),
        "losing",
    )
    same = F.col(id_col) == F.col(own_id)
    repeated = staged(losing.where(F.col(stays)).select(own_id), "repeated")
    again = docs.join(repeated, same, "left_semi").dropDuplicates([id_col])
    return docs.join(losing.select(own_id), same, "left_anti").union(again)
