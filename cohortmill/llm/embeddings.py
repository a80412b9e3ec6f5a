"""Embedding near-duplicates with randomly rotated binary codes.

Every valid vector is normalised and rotated at random; its code is the signs of the rotated components, and the stored
correction factor is the inner product of the code's unit vector with the rotated vector. For another vector q,
<code, rotated q> / factor estimates the cosine without bias, with an error that exceeds
``epsilon * sqrt((1 - f^2) / f^2) / sqrt(d - 1)`` with a probability that falls exponentially in epsilon squared. Pairs
whose upper bound is below the threshold are dismissed; all others are computed exactly in double precision, and only the
exact value makes a link.

Which pairs are looked at: vectors meet in buckets of ``bits`` random-hyperplane signs, in ``bands`` bands. At cosine 0.95 a
pair shares no bucket with probability 5e-6; higher cosines less. A pair is counted in the first band in which its keys
agree only. Buckets with the same members are looked at once. Equal vectors are one node with a weight, known by the
fingerprint of the vector; ids come in only where a component is named by its smallest.

Large buckets are dealt into blocks by a hash, and each pair of blocks is one cell of at most about ``2 * BLOCK`` vectors, so
no group meets in one task. Cells give one row per linked vector (its number of links there and its smallest connected
member), never pairs.

Defined cases: a vector that is null, empty, zero, or has null or non-finite components links with nothing; vectors of different
lengths never link; rows with a null id link with nothing; rows that repeat an id count as rows, with equal or different vectors.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.llm.batches import pairs_of_runs, smallest_connected, whole_runs
from cohortmill.llm.components import components
from cohortmill.llm.staging import prepare, staged

BITS, BANDS = 20, 96
EPSILON = 5.0
BLOCK = 512


@functools.lru_cache(maxsize=8)
def rotation(dim: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(dim).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


@functools.lru_cache(maxsize=8)
def hyperplanes(dim: int, bands: int, bits: int) -> np.ndarray:
    return np.random.default_rng(dim + 1_000_003).standard_normal((dim, bands * bits))


def band_keys(units: np.ndarray, bands: int, bits: int) -> np.ndarray:
    """The sign bits of each band as one number, by vector and band."""
    signs = (units @ hyperplanes(units.shape[1], bands, bits) > 0).reshape(len(units), bands, bits)
    return signs @ (1 << np.arange(bits))


def codes(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated vectors, and the correction factors."""
    rotated = units @ rotation(units.shape[1])
    return np.packbits(rotated > 0, axis=1), np.abs(rotated).sum(axis=1) / np.sqrt(units.shape[1])


def possible(signs: np.ndarray, rotated: np.ndarray, factors: np.ndarray, u: np.ndarray, v: np.ndarray, threshold: float,
             epsilon: float) -> np.ndarray:
    """Whether the cosine of the pairs (u, v) may reach the threshold, by the bounds of both codes."""
    dim = signs.shape[1]
    error = epsilon * np.sqrt(np.maximum(1 - factors**2, 0)) / factors / np.sqrt(max(dim - 1, 1))
    out = np.ones(len(u), bool)
    for a, b in ((u, v), (v, u)):
        estimate = np.einsum("ij,ij->i", signs[a], rotated[b]) / np.sqrt(dim) / factors[a]
        out &= estimate + error[a] >= threshold
    return out


_VECTOR = T.StructType([
    T.StructField("set_a", T.LongType()), T.StructField("set_b", T.LongType()), T.StructField("vector", T.ArrayType(T.DoubleType())),
    T.StructField("code", T.BinaryType()), T.StructField("factor", T.DoubleType()), T.StructField("keys", T.ArrayType(T.IntegerType())),
])


def _encoded(vectors: DataFrame, bands: int, bits: int) -> DataFrame:
    """(id, fingerprint, vector, code, factor, keys) of the valid vectors; null fields for the others."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [None] * batch.num_rows
            by_dim: dict[int, list[int]] = {}
            arrays = []
            for k, cell in enumerate(batch.column(1).to_pylist()):
                arrays.append(None)
                if cell and None not in cell:
                    v = np.array(cell, np.float64) + 0.0
                    norm = np.linalg.norm(v / np.abs(v).max()) if np.isfinite(v).all() and np.abs(v).max() > 0 else 0.0
                    if norm:
                        arrays[k] = v
                        by_dim.setdefault(len(v), []).append(k)
            for places in by_dim.values():
                stack = np.stack([arrays[k] for k in places])
                units = unit(stack)
                packed, factors = codes(units)
                keys = band_keys(units, bands, bits)
                for k, v, code, factor, key in zip(places, stack, packed, factors, keys, strict=True):
                    mark = hashlib.blake2b(v.tobytes(), digest_size=16).digest()
                    rows[k] = (int.from_bytes(mark[:8], "big", signed=True), int.from_bytes(mark[8:], "big", signed=True),
                               v.tolist(), code.tobytes(), float(factor), key.tolist())
            columns = list(zip(*[r or (None,) * 6 for r in rows], strict=True)) or [()] * 6
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.binary(), pa.float64(), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds, strict=True))],
                ["id", *(f.name for f in _VECTOR)])

    return vectors.mapInArrow(run, T.StructType([vectors.schema["id"], *_VECTOR]))


def unit(stack: np.ndarray) -> np.ndarray:
    scaled = stack / np.abs(stack).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _cell_links(bounds: np.ndarray, table: pa.Table, threshold: float, epsilon: float) -> tuple[np.ndarray, np.ndarray]:
    """(number of links, position of the smallest connected member) of the rows of some cells."""
    n = table.num_rows

    def matrix(name: str) -> np.ndarray:
        return np.asarray(table.column(name).combine_chunks().flatten()).reshape(n, -1)

    packed = np.frombuffer(b"".join(table.column("code").to_pylist()), np.uint8).reshape(n, -1)
    units, keys, factors = unit(matrix("vector")), matrix("keys"), table.column("factor").to_numpy()
    dim = units.shape[1]
    signs, rotated = np.unpackbits(packed, axis=1, count=dim).astype(np.float32) * 2 - 1, (units @ rotation(dim)).astype(np.float32)
    block, low, high, band = (table.column(c).to_numpy() for c in ("block", "low", "high", "band"))
    weights, count = table.column("weight").to_numpy(), np.zeros(n, np.int64)
    links_u, links_v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for u, v in pairs_of_runs(bounds):
        two = (low[u] == high[u]) | (block[u] != block[v])  # pairs inside one block belong to its own cell
        u, v = u[two], v[two]
        first = (keys[u] == keys[v]).argmax(axis=1) == band[u]
        u, v = u[first], v[first]
        near = possible(signs, rotated, factors, u, v, threshold, epsilon)
        u, v = u[near], v[near]
        linked = np.einsum("ij,ij->i", units[u], units[v]) >= threshold
        u, v = u[linked], v[linked]
        np.add.at(count, u, weights[v])
        np.add.at(count, v, weights[u])
        links_u.append(u)
        links_v.append(v)
    return count, smallest_connected(n, np.concatenate(links_u), np.concatenate(links_v))


def near_duplicate_vectors(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding",
                           bands: int = BANDS, bits: int = BITS, epsilon: float = EPSILON, block: int = BLOCK) -> DataFrame:
    """Per row: id, n_links, component_id, kept."""
    prepare(vectors.sparkSession)
    encoded = staged(
        _encoded(vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector")), bands, bits), "vectors")
    valid = encoded.where("set_a is not null and id is not null")
    node = F.struct("set_a", "set_b").alias("node")
    groups = staged(valid.groupBy("set_a", "set_b").agg(F.min("id").alias("id"), F.count("*").alias("weight")), "groups")
    nodes = staged(
        groups.join(encoded, ["set_a", "set_b", "id"]).dropDuplicates(["set_a", "set_b"])
        .select(node, "weight", "vector", "code", "factor", "keys"), "nodes")

    # Buckets of several nodes; of buckets with equal members that of the first band.
    in_bands = nodes.select("node", F.size("vector").alias("dim"), F.posexplode("keys").alias("band", "key"))
    mark = F.xxhash64("node")
    sizes = in_bands.groupBy("band", "dim", "key").agg(
        F.count("*").alias("n"), F.bit_xor(mark).alias("x"), F.bit_xor(F.xxhash64(mark)).alias("y")).where("n > 1")
    buckets = staged(
        sizes.groupBy("n", "dim", "x", "y").agg(F.min(F.struct("band", "key")).alias("first"))
        .select(F.col("first.band").alias("band"), "dim", F.col("first.key").alias("key"), "n"), "buckets")
    n_blocks = F.ceil(F.col("n") / F.lit(block)).cast("int")
    rows = (
        in_bands.join(buckets, ["band", "dim", "key"])
        .withColumn("block", F.pmod(mark, n_blocks).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
        .select("node", "dim", "key", "band", "block", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"))
    )
    cells = ["dim", "key", "band", "low", "high"]
    filled = staged(rows, "cells").join(nodes, "node").select(
        *cells, "block", "node", "weight", "vector", "code", "factor", "keys")
    node_type = nodes.schema["node"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, table in whole_runs(batches, cells):
            dims = table.column("dim").to_numpy()[bounds[:-1]]
            cuts = np.concatenate([[0], np.flatnonzero(dims[1:] != dims[:-1]) + 1, [len(dims)]])
            for a, b in zip(cuts, cuts[1:], strict=False):
                part = table.slice(bounds[a], bounds[b] - bounds[a])
                count, label = _cell_links(bounds[a:b + 1] - bounds[a], part, threshold, epsilon)
                names, keep = part.column("node").combine_chunks(), np.flatnonzero(count)
                if len(keep):
                    yield pa.RecordBatch.from_arrays(
                        [names.take(pa.array(label[keep])), names.take(pa.array(keep)), pa.array(count[keep])], ["u", "v", "n"])

    found = filled.repartition(*cells).sortWithinPartitions(*cells).mapInArrow(run, T.StructType([
        T.StructField("u", node_type), T.StructField("v", node_type), T.StructField("n", T.LongType())]))
    found = staged(found, "found")
    counts = found.groupBy("v").agg(F.sum("n").alias("linked")).withColumnRenamed("v", "node")
    named = components(found).withColumnRenamed("id", "node")
    linked = staged(
        groups.select("set_a", "set_b", "id", "weight", node).join(counts, "node", "left").join(named, "node", "left")
        .select("set_a", "set_b", "id", (F.coalesce("linked", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "node").alias("named")),
        "linked",
    )
    smallest = staged(linked.groupBy("named").agg(F.min("id").alias("component")), "smallest")
    answers = staged(linked.join(smallest, "named").select("set_a", "set_b", "n_links", "component"), "answers")
    alone = F.col("id").isNull() | F.col("set_a").isNull()
    component = F.when(alone, F.col("id")).otherwise(F.col("component"))
    return (
        encoded.select("id", "set_a", "set_b").join(answers, ["set_a", "set_b"], "left")
        .select(F.col("id").alias(id_col), F.when(alone, F.lit(0)).otherwise(F.col("n_links")).cast("long").alias("n_links"),
                component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))
    )
