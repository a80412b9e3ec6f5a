"""Merkle manifest of a dataset as a persistent, path-copying tree.

Each row is a leaf, the SHA-256 of its fields. Within a source leaves ascend by id; every ``FAN`` consecutive nodes (the
last run may be shorter, even one) become the hash of their digests until one remains, the subroot. The subroots, in the
order of their sources, become the root by the same rule.

The tree is built in aligned blocks of FAN ** ``LAYER`` leaves. A block is a small tree of its own that one task holds;
the roots of the blocks of a source are the leaves of the next layer of blocks, and so on, so a source that holds a third
of all rows is as many blocks as it needs. Paths then go down again: each block is given the siblings above its root, and
each leaf has its proof.

A changed leaf is a new version of the tree. It copies the leaf's ancestors within the block and shares every other node;
above the block the version goes on with the siblings that came down, copying one node per level, so a version costs the
height of the tree and versions of different leaves never touch each other.

What is shuffled are ids and digests, never texts: once to place the leaves, once to build the blocks and once for the
versions. One digest reaches the driver, the root.

Defined cases: a null field counts as ``-``; a null source is a source that comes first; null ids come first in their
source, ties go by the digest of the leaf, and repeated rows are leaves of their own; a null id is never tampered with; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortmill.llm.batches import row_batches, started_runs
from cohortmill.llm.ranks import in_blocks, placed
from cohortmill.llm.staging import prepare, staged

FAN = 3
LAYER = 7


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


class Block:
    """The tree over one aligned run of leaves: at most ``layer`` levels of a tree over ``n`` of them."""

    def __init__(self, leaves: list[str], n: int, layer: int = LAYER) -> None:
        self.levels = [leaves]
        for _ in range(min(layer, height(n))):
            below = self.levels[-1]
            self.levels.append([digest("".join(below[k:k + FAN])) for k in range(0, len(below), FAN)])

    @property
    def root(self) -> str:
        return self.levels[-1][0]

    def siblings(self, place: int) -> list[tuple[str, str]]:
        """What stands before and after the node in its run, level by level."""
        found = []
        for level in self.levels[:-1]:
            low = place - place % FAN
            found.append(("".join(level[low:place]), "".join(level[place + 1:low + FAN])))
            place //= FAN
        return found

    def version(self, place: int, leaf: str) -> list[str]:
        """The tree with another leaf: the leaf and the copies of its ancestors up to the new root of the block. Every
        other node is that of this block."""
        return copied(self.siblings(place), leaf)


def copied(siblings: list[tuple[str, str]], node: str) -> list[str]:
    """``node`` and its ancestors between the given siblings."""
    path = [node]
    for before, after in siblings:
        path.append(digest(before + path[-1] + after))
    return path


def as_text(siblings: list[tuple[str, str]]) -> str:
    return ",".join(f"{before}|{after}" for before, after in siblings)


def from_text(path: str) -> list[tuple[str, str]]:
    return [tuple(level.split("|")) for level in path.split(",")] if path else []


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def layer_above(nodes: DataFrame, layer: int = LAYER) -> DataFrame:
    """The roots of all blocks of ``nodes`` (group, place, n, digest), in the same shape: ``n`` of them in the group."""
    span = FAN ** layer

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for run in started_runs(batches, lambda b: b.column("place").to_numpy() % span == 0):
                n = run.column("n")[0].as_py()
                block = Block(run.column("digest").to_pylist(), n, layer)
                yield run.column("group")[0].as_py(), run.column("place")[0].as_py() // span, -(-n // span), block.root

        yield from row_batches(rows(), ["group", "place", "n", "digest"], [pa.string(), pa.int64(), pa.int64(), pa.string()])

    shape = "group string, place long, n long, digest string"
    nodes = in_blocks(nodes.select("group", "place", "n", "digest"), "group", span, "place")
    return nodes.mapInArrow(build, shape)


def layers(nodes: DataFrame, layer: int, name: str) -> list[DataFrame]:
    """``nodes`` and the layers above them; the last one has one node per group, its root."""
    found = [nodes]
    while len(found) == 1 or found[-1].agg(F.max("n")).first()[0] > 1:
        found.append(staged(layer_above(found[-1], layer), name))
    return found


def _with_paths(nodes: DataFrame, above: DataFrame, layer: int) -> DataFrame:
    """``nodes`` by blocks, each block behind a row with the path above its root (``above``: group, place, path ...)."""
    marks = above.withColumn("place", F.col("place") * FAN ** layer).withColumn("marked", F.lit(0))
    marked = nodes.withColumn("marked", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    return in_blocks(marked, "group", FAN ** layer, "marked", "place")


def _blocks(batches: Iterator[pa.RecordBatch], layer: int) -> Iterator[
        tuple[pa.Table, pa.Table, Block, list[tuple[str, str]]]]:
    """(row with the path, rows of the nodes, tree, path above the tree) of each block of a partition."""
    for run in started_runs(batches, lambda b: b.column("path").is_valid().to_numpy(zero_copy_only=False)):
        mark, nodes = run.slice(0, 1), run.slice(1)
        block = Block(nodes.column("digest").to_pylist(), nodes.column("n")[0].as_py(), layer)
        yield mark, nodes, block, from_text(mark.column("path")[0].as_py())


def paths_below(nodes: DataFrame, above: DataFrame, layer: int = LAYER) -> DataFrame:
    """(group, place, path) of ``nodes`` from the paths of the layer above."""
    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for mark, nodes, block, path in _blocks(batches, layer):
                group = mark.column("group")[0].as_py()
                for k, place in enumerate(nodes.column("place").to_pylist()):
                    yield group, place, as_text(block.siblings(k) + path)

        yield from row_batches(rows(), ["group", "place", "path"], [pa.string(), pa.int64(), pa.string()])

    return _with_paths(nodes, above, layer).mapInArrow(descend, "group string, place long, path string")


def descended(found: list[DataFrame], above: DataFrame, layer: int, name: str, to: int) -> DataFrame:
    """Paths of layer ``to`` of a tree, from the paths of its last one."""
    for nodes in reversed(found[to:-1]):
        above = staged(paths_below(nodes, above, layer), name)
    return above


def manifest(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", field_cols: tuple[str, ...] = (
        "doc_id", "source", "lang", "n_chars", "text"), changed: dict[str, Column] | None = None, layer: int = LAYER) -> DataFrame:
    """Per row: id, leaf, subroot, root, path (the siblings from the leaf to the root), folded_root and verified.

    ``changed`` maps fields to their value in the version to check (null field and all: the row as it is now); default: no
    row differs. ``folded_root`` is the root of the version in which this row alone has its changed fields.
    """
    prepare(docs.sparkSession)
    changed = changed or {}
    rows = docs.select(
        F.col(id_col).alias("id"),
        # Null before any source, and sources by their bytes.
        F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("")).alias("group"),
        leaf(*[F.col(c) for c in field_cols]).alias("digest"),
        leaf(*[changed.get(c, F.col(c)) for c in field_cols]).alias("now"),
    )
    leaves = staged(placed(staged(rows, "digests"), "group", ["id", "digest"], "leaves"), "placed-leaves")
    shape = T.StructType([T.StructField(id_col, leaves.schema["id"].dataType)] + [
        T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root", "path", "folded_root")
    ] + [T.StructField("verified", T.BooleanType())])
    if leaves.isEmpty():
        return docs.sparkSession.createDataFrame([], shape)

    of_sources = layers(leaves, layer, "source-layer")
    subroots = of_sources[-1].select("group", F.col("digest").alias("subroot"))
    tops = placed(subroots.select(F.lit("").alias("whole"), "group", F.col("subroot").alias("digest")), "whole", ["group"], "subroots")
    tops = staged(tops.select(F.col("group").alias("source"), F.col("whole").alias("group"), "place", "n", "digest"), "placed-subroots")
    of_whole = layers(tops.drop("source"), layer, "whole-layer")
    root = of_whole[-1].first()["digest"]

    over_whole = of_whole[-1].select("group", "place", F.lit("").alias("path"))
    over_sources = tops.select("source", "place").join(descended(of_whole, over_whole, layer, "whole-paths", 0).drop("group"), "place")
    over_sources = over_sources.select(F.col("source").alias("group"), F.lit(0).cast("long").alias("place"), "path")
    over_blocks = descended(of_sources, over_sources, layer, "source-paths", 1).join(subroots, "group")

    def versions(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for mark, nodes, block, path in _blocks(batches, layer):
            subroot, found, folded = mark.column("subroot")[0].as_py(), [], []
            for k, now in enumerate(nodes.column("now").to_pylist()):
                found.append(as_text(block.siblings(k) + path))
                # A version of the block, gone on with above it.
                folded.append(copied(path, block.version(k, now)[-1])[-1])
            ids = nodes.column("id").combine_chunks()
            yield pa.RecordBatch.from_arrays([
                ids, nodes.column("digest").combine_chunks(), pa.array([subroot] * len(ids), pa.string()),
                pa.array([root] * len(ids), pa.string()), pa.array(found, pa.string()), pa.array(folded, pa.string()),
                pa.array([x == root for x in folded], pa.bool_()),
            ], shape.names)

    return _with_paths(leaves, over_blocks, layer).mapInArrow(versions, shape)


def proof(path: str = "path") -> Column:
    """SHA-256 of the siblings of a path, one after the other."""
    return F.sha2(F.translate(path, "|,", "").cast("binary"), 256)
