"""The Merkle manifest against a plain recursive version, over layers of small blocks."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from cohortmill.llm import merkle
from cohortmill.llm.queries import QUERIES

DDL = "doc_id long, source string, lang string, n_chars long, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def grow(nodes):
    """(root, siblings of each node, lowest level first)."""
    proofs, owners, level = [[] for _ in nodes], [[k] for k in range(len(nodes))], list(nodes)
    while len(level) > 1:
        runs = [range(k, min(k + 3, len(level))) for k in range(0, len(level), 3)]
        for run in runs:
            for at in run:
                pair = ("".join(level[x] for x in run if x < at), "".join(level[x] for x in run if x > at))
                for leaf in owners[at]:
                    proofs[leaf].append(pair)
        owners = [[leaf for at in run for leaf in owners[at]] for run in runs]
        level = [sha("".join(level[at] for at in run)) for run in runs]
    return level[0], proofs


def brute(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[1], []).append(row)
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    grown = {}
    for source in order:
        leaves = sorted(((r[0] is not None, r[0] or 0, sha("".join(map(field, r))), r) for r in by_source[source]), key=lambda x: x[:3])
        grown[source] = leaves, *grow([x[2] for x in leaves])
    root, tops = grow([grown[s][1] for s in order])
    out = []
    for source, top in zip(order, tops, strict=True):
        leaves, subroot, proofs = grown[source]
        for (_, _, leaf, row), proof in zip(leaves, proofs, strict=True):
            proof = proof + top
            node = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                node = sha("".join(map(field, [*row[:4], row[4].replace("\n", "")])))
            for before, after in proof:
                node = sha(before + node + after)
            out.append((row[0], leaf, subroot, root, sha("".join(a + b for a, b in proof)), node, node == root))
    return out


def tampered():
    is_even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return {"text": F.when(is_even, F.translate("text", "\n", "")).otherwise(F.col("text"))}


def rows_of(df):
    return [tuple(r) for r in df.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(), "folded_root", "verified").collect()]


def made_up(n, seed=5):
    rng = random.Random(seed)
    sources = [None, "", "a", "b", "é", "Z"]
    rows = [(k, rng.choice(sources) if k % 3 else "hot", rng.choice([None, "en"]), rng.choice([None, 3]),
             rng.choice([None, "", "x\ny", "long é\n\n" * 40, f"text {k}"])) for k in range(n)]
    return rows + [(None, "a", None, None, "x\ny"), (None, "a", None, None, "x\ny"), (None, "a", "en", 1, "z"),
                   (7, "a", None, None, "same\n"), (7, "a", None, None, "same\n"), (10**18, "alone", None, None, "q\n")]


@pytest.mark.parametrize(("n", "layer"), [(400, 1), (400, 2), (30, 7)])
def test_manifest_equals_recursion(spark, n, layer):
    rows = made_up(n)
    found = rows_of(merkle.manifest(spark.createDataFrame(rows, DDL), changed=tampered(), layer=layer))
    assert sorted(found, key=repr) == sorted(brute(rows), key=repr)
    assert {x[-1] for x in found} == {True, False}


def test_versions_share_all_but_the_path():
    block = merkle.Block([sha(str(k)) for k in range(20)], 20)
    before = [list(level) for level in block.levels]
    path = block.version(13, sha("other"))
    assert len(path) == len(block.levels) == 4 and path[-1] != block.root and block.levels == before
    leaves = [sha(str(k)) if k != 13 else sha("other") for k in range(20)]
    assert merkle.Block(leaves, 20).root == path[-1]
    assert block.version(13, sha("13"))[-1] == block.root


def test_one_row_one_source_and_no_row(spark):
    one = [(3, None, None, None, None)]
    assert rows_of(merkle.manifest(spark.createDataFrame(one, DDL))) == brute(one)
    empty = merkle.manifest(spark.createDataFrame([], DDL))
    assert empty.count() == 0 and "folded_root" in empty.columns


def test_other_columns_do_not_clash(spark):
    rows = made_up(20)
    wide = spark.createDataFrame(rows, DDL)
    for name in ("id", "group", "place", "n", "digest", "path", "marked", "block", "now", "__at", "root", "leaf"):
        wide = wide.withColumn(name, F.lit("x"))
    assert sorted(rows_of(merkle.manifest(wide, changed=tampered())), key=repr) == sorted(brute(rows), key=repr)


def test_query_on_given_table(spark):
    out = QUERIES["op13_merkle_manifest"](spark, "/root/testdata/sf0.001")
    rows = [tuple(r) for r in out.collect()]
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(rows) == sorted(brute([tuple(r) for r in docs.collect()]))
