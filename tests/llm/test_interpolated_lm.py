"""Deleted interpolation against counts of word tuples."""

from __future__ import annotations

import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import interpolated_lm as lm
from cohortmill.llm.queries import QUERIES

DDL = "doc_id long, text string"


def tokens_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in lowered.translate({k: 32 for k in range(9, 14)}).split(" ") if w] + ["</s>"]


def part_of(doc_id):
    rest = zlib.crc32(str(doc_id).encode()) % 10
    return lm.SCORED if rest == 0 else lm.DELETED if rest == 9 else lm.KEPT


def part_column():
    rest = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10
    return F.when(rest == 0, lm.SCORED).when(rest == 9, lm.DELETED).otherwise(lm.KEPT)


class Counts:
    def __init__(self, texts, order):
        self.order, self.grams, self.contexts = order, Counter(), Counter()
        for text in texts:
            for k, gram in ((k, g) for i in range(len(text)) for k, g in enumerate(self.grams_at(text, i))):
                self.grams[gram] += 1
                self.contexts[(k, gram[:-1])] += 1
        self.floor = 1 / (len({g for g in self.grams if len(g) == 1}) + 1)

    def grams_at(self, text, i):
        padded = ["<s>"] * (self.order - 1) + text
        at = i + self.order - 1
        return [tuple(padded[at - k:at + 1]) for k in range(self.order)]

    def levels(self, text, i):
        for k, gram in enumerate(self.grams_at(text, i)):
            above = self.contexts[(k, gram[:-1])]
            yield 0 if not above else int(math.log2(above)) + 1, self.grams[gram] / above if above else 0.0

    def probability(self, text, i, weights):
        p = self.floor
        for k, (bucket, estimate) in enumerate(self.levels(text, i)):
            w = weights[k][bucket]
            p = w * estimate + (1 - w) * p
        return p


def learned(counts, texts, rounds):
    weights = np.full((counts.order, 66), 0.5)
    weights[:, 0] = 0
    for _ in range(rounds):
        chosen, reached = np.zeros_like(weights), np.zeros_like(weights)
        for text in texts:
            for i in range(len(text)):
                levels, chain = list(counts.levels(text, i)), [counts.floor]
                for k, (bucket, estimate) in enumerate(levels):
                    chain.append(weights[k][bucket] * estimate + (1 - weights[k][bucket]) * chain[-1])
                left = 1.0
                for k in reversed(range(counts.order)):
                    bucket, estimate = levels[k]
                    own = left * weights[k][bucket] * estimate / chain[k + 1]
                    chosen[k, bucket] += own
                    reached[k, bucket] += left
                    left -= own
        common = (chosen.sum(axis=1) + 1) / (reached.sum(axis=1) + 2)
        weights = np.where(reached > 0, (chosen + 1) / (reached + 2), common[:, None])
        weights[:, 0] = 0
    return weights


def made_up(n, seed=1):
    rng = random.Random(seed)
    words = ["the", "The", "of", "cat", "Café", "ÉTÉ", "x y", "a.b"] + [f"w{k}" for k in range(60)]
    rows = [(k, rng.choice([" ", "\n", "\t "]).join(words[min(int(rng.expovariate(0.12)), len(words) - 1)] for _ in range(rng.randint(0, 40))))
            for k in range(n)]
    return rows + [(n, None), (n + 1, ""), (n + 2, " \n"), (5, "the the cat"), (5, "the the cat"), (None, "of the cat"),
                   (n + 3, "rare" + "word" * 30_000), (n + 4, "the cat " * 20_000)]


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores_equal_counts_of_tuples(spark, order):
    rows = made_up(150)
    df, totals, weights = lm.score(spark.createDataFrame(rows, DDL).repartition(5), part_column(), order)
    found = sorted((tuple(r) for r in df.collect()), key=repr)
    texts = [(doc, part_of(doc) if doc is not None else lm.KEPT, tokens_of(text)) for doc, text in rows]
    train = [t for _, part, t in texts if part != lm.SCORED]
    own, every = Counts([t for _, part, t in texts if part == lm.KEPT], order), Counts(train, order)
    assert totals.tokens[1] == sum(map(len, train)) and totals.texts[1] == len(train)
    assert np.allclose(weights.table, learned(own, [t for _, part, t in texts if part == lm.DELETED], weights.rounds))
    assert all(b >= a - 1e-6 * abs(a) for a, b in zip(weights.history, weights.history[1:], strict=False))
    n, v = totals.tokens[1], totals.types[1]
    expected = []
    for doc, part, text in texts:
        counts = [every.grams[(w,)] for w in text]
        expected.append((doc, part, len(text), sum(c > 0 for c in counts),
                         sum(math.log10((c + 0.1) / (n + 0.1 * (v + 1))) for c in counts),
                         sum(math.log10(every.probability(text, i, weights.table)) for i in range(len(text)))))
    expected.sort(key=repr)
    assert [r[:4] for r in found] == [r[:4] for r in expected]
    assert np.allclose([r[4:] for r in found], [r[4:] for r in expected], rtol=1e-9)


def test_probabilities_sum_to_one():
    rng = random.Random(3)
    texts = [tokens_of(" ".join(rng.choice("abcde") for _ in range(8))) for _ in range(40)]
    counts = Counts(texts, 2)
    weights = learned(counts, texts[:5], 3)
    words = sorted({w for t in texts for w in t}) + ["never-seen"]
    for context in (["a"], ["e"], [], ["never-seen"]):
        assert math.isclose(sum(counts.probability([*context, w], len(context), weights) for w in words), 1)


def test_packed_integers_come_back():
    rng = np.random.default_rng(1)
    for values in (np.zeros(0, np.int64), np.array([0, 5, 1 << 40]), rng.integers(0, 9, 1000)):
        assert (lm.unpack(lm.pack(values)) == values).all()
    keys = np.unique(rng.integers(0, 2**64 - 1, 500, dtype=np.uint64))
    assert (lm.unpack_sorted(lm.pack_sorted(keys)) == keys).all()


def test_rows_and_batches_a_task_holds_are_bounded(spark, monkeypatch):
    tables, staged = {}, lm.staged
    monkeypatch.setattr(lm, "staged", lambda df, name, *options: tables.setdefault(name, staged(df, name, *options)))
    df = spark.createDataFrame([(k, "the cat sat " * 40_000) for k in range(6)], DDL).repartition(1)
    lm.score(df, F.when(F.col("doc_id") < 4, lm.KEPT).otherwise(lm.DELETED))
    longest, total = tables["estimates"].agg(F.max(F.length("bucket")), F.sum(F.length("bucket"))).first()
    assert longest <= 1 << 17 and total == lm.ORDER * 2 * 120_001

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    wide = spark.range(0, 40, 1, 1).withColumn("x", F.expr("repeat('x', 1000000)"))
    assert wide.mapInArrow(sizes, "n long").agg(F.max("n")).first()[0] < 8_000_000


def test_nothing_to_learn_from_and_empty_table(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], DDL)
    out, totals, _ = lm.score(df, F.lit(lm.SCORED))
    assert totals.tokens == [0, 0] and {(r.n_tokens, r.n_known, r.base_score, r.score) for r in out.collect()} == {(3, 0, 0, 0), (1, 0, 0, 0)}
    only = lm.score(df, F.lit(lm.KEPT))[0].collect()
    assert all(math.isfinite(r.score) and r.n_known == r.n_tokens for r in only)
    assert lm.score(spark.createDataFrame([], DDL), F.lit(lm.KEPT))[0].count() == 0


def test_other_columns_do_not_clash(spark):
    rows = made_up(30)
    wide = spark.createDataFrame(rows, DDL)
    plain = lm.score(wide, part_column())[0].collect()
    for name in ("id", "part", "chunk", "kind", "bucket", "keys", "kept", "n", "types", "score"):
        wide = wide.withColumn(name, F.lit("x"))
    assert sorted(map(repr, lm.score(wide, part_column())[0].collect())) == sorted(map(repr, plain))


def test_held_out_text_is_likelier_than_by_single_words(spark):
    out = QUERIES["op11_interpolated_lm"](spark, "/root/testdata/sf0.01")
    assert out.columns == ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    sums = out.where("held_out").agg(F.sum("base_score"), F.sum("score"), F.count("*")).first()
    assert sums[2] > 50 and sums[1] > 1.1 * sums[0] and sums[1] < 0
