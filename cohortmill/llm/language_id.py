"""Language ID by words first: known words score by their log frequency in each language, unseen words fall back to
progressively shorter character n-grams.

Training counts, per language, the words of labelled texts and the n-grams (5 to 1 letters, word ends marked) of these
words. The counts are Spark aggregations over a bounded sample of the labelled rows: of each language rows are taken by a
hash of their key so that about ``TRAIN_DOCS`` are expected, and all rows of a smaller language. The sample is the only
bound: the model keeps every count of it, one entry per word or n-gram and language that has it, so what is broadcast grows
with the entries of the sample, not with languages times words. Prediction covers every whole text:

* a word in the vocabulary adds its smoothed log frequency per language;
* any other word adds the mean over its known n-grams of the longest length that has a known one;
* a word without any known n-gram adds nothing.

The label is the language with the highest mean over words (ties: the first in sort order), ``score`` its share in the
softmax of the sums, from 0 to 1. Text that is null or has no letter is ``und`` with score 0, as is every text when
nothing could be learned.

Defined cases: training ignores rows with a null text or label; null or repeated ids are predicted row by row.
"""

from __future__ import annotations

import sys
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from cohortmill.llm.batches import gather, mix, row_chunks
from cohortmill.llm.staging import prepare, staged

UNKNOWN = "und"
TRAIN_DOCS = 5_000
LONGEST = 5

_STEP = np.uint64(0x9E3779B97F4A7C15)
_EDGE = np.uint32(0x110000)


def _letter_table() -> np.ndarray:
    return np.fromiter((chr(k).isalpha() for k in range(sys.maxunicode + 1)), bool, sys.maxunicode + 1)


_LETTERS: list[np.ndarray] = []


class LetterWords:
    """The runs of letters of some lower-cased texts, as code points."""

    def __init__(self, texts: list[str]) -> None:
        if not _LETTERS:
            _LETTERS.append(_letter_table())
        # A separator that is no letter ends each text.
        self.points = np.frombuffer("\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
        inside = np.concatenate([[False], _LETTERS[0][self.points], [False]])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        self.starts, self.ends = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.starts, bounds)

    def hashes(self) -> np.ndarray:
        """A hash of each word, from its code points in order."""
        return _folded(self.points, self.starts, self.ends - self.starts)


def _folded(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    total = lengths.astype(np.uint64)
    if not len(lengths):
        return total
    order = np.argsort(-lengths, kind="stable")
    starts, sorted_lengths = starts[order], lengths[order]
    sums = total[order]
    for k in range(int(sorted_lengths[0])):
        live = int(np.searchsorted(-sorted_lengths, -k, side="left"))
        sums[:live] = mix(sums[:live] * _STEP + points[starts[:live] + k])
    total[order] = sums
    return total


def _gram_hashes(points: np.ndarray, starts: np.ndarray, lengths: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, hash) of all n-grams of the words, each word between edge marks."""
    marked = lengths + 2
    bounds = np.concatenate([[0], np.cumsum(marked)])
    flat = np.full(bounds[-1], _EDGE, np.uint32)
    place = np.repeat(bounds[:-1] + 1 - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths) + np.arange(lengths.sum())
    flat[place] = points[np.repeat(starts - np.concatenate([[0], np.cumsum(lengths)])[:-1], lengths) + np.arange(lengths.sum())]
    counts = np.maximum(marked - n + 1, 0)
    word = np.repeat(np.arange(len(starts)), counts)
    begin = np.repeat(bounds[:-1] - np.concatenate([[0], np.cumsum(counts)])[:-1], counts) + np.arange(counts.sum())
    total = np.full(len(begin), n, np.uint64)
    for k in range(n):
        total = mix(total * _STEP + flat[begin + k])
    return word, total


class Table:
    """Sorted hashes, and for each the languages that have it: how much more likely it is there than an unseen one.

    With add-half smoothing an entry counted n times in a language of T occurrences has log frequency
    log((n + 0.5) / (T + 0.5 * entries)): that of an unseen one there (``absent``) and log(2 n + 1).
    """

    def __init__(self, hashes: np.ndarray, langs: np.ndarray, counts: np.ndarray, languages: int) -> None:
        order = np.lexsort((langs, hashes))
        hashes, self.langs, counts = hashes[order], langs[order].astype(np.int32), counts[order]
        starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else np.zeros(0, np.int64)
        self.hashes, self.bounds = hashes[starts], np.concatenate([starts, [len(hashes)]])
        self.gains = np.log(2 * counts + 1.0)
        totals = np.bincount(self.langs, counts, minlength=languages) + 0.5 * len(starts)
        self.absent = np.log(0.5 / totals) if len(starts) else np.zeros(languages)

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each hash, and whether it is there."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def sums(self, at: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
        """Per row and language the sum of the log frequencies of the entries at ``at``, each for its row."""
        out = np.bincount(row, minlength=rows)[:, None] * self.absent
        langs, bounds = gather(self.langs, self.bounds, at)
        gains, _ = gather(self.gains, self.bounds, at)
        np.add.at(out, (np.repeat(row, np.diff(bounds)), langs), gains)
        return out


class Model:
    """A table of words, and one of the n-grams of each length."""

    def __init__(self, languages: list[str], words: Table, grams: dict[int, Table]) -> None:
        self.languages, self.words, self.grams = languages, words, grams

    def word_scores(self, text: LetterWords, pick: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Score of the words at ``pick`` per language."""
        scores = np.zeros((len(pick), len(self.languages)))
        at, known = self.words.find(hashes)
        own = np.flatnonzero(known)
        scores[own] = self.words.sums(at[own], np.arange(len(own)), len(own))
        rest = np.flatnonzero(~known)
        for n in range(LONGEST, 0, -1):
            if not len(rest):
                break
            starts = text.starts[pick[rest]]
            word, grams = _gram_hashes(text.points, starts, text.ends[pick[rest]] - starts, n)
            at, seen = self.grams[n].find(grams)
            count = np.bincount(word[seen], minlength=len(rest))
            found = count > 0
            scores[rest[found]] = self.grams[n].sums(at[seen], word[seen], len(rest))[found] / count[found][:, None]
            rest = rest[~found]
        return scores

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        words = LetterWords([t.lower() for t in texts])
        hashes, first, back = np.unique(words.hashes(), return_index=True, return_inverse=True)
        scores = self.word_scores(words, first, hashes)[back]
        sums = np.zeros((len(texts), len(self.languages)))
        counts = np.diff(words.first)
        some = np.flatnonzero(counts)
        if len(some) and self.languages:
            sums[some] = np.add.reduceat(scores, words.first[:-1][some], axis=0)
        labels, shares = [], np.zeros(len(texts))
        for row, count in enumerate(counts.tolist()):
            if not count or not self.languages:
                labels.append(UNKNOWN)
                continue
            best = int(sums[row].argmax())
            labels.append(self.languages[best])
            shares[row] = 1 / np.exp(sums[row] - sums[row, best]).sum()
        return labels, shares


def _counted(train: DataFrame) -> DataFrame:
    """(lang, kind, hash, n): occurrences of words (kind 0) and n-grams (kind n), summed per batch before the shuffle."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, list[str]] = defaultdict(list)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                by_language[lang].append(text.lower())
            for lang, texts in by_language.items():
                words = LetterWords(texts)
                hashes, first, n = np.unique(words.hashes(), return_index=True, return_counts=True)
                parts = [(0, hashes, n)]
                starts = words.starts[first]
                for size in range(1, LONGEST + 1):
                    word, grams = _gram_hashes(words.points, starts, words.ends[first] - starts, size)
                    own, back = np.unique(grams, return_inverse=True)
                    parts.append((size, own, np.bincount(back, weights=n[word], minlength=len(own)).astype(np.int64)))
                for kind, own, times in parts:
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * len(own), pa.string()), pa.array(np.full(len(own), kind, np.int32)),
                        pa.array(own.view(np.int64)), pa.array(times.astype(np.int64)),
                    ], ["lang", "kind", "hash", "n"])

    counts = train.mapInArrow(count, "lang string, kind int, hash long, n long")
    return counts.groupBy("lang", "kind", "hash").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labelled: Column | None = None, text_col: str = "text", lang_col: str = "lang",
          key_col: str = "doc_id", train_docs: int = TRAIN_DOCS) -> Model:
    """The model of the rows where ``labelled`` holds (default: all) and text and label are not null."""
    prepare(docs.sparkSession)
    rows = docs if labelled is None else docs.where(labelled)
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.col(key_col).alias("key"))
    rows = rows.where("lang is not null and text is not null")
    totals = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    space = 1 << 40
    bounds = {lang: space * train_docs // n for lang, n in totals.items() if n > train_docs}
    if bounds:
        bound = F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair])[F.col("lang")]
        rows = rows.where(F.pmod(F.xxhash64("key", F.xxhash64("text")), F.lit(space)) < F.coalesce(bound, F.lit(space)))
    counts = staged(_counted(rows.select("lang", "text")), "counts")
    languages = sorted(totals)
    place = {lang: k for k, lang in enumerate(languages)}

    def table(kind: int) -> Table:
        rows = counts.where(F.col("kind") == kind).select("lang", "hash", "n").toArrow()
        langs = rows.column("lang").combine_chunks().dictionary_encode()
        numbers = np.array([place[x] for x in langs.dictionary.to_pylist()], np.int64)[langs.indices.to_numpy()]
        return Table(rows.column("hash").to_numpy().view(np.uint64), numbers, rows.column("n").to_numpy(), len(languages))

    return Model(languages, table(0), {n: table(n) for n in range(1, LONGEST + 1)})


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lang_pred, score."""
    spark = docs.sparkSession
    prepare(spark)
    shared = spark.sparkContext.broadcast(model)
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, labels, shares in predicted(shared.value, batch.column(1)):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, high - low), pa.array(labels, pa.string()), pa.array(shares)],
                    [id_col, "lang_pred", "score"])

    return named.mapInArrow(label, T.StructType([
        named.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def predicted(model: Model, column: pa.Array) -> Iterator[tuple[int, int, list[str], np.ndarray]]:
    """(first row, end row, labels, scores) in chunks of the batch."""
    texts = [t or "" for t in column.to_pylist()]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    for low, high in row_chunks(bounds):
        labels, shares = model.predict(texts[low:high])
        yield low, high, labels, shares


def keep_identified(docs: DataFrame, model: Model, least: float = 0.0, text_col: str = "text") -> DataFrame:
    """The documents, all columns, whose language is known with at least ``least`` (default: all that are not ``und``)."""
    spark = docs.sparkSession
    prepare(spark)
    shared, place = spark.sparkContext.broadcast(model), docs.columns.index(text_col)

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, labels, shares in predicted(shared.value, batch.column(place)):
                good = (np.array(labels) != UNKNOWN) & (shares >= least)
                yield batch.slice(low, high - low).filter(pa.array(good))

    return docs.mapInArrow(kept, docs.schema)
