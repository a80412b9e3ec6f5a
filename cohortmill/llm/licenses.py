"""License scans by template markup: optional and replaceable regions are compiled into token automata.

A template (see ``license_templates``) becomes an automaton over words: a mandatory word is one transition, an optional
region may be skipped, a replaceable region takes up to its number of any words. A text is accepted where the automaton
runs from a template's first words to its end, so the mandatory wording matches exactly. Runs start only where the first
mandatory words (the anchor) stand, found by window hashes over the whole text and verified; all places are tried.

Defined cases: a null or word-less text has no places and no labels (empty strings) and score 0; repeated rows are answered
each. The score is 1 with an accepted template, 0.5 with a base phrase only, else 0.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from cohortmill.llm.batches import ALNUM, Words, word_chunks
from cohortmill.llm.license_templates import BASE_PHRASES, LABELS, SPELLINGS, TEMPLATES
from cohortmill.llm.staging import prepare

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_PART = re.compile(r"(\[\[)|(\]\])|<<(\d+)>>|([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)")
ANCHOR = 3


def parts(template: str) -> list:
    """Words, ("any", n) for a replaceable region, and ("maybe", parts) for an optional one."""
    stack: list[list] = [[]]
    for begin, end, count, word in _PART.findall(template):
        if begin:
            stack.append([])
        elif end:
            inner = stack.pop()
            stack[-1].append(("maybe", inner))
        elif count:
            stack[-1].append(("any", int(count)))
        else:
            stack[-1].append(SPELLINGS.get(word.lower(), word.lower()))
    return stack[0]


class Automaton:
    """States 0 .. end; by state: the word it takes, whether it takes any word, and where it may go without a word."""

    def __init__(self, template: str) -> None:
        self.parts = parts(template)
        self.words: list[bytes | None] = []
        self.any: list[bool] = []
        self.skips: list[list[int]] = []
        self._add(self.parts)
        self.end = len(self.words)
        self.anchor = [w for w in itertools.takewhile(lambda p: isinstance(p, str), self.parts)][:ANCHOR]
        if not self.anchor:
            raise ValueError("a template begins with mandatory words")
        self.start = self.closed({0})

    def _state(self, word: bytes | None, takes_any: bool) -> int:
        self.words.append(word)
        self.any.append(takes_any)
        self.skips.append([])
        return len(self.words) - 1

    def _add(self, region: list) -> None:
        for part in region:
            if isinstance(part, str):
                self._state(part.encode(), False)
            elif part[0] == "any":
                states = [self._state(None, True) for _ in range(part[1])]
                for s in states:
                    self.skips[s].append(len(self.words))
            else:
                first = self._state(None, False)
                self.skips[first].append(first + 1)
                self._add(part[1])
                self.skips[first].append(len(self.words))

    def closed(self, states: set[int]) -> frozenset[int]:
        out, todo = set(states), list(states)
        while todo:
            s = todo.pop()
            for t in self.skips[s] if s < len(self.skips) else ():
                if t not in out:
                    out.add(t)
                    todo.append(t)
        return frozenset(out)

    def run(self, words: Words, at: int, stop: int) -> int | None:
        """The end of the longest accepted run of words from ``at``, or None."""
        states, accepted = self.start, None
        while states:
            if self.end in states:
                accepted = at
            if at >= stop:
                break
            word = words.data[words.starts[at]:words.ends[at]].tobytes()
            word = _SPELLED.get(word, word)
            states = self.closed({s + 1 for s in states if s < self.end and (self.any[s] or self.words[s] == word)})
            at += 1
        return accepted

    def pattern(self) -> str:
        """The same language as a regular expression over words that each end in one space."""
        def text(region: list) -> str:
            return "".join(
                "(?:" + "|".join(variants(p)) + ") " if isinstance(p, str)
                else f"(?:[^ ]+ ){{0,{p[1]}}}" if p[0] == "any" else f"(?:{text(p[1])})?"
                for p in region
            )
        return " " + text(self.parts)


_SPELLED = {k.encode(): v.encode() for k, v in SPELLINGS.items()}


def variants(word: str) -> list[str]:
    return [word, *(k for k, v in SPELLINGS.items() if v == word)]


def _phrase_hash(phrase: str) -> np.uint64:
    column = pa.array([phrase])
    return next(words.windows(int(words.counts[0]))[1][0] for _, _, words in word_chunks(column, ALNUM))


class Scanner:
    """All automata and base phrases, with the hashes of what to look for by number of words."""

    def __init__(self, templates: dict[str, str], labels: dict[str, str], phrases: dict[str, str]) -> None:
        self.automata = [(labels.get(name, name), Automaton(t)) for name, t in templates.items()]
        self.phrases = phrases
        self.anchors: dict[int, dict[bytes, list[int]]] = {}
        for k, (_, automaton) in enumerate(self.automata):
            for spelled in itertools.product(*map(variants, automaton.anchor)):
                by_text = self.anchors.setdefault(len(spelled), {})
                by_text.setdefault(" ".join(spelled).encode(), []).append(k)
        self.sought: dict[int, np.ndarray] = {}
        texts = [*phrases, *(t.decode() for by in self.anchors.values() for t in by)]
        for text in texts:
            n = len(_WORD.findall(text))
            self.sought[n] = np.append(self.sought.get(n, np.zeros(0, np.uint64)), _phrase_hash(text))
        self.sought = {n: np.unique(h) for n, h in self.sought.items()}

    def scan(self, words: Words) -> tuple[dict[int, list[tuple[int, str]]], dict[int, list[tuple[str, int, int]]]]:
        """By row of the chunk: base places (start, label) and accepted templates (label, start, end)."""
        base: dict[int, list[tuple[int, str]]] = {}
        accepted: dict[int, list[tuple[str, int, int]]] = {}
        for n, sought in self.sought.items():
            starts, hashes = words.windows(n)
            at = np.minimum(np.searchsorted(sought, hashes), len(sought) - 1)
            for start in starts[sought[at] == hashes].tolist():
                text = words.run(start, n)
                row = int(np.searchsorted(words.first, start, side="right")) - 1
                first, stop = int(words.first[row]), int(words.first[row + 1])
                if (label := self.phrases.get(text.decode())) is not None:
                    base.setdefault(row, []).append((start - first, label))
                for k in self.anchors.get(n, {}).get(text, ()):
                    label, automaton = self.automata[k]
                    if (end := automaton.run(words, start, stop)) is not None:
                        accepted.setdefault(row, []).append((label, start - first, end - first))
        return base, accepted


_SCHEMA = [
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
    T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.ArrayType(T.StringType())),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))),
]
_MATCHES = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates: dict[str, str] = TEMPLATES,
                  labels: dict[str, str] = LABELS, phrases: dict[str, str] = BASE_PHRASES) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels (sorted), matches (label, start, end in words)."""
    prepare(docs.sparkSession)
    named = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, labels, phrases)
        for batch in batches:
            for low, high, words in word_chunks(batch.column(1), ALNUM):
                base, accepted = scanner.scan(words)
                rows = [base.get(k, []) for k in range(high - low)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(low, high - low), pa.array(words.counts, pa.int64()),
                    pa.array([len(r) for r in rows], pa.int64()),
                    pa.array([min(r)[0] if r else None for r in rows], pa.int64()),
                    pa.array([max(r)[0] if r else None for r in rows], pa.int64()),
                    pa.array([sorted({x for _, x in r}) for r in rows], pa.list_(pa.string())),
                    pa.array([[dict(zip(("label", "start", "end"), m, strict=True)) for m in sorted(accepted.get(k, []))]
                              for k in range(high - low)], _MATCHES),
                ], [id_col, *(f.name for f in _SCHEMA)])

    return named.mapInArrow(run, T.StructType([named.schema[id_col], *_SCHEMA]))
