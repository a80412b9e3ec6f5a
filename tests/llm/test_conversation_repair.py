"""Conversation repair against exhaustive search, over blocks of few cells."""

from __future__ import annotations

import hashlib
import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import conversation_repair as repair
from cohortmill.llm.queries import QUERIES, damaged

DDL = "conv_id long, turn long, role string, text string"
WHOLE = re.compile(r"(s?(ua)+)?\Z")
SPACE = " \t\n\x0b\x0c\r"


def faults(turns):
    """Rows in order, with the first fault of each."""
    turns = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in turns]
    turns.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), hashlib.sha256(row[2].encode()).digest()))
    seen, out = set(), []
    for _, role, text in turns:
        end = text.rstrip(SPACE)[-1:]
        fault = "blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, fault))
    return turns, out


def cheapest(rows):
    """All edit strings of a few rows, tried out."""
    best = None
    edits = [["D"] if fault in ("blank", "duplicate") else ["D", "K", "Ru", "Ra"] for _, _, fault in rows]
    gaps = [(), ("Iu",), ("Ia",), ("Iu", "Ia"), ("Ia", "Iu")]
    for chosen in itertools.product(*edits):
        for ahead in itertools.product(gaps, repeat=len(rows) + 1):
            steps, cost, result = [], 0, []
            for k, extra in enumerate(ahead):
                for insert in extra:
                    steps.append("I")
                    cost += 5
                    result.append({"Iu": "user", "Ia": "assistant"}[insert] + ":")
                if k < len(rows):
                    role, text, fault = rows[k]
                    edit = chosen[k]
                    steps.append(edit[0])
                    cost += {"D": 2, "K": 0, "R": 1}[edit[0]] + (5 if edit != "D" and fault == "truncated" else 0)
                    if edit != "D":
                        result.append(f"{ {'K': role, 'Ru': 'user', 'Ra': 'assistant'}[edit] }:{text}")
            if WHOLE.match("".join(r[:1] if r[:1] != ":" else "?" for r in result)):
                found = (cost, "".join(steps), "\n".join(result))
                best = min(best, found) if best else found
    return best


def brute(rows):
    out, by_conv = {}, {}
    for conv, turn, role, text in rows:
        by_conv.setdefault(conv, []).append((turn, role, text))
    for conv, own in by_conv.items():
        turns, marked = faults(own)
        numbers = [t for t, _, _ in turns if t is not None]
        count = {f: sum(x == f for _, _, x in marked) for f in ("blank", "duplicate", "truncated")}
        initials = [r[:1] for r, _, _ in marked]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
        cost, audit, text = cheapest(marked)
        out[conv] = (max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0, *count.values(), illegal, cost, audit,
                     hashlib.sha256(text.encode()).hexdigest())
    return out


def made_up(convs, longest, seed):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["Yes.", "No!", "Why?", "cut", " \t\n", "", None, "é…", "Long. " * 30, "end. \n", "nbsp. "]
    return [(conv, rng.choice([None, *range(-2, 5)]), rng.choice(roles), rng.choice(texts))
            for conv in [*range(convs), None] for _ in range(rng.randint(1, longest))]


def report_of(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize(("seed", "span"), [(1, repair.SPAN), (2, 1), (3, 2)])
def test_repair_equals_exhaustive_search(spark, seed, span):
    rows = made_up(25, 3, seed)
    report, _ = repair.repair(spark.createDataFrame(rows, DDL), span=span)
    assert report_of(report) == brute(rows)


def test_long_conversations_in_blocks_equal_one_block(spark):
    rng = random.Random(9)
    rows = [(1, k // 2, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["a.", "b", f"c{k}.", ""])) for k in range(500)]
    rows += [(1, 7, "user", "hot.")] * 300 + [(2, k, "user", "same.") for k in range(200)] + [(3, 0, "user", "x" * 200_000 + ".")]
    rows += [(4, k, ("user", "assistant")[k % 2], f"t{k}.") for k in range(3000)]
    df = spark.createDataFrame(rows, DDL)
    one, kept = repair.repair(df)
    few, _ = repair.repair(df, span=17)
    assert report_of(one) == report_of(few)
    by_conv = {}
    for r in sorted(kept.collect(), key=lambda r: (r.conv_id, r.place, r.nth)):
        by_conv.setdefault(r.conv_id, []).append((r.role, r.text))
    for conv, found in report_of(one).items():
        own = by_conv.get(conv, [])
        assert WHOLE.match("".join(role[0] for role, _ in own))
        assert found[-1] == hashlib.sha256("\n".join(f"{a}:{b}" for a, b in own).encode()).hexdigest()
    assert report_of(one)[2][-2] == "D" * 200 and report_of(one)[4][-2] == "K" * 3000


def test_runs_by_powers_equal_single_steps():
    rng = random.Random(4)
    for _ in range(50):
        sym, n = rng.randrange(9), rng.randrange(1, 70)
        behind = repair.final()
        for _ in range(n):
            behind = repair.step(sym, behind)
        assert tuple(repair.advanced(sym, n, np.array(repair.final())).tolist()) == behind


def test_rows_that_count_not_and_empty_table(spark):
    rows = [(1, 0, "user", "a."), (1, 1, "assistant", "b."), (2, 0, "user", "c.")]
    df = spark.createDataFrame(rows, DDL).withColumn("times", F.when(F.col("conv_id") == 2, 0).otherwise(1))
    found = report_of(repair.repair(df, F.col("times"))[0])
    assert found[1][-2] == "KK" and found[2] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    report, kept = repair.repair(spark.createDataFrame([], DDL))
    assert report.count() == 0 and kept.count() == 0


def test_other_columns_do_not_clash(spark):
    rows = made_up(6, 3, 8)
    wide = spark.createDataFrame(rows, DDL)
    for name in ("conv", "mark", "copies", "has_turn", "turn_no", "place", "n", "block", "kind", "blank", "new", "cost", "__at", "audit"):
        wide = wide.withColumn(name, F.lit("x"))
    assert report_of(repair.repair(wide)[0]) == brute(rows)


def test_query_on_damaged_rows(spark):
    turns, copies = damaged(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet"))
    rows = [tuple(r[:4]) for r in turns.collect() for _ in range(r.copies)]
    found = report_of(QUERIES["op12_conversation_repair"](spark, "/root/testdata/sf0.001"))
    short = {conv for conv in {r[0] for r in rows} if sum(r[0] == conv for r in rows) <= 3}
    expected = brute([r for r in rows if r[0] in short])
    assert short and {conv: found[conv] for conv in short} == expected
