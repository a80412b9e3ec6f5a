"""Operators that relate rows, against brute-force versions: near duplicates, vectors, archives, shards, quotations, pipeline."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.llm import embeddings, minhash, quotation, sharding, warc
from cohortmill.llm.components import components
from cohortmill.llm.queries import QUERIES
from cohortmill.llm.staging import fresh_path


def closure(nodes, links):
    least = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(least[a], least[b])
            if least[a] != low or least[b] != low:
                least[a] = least[b] = low
                changed = True
    return least


def test_components_of_paths_and_stars(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(100, 160)] + [(5, k) for k in range(200, 300)] + [
        (rng.randrange(400, 460), rng.randrange(400, 460)) for _ in range(40)] + [(7, 7), (None, 3)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert found == closure({x for pair in real for x in pair}, real)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


# Near duplicates

def shingles(text, size):
    words = [w for w in (text or "").translate({k: 32 for k in range(9, 14)}).split(" ") if w]
    words = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + size]) for k in range(max(1, len(words) - size + 1)))


def brute_duplicates(rows, size, percent):
    sets = {k: shingles(t, size) for k, t in rows if k is not None}
    ids = sorted(sets)
    links = [(a, b) for i, a in enumerate(ids) for b in ids[i + 1:] if sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {k: (len(sets[k]), c) for k, c in closure(ids, links).items()}


def varied(rng, n, words=60):
    base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(words)]
    out = []
    for _ in range(n):
        own = list(base)
        for _ in range(rng.randrange(0, 7)):
            own[rng.randrange(len(own))] = "edit" + str(rng.randrange(1000))
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("size, block", [(2, 512), (5, 3)])
def test_near_duplicates_equal_brute_force(spark, size, block, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCS", block)  # small blocks: open buckets take several cells
    rng = random.Random(size)
    texts = [t for _ in range(5) for t in varied(rng, 30)] + ["", None, "  \n", "one", "ONE", "one two", "x y z", "x Y z"] + [
        "same text " * 30] * 20
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame([(k, t, "clash") for k, t in [*rows, (None, "one")]], "doc_id long, text string, component_id string")
    found = minhash.near_duplicates(docs, size=size).collect()
    expected = brute_duplicates(rows, size, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found if r.doc_id is not None} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None) and len(found) == len(rows) + 1
    kept = minhash.without_near_duplicates(docs, size=size)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(k for k, (_, c) in expected.items() if k == c)


def test_repeated_rows_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")] * 3 + [(2, "a b c d e f")], "doc_id long, text string")
    assert [(r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).orderBy("doc_id").collect()] == [(1, 1)] * 3 + [(2, 1)]
    assert [r.doc_id for r in minhash.without_near_duplicates(docs).collect()] == [1]
    assert minhash.near_duplicates(docs.where("false")).count() == 0
    assert minhash.without_near_duplicates(docs.where("false")).count() == 0


def test_an_id_on_different_texts_stays_once(spark):
    """Id 5 has a text of its own, one of id 3 and one that shares buckets with its first; id 4 has copies only."""
    own = "p q r s t u v w x y z aa bb cc dd ee ff gg hh ii jj kk ll mm nn oo"
    rows = [(3, "a b c d e f"), (5, "a b c d e f"), (5, own), (5, own + " pp"), (4, "a b c d e f"), (4, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(r.doc_id for r in minhash.without_near_duplicates(docs).collect()) == [3, 5]
    assert sorted((r.doc_id, r.component_id) for r in minhash.near_duplicates(docs).collect()) == [
        (3, 3), (4, 3), (4, 3), (5, 3), (5, 5), (5, 5)]


def test_densified_bins_agree_as_often_as_the_sets_are_similar():
    rng = np.random.default_rng(1)
    hashing, agree = minhash.OnePermutation(40, 6), []
    for _ in range(200):
        both = rng.integers(0, 2**64, 8, dtype=np.uint64)
        a, b = np.sort(both), np.sort(np.append(both, rng.integers(0, 2**64, 2, dtype=np.uint64)))
        agree.append((hashing.signature(a) == hashing.signature(b)).mean())
    assert abs(np.mean(agree) - 0.8) < 0.03


def test_large_sets_are_compared_in_whole_numbers():
    # Of the rule's two sides, 20 apart here, 32-bit floats make equal numbers.
    for common, union in ((3_200_007, 4_000_009), (800_000, 1_000_000), (799_999, 1_000_000)):
        n = np.array([common, union], np.float32)
        found = minhash.similar(np.array([[common, common], [common, union]], np.float32), n, 80)
        assert found[0, 1] == found[1, 0] == (100 * common >= 80 * union)


# Vectors

@pytest.mark.parametrize("block", [4, 512])
def test_vectors_equal_brute_force(spark, block):
    rng = np.random.default_rng(8)
    centres = rng.standard_normal((6, 24))
    rows = [(k, (centres[k % 6] * (1 + k % 3) + 0.06 * rng.standard_normal(24)).astype(np.float32).tolist()) for k in range(90)]
    rows += [(90, rows[0][1]), (91, rows[0][1]), (92, None), (93, [0.0] * 24), (94, [float("nan")] * 24), (95, []),
             (96, [1.0, None]), (97, [1.0, 2.0]), (98, [2.0, 4.0]), (99, [float("inf")] + [1.0] * 23)]
    table = spark.createDataFrame([(k, v, "c") for k, v in rows], "vec_id long, embedding array<float>, n_links string")
    found = embeddings.near_duplicate_vectors(table, block=block, bands=200, bits=8).collect()
    good = {k: np.array(v, np.float64) for k, v in rows if v and None not in v and np.isfinite(v).all() and np.any(v)}
    links = [(a, b) for a in good for b in good if a < b and len(good[a]) == len(good[b])
             and good[a] @ good[b] / np.linalg.norm(good[a]) / np.linalg.norm(good[b]) >= 0.95]
    least = closure([k for k, _ in rows], links)
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in found} == {
        k: (sum(k in pair for pair in links), least[k], k == least[k]) for k, _ in rows}
    assert embeddings.near_duplicate_vectors(table.where("false")).count() == 0


@pytest.mark.parametrize("block", [2, 512])
def test_one_id_on_different_vectors_counts_as_rows(spark, block):
    rng = np.random.default_rng(9)
    a, b, c, d = rng.standard_normal((4, 24))
    near = lambda v: v + 0.01 * rng.standard_normal(24)
    rows = [(1, a), (1, b), (2, a), (3, near(a)), (4, b), (5, near(b)), (6, near(b)), (7, c), (1, c), (8, d), (8, near(d)), (8, d), (2, near(d))]
    table = spark.createDataFrame([(k, v.tolist()) for k, v in rows], "vec_id long, embedding array<double>")
    found = embeddings.near_duplicate_vectors(table, block=block, bands=200, bits=8).collect()
    n = range(len(rows))
    links = [(i, j) for i in n for j in n if i < j and rows[i][1] @ rows[j][1]
             / np.linalg.norm(rows[i][1]) / np.linalg.norm(rows[j][1]) >= 0.95]
    group = closure(n, links)
    least = {i: min(rows[j][0] for j in n if group[j] == group[i]) for i in n}
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in found) == sorted(
        (rows[i][0], sum(i in pair for pair in links), least[i], rows[i][0] == least[i]) for i in n)


def test_the_bounds_of_the_codes_hold():
    rng = np.random.default_rng(4)
    units = embeddings.unit(rng.standard_normal((300, 64)) + 0.7 * rng.standard_normal((1, 64)))
    packed, factors = embeddings.codes(units)
    signs = np.unpackbits(packed, axis=1) * 2.0 - 1.0
    rotated = units @ embeddings.rotation(64)
    u, v = np.triu_indices(300, 1)
    cosine = np.einsum("ij,ij->i", units[u], units[v])
    estimate = np.einsum("ij,ij->i", signs[u], rotated[v]) / 8 / factors[u]
    assert abs((estimate - cosine).mean()) < 0.01
    for threshold in (0.2, 0.5):
        may = embeddings.possible(signs, rotated, factors, u, v, threshold, embeddings.EPSILON)
        assert not (~may & (cosine >= threshold)).any()


# Archives

def brute_warc(rows):
    first = {}
    for page, html in rows:
        if page is not None:
            first[html or ""] = min(first.get(html or "", page), page)
    out = []
    for page, html in rows:
        body = (html or "").encode()
        original = first.get(html or "")
        again = len(body) >= 100 and original is not None and page != original
        out.append((page, len(body), hashlib.sha256(body).hexdigest(), "revisit" if again else "response", original if again else None))
    return sorted(out, key=str)


def test_archives_round_trip(spark):
    long = "<p>" + "é\r\n\r\nWARC/1.1\r\n" * 20
    rows = [(3, long), (1, long), (2, long), (4, "short"), (5, "short"), (6, None), (7, ""), (None, long), (8, "x" * 100), (8, "x" * 100), (9, "x" * 99)]
    pages = spark.createDataFrame([(p, "http://a/\r\nb", h, "c") for p, h in rows], "page_id long, url string, html string, type string")
    path = fresh_path(spark, "pages")
    pages.withColumn("type", F.lit("c")).write.parquet(path + "/pages.parquet")
    found = QUERIES["op5_warc_transactions"](spark, path).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute_warc(rows)
    captures = warc.round_trip(pages, payloads=True).collect()
    stored = sorted(bytes(r.response.payload).decode() for r in captures if r.response.payload is not None)
    assert stored == sorted([long, "short", "short", "", "", "x" * 100, "x" * 100, "x" * 99])
    assert all(len(r.requests) == 1 and len(r.metadata) == 1 for r in captures)
    assert warc.round_trip(pages.where("false")).count() == 0


def test_transactions_follow_identifiers_both_ways_and_keep_orphans(spark):
    row = lambda i, kind, to=(): (i, kind, "u", "d", list(to), None, 0, "x", {}, None)
    records = spark.createDataFrame([
        row("r1", "response"), row("q1", "request", ["r1"]), row("m1", "metadata", ["q1"]), row("m2", "metadata", ["r1"]),
        row("q2", "request"), row("r2", "response", ["q2"]), row("q3", "request", ["gone"]), row("q4", "request"),
    ], warc.RECORD)
    found = {r.record_id: r for r in warc.transactions(records).collect()}
    names = lambda parts: [p.record_id for p in parts or []]
    assert names(found["r1"].requests) == ["q1"] and names(found["r1"].metadata) == ["m1", "m2"]
    assert names(found["r2"].requests) == ["q2"]
    assert found["gone"].response is None and names(found["gone"].requests) == ["q3"] and names(found["q4"].requests) == ["q4"]


def test_a_cut_archive_is_an_error():
    record = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabcde\r\n\r\n"
    assert [r["payload"] for r in warc.records_of(gzip.compress(record) + gzip.compress(record))] == [b"abcde"] * 2
    with pytest.raises(ValueError):
        list(warc.records_of(record[:-7]))


# Shards

def test_shards_are_contiguous_and_balanced(spark):
    rng = random.Random(9)
    rows = [(k, "é" * rng.randrange(300)) for k in range(400)] + [(7, "dup")] * 150 + [(None, None), (None, "")]
    docs = spark.createDataFrame([(k, t, "c") for k, t in rows], "doc_id long, text string, shard string").repartition(7)
    found = sharding.balanced_shards(docs, 16).collect()
    assert sorted((r.doc_id, r["size"], r.text_crc32) for r in found if r.doc_id is not None) == sorted(
        (k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for k, t in rows if k is not None)
    ordered = sorted(found, key=lambda r: (-1 if r.doc_id is None else r.doc_id, r.text_crc32, r["size"]))
    total, before = sum(r["size"] for r in ordered), 0
    sizes, shards = {}, []
    for r in ordered:
        shards.append(min(15, (2 * before + r["size"]) * 16 // (2 * total)))
        before += r["size"]
        sizes[shards[-1]] = sizes.get(shards[-1], 0) + r["size"]
    assert [r.shard for r in ordered] == shards
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in found)
    for shard in range(16):
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(shards.count(shard)))
    assert sharding.balanced_shards(docs.where("false")).count() == 0


# Quotations

def test_quotes_are_linked_and_cut(spark):
    rows = [
        (1, 0, "u", "Hello all,\n\nwhat is   the time?\nPlease tell."), (1, 1, "a", "On Monday u wrote:\n> What is the time?\n>please tell.\n\nNoon."),
        (1, 2, "u", ">> what is the\n>> TIME? Please tell.\n> Noon.\nThanks"), (1, 3, "a", "New topic"), (1, 4, "u", "> noon.\nreally?"),
        (1, 5, "a", "> never said\nok"), (2, 0, "u", "> Noon.\nother conversation"), (2, 1, "a", None), (2, None, "u", "> x"), (None, 3, "u", "y"),
    ]
    messages = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, path string")
    found = {(r.conv_id, r.turn): r for r in quotation.link_quotations(messages).collect()}
    assert len(found) == len(rows)
    one = [found[1, k] for k in range(6)]
    assert [r.own_text for r in one] == [rows[0][3], "Noon.", "Thanks", "New topic", "really?", "ok"]
    assert [r.parent_turn for r in one] == [None, 0, 1, None, 1, None]
    assert [r.path for r in one] == [[0], [0, 1], [0, 1, 2], [3], [0, 1, 4], [5]]
    assert [r.position for r in one] == [0, 1, 2, 4, 3, 5] and [r.depth for r in one] == [0, 1, 2, 0, 2, 0]
    assert (one[2].quote_levels, one[2].n_quotes, one[2].n_linked) == (2, 2, 2)
    assert (one[5].n_quotes, one[5].n_linked) == (1, 0) and found[2, 0].parent_turn is None
    assert found[2, None].position is None and found[None, 3].position is None
    assert quotation.link_quotations(messages.where("false")).count() == 0


def brute_links(rows):
    """(own text's words, parent, linked passages) per message, line by line."""
    def level(line):
        marks = re.match(r"[ \t]*((?:>[ \t]?)+)", line)
        return (marks.group(1).count(">"), line[marks.end():]) if marks else (0, line)

    def passages(text):
        runs, last = [], None
        for lev, content in map(level, re.split(r"\r\n|\r|\n", text or "")):
            if not content.strip(" "):
                last = None
                continue
            if lev != last:
                runs.append((lev, []))
            runs[-1][1].append(" ".join(content.lower().split()))
            last = lev
        return runs

    parsed = {k: passages(t) for *k, t in ((c, n, t) for c, n, t in rows) for k in [tuple(k)]}
    out = {}
    for (conv, turn), runs in parsed.items():
        before = sorted(n for c, n in parsed if c == conv and n < turn)
        found = []
        for nth, (lev, lines) in enumerate(runs):
            if not lev:
                continue
            own = [(n, ls) for n in before for v, ls in parsed[conv, n] if not v]
            first = next((n for n, ls in own if " ".join(ls) == " ".join(lines)), None)
            if first is None:
                hits = [(-len(x), n) for x in lines for n, ls in own if x in ls]
                first = min(hits)[1] if hits else None
            found.append((lev, nth, first))
        linked = [f for f in found if f[2] is not None]
        out[conv, turn] = (min(linked)[2] if linked else None, len(found), len(linked))
    return out


def test_links_equal_brute_force(spark):
    rng = random.Random(12)
    lines = ["alpha beta", "Gamma  delta epsilon", "zeta", "eta theta iota", "kappa", "lambda mu nu xi"]
    rows, said = [], {}
    for conv in range(6):
        for turn in range(7):
            parts = []
            for _ in range(rng.randint(0, 2)):
                source = said.get((conv, rng.randrange(turn)), []) if turn else []
                quote = rng.sample(source, rng.randint(1, len(source))) if source else rng.sample(lines, 1)
                parts += [rng.choice(["> ", ">", ">> "]) + x for x in quote] + rng.choice([[], [""]])
            own = rng.sample(lines, rng.randint(1, 3))
            said[conv, turn] = own
            rows.append((conv, turn, "\n".join(parts + own)))
    df = spark.createDataFrame([(c, n, "u", t) for c, n, t in rows], "conv_id long, turn long, role string, text string")
    found = {(r.conv_id, r.turn): (r.parent_turn, r.n_quotes, r.n_linked) for r in quotation.link_quotations(df).collect()}
    assert found == brute_links(rows) and sum(x[0] is not None for x in found.values()) > 10


def test_introductions_of_any_shape_are_cut(spark):
    long = "On Monday " + "x" * 80 + " wrote to all of us, as " + "y" * 80 + " may have seen:"
    rows = [(1, 0, "one\ntwo words"), (1, 1, "On Mon, Bob\nwrote:\n> two words\nyes"), (1, 2, "Bob wrote:\n\n> one\nno"),
            (1, 3, f"{long}\n> never\nok"), (1, 4, "He wrote:\nnothing quoted"), (1, 5, "On time\n> one two words\nfine")]
    df = spark.createDataFrame([(c, n, "u", t) for c, n, t in rows], "conv_id long, turn long, role string, text string")
    found = {r.turn: (r.own_text, r.parent_turn) for r in quotation.link_quotations(df).collect()}
    assert found == {0: ("one\ntwo words", None), 1: ("yes", 0), 2: ("no", 0), 3: ("ok", None),
                     4: ("He wrote:\nnothing quoted", None), 5: ("On time\nfine", 0)}


def test_null_ids_and_clashing_names_in_near_duplicates(spark):
    text = "one two three four five six seven"
    docs = spark.createDataFrame([(1, text), (2, text), (None, text), (3, "other words here")], "doc_id long, text string")
    for name in ("__kept_id", "__rows", "id", "node"):
        docs = docs.withColumn(name, F.lit("x"))
    found = sorted((tuple(r) for r in minhash.near_duplicates(docs, 2, 80).collect()), key=repr)
    assert found == sorted([(1, 6, 1, True), (2, 6, 1, False), (None, 6, None, True), (3, 2, 3, True)], key=repr)
    kept = minhash.without_near_duplicates(docs, 2, 80)
    assert kept.columns == docs.columns and sorted(map(str, (r.doc_id for r in kept.collect()))) == ["1", "3", "None"]


def test_long_reply_chains_have_whole_paths(spark):
    rows = [(1, k, "u", f"> message {k - 1}\nmessage {k}" if k else "message 0") for k in range(40)]
    found = quotation.link_quotations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.turn: r.path for r in found} == {k: list(range(k + 1)) for k in range(40)}


# Pipeline

def test_the_pipeline_equals_brute_force(spark):
    import corpus_pipeline
    from tests.llm.test_text_operators import brute_overlap

    rng = random.Random(4)
    passage = "one two three four five six seven eight nine ten eleven"
    texts = [t for _ in range(4) for t in varied(rng, 8)] + [f"start {passage} end", "123 !", None, "clean words here", "clean words here"]
    rows = [(k, t, "en" if k % 2 else "de", "s", len(t or "")) for k, t in enumerate(texts)]
    path = fresh_path(spark, "corpus")
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    identified = [(k, t) for k, t, *_ in rows if any(c.isalpha() for c in t or "")]
    groups = brute_duplicates(identified, 5, 80)
    expected = {k: t for k, t in identified if groups[k][1] == k and brute_overlap(t, [(1, passage)], 10)[1] == 0}
    found = corpus_pipeline.run(spark, path).collect()
    assert {r.doc_id: r.decoded_sha256 for r in found} == {k: hashlib.sha256(t.encode()).hexdigest() for k, t in expected.items()}
    assert len(corpus_pipeline.STAGES) == 4
