"""Operators on single texts against brute-force versions: extraction, decontamination, licences, language ID, byte BPE."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F

from cohortmill.llm import byte_bpe, decontamination, html_extraction, language_id, licenses
from cohortmill.llm.batches import ALNUM, NOT_SPACE, word_chunks
from cohortmill.llm.license_templates import TEMPLATES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = ["", None, " ", "One", "one two", "É à la Carte 9x", "a" * 3000, "x-y_z\n\tq", "ÀB C   d", "1 2 3 4 5 6 7 8 9 10 11 12"]


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def docs_of(spark, texts, extra=""):
    rows = [(k, t, *(["clash"] if extra else [])) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string" + (f", {extra} string" if extra else ""))


@pytest.mark.parametrize("classes, split", [(ALNUM, words_of), (NOT_SPACE, lambda t: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)))])
def test_words_of_whole_batches(classes, split):
    found = []
    for low, high, words in word_chunks(pa.array(TEXTS), classes):
        found += [[words.run(k, 1).decode() for k in range(words.first[r], words.first[r + 1])] for r in range(high - low)]
        assert len(set(words.hashes.tolist())) == len({w for ws in found for w in ws})
    assert found == [split(t) for t in TEXTS]


# Decontamination

def brute_overlap(text, items, n):
    words, hit, found = words_of(text), set(), set()
    for item, body in items:
        own = words_of(body)
        size = min(n, len(own))
        for s in range(len(own) - size + 1) if size else ():
            for at in range(len(words) - size + 1):
                if words[at:at + size] == own[s:s + size]:
                    hit.update(range(at, at + size))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block", [2, 1000])
def test_overlaps_equal_brute_force_in_one_or_many_blocks(spark, block):
    rng = random.Random(3)
    vocabulary = ["a", "b", "c", "D", "é"]
    say = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(k, say(rng.randrange(0, 9))) for k in range(8)] + [(90, None), (91, "--"), (3, "a b c")]
    texts = TEXTS + [say(rng.randrange(0, 60)) for _ in range(30)]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.overlaps(docs_of(spark, texts, "n_words"), benchmark, n=4, block_windows=block).collect()
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in found} == {
        k: brute_overlap(t, items, 4) for k, t in enumerate(texts)}


def test_decontamination_drops_documents_or_spans(spark):
    benchmark = spark.createDataFrame([(1, "the quick brown fox jumps")], "item_id long, text string")
    docs = docs_of(spark, ["So: The quick, brown fox jumps! End", "quick brown fox jumps", None, ""], "spans")
    kept = decontamination.decontaminate(docs, benchmark, n=5)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [1, 2, 3]
    cut = decontamination.decontaminate(docs, benchmark, mode="spans", n=5).orderBy("doc_id").collect()
    assert [r.text for r in cut] == ["So: ! End", "quick brown fox jumps", None, ""]


def test_an_empty_benchmark_or_table(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r.n_hit for r in decontamination.overlaps(docs_of(spark, ["a b"]), none).collect()] == [0]
    empty = docs_of(spark, ["a"]).where("false")
    assert decontamination.overlaps(empty, none).count() == 0 and decontamination.decontaminate(empty, none).count() == 0


# Extraction

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body class="no-sidebar"><nav><ul><li><a href=/>Home</a>
<li><a href=/b>News of the day</a></ul></nav><div id="cookie-notice">We use cookies on this long page, please agree to them.</div>
<div class="main-content"><h1>A  title</h1><p>First <b>bold</b>ly set paragraph &amp; more,<br>with a break.<p>Second one, <a href=x>linked</a>.
<form><input>Send</form><div>{deep}</div><p>Short.</p></div><aside>Side text that is quite long, longer than others.</aside>
<section class="comments"><p>I disagree with everything that was said here, at length.</p></section><footer>&copy; 2024</footer></body></html>"""


def test_extraction_keeps_the_article_only():
    text = html_extraction.extract(PAGE.format(deep="Deep text."))
    assert text == "A title First boldly set paragraph & more, with a break. Second one, linked. Deep text. Short."


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain  text", "plain text"), ("x < y &lt; z &am", "x < y < z &am"), ("<p>cut<!-- no", "cut"),
    ("<p>cut<script>var x", "cut"), ("<p>a</p><p", "a"), ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("<div>" * 3000 + "deep", "deep"), ("</b></p>stray", "stray"), ("<nav>only</nav>", ""), ("<p>a&#8364;b&nbsp;c", "a€b c"),
])
def test_odd_pages(page, text):
    assert html_extraction.extract(page) == text


def test_pages_cut_anywhere_give_a_prefix_of_the_words():
    page = PAGE.format(deep="Deep text.")
    whole = html_extraction.extract(page)
    for end in range(0, len(page), 7):
        html_extraction.extract(page[:end])
    assert whole.startswith(html_extraction.extract(page[:page.index("<form>")])[:60])


STORY = [f"Paragraph {k} of the story tells at length what happened on that day, and why nobody saw it coming." for k in range(6)]
BODY = "".join(f"<p>{p}</p>" for p in STORY)


@pytest.mark.parametrize("wrapper", [
    "<div id=page class='site left-sidebar'>{}</div>", "<div class='content-with-sidebar'>{}</div>", "<div class=widget>{}</div>",
    "<div class='elementor-widget-container'>{}</div>", "<form id=aspnetForm>{}</form>", "<div class=has-header><form>{}</form></div>",
    "<div class='layout sidebar'><div class='left-sidebar'>{}</div></div>", "<div role=form>{}</div>",
])
@pytest.mark.parametrize("inner", ["{}", "<article>{}</article>", "<main>{}</main>", "<div>{}</div>"])
def test_wrappers_do_not_take_the_article_with_them(wrapper, inner):
    around = "<nav><a href=/>Home</a></nav><div class=ad>Buy this.</div>{}<div class='site-footer'>Imprint</div><footer>2024</footer>"
    for story in (inner.format(BODY), inner.format("<h1>Head</h1>" + BODY)):
        expected = ("Head " if "<h1>" in story else "") + " ".join(STORY)
        assert html_extraction.extract(around.format(wrapper.format(story))) == expected
        assert html_extraction.extract(wrapper.format(around.format(story))) == expected


def test_an_article_of_many_widgets_is_whole_and_other_text_goes():
    widgets = "".join(f"<div class='elementor-widget elementor-widget-text'>{p}</div>" for p in STORY)
    for head in ("", "<h1>Head</h1>"):
        assert html_extraction.extract(f"<body><div>{head}{widgets}</div>") == ("Head " if head else "") + " ".join(STORY)
    reader = "<div id=comments class=comments-area><ol><li><article class=comment-body><p>I see it the other way.</article></ol></div>"
    assert html_extraction.extract(f"<main><article><h1>Head</h1>{BODY}</article>{reader}</main>") == "Head " + " ".join(STORY)
    long = "<p>I disagree with all that was said, and so does everybody else whom I know.</p>" * 12
    for name in ("comments", "post-comments"):
        page = f"<body><article><h1>Head</h1>{BODY}<form><p>Send this to a friend.</form></article><div class={name}>{long}</div>"
        assert html_extraction.extract(page) == "Head " + " ".join(STORY)
    assert html_extraction.extract("<div class=widget>" * 3000 + "deep") == "deep"


def test_extraction_over_a_table(spark):
    pages = spark.createDataFrame([(1, "u", "<p>x", "c"), (1, "u", "<p>x", "c"), (2, None, None, None)],
                                  "page_id long, url string, html string, text string")
    assert sorted(r.text for r in html_extraction.main_text(pages).collect()) == ["", "x", "x"]


# Licences

def test_every_template_accepts_itself_and_no_changed_word():
    scanner = licenses.Scanner(licenses.TEMPLATES, {}, licenses.BASE_PHRASES)
    for name, template in TEMPLATES.items():
        for keep in (True, False):
            text = re.sub(r"<<\d+>>", "Jane", re.sub(r"\[\[(.*?)\]\]", r"\1" if keep else " ", template, flags=re.S))
            for _, _, words in word_chunks(pa.array(["before " + text + " after"]), ALNUM):
                assert name in {m[0] for m in scanner.scan(words)[1].get(0, [])}, (name, keep)
            parts = licenses.parts(template)
            mandatory = [p for p in parts if isinstance(p, str)]
            changed = re.sub(rf"\b{mandatory[-1]}\b(?!.*\b{mandatory[-1]}\b)", "other", text.lower(), flags=re.S)
            for _, _, words in word_chunks(pa.array([changed]), ALNUM):
                assert name not in {m[0] for m in scanner.scan(words)[1].get(0, [])}, (name, keep)


@pytest.mark.parametrize("text, labels", [
    *((f"It is {verb} under the MIT License.", {"mit"}) for verb in ("licensed", "distributed", "available", "released", "provided")),
    ("Released under the Apache License", {"apache"}), ("distributed under the terms of the Apache Licence, Version 2.0", {"apache"}),
    ("licensed under CC BY 3.0", {"cc-by"}), ("shared under a CC-BY-SA 2.5 licence", {"cc-by-sa"}), ("available under CC BY-NC-ND 4.0", {"cc-by-nc-nd"}),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", {"cc-by"}),
    ("licensed under the Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License", {"cc-by-nc-sa"}),
    ("available under the Creative Commons Attribution-NoDerivatives License", {"cc-by-nd"}),
    ("This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as "
     "published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.", {"lgpl"}),
    ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as "
     "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.", {"agpl"}),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", {"mpl"}),
    ("This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0", {"epl"}),
    ("licensed under CC BY-NC-SA 4.0", {"cc-by-nc-sa"}), ("licensed under CC BY-NC 4.0", {"cc-by-nc"}), ("licensed under CC BY 4.0", {"cc-by"}),
    ("licensed under the GNU Lesser General Public License, version 3", {"lgpl"}), ("licensed under the GNU General Public License, version 3", {"gpl"}),
    ("SPDX-License-Identifier: MIT", {"mit"}), ("SPDX-License-Identifier: (GPL-2.0-or-later OR Apache-2.0)", {"gpl", "apache"}),
    ("SPDX-License-Identifier: CC-BY-NC-SA-4.0", {"cc-by-nc-sa"}), ("SPDX-License-Identifier: CC-BY-4.0", {"cc-by"}),
    ("Distributed under the Boost Software License, Version 1.0.", {"boost"}), ("released under a BSD-style license", {"bsd"}),
    ("available under the 3-Clause BSD License", {"bsd-3-clause"}), ("under the terms of the BSD 2-Clause licence", {"bsd-2-clause"}),
    ("Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION", {"apache"}),
    ("GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation, Inc.", {"lgpl"}),
    ("GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software Foundation, Inc.", {"gpl"}),
    ("Mozilla Public License Version 2.0 ====== 1. Definitions", {"mpl"}), ("An SPDX license identifier of MIT", set()),
    ("under the table, Creative Commons Attribution", set()), ("a Mozilla of the public", set()),
])
def test_notices_and_headers_of_the_families(text, labels):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.LABELS, licenses.BASE_PHRASES)
    for _, _, words in word_chunks(pa.array(["Before. " + text + " After."]), ALNUM):
        assert {m[0] for m in scanner.scan(words)[1].get(0, [])} == labels


def test_base_places(spark):
    texts = ["MIT licence, mit-License mit license", "x Apache  License", "GNU General Public License", "mitlicense", *TEXTS]
    found = {r.doc_id: r for r in licenses.scan_licenses(docs_of(spark, texts, "matches")).collect()}
    assert (found[0].n_base, found[0].first_word, found[0].last_word, found[0].base_labels) == (2, 2, 4, ["mit"])
    assert (found[1].n_base, found[1].first_word, found[2].first_word, found[2].base_labels) == (1, 1, 1, ["gpl"])
    assert found[3].n_base == 0 and found[3].first_word is None and all(found[k].n_base == 0 for k in range(4, len(texts)))


# Language ID

def brute_model(rows):
    from collections import Counter
    words, grams = Counter(), Counter()
    for lang, text in rows:
        for w in re.findall(r"[^\W\d_]+", text.lower()):
            words[w, lang] += 1
            marked = f"^{w}^"
            for n in range(1, 6):
                for k in range(len(marked) - n + 1):
                    grams[n, marked[k:k + n], lang] += 1
    return words, grams


def brute_predict(rows, text, languages):
    words, grams = brute_model(rows)
    log = lambda table, key, lang, size, of: np.log((table[*key, lang] + 0.5) / (of[lang] + 0.5 * size))
    vocabulary = {w for w, _ in words}
    of_words = {lang: sum(n for (_, x), n in words.items() if x == lang) for lang in languages}
    known = {n: {g for m, g, _ in grams if m == n} for n in range(1, 6)}
    of_grams = {n: {lang: sum(c for (m, _, x), c in grams.items() if m == n and x == lang) for lang in languages} for n in known}
    total = dict.fromkeys(languages, 0.0)
    for w in re.findall(r"[^\W\d_]+", text.lower()):
        for lang in languages:
            if w in vocabulary:
                total[lang] += log(words, (w,), lang, len(vocabulary), of_words)
                continue
            for n in range(5, 0, -1):
                own = [g for k in range(len(w) + 3 - n) if (g := f"^{w}^"[k:k + n]) in known[n]]
                if own:
                    total[lang] += sum(log(grams, (n, g), lang, len(known[n]), of_grams[n]) for g in own) / len(own)
                    break
    best = max(sorted(total), key=total.get)
    return best, 1 / sum(np.exp(v - total[best]) for v in total.values())


def test_language_id_equals_brute_force(spark):
    rows = [("en", "the cat and the dog"), ("de", "der Hund und die Katze"), ("fr", "le chien et la chatte"), (None, "zzz"), ("en", None)]
    docs = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    assert model.languages == ["de", "en", "fr"]
    texts = ["the hund", "chats dogs", "Katzen undd", "über q", "", None, "123 !", "the the la"]
    found = language_id.predict(docs_of(spark, texts, "score"), model).orderBy("doc_id").collect()
    labelled = [(x, t) for x, t in rows if x and t]
    for r, text in zip(found, texts, strict=True):
        if not re.search(r"[^\W\d_]", text or ""):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        else:
            label, score = brute_predict(labelled, text, model.languages)
            assert r.lang_pred == label and abs(r.score - score) < 1e-9
    kept = language_id.keep_identified(docs_of(spark, texts, "score"), model, least=0.0)
    assert sorted(r.doc_id for r in kept.collect()) == [0, 1, 2, 3, 7]


def test_small_languages_keep_their_rows_words_and_grams(spark):
    rng = random.Random(6)
    say = lambda letters: " ".join("".join(rng.choice(letters) for _ in range(6)) for _ in range(8))
    rows = [("en", say("abcdefgh")) for _ in range(400)] + [("fi", "xu yv xu yv"), ("se", "qo wp qo")]
    docs = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.train(docs, train_docs=40)
    assert model.languages == ["en", "fi", "se"]
    assert len(model.words.hashes) > 200 and {"fi", "se"} <= {model.languages[k] for k in model.words.langs}
    found = language_id.predict(docs_of(spark, ["xu yv", "qo wp", rows[0][1]]), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == ["fi", "se", "en"]


def test_a_hundred_languages_keep_every_count(spark):
    rng = random.Random(11)
    letters = [chr(0x3b1 + k) for k in range(20)] + list("abcdefghij")
    alphabets = {f"l{k:03}": rng.sample(letters, 6) for k in range(100)}
    say = lambda x, n: " ".join("".join(rng.choice(alphabets[x]) for _ in range(rng.randint(2, 7))) for _ in range(n))
    rows = [(x, say(x, 12)) for x in alphabets for _ in range(3)]
    docs = spark.createDataFrame([(k, t, x) for k, (x, t) in enumerate(rows)], "doc_id long, text string, lang string")
    model = language_id.train(docs)
    words, grams = brute_model(rows)
    # One entry per word or n-gram and language that has it: nothing is cut, and memory is linear in these.
    assert len(model.words.langs) == len(words) and sum(len(t.langs) for t in model.grams.values()) == len(grams)
    texts = [say(x, 6) for x in sorted(alphabets)[::25]] + [rows[7][1], rows[200][1]]
    found = language_id.predict(docs_of(spark, texts), model).orderBy("doc_id").collect()
    for r, text in zip(found, texts, strict=True):
        label, score = brute_predict(rows, text, model.languages)
        assert r.lang_pred == label and abs(r.score - score) < 1e-9


def test_the_pipeline_keeps_short_clean_texts_of_any_share(spark):
    import corpus_pipeline
    rows = [(k, f"{x} {x}x menu", f"l{x}") for k, x in enumerate("abcdefgh") for _ in range(6)]
    ids = spark.range(1000, 1000 + len(rows)).collect()
    rows = [(i.id, t, x) for i, (_, t, x) in zip(ids, rows, strict=True)] + [(1, "menu", None), (2, "Ωψ", None), (3, "12!", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = {r.doc_id for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert kept == {k for k, t, _ in rows if k != 3}


def test_without_labels_everything_is_undetermined(spark):
    docs = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert language_id.predict(docs, language_id.train(docs)).first()[1:] == ("und", 0.0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    found = language_id.predict(docs, language_id.train(docs, ~held, train_docs=300)).join(docs.where(held), "doc_id")
    assert found.where("lang_pred = lang").count() >= 0.97 * found.count()


# Byte-level BPE

@pytest.fixture(scope="module")
def ranks():
    return byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def texts_for_tokens():
    rng = random.Random(1)
    parts = ["a", "s", "re", "'", "'s", "'ll", "'v", " ", "  ", "\n", "\t", "1", "٣", "é", "!", "漢", "😀", "\x1c", "\x85", " ", "́", "e"]
    return ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(3000)] + [
        "<|endoftext|>", "x" * 5000, "ab" * 900, " " * 3000, "1'2's't", "don't we'll 'reword"]


def test_bpe_equals_the_library(ranks):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = texts_for_tokens()
    bpe = byte_bpe.ByteBPE(ranks, cache=100)
    ids, bounds, ends = bpe.encode(texts)
    for text, a, b in zip(texts, bounds, bounds[1:], strict=False):
        assert ids[a:b].tolist() == library.encode_ordinary(text)
    assert bpe.decode(ids) == "".join(texts).encode() and (not len(ids) or ends[-1] == len(ids))


def test_scan_is_the_fold():
    rng = np.random.default_rng(5)
    elements = byte_bpe.ELEMENT[rng.integers(0, len(byte_bpe.ELEMENT), 5000)]
    state, expected = byte_bpe.FRESH, []
    for e in elements:
        state = byte_bpe.STATES[e, state]
        expected.append(state)
    for block in (3, 128):
        assert byte_bpe.STATES[byte_bpe.scanned(elements, block), byte_bpe.FRESH].tolist() == expected


def test_encode_decode_and_digests(spark, ranks):
    texts = [*TEXTS, "don't stop", "漢字"]
    docs = docs_of(spark, texts, "ids")
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = byte_bpe.encode(docs, ranks)
    rows = encoded.orderBy("doc_id").collect()
    assert [r.ids for r in rows] == [library.encode_ordinary(t or "") for t in texts]
    pieces = [re.findall(r"\S", t or "") for t in texts]
    assert all((r.ends or [0])[-1] == len(r.ids) for r in rows) and len(pieces) == len(rows)
    assert [bytes(r.bytes) for r in byte_bpe.decode(encoded, ranks).orderBy("doc_id").collect()] == [(t or "").encode() for t in texts]
    for r, text in zip(byte_bpe.digests(docs, ranks).orderBy("doc_id").collect(), texts, strict=True):
        ids = library.encode_ordinary(text or "")
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    with pytest.raises(ValueError):
        byte_bpe.ByteBPE(ranks).decode(np.array([60_000]))


# Pages that are not well formed

def test_quotes_in_attributes_open_a_value_only_behind_an_equals_sign():
    body = "<p title='it's'>First paragraph here, long enough.</p><p class=x don't>Second paragraph here, too.</p><a title=Bob's>Third.</a>"
    text = html_extraction.extract(f"<html><body><article>{body}</article></body></html>")
    assert text == "First paragraph here, long enough. Second paragraph here, too. Third."
    assert html_extraction.extract("<body><p data-x='a > b' title=\"c > d\">Kept text of the page.</p></body>") == "Kept text of the page."


def test_depth_costs_no_more_than_length():
    import time
    began = time.perf_counter()
    for opened, closed in (("<div>", "</div>"), ("<b>", "")):
        page = "<body>" + opened * 20_000 + "Some words of text." + closed * 20_000 + "</body>"
        assert html_extraction.extract(page) == "Some words of text."
    assert time.perf_counter() - began < 10
