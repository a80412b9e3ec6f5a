"""DuckDB SQL with the results of the queries, written from their contracts."""

from __future__ import annotations

import itertools
import string

from cohortmill.llm.license_templates import BASE_PHRASES, LABELS, TEMPLATES
from cohortmill.llm.licenses import Automaton, variants

# The two word patterns of the contracts.
ALNUM_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
SPACE_WORDS = r"[^\x20\x09-\x0D]+"


def words(text: str, pattern: str = ALNUM_WORDS) -> str:
    lower = f"translate(coalesce({text}, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"regexp_extract_all({lower}, '{pattern}')"


DECONTAMINATION = f"""
WITH item AS (SELECT item_id::VARCHAR AS item, {words('text')} AS w FROM benchmark WHERE item_id IS NOT NULL),
size AS (SELECT item, w, least(10, len(w)) AS n FROM item WHERE len(w) > 0),
win AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM size)
),
doc AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
place AS (
  SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i
  FROM doc, (SELECT DISTINCT n FROM win) WHERE len(w) >= n
),
hit AS (
  SELECT p.r, p.i, p.n, win.item FROM (SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS win FROM place) p
  JOIN win USING (win, n)
),
covered AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM hit) GROUP BY r),
found AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN found USING (r)
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE doc AS (SELECT doc_id, {words('text', SPACE_WORDS)} AS w FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(CASE WHEN len(w) >= 2 THEN list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                               WHEN len(w) = 1 THEN w ELSE [] END) AS s FROM doc)
),
n AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS k FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id < b.doc_id
  GROUP BY ALL
),
link AS (
  SELECT u, v FROM common JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * k >= 80 * (a.n + b.n - k)
),
reach AS (
  SELECT u, v FROM link UNION SELECT v, u FROM link
  UNION SELECT r.u, l.v FROM reach r JOIN (SELECT u, v FROM link UNION SELECT v, u FROM link) l ON r.v = l.u
),
least_id AS (SELECT u AS doc_id, min(v) AS m FROM reach GROUP BY u)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id,
       doc_id <= coalesce(m, doc_id) AS kept
FROM doc LEFT JOIN n USING (doc_id) LEFT JOIN least_id USING (doc_id)
"""

WARC = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

VECTORS = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
link AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95
),
reach AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
least_id AS (SELECT u AS vec_id, min(v) AS m FROM reach GROUP BY u),
n AS (SELECT u AS vec_id, count(*) AS n FROM link GROUP BY u)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM embeddings LEFT JOIN n USING (vec_id) LEFT JOIN least_id USING (vec_id)
"""


def licenses() -> str:
    """Base places word by word; each template as a regular expression over the words of a text."""
    by_label: dict[str, list[str]] = {}
    for name, template in TEMPLATES.items():
        automaton = Automaton(template)
        anchors = [" ".join(a) for a in itertools.product(*map(variants, automaton.anchor))]
        there = " OR ".join(f"contains(s, ' {a} ')" for a in anchors)
        by_label.setdefault(LABELS.get(name, name), []).append(f"(({there}) AND regexp_matches(s, '{automaton.pattern()}'))")
    method = " UNION ALL ".join(
        f"SELECT r, '{label}' AS label FROM doc WHERE " + " OR ".join(patterns)
        for label, patterns in by_label.items())
    base = " UNION ALL ".join(
        f"SELECT r, '{label}' AS label, unnest(list_filter(range(0, len(w) - {n} + 1), "
        f"lambda i: array_to_string(w[i + 1:i + {n}], ' ') = '{phrase}')) AS pos FROM doc WHERE len(w) >= {n}"
        for phrase, label in BASE_PHRASES.items() for n in [len(phrase.split())])
    return f"""
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, {words('text')} AS w FROM documents),
doc AS (SELECT r, doc_id, w, ' ' || array_to_string(w, ' ') || ' ' AS s FROM raw),
base AS ({base}), method AS ({method}),
b AS (SELECT r, count(*) AS n, min(pos) AS a, max(pos) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM base GROUP BY r),
m AS (SELECT DISTINCT r FROM method),
l AS (
  SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
  FROM (SELECT r, label FROM base UNION SELECT r, label FROM method) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(b.n, 0) AS n_base, b.a AS first_word, b.z AS last_word,
       coalesce(b.labels, '') AS base_labels, coalesce(l.labels, '') AS labels,
       CASE WHEN m.r IS NOT NULL THEN 1.0::DOUBLE WHEN b.n > 0 THEN 0.5::DOUBLE ELSE 0.0::DOUBLE END AS score
FROM doc LEFT JOIN b USING (r) LEFT JOIN m USING (r) LEFT JOIN l USING (r)
"""


def crc32(text: str) -> str:
    """Unsigned CRC-32 of a short ASCII text, bit by bit (DuckDB has no function for it)."""
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ascii(substr({text}, i::INT, 1))::UBIGINT)"
    bits = "list_reduce(list_prepend(xor(a, b), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384::UBIGINT))"
    return f"xor(list_reduce(list_prepend(4294967295::UBIGINT, {codes}), lambda a, b: {bits}), 4294967295::UBIGINT)"


def _leaf(text: str) -> str:
    fields = [f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)]
    return f"sha256({' || '.join(fields)})"


# Nodes by level; siblings of a place are the other places of its run of three. Trees of sources and the tree over them
# are built by the same recursion, one after the other.
MERKLE = f"""
WITH RECURSIVE doc AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS grp, {_leaf('text')} AS leaf,
         CASE WHEN {crc32('doc_id::VARCHAR')} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf('text')} END AS now
  FROM documents
),
start AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS place, count(*) OVER (PARTITION BY grp) AS n
  FROM doc
),
node AS (
  SELECT 0 AS level, grp, place, n, leaf AS digest FROM start
  UNION ALL
  SELECT level + 1, grp, place // 3, max((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM node
  WHERE n > 1 GROUP BY level + 1, grp, place // 3
),
subroot AS (SELECT grp, level AS height, digest, row_number() OVER (ORDER BY grp) - 1 AS place, count(*) OVER () AS n FROM node WHERE n = 1),
top AS (
  SELECT 0 AS level, place, n, digest FROM subroot
  UNION ALL
  SELECT level + 1, place // 3, max((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY place)) FROM top
  WHERE n > 1 GROUP BY level + 1, place // 3
),
whole AS (SELECT digest AS root FROM top WHERE n = 1),
every AS (
  SELECT grp, level, place, digest FROM node WHERE n > 1
  UNION ALL
  SELECT s.grp, s.height + t.level, t.place, t.digest FROM subroot s, top t WHERE t.n > 1
),
step AS (
  SELECT d.r, e.level, CASE WHEN e.level < s.height THEN d.place // (3 ** e.level)::BIGINT
                            ELSE s.place // (3 ** (e.level - s.height))::BIGINT END AS place, d.grp
  FROM start d JOIN subroot s USING (grp) JOIN (SELECT DISTINCT grp, level FROM every) e USING (grp)
),
sibling AS (
  SELECT t.r, t.level, coalesce(string_agg(e.digest, '' ORDER BY e.place) FILTER (e.place < t.place), '') AS ahead,
         coalesce(string_agg(e.digest, '' ORDER BY e.place) FILTER (e.place > t.place), '') AS behind
  FROM step t JOIN every e ON e.grp = t.grp AND e.level = t.level AND e.place // 3 = t.place // 3 GROUP BY t.r, t.level
),
proof AS (SELECT r, sha256(string_agg(ahead || behind, '' ORDER BY level)) AS proof_sha256 FROM sibling GROUP BY r),
fold AS (
  SELECT r, 0 AS level, now AS digest FROM start
  UNION ALL
  SELECT f.r, f.level + 1, sha256(s.ahead || f.digest || s.behind) FROM fold f JOIN sibling s ON s.r = f.r AND s.level = f.level
),
folded AS (SELECT r, max_by(digest, level) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, s.digest AS subroot, root, coalesce(proof_sha256, sha256('')) AS proof_sha256, folded_root,
       folded_root = root AS verified
FROM start d JOIN subroot s USING (grp) CROSS JOIN whole LEFT JOIN proof USING (r) JOIN folded USING (r)
"""


def _least_edits() -> str:
    """Cheapest repair from one row on, for each state: (cost, letters, repaired rows), from those behind the row (b0 to b3)."""
    pen = "CASE WHEN truncated THEN 5 ELSE 0 END"
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    names = {2: "user", 3: "assistant"}
    kept = "concat(role, ':', text)"

    def edit(letter: str, cost: str, state: int, row: str | None) -> str:
        rows = f"b{state}.r" if row is None else f"list_prepend({row}, b{state}.r)"
        return f"{{'c': b{state}.c + {cost}, 's': '{letter}' || b{state}.s, 'r': {rows}}}"

    def base(state: int) -> str:
        to = after[state]
        renamed = f"concat('{names[to]}:', text)"
        options = [edit("D", "2", state, None), f"CASE WHEN NOT gone THEN {edit('R', f'1 + {pen}', to, renamed)} END",
                   f"CASE WHEN NOT gone AND left(role, 1) = '{names[to][0]}' THEN {edit('K', pen, to, kept)} END"]
        if state == 0:
            options.append(f"CASE WHEN NOT gone AND left(role, 1) = 's' THEN {edit('K', pen, 1, kept)} END")
        return f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))"

    def inserted(state: int) -> str:
        one, two = after[state], after[after[state]]
        return (f"list_min([e{state}, {{'c': e{one}.c + 5, 's': 'I' || e{one}.s, 'r': list_prepend('{names[one]}:', e{one}.r)}}, "
                f"{{'c': e{two}.c + 10, 's': 'II' || e{two}.s, 'r': list_concat(['{names[one]}:', '{names[two]}:'], e{two}.r)}}])")

    bases = ", ".join(f"{base(k)} AS e{k}" for k in range(4))
    return f"SELECT k, pos - 1 AS pos, {', '.join(f'{inserted(k)} AS b{k}' for k in range(4))} FROM (SELECT k, pos, {bases} FROM joined)"


CONVERSATIONS = f"""
WITH RECURSIVE raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind
  FROM conversations
),
conv AS (SELECT conv_id, row_number() OVER () AS k FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT k, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, text, copy FROM (
    SELECT conv_id, turn, kind, role, unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM raw WHERE kind <> 0) d JOIN conv c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
),
placed AS (
  SELECT k, turn, role, text, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending,
         regexp_matches(text, '[^\x20\x09-\x0D]') AS has_text
  FROM damaged
),
seen AS (SELECT *, row_number() OVER (PARTITION BY k, role, text ORDER BY pos) > 1 AS again FROM placed),
turns AS (
  SELECT k, turn, role, text, pos, NOT has_text AS blank, has_text AND again AS duplicate, NOT has_text OR again AS gone,
         has_text AND NOT again AND ending NOT IN ('.', '!', '?') AS truncated,
         lag(left(role, 1)) OVER (PARTITION BY k ORDER BY pos) || left(role, 1) AS neighbours
  FROM seen
),
dp AS (
  SELECT k, count(*) AS pos, {{'c': 0::BIGINT, 's': '', 'r': []::VARCHAR[]}} AS b0,
         {{'c': 10::BIGINT, 's': 'II', 'r': ['user:', 'assistant:']}} AS b1, {{'c': 5::BIGINT, 's': 'I', 'r': ['assistant:']}} AS b2,
         {{'c': 0::BIGINT, 's': '', 'r': []::VARCHAR[]}} AS b3
  FROM turns GROUP BY k
  UNION ALL
  (WITH joined AS (SELECT dp.*, role, text, gone, truncated FROM dp JOIN turns USING (k, pos)) {_least_edits()})
),
faults AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
         count(*) FILTER (neighbours NOT IN ('su', 'ua', 'au')) AS illegal
  FROM turns GROUP BY k
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b0.c, 0) AS cost, coalesce(b0.s, '') AS audit,
       sha256(coalesce(array_to_string(b0.r, chr(10)), '')) AS repaired_sha256
FROM conv LEFT JOIN faults USING (k) LEFT JOIN (SELECT k, b0 FROM dp WHERE pos = 0) USING (k)
"""
