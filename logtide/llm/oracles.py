"""SQL for the registered queries that SQL can express, over the given tables."""

from __future__ import annotations

import string

_WORD = r"[^\x20\x09-\x0D]+"
_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase

RULE_LEDGER = rf"""
WITH base AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM base)
),
twice AS (SELECT doc_id, w FROM win GROUP BY ALL HAVING count(*) > 1),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n
  FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM win JOIN twice USING (doc_id, w))
  GROUP BY doc_id
),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    len(lines) AS n_lines, len(regexp_extract_all(text, '\p{{Lu}}')) AS n_capitals
  FROM base LEFT JOIN hit USING (doc_id)
),
bits AS (
  SELECT *, CAST(
    (CASE WHEN n_words < 20 THEN 1 ELSE 0 END)
    + (CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 100 * n_symbols > 5 * word_chars THEN 4 ELSE 0 END)
    + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
    + (CASE WHEN 100 * n_capitals > 50 * word_chars THEN 16 ELSE 0 END) AS BIGINT) AS failure_bits
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  failure_bits & 3 <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits
FROM bits
"""

CONTENT_PARTS = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
),
u AS (
  SELECT *, CASE WHEN conv_id IS NULL THEN row_number() OVER () END AS alone,
    ['', '<|image|>', '<|audio|>', '<|document|>'][coalesce(turn, 0) % 4 + 1] AS mark,
    [0, 256, 128, 1024][coalesce(turn, 0) % 4 + 1] AS tokens
  FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text))
    AS loss_sha256,
  CAST(sum(23 + length(replace(role, '<', '<~')) + length(replace(text, '<', '<~')) + length(mark)) AS BIGINT)
    AS formatted_chars,
  CAST(sum(CASE WHEN mark = '' THEN 0 ELSE 1 END) AS BIGINT) AS n_attachments,
  CAST(sum(tokens) AS BIGINT) AS placeholder_tokens
FROM u GROUP BY conv_id, alone
"""

FM_DECONTAMINATE = rf"""
WITH item AS (
  SELECT item_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '{_BENCH_WORD}') AS words
  FROM benchmark WHERE text IS NOT NULL
),
phrase AS (
  SELECT DISTINCT item_id, least(10, len(words)) AS n,
    array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS w
  FROM (SELECT item_id, words, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS i
        FROM item WHERE len(words) > 0)
),
doc AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_BENCH_WORD}') AS words
  FROM documents
),
win AS (
  SELECT doc_id, n, i, array_to_string(words[i:i + n - 1], ' ') AS w
  FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
        FROM doc, (SELECT DISTINCT n FROM phrase))
),
found AS (SELECT doc_id, i, n, item_id FROM win JOIN phrase USING (n, w)),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id
),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

COVER_DEDUP = rf"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS words FROM documents
),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 49], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM doc)
),
least AS (SELECT w, min(doc_id) AS m FROM win GROUP BY w),
gone AS (
  SELECT DISTINCT doc_id, j
  FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM win JOIN least USING (w) WHERE doc_id > m)
),
word AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS j FROM doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS kept, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
  CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

BAYES_MINHASH = rf"""
WITH RECURSIVE doc AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS words
  FROM documents
),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(words[i:i + 3], ' ') AS s
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i
        FROM doc WHERE len(words) > 0)
),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
),
link AS (
  SELECT a, b FROM pair JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b
  WHERE 100 * c >= 80 * (x.n + y.n - c)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM doc
  UNION
  SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b
),
component AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id,
  doc_id = component_id AS kept
FROM component LEFT JOIN size USING (doc_id)
"""

HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
pair AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM (SELECT * FROM v WHERE vec_id % 100 = 0) a JOIN v b ON a.vec_id <> b.vec_id
),
positive AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM pair WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM positive JOIN pair USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
"""

FILL_MIDDLE = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines,
    sha256('7:' || doc_id) AS h
  FROM documents
),
place AS (
  SELECT *, len(lines) AS n, CAST('0x' || h[1:8] AS BIGINT) % (len(lines) + 1) AS one,
    CAST('0x' || h[9:16] AS BIGINT) % (len(lines) + 1) AS two,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
        OR CAST('0x' || h[17:24] AS BIGINT) % 100 >= 100 THEN 'plain'
      WHEN CAST('0x' || h[25:32] AS BIGINT) % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM cut
),
part AS (
  SELECT *, array_to_string(lines[1:least(one, two)], '') AS p,
    array_to_string(lines[least(one, two) + 1:greatest(one, two)], '') AS m,
    array_to_string(lines[greatest(one, two) + 1:], '') AS s
  FROM place
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
  CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE text END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM part
"""

ORACLES = {
    "op2_rule_ledger": RULE_LEDGER,
    "op4_content_parts": CONTENT_PARTS,
    "op5_fm_decontaminate": FM_DECONTAMINATE,
    "op7_cover_dedup": COVER_DEDUP,
    "op10_bayes_minhash": BAYES_MINHASH,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op13_fill_middle": FILL_MIDDLE,
}
