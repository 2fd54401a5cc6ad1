"""SQL for the corpus queries that SQL can express, on the driver's tables (ids are unique there)."""

from __future__ import annotations

import string

from jobtide.llm.common import WORD
from jobtide.llm.decontaminate import TEST_WORD

_LOWER = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

DECONTAMINATION = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{TEST_WORD}') AS w FROM documents),
tests AS (SELECT item_id, regexp_extract_all({_LOWER}, '{TEST_WORD}') AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS phrase, least(len(w), 10) AS n
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM tests WHERE len(w) > 0)),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, i, n, item_id FROM places JOIN windows USING (phrase, n)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY 1),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

REPEATS = rf"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS s
  FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM docs)),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p
  FROM windows SEMI JOIN (SELECT s FROM windows GROUP BY 1 HAVING count(*) > 1) USING (s)),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS words, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs) ANTI JOIN gone USING (doc_id, p)
  GROUP BY 1)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(words, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""

# 5 bits of a SHA-1 at a time, out of two hexadecimal digits, as base32.
WARC = """
WITH paged AS (SELECT page_id, coalesce(html, '') AS body, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
SELECT page_id, strlen(body) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((('0x' || substr(sha1(body), (5 * i) // 4 + 1, 2))::INTEGER >> (3 - (5 * i) % 4)::INTEGER) & 31) + 1, 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM paged"""

TOPK = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT FOR x IN embedding] AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS query_id, b.vec_id,
    list_sum([p[1] * p[2] FOR p IN list_zip(a.q, b.q)])::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score
FROM (SELECT *, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank FROM scored)
WHERE rank <= 5"""

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _with(state: str, cost: str, edit: str, line: str = "''") -> str:
    return f"{{'c': {state}.c + {cost}, 'e': {state}.e || '{edit}', 'r': {state}.r || {line}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _repair_steps() -> tuple[str, str, str]:
    """(states with turns inserted, states after a turn, the end): s0 to s3 are nothing yet, after system, user, assistant.

    A state is its least (cost, edits) and the text these give, so the least struct is the cheapest, first repair.
    """
    user, assistant = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    inserted = f"s0 AS b0, s1 AS b1, {_least('s2', *[_with(s, '5', 'I', user) for s in ('s0', 's1', 's3')])} AS b2"
    inserted3 = _least("s3", _with("b2", "5", "I", assistant))
    line, must = "chr(10) || role || ':' || text", "fault IN ('blank', 'duplicate')"

    def turned(froms: tuple[str, ...], role: str | None, initial: str) -> str:
        kept = [f"CASE WHEN NOT {must} AND role[1] = '{initial}' THEN {_with(s, 'cut', 'K', line)} END" for s in froms]
        new = [f"CASE WHEN NOT {must} THEN {_with(s, '1 + cut', 'R', role + ' || text')} END" for s in froms] if role else []
        return ", ".join([*kept, *new])

    after = (f"{_with('b0', '2', 'D')} AS s0, {_least(_with('b1', '2', 'D'), turned(('b0',), None, 's'))} AS s1,"
             f" {_least(_with('b2', '2', 'D'), turned(('b0', 'b1', 'b3'), user, 'u'))} AS s2,"
             f" {_least(_with('b3', '2', 'D'), turned(('b2',), assistant, 'a'))} AS s3")
    return inserted, inserted3, after


_INSERTED, _INSERTED_3, _AFTER = _repair_steps()
_NEVER = "{'c': 1000000000::BIGINT, 'e': '', 'r': ''}"

# crc32 takes a byte and then eight shifts (-1) at a time.
REPAIR = f"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce([4294967295::BIGINT] || flatten([[ord(ch)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1] FOR ch IN
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')]),
      lambda crc, v: CASE WHEN v >= 0 THEN xor(crc, v) WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END),
      4294967295) % 20 AS hit
  FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE hit WHEN 4 THEN 'user' ELSE role END AS role,
    CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE hit WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM dealt WHERE hit <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, copy) AS i, rtrim(text, {_SPACE}) AS said
  FROM damaged),
faulty AS (
  SELECT *, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au') AS illegal,
    CASE WHEN said = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed),
turns AS (SELECT *, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cut FROM faulty),
steps AS (
  SELECT conv_id, 0::BIGINT AS i, {{'c': 0::BIGINT, 'e': '', 'r': ''}} AS s0, {_NEVER} AS s1, {_NEVER} AS s2, {_NEVER} AS s3
  FROM (SELECT DISTINCT conv_id FROM conversations)
  UNION ALL
  SELECT conv_id, i, {_AFTER}
  FROM (
    SELECT *, {_INSERTED_3} AS b3
    FROM (
      SELECT t.conv_id, t.i, t.role, t.text, t.fault, t.cut, s3, {_INSERTED}
      FROM steps JOIN turns t ON t.conv_id IS NOT DISTINCT FROM steps.conv_id AND t.i = steps.i + 1))),
ended AS (
  SELECT conv_id, list_min([b0, {_INSERTED_3}]) AS best
  FROM (
    SELECT conv_id, s3, {_INSERTED}
    FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS back FROM steps) WHERE back = 1)),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
  FROM turns GROUP BY 1)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, best.c AS cost, best.e AS audit,
  sha256(substr(best.r, 2)) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id"""

MINHASH = rf"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{WORD}') AS w FROM documents),
alike AS (SELECT w, min(doc_id) AS first FROM docs GROUP BY 1),
sets AS (
  SELECT first, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE [array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)) AS s
  FROM alike),
sizes AS (SELECT first, count(*) AS n FROM sets GROUP BY 1),
often AS (SELECT s, row_number() OVER () AS id FROM sets GROUP BY 1 HAVING count(*) > 1),
numbered AS MATERIALIZED (SELECT first, id, n FROM sets JOIN often USING (s) JOIN sizes USING (first)),
links AS (
  SELECT a.first AS a, b.first AS b
  FROM numbered a JOIN numbered b ON a.id = b.id AND a.first <> b.first AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reached AS (SELECT first, first AS other FROM alike UNION SELECT first, b FROM reached JOIN links ON a = other)
SELECT doc_id, coalesce(n, 0) AS n_shingles, CASE WHEN len(w) > 0 THEN component_id ELSE doc_id END AS component_id,
  len(w) = 0 OR doc_id = component_id AS kept
FROM docs JOIN alike USING (w) LEFT JOIN sizes USING (first)
  JOIN (SELECT first, min(other) AS component_id FROM reached GROUP BY 1) USING (first)"""

DIVERGENCE = rf"""
WITH docs AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents),
words AS (SELECT doc_id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 30),
langs AS (SELECT lang, sum(total) AS n, count(*) AS v FROM kept GROUP BY 1),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
sums AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY 1, 2),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
    1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)) // (coalesce(s.n, 0) + 5 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 5)) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON l.lang = g.lang
  LEFT JOIN sums s ON s.lang = g.lang AND s.source = g.source
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item, sum(abs(x.p - y.p))::BIGINT AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY 1, 2, 4
  UNION ALL
  SELECT x.lang, x.source, 'pair', y.source, 0 FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
  WHERE x.lang NOT IN (SELECT lang FROM langs)),
over AS (SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, rank
FROM (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over))
WHERE part = 'pair' OR rank <= 50"""

ORACLE = {
    "op1_decontamination": DECONTAMINATION,
    "op2_substring_dedup": REPEATS,
    "op3_warc": WARC,
    "op7_exact_topk": TOPK,
    "op11_conversation_repair": REPAIR,
    "op12_minhash": MINHASH,
    "op13_source_divergence": DIVERGENCE,
}
