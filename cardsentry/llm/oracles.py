"""DuckDB twins of the queries that SQL can express, written another way than
the operators: deletion neighbourhoods instead of an index, a DP that carries
its audit instead of matrices, CRC-32 as a fold over bytes."""

from __future__ import annotations

# The CRC-32 table from its polynomial, one row.
CRC_TABLE = """crc_table AS (
  SELECT list(list_reduce([i::BIGINT] || range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS crc_t
  FROM range(256) r(i)
)"""


def crc32(raw: str) -> str:
    """Unsigned CRC-32 of the bytes of a hex text; needs ``crc_t`` in scope."""
    byte = f"('0x' || substr({raw}, (2 * k - 1)::INTEGER, 2))::BIGINT"
    return (f"xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length({raw}) // 2 + 1), lambda k: {byte}), "
            "lambda c, v: xor(c // 256, crc_t[xor(c, v) % 256 + 1])), 4294967295)")


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def spelling() -> str:
    return f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS raw, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[a-zÀ-ÿ]+')) AS run FROM documents)
  GROUP BY ALL
),
hashed AS (SELECT run, n, {crc32("raw")} AS h FROM runs, crc_table),
vocabulary AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3
),
cut AS (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM vocabulary)),
pairs AS (
  SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, b.word FROM cut a JOIN vocabulary b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM cut a JOIN vocabulary b ON a.rest = b.word
),
near AS (
  SELECT p.word, count(*) AS n_near, first(p.other ORDER BY v.n DESC, p.other) AS best, max(v.n) AS best_n
  FROM pairs p JOIN vocabulary v ON v.word = p.other GROUP BY p.word
),
formed AS (
  SELECT v.word, v.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 2 * v.n THEN b.best END AS form,
         CASE WHEN b.best_n >= 2 * v.n THEN b.best_n END AS form_n
  FROM vocabulary v LEFT JOIN near b ON b.word = v.word
),
way AS (
  SELECT word, form AS at FROM formed WHERE form IS NOT NULL
  UNION ALL SELECT w.word, f.form FROM way w JOIN formed f ON f.word = w.at AND f.form IS NOT NULL
),
ends AS (SELECT w.word, w.at FROM way w JOIN formed f ON f.word = w.at AND f.form IS NULL)
SELECT f.word, f.form, coalesce(e.at, f.word) AS root, f.n, f.n_near, f.form_n FROM formed f LEFT JOIN ends e ON e.word = f.word
"""


def conversations() -> str:
    shown = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE {CRC_TABLE},
rows_named AS (
  SELECT coalesce(conv_id::VARCHAR, '') AS conv, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode({shown})) AS raw FROM conversations
),
hit AS (SELECT conv, turn, role, text, {crc32("raw")} % 20 AS h FROM rows_named, crc_table),
damaged AS (
  SELECT conv, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN h = 1 THEN '' WHEN h = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hit WHERE h <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos, rtrim(text, {blanks}) AS said FROM damaged
),
faulty AS (
  SELECT conv, turn, role, text, pos, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY pos) AS before,
         CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY pos) > 1 THEN 'duplicate'
              WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
  FROM placed
),
counts AS (
  SELECT conv, count(*) AS n_rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faulty GROUP BY conv
),
-- states: 0 nothing yet, 1 after system, 2 after user, 3 after assistant
added(state, to_state, cost, letters, lines) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []),
  (0, 2, 2, 'I', ['user:']), (1, 2, 2, 'I', ['user:']), (2, 3, 2, 'I', ['assistant:']), (3, 2, 2, 'I', ['user:']),
  (0, 3, 4, 'II', ['user:', 'assistant:']), (1, 3, 4, 'II', ['user:', 'assistant:'])),
edits(state, to_state, cost, letter, initial, role) AS (VALUES
  (0, 0, 3, 'D', NULL, NULL), (1, 1, 3, 'D', NULL, NULL), (2, 2, 3, 'D', NULL, NULL), (3, 3, 3, 'D', NULL, NULL),
  (0, 1, 0, 'K', 's', NULL), (0, 2, 0, 'K', 'u', NULL), (1, 2, 0, 'K', 'u', NULL), (3, 2, 0, 'K', 'u', NULL), (2, 3, 0, 'K', 'a', NULL),
  (0, 2, 2, 'R', NULL, 'user'), (1, 2, 2, 'R', NULL, 'user'), (3, 2, 2, 'R', NULL, 'user'), (2, 3, 2, 'R', NULL, 'assistant')),
dp AS (
  SELECT DISTINCT coalesce(conv_id::VARCHAR, '') AS conv, 0::BIGINT AS pos, 0 AS state, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM conversations
  UNION ALL
  SELECT conv, pos, state, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY conv, state ORDER BY cost, audit) AS nth FROM (
      SELECT d.conv, f.pos, e.to_state AS state,
             d.cost + a.cost + e.cost + CASE WHEN e.letter <> 'D' AND f.fault = 'truncated' THEN 1 ELSE 0 END AS cost,
             d.audit || a.letters || e.letter AS audit,
             d.lines || a.lines || CASE WHEN e.letter = 'D' THEN []::VARCHAR[] ELSE [coalesce(e.role, f.role) || ':' || f.text] END AS lines
      FROM dp d JOIN faulty f ON f.conv = d.conv AND f.pos = d.pos + 1
      JOIN added a ON a.state = d.state
      JOIN edits e ON e.state = a.to_state AND (e.initial IS NULL OR e.initial = f.initial)
      WHERE e.letter = 'D' OR f.fault NOT IN ('blank', 'duplicate')
    )
  ) WHERE nth = 1
),
ended AS (
  SELECT d.conv, d.cost + a.cost AS cost, d.audit || a.letters AS audit, d.lines || a.lines AS lines,
         row_number() OVER (PARTITION BY d.conv ORDER BY d.cost + a.cost, d.audit || a.letters) AS nth
  FROM dp d LEFT JOIN counts c ON c.conv = d.conv JOIN added a ON a.state = d.state AND a.to_state IN (0, 3)
  WHERE d.pos = coalesce(c.n_rows, 0)
)
SELECT nullif(e.conv, '')::BIGINT AS conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, e.cost::BIGINT AS cost, e.audit,
       sha256(array_to_string(e.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN counts c ON c.conv = e.conv WHERE e.nth = 1
"""
