"""DuckDB SQL of the registered text queries that SQL can express.

The others rest on tokenizer files (op2, op8), on automata, class models or tree scores
(op4, op10, op6), on scored spans (op5), on runs of lines of any length (op7) or on edit
distances (op9); the tests hold those against brute force or the libraries.
"""

from __future__ import annotations

from rollmatch.llm.quality import RULES, STOP_WORDS

WORD = r"[^\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rules() -> str:
    """The threshold table as a SQL condition."""
    ratio = {
        "symbols_per_word": "n_symbols / n_words", "mean_word_chars": "word_chars / n_words", "stop_word_ratio": "n_stop / n_words",
        "repeat_ratio": "n_repeat_words / n_words", "capital_ratio": "n_capitals / greatest(word_chars, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    }
    parts = []
    for r in RULES:
        bounds = [f"{ratio[r.measure]} >= {r.low}"] * (r.low is not None) + [f"{ratio[r.measure]} <= {r.high}"] * (r.high is not None)
        parts.append(f"(n_words < {r.min_words} OR ({' AND '.join(bounds)}))")
    return " AND ".join(parts)


QUALITY = rf"""
WITH w AS (
  SELECT doc_id, t, regexp_extract_all(t, '{WORD}') AS ws,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS ls
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
g AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g FROM w, unnest(range(1, len(ws) - 1)) u(i)),
often AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM often) GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, coalesce(covered.n, 0) AS n_repeat_words, len(ls) AS n_lines,
         length(regexp_replace(t, '[^\p{{Lu}}]', '', 'g')) AS n_capitals,
         len(list_filter(ws, lambda x: lower(x) IN ({", ".join(f"'{x}'" for x in dict.fromkeys(STOP_WORDS))}))) AS n_stop
  FROM w LEFT JOIN covered USING (doc_id)),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND {_rules()} AS kept FROM f"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD}') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS g FROM w, unnest(range(1, greatest(len(ws) - 2, 2))) u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, na.n, nb.n HAVING 100 * count(*) >= 80 * (na.n + nb.n - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM w UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, w.doc_id = c.component_id AS kept
FROM w JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)"""

#: CRC-32 of an ASCII string as SQL: its bytes one after the other, eight shifts each.
CRC32 = """xor(4294967295, list_reduce([4294967295] || flatten(list_transform(range(1, length({x}) + 1), lambda i: [ascii({x}[i]), -1, -1, -1, -1, -1, -1, -1, -1])),
  lambda a, b: CASE WHEN b >= 0 THEN xor(a, b) ELSE xor(a >> 1, 3988292384 * (a & 1)) END))"""


def _field(x: str) -> str:
    return f"coalesce(CAST(strlen(CAST({x} AS VARCHAR)) AS VARCHAR) || ':' || CAST({x} AS VARCHAR), '-')"


def _levels(name: str, start: str) -> str:
    """A recursive table of all nodes above ``start`` (tree, idx, h) and a table of their runs."""
    return f"""
{name} AS (
  SELECT tree, 0 AS l, idx, h, count(*) OVER (PARTITION BY tree) AS m FROM {start}
  UNION ALL
  SELECT tree, l + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (m + 7) // 8 FROM {name} WHERE m > 1 GROUP BY tree, l, idx // 8, m),
{name}_runs AS (SELECT tree, l + 1 AS l, idx // 8 AS up, list(h ORDER BY idx) AS kids FROM {name} WHERE m > 1 GROUP BY tree, l, idx // 8)"""


def _climb(name: str, runs: str, start: str) -> str:
    """The ways up from ``start`` (tree, idx, leaf_tree, leaf_idx, cur, proof) over ``runs``; the last row of each is its end."""
    p = "CAST(c.idx % 8 AS INTEGER)"
    return f"""
{name}_all AS (
  SELECT *, 0 AS l FROM {start}
  UNION ALL
  SELECT c.tree, c.idx // 8, leaf_tree, leaf_idx, sha256(array_to_string(kids[1:{p}] || [cur] || kids[{p} + 2:], '')),
         proof || array_to_string(kids[1:{p}] || kids[{p} + 2:], ''), c.l + 1
  FROM {name}_all c JOIN {runs} r ON r.tree = c.tree AND r.l = c.l + 1 AND r.up = c.idx // 8),
{name} AS (SELECT * FROM {name}_all QUALIFY l = max(l) OVER (PARTITION BY leaf_tree, leaf_idx))"""


_LEAF = "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", "n_chars", "text")) + ")"
_TAMPERED = _LEAF.replace("(text AS", "(lowered AS")
MERKLE = f"""
WITH RECURSIVE
d AS (SELECT *, CASE WHEN {CRC32.format(x="CAST(doc_id AS VARCHAR)")} % 3 = 0 THEN translate(text, '{_UPPER}', '{_LOWER}') ELSE text END AS lowered FROM documents),
hashed AS (SELECT doc_id, lang, {_LEAF} AS h, {_TAMPERED} AS claimed FROM d),
trees AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM (SELECT DISTINCT lang FROM documents)),
leaf AS (
  SELECT doc_id, h, claimed, tree, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS idx
  FROM hashed JOIN trees ON hashed.lang IS NOT DISTINCT FROM trees.lang),
{_levels("low", "leaf")},
sub AS (SELECT 0 AS tree, tree AS idx, h FROM low WHERE m = 1),
{_levels("high", "sub")},
top AS (SELECT h FROM high WHERE m = 1),
start1 AS (SELECT tree, idx, tree AS leaf_tree, idx AS leaf_idx, claimed AS cur, '' AS proof FROM leaf),
{_climb("c1", "low_runs", "start1")},
start2 AS (SELECT 0 AS tree, leaf_tree AS idx, leaf_tree, leaf_idx, cur, proof FROM c1),
{_climb("c2", "high_runs", "start2")}
SELECT doc_id, leaf.h AS leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = top.h AS verified
FROM leaf JOIN c2 ON leaf.tree = leaf_tree AND leaf.idx = leaf_idx JOIN sub ON sub.idx = leaf.tree, top"""

#: The states of the grammar ``(s?(ua)+)?`` are the last initial ('' at the start); rows of ``dp`` hold the cheapest,
#: then ASCII-least edits of a conversation's first i turns for each state, ``ins`` up to two inserts after a turn.
REPAIR = rf"""
WITH RECURSIVE
src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32.format(x="(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS k FROM conversations),
convs AS (SELECT conv_id, row_number() OVER (ORDER BY conv_id) AS c FROM (SELECT DISTINCT conv_id FROM conversations)),
damaged AS (
  SELECT c, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE k WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM src JOIN convs ON src.conv_id IS NOT DISTINCT FROM convs.conv_id WHERE k <> 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, role[1] AS initial FROM damaged),
t AS (
  SELECT *, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS pair,
         CASE WHEN NOT regexp_matches(text, '{WORD}') THEN 'blank' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
  FROM ordered),
counts AS (
  SELECT c, CAST(coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS BIGINT) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM t GROUP BY c),
grammar(g, symbol, g2) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
moves AS (
  SELECT 'K' AS op, g, symbol, g2, 0 AS cost FROM grammar UNION ALL SELECT 'R', g, symbol, g2, 1 FROM grammar WHERE symbol <> 's'
  UNION ALL SELECT 'D', g, '', g, 2 FROM (VALUES (''), ('s'), ('u'), ('a')) v(g)),
ins(g, g2, cost, letters, body) AS (
  VALUES ('', '', 0, '', CAST([] AS VARCHAR[])), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
         ('', 'u', 5, 'I', ['user:']), ('s', 'u', 5, 'I', ['user:']), ('u', 'a', 5, 'I', ['assistant:']), ('a', 'u', 5, 'I', ['user:']),
         ('', 'a', 10, 'II', ['user:', 'assistant:']), ('s', 'a', 10, 'II', ['user:', 'assistant:']),
         ('u', 'u', 10, 'II', ['assistant:', 'user:']), ('a', 'a', 10, 'II', ['user:', 'assistant:'])),
dp AS (
  SELECT c, CAST(0 AS BIGINT) AS i, ins.g2 AS g, CAST(cost AS BIGINT) AS cost, letters AS audit, body FROM convs, ins WHERE ins.g = ''
  UNION ALL
  SELECT c, i, g, cost, audit, body FROM (
    SELECT dp.c, t.i, ins.g2 AS g, dp.cost + moves.cost + CASE WHEN op <> 'D' AND fault = 'truncated' THEN 5 ELSE 0 END + ins.cost AS cost,
           audit || op || letters AS audit,
           dp.body || CASE op WHEN 'D' THEN [] WHEN 'K' THEN [role || ':' || text] ELSE [CASE symbol WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] END || ins.body AS body
    FROM dp JOIN t ON t.c = dp.c AND t.i = dp.i + 1
    JOIN moves ON moves.g = dp.g AND (op = 'D' OR (fault NOT IN ('blank', 'duplicate') AND (op = 'R' OR symbol = initial)))
    JOIN ins ON ins.g = moves.g2)
  QUALIFY row_number() OVER (PARTITION BY c, g ORDER BY cost, audit) = 1),
ends AS (
  SELECT dp.* FROM dp LEFT JOIN counts USING (c) WHERE i = coalesce(n, 0) AND g IN ('', 'a')
  QUALIFY row_number() OVER (PARTITION BY c ORDER BY cost, audit) = 1)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, cost, audit, sha256(array_to_string(body, chr(10))) AS repaired_sha256
FROM convs JOIN ends USING (c) LEFT JOIN counts USING (c)"""

#: Windows of 100 bytes as numbers of their hex text; repeated ones make runs, what lies between stays.
REPEATS = """
WITH w AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
s AS (SELECT doc_id, i, md5_number(hx[2 * i + 1:2 * i + 200]) AS g FROM w, unnest(range(len(hx) // 2 - 99)) u(i)),
later AS (SELECT doc_id, i FROM s QUALIFY row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS LAST, i) > 1),
marked AS (SELECT doc_id, i, i > coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -101) + 100 AS opens FROM later),
runs AS (SELECT doc_id, i, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM marked),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
before AS (SELECT doc_id, run, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY run), 0) AS a0 FROM spans),
cut AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS n_spans, max(b) AS last, string_agg(hx[2 * a0 + 1:2 * a], '' ORDER BY run) AS hx
  FROM before JOIN w USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(len(w.hx) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(cut.hx, '') || w.hx[2 * coalesce(last, 0) + 1:])) AS kept_sha256
FROM w LEFT JOIN cut USING (doc_id)"""

ORACLE_SQL: dict[str, str] = {
    "op1_quality_rules": QUALITY, "op3_minhash_neardup": NEAR_DUPLICATES, "op11_suffix_dedup": REPEATS, "op12_merkle_manifest": MERKLE,
    "op13_conversation_repair": REPAIR}
