"""DuckDB SQL for the operators whose results SQL can express."""

from __future__ import annotations

from corpusloom.llm import conversation_repair as c
from corpusloom.llm import quality_rules as q
from corpusloom.llm import secrets as s
from corpusloom.llm import variants as v

WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, i, v, v || ' ' || lead(v, 1) OVER o || ' ' || lead(v, 2) OVER o || ' ' || lead(v, 3) OVER o || ' ' || lead(v, 4) OVER o AS k FROM (SELECT rid, generate_subscripts(ws, 1) AS i, unnest(ws) AS v FROM (SELECT rid, regexp_extract_all(text, '{WORD}') AS ws FROM d)) WINDOW o AS (PARTITION BY rid ORDER BY i)),
n AS (SELECT rid, count(*) AS n_words, sum(length(v)) AS word_chars FROM w GROUP BY rid),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM w WHERE k IS NOT NULL) WHERE c > 1),
cov AS (SELECT rid, count(DISTINCT i + j) AS n_repeat_words FROM twice, range({q.WINDOW}) r(j) GROUP BY rid),
l AS (SELECT rid, t, {_LOWER} AS low FROM (SELECT rid, unnest(string_split(text, chr(10))) AS t FROM d) WHERE regexp_matches(t, '{WORD}')),
x AS (SELECT rid, t, array_to_string(regexp_extract_all(low, '{WORD}'), ' ') AS line, len(regexp_extract_all(low, '{WORD}')) AS words FROM l),
dup AS (SELECT rid, count(*) - count(DISTINCT t) AS n_dup_lines FROM x GROUP BY rid),
f AS (SELECT host, line, count(*) AS holders FROM (SELECT DISTINCT host, doc_id, text, line FROM x JOIN d USING (rid)) GROUP BY ALL),
h AS (SELECT host, count(*) AS documents FROM (SELECT DISTINCT host, doc_id, text FROM d) GROUP BY host),
common AS (SELECT f.host, line FROM f JOIN h ON f.host IS NOT DISTINCT FROM h.host WHERE holders > {q.LINE_MIN_DOCUMENTS} AND (holders > documents * {q.LINE_HOST_SHARE} OR holders > {q.LINE_ENOUGH_DOCUMENTS})),
gone AS (SELECT x.rid, sum(words) AS removed_words FROM x JOIN d USING (rid) JOIN common ON common.host IS NOT DISTINCT FROM d.host AND common.line = x.line GROUP BY x.rid),
m AS (SELECT doc_id, CAST(coalesce(n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars, CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(removed_words, 0) AS BIGINT) AS removed_words FROM d LEFT JOIN n USING (rid) LEFT JOIN cov USING (rid) LEFT JOIN dup USING (rid) LEFT JOIN gone USING (rid)),
b AS (SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.REPEAT_PERCENT} * n_words AS base_failed FROM m)
SELECT *, NOT base_failed AND NOT (removed_words > 0 AND (n_words - removed_words < {q.MIN_WORDS} OR n_words - removed_words < n_words * {q.LEFT_SHARE})) AS kept FROM b"""


def _quoted(pattern: str) -> str:
    return pattern.replace("'", "''")


def _spans(kind: int, pattern: str) -> str:
    p = _quoted(pattern)
    return f"SELECT rid, {kind} AS kind, i, v, sum(length(v) + length(p)) OVER (PARTITION BY rid ORDER BY i) AS stop FROM (SELECT rid, generate_subscripts(vs, 1) AS i, unnest(vs) AS v, unnest(ps[1:len(vs)]) AS p FROM (SELECT rid, regexp_extract_all(text, '{p}') AS vs, string_split_regex(text, '{p}') AS ps FROM d WHERE regexp_matches(text, '{p}')))"


_SECRET = f"sha256(CASE WHEN kind = 0 THEN regexp_extract(v, '{_quoted(s.ASSIGN)}', 2) ELSE v END)"
_NAME = "['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || start || ':' || stop"

OP4 = f"""WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(source, chr(1)) AS owner, coalesce(text, '') AS text FROM documents),
raw AS ({_spans(0, s.ASSIGN)} UNION ALL {_spans(1, s.ACCESS)} UNION ALL {_spans(2, s.HEX)} UNION ALL {_spans(3, s.CANDIDATE)}),
sp AS (SELECT rid, kind, v, CAST(stop AS BIGINT) AS stop, CAST(stop - length(v) AS BIGINT) AS start FROM raw),
base AS (SELECT * FROM sp WHERE kind < 3 AND (kind > 0 OR length(regexp_extract(v, '{_quoted(s.ASSIGN)}', 2)) >= {s.ASSIGN_LEAST})),
tok AS (SELECT * FROM sp WHERE kind = 3 AND length(regexp_replace(v, '[^0-9]', '', 'g')) >= {s.CANDIDATE_DIGITS} AND length(regexp_replace(v, '[^A-Za-z]', '', 'g')) >= {s.CANDIDATE_LETTERS} AND NOT EXISTS (SELECT 1 FROM base WHERE base.rid = sp.rid AND base.start < sp.stop AND sp.start < base.stop)),
cand AS (SELECT *, {_SECRET} AS secret FROM (SELECT * FROM base UNION ALL SELECT * FROM tok)),
rare AS (SELECT secret FROM cand JOIN d USING (rid) GROUP BY secret HAVING count(DISTINCT owner) = 1 OR (count(DISTINCT owner) <= {s.MAX_OWNERS} AND count(DISTINCT (owner, text)) <= {s.MAX_REPOSITORIES})),
owned AS (SELECT * FROM cand WHERE secret IN (SELECT secret FROM rare)),
b AS (SELECT rid, count(*) FILTER (WHERE kind = 0) AS n_assign, count(*) FILTER (WHERE kind = 1) AS n_access, count(*) FILTER (WHERE kind = 2) AS n_hex, string_agg({_NAME}, ',' ORDER BY start, kind) AS names FROM base GROUP BY rid),
o AS (SELECT rid, count(*) FILTER (WHERE kind = 3) AS n_owned, count(*) FILTER (WHERE kind < 3) AS n_base_owned FROM owned GROUP BY rid),
a AS (SELECT rid, string_agg({_NAME}, ',' ORDER BY start, kind) AS names FROM (SELECT rid, kind, start, stop FROM base UNION ALL SELECT rid, kind, start, stop FROM owned WHERE kind = 3) GROUP BY rid)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(b.names, '')) AS base_sha256, coalesce(a.names, '') AS spans, coalesce(n_owned, 0) AS n_owned, coalesce(n_base_owned, 0) AS n_base_owned FROM d LEFT JOIN b USING (rid) LEFT JOIN o USING (rid) LEFT JOIN a USING (rid)"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes: each byte is mixed in and followed by eight shifts."""
    octets = f"flatten(list_transform(range(1, length(hex(encode({text}))), 2), lambda i: [CAST('0x' || substring(hex(encode({text})), i, 2) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))"
    return f"xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {octets}), lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) ELSE xor(s >> 1, 3988292384 * (s & 1)) END))"


_MOVES = ", ".join(f"({b}, '{kind}', {a}, {cost}, '{audit}', '{made}')" for b, kind, a, cost, audit, made in c.moves())
_ENDS = ", ".join(f"({s}, {cost}, '{audit}', '{made}')" for s, (cost, audit, made) in c.ENDS.items())
_INSERTED = "replace(replace({0}, 'U', 'user:' || chr(10)), 'A', 'assistant:' || chr(10))"

OP11 = rf"""WITH RECURSIVE drawn AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS draw FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN draw = 4 THEN 'user' ELSE role END AS role, CASE draw WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN draw = 3 THEN 2 ELSE 1 END)) AS copy FROM drawn WHERE draw <> 0),
placed AS (SELECT *, row_number() OVER o - 1 AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth, lag(role) OVER o AS before FROM damaged WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^{c.SPACE}]') THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?][{c.SPACE}]*\z') THEN 'truncated' ELSE 'none' END AS fault, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial FROM placed),
kinds AS (SELECT conv_id, pos, role, text, CASE WHEN fault IN ('blank', 'duplicate') THEN 'd' WHEN fault = 'truncated' THEN upper(initial) ELSE initial END AS kind FROM judged),
moves(b, kind, a, cost, audit, made) AS (VALUES {_MOVES}),
ends(state, cost, audit, made) AS (VALUES {_ENDS}),
walk AS (
 SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS pos, 0 AS state, CAST(0 AS BIGINT) AS cost, '' AS audit, '' AS said FROM kinds
 UNION ALL
 SELECT conv_id, pos + 1, state, best.cost, best.audit, best.said FROM (
  SELECT w.conv_id, w.pos, m.a AS state, min({{'cost': w.cost + m.cost, 'audit': w.audit || m.audit, 'said': w.said || {_INSERTED.format("m.made[:-2]")} || CASE m.made[-1:] WHEN 'D' THEN '' WHEN 'K' THEN k.role || ':' || k.text || chr(10) WHEN 'u' THEN 'user:' || k.text || chr(10) ELSE 'assistant:' || k.text || chr(10) END}}) AS best
  FROM walk w JOIN kinds k ON k.conv_id IS NOT DISTINCT FROM w.conv_id AND k.pos = w.pos JOIN moves m ON m.b = w.state AND m.kind = k.kind GROUP BY ALL)),
sums AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND left(before, 1) || left(role, 1) NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
best AS (SELECT s.conv_id, min({{'cost': w.cost + e.cost, 'audit': w.audit || e.audit, 'said': w.said || {_INSERTED.format("e.made")}}}) AS best FROM sums s JOIN walk w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.pos = s.n JOIN ends e ON e.state = w.state GROUP BY s.conv_id)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0) AS cost, coalesce(best.audit, '') AS audit, sha256(coalesce(best.said[:-2], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM i.conv_id"""


_REST = "list_transform(range(1, length({0}) + 1), lambda i: {{'at': i, 'rest': {0}[:i - 1] || {0}[i + 1:]}})"

OP13 = rf"""WITH RECURSIVE said AS (SELECT id, translate(run, '{v.UPPER}', '{v.LOWER}') AS run, count(*) AS times FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[{v.LETTERS}]+')) AS run FROM documents) WHERE length(run) >= {v.LEAST} GROUP BY ALL),
drawn AS (SELECT run, times, {_crc32("id || ':' || run")} AS h FROM said),
words AS (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (SELECT CASE WHEN h % {v.DAMAGED} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, times FROM drawn) WHERE length(word) >= {v.LEAST} GROUP BY word HAVING sum(times) >= {v.OFTEN}),
rests AS (SELECT word, n, r.at AS at, r.rest AS rest FROM (SELECT word, n, unnest({_REST.format("word")}) AS r FROM words)),
near AS (SELECT a.word, b.word AS other, b.n AS other_n FROM rests a JOIN rests b ON a.rest = b.rest AND a.at = b.at AND a.word <> b.word
 UNION SELECT r.word, w.word, w.n FROM rests r JOIN words w ON w.word = r.rest
 UNION SELECT w.word, r.word, r.n FROM rests r JOIN words w ON w.word = r.rest),
best AS (SELECT word, count(*) AS n_near, min({{'less': -other_n, 'other': other}}) AS b FROM near GROUP BY word),
forms AS (SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -b.less >= 2 * n THEN b.other END AS form, CASE WHEN -b.less >= 2 * n THEN -b.less END AS form_n FROM words w LEFT JOIN best USING (word)),
way AS (SELECT word, form AS goal FROM forms WHERE form IS NOT NULL UNION ALL SELECT way.word, f.form FROM way JOIN forms f ON f.word = way.goal AND f.form IS NOT NULL),
roots AS (SELECT way.word, goal AS root FROM way JOIN forms f ON f.word = goal AND f.form IS NULL)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM forms LEFT JOIN roots USING (word)"""


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": OP1, "op4_secrets": OP4, "op11_conversation_repair": OP11, "op13_variants": OP13}
