"""DuckDB SQL for the queries that SQL can express.

Operators 1, 3, 4, 6, 7, 8, 10 and the pipeline are tested against brute-force versions,
round trips or held-out accuracy instead.
"""

from __future__ import annotations

from bellwether.llm import url_templates as U
from bellwether.llm.chat_format import END, SYSTEM, UNKNOWN
from bellwether.llm.decontaminate import WINDOW
from bellwether.llm.text import WORD_PATTERN

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{WORD_PATTERN}')"
_END = END.replace("\n", "' || chr(10) || '")

OP2 = f"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS ws FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(ws), {WINDOW}) AS size,
         array_to_string(ws[i : i + least(len(ws), {WINDOW}) - 1], ' ') AS passage
  FROM item, unnest(range(1, greatest(len(ws) - {WINDOW} + 2, 2))) AS r(i) WHERE len(ws) > 0),
doc AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
hit AS (
  SELECT d.doc_id, p.i, s.size, win.item_id
  FROM doc d, (SELECT DISTINCT size FROM win) s, unnest(range(1, greatest(len(d.ws) - s.size + 2, 1))) AS p(i)
  JOIN win ON win.size = s.size AND win.passage = array_to_string(d.ws[p.i : p.i + s.size - 1], ' ')),
word AS (
  SELECT doc_id, count(DISTINCT w) AS n_hit FROM hit, unnest(range(i, i + size)) AS q(w) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(w.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(x.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(x.ids, '')) AS items_sha256,
       coalesce(w.n_hit, 0) > 0 AS contaminated
FROM doc d LEFT JOIN word w USING (doc_id) LEFT JOIN items x USING (doc_id)
"""

OP5 = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(text) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents)
WINDOW same AS (PARTITION BY text)
"""

OP9 = f"""
WITH turns AS (
  SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN '{UNKNOWN}' ELSE role END AS speaker,
         coalesce(text, '') AS text, count(*) AS copies
  FROM conversations GROUP BY ALL),
dealt AS (
  SELECT *, CAST((sum(length(speaker) + length(text)) OVER (
           PARTITION BY conv_id ORDER BY turn NULLS FIRST, speaker, text) - length(speaker) - length(text))
         // 16000000 AS BIGINT) AS piece
  FROM turns),
seen AS (
  SELECT t.*, p.perspective,
         CASE WHEN t.speaker = '{SYSTEM}' THEN '<|system|>' WHEN t.speaker = p.perspective THEN '<|assistant|>'
              ELSE '<|user name=' || t.speaker || '|>' END || chr(10) AS head,
         t.text || '{_END}' AS body
  FROM dealt t JOIN (SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> '{SYSTEM}') p
    ON p.conv_id IS NOT DISTINCT FROM t.conv_id),
placed AS (
  SELECT *, sum(length(head) + length(body)) OVER (
           PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, text) AS upto
  FROM seen)
SELECT conv_id, perspective, piece, CAST(min(upto - length(head) - length(body)) AS BIGINT) AS "offset",
       count(*) AS n_turns, CAST(sum(copies) AS BIGINT) AS n_rows,
       string_agg(head || body, '' ORDER BY upto) AS text,
       coalesce(string_agg(CAST(upto - length(body) AS BIGINT) || '-' || CAST(upto AS BIGINT), ',' ORDER BY upto)
                FILTER (WHERE speaker = perspective), '') AS mask,
       CAST(coalesce(sum(length(body)) FILTER (WHERE speaker = perspective), 0) AS BIGINT) AS n_trained
FROM placed GROUP BY conv_id, perspective, piece
"""

OP12 = """
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
failed AS (
  SELECT doc_id, part,
         CAST(len(ws) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT)
         + 4 * CAST(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS INT)
         + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INT)
         + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INT) AS fails
  FROM words),
known AS (
  SELECT doc_id, coalesce(max(CAST(quality = 1 AS INT)), 0) AS good, coalesce(max(CAST(toxic = 1 AS INT)), 0) AS toxic
  FROM labels GROUP BY doc_id),
counts AS (
  SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM failed LEFT JOIN known USING (doc_id) GROUP BY part, fails),
letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS t(x, bit)),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letter a, letter b, letter c, letter d, letter e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31),
steps AS (
  SELECT filter_order, k AS step, bits[k] AS f, coalesce(list_sum(bits[1 : k - 1]), 0) AS done
  FROM orders, range(1, 6) AS r(k)),
result AS (
  SELECT part, filter_order, step, f,
         sum(n) FILTER (WHERE fails & (done | f) = 0) AS kept,
         sum(n) FILTER (WHERE fails & done = 0 AND fails & f > 0) AS removed,
         sum(n) FILTER (WHERE fails & done > 0 AND fails & f > 0) AS redundant,
         sum(n) FILTER (WHERE fails = f) AS unique_fails,
         sum(good) FILTER (WHERE fails & done = 0 AND fails & f > 0) AS good_lost,
         sum(toxic) FILTER (WHERE fails & done = 0 AND fails & f > 0) AS toxic_lost
  FROM counts, (SELECT filter_order, CAST(step AS INT) AS step, f, CAST(done AS INT) AS done FROM steps)
  GROUP BY part, filter_order, step, f)
SELECT part, filter_order, step, CAST(coalesce(kept, 0) AS BIGINT) AS kept, CAST(coalesce(removed, 0) AS BIGINT) AS removed,
       CAST(coalesce(redundant, 0) AS BIGINT) AS redundant, CAST(coalesce(unique_fails, 0) AS BIGINT) AS unique_fails,
       CAST(coalesce(good_lost, 0) AS BIGINT) AS good_lost, CAST(coalesce(toxic_lost, 0) AS BIGINT) AS toxic_lost,
       CAST(coalesce(sum(removed) OVER (PARTITION BY part, f), 0) AS BIGINT) AS shapley
FROM result
"""

OP13 = f"""
WITH doc AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS k,
         translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS text FROM documents),
used AS (
  SELECT lang, source, k, unnest(regexp_extract_all(text, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM doc),
term AS (SELECT lang, term, count(*) AS n FROM used GROUP BY lang, term HAVING count(DISTINCT k) >= 3),
lang AS (SELECT lang, count(*) AS v, CAST(sum(n) AS BIGINT) AS total FROM term GROUP BY lang),
own AS (SELECT lang, source, term, count(*) AS n FROM used JOIN term USING (lang, term) GROUP BY lang, source, term),
grp AS (
  SELECT lang, source, CAST(coalesce(sum(own.n), 0) AS BIGINT) AS total
  FROM (SELECT DISTINCT lang, source FROM doc) LEFT JOIN own USING (lang, source) GROUP BY lang, source),
share AS (
  SELECT g.lang, g.source, t.term, coalesce(o.n, 0) AS n,
         1 + CAST(1000000000 AS HUGEINT) * (coalesce(o.n, 0) + 1) // (g.total + l.v) AS p,
         1 + CAST(1000000000 AS HUGEINT) * (t.n + 1) // (l.total + l.v) AS q
  FROM grp g JOIN term t USING (lang) JOIN lang l USING (lang) LEFT JOIN own o USING (lang, source, term)),
gap AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pair AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(gap.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN gap ON gap.lang = a.lang AND gap.source = a.source AND gap.item = b.source),
top AS (
  SELECT lang, source, 'term' AS part, term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM share WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
FROM (SELECT * FROM pair UNION ALL SELECT * FROM top) QUALIFY part = 'pair' OR rank <= 200
"""


def _op11() -> str:
    """The levels of the descent and of the merging, one after the other."""
    rest = "CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END"
    rules = sorted(U.RULES, key=lambda r: -len(r[0]))

    def case(pick: str) -> str:
        tests = []
        for text, says in rules:
            name, _, path = text.partition("/")
            said = text if pick == "rule" else says
            tests.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{path}') THEN '{said}'")
        return "CASE " + " ".join(tests) + " END"

    steps = [f"""
url AS MATERIALIZED (
  SELECT page_id, translate(regexp_extract({rest}, '^([^/?#]*)([^?#]*)', 1), '{_UPPER}', '{_LOWER}') AS host,
         regexp_extract({rest}, '^([^/?#]*)([^?#]*)', 2) AS path FROM pages),
ruled AS MATERIALIZED (SELECT *, {case('rule')} AS rule, {case('verdict')} AS says FROM url),
u0 AS MATERIALIZED (
  SELECT host, path, n, a, b, CASE WHEN bare = '' THEN [] ELSE string_split(bare, '/') END AS segs, CAST([] AS VARCHAR[]) AS tmpl
  FROM (SELECT host, path, regexp_replace(path, '^/|/$', '', 'g') AS bare, count(*) AS n,
               count(*) FILTER (WHERE says = 'allow') AS a, count(*) FILTER (WHERE says = 'block') AS b
        FROM ruled GROUP BY host, path))"""]
    for k in range(1, U.DEPTH + 1):
        steps.append(f"""
a{k} AS MATERIALIZED (
  SELECT *, array_to_string(tmpl, '') AS prefix,
         CASE WHEN len(segs) >= {k} THEN CASE WHEN regexp_matches(segs[{k}], '{U.NUMBER}')
           OR (regexp_matches(segs[{k}], '{U.HEX}') AND regexp_matches(segs[{k}], '[0-9]')) THEN '*' ELSE '/' || segs[{k}] END END AS s
  FROM u{k - 1}),
k{k} AS MATERIALIZED (
  SELECT host, prefix, s, CASE WHEN s <> '*' AND kinds > {U.MANY} AND kinds * kinds > node_n AND m * 10 < node_n THEN '*' ELSE s END AS token
  FROM (SELECT *, sum(m) OVER w AS node_n, count(*) FILTER (WHERE s <> '*') OVER w AS kinds
        FROM (SELECT host, prefix, s, sum(n) AS m FROM a{k} WHERE s IS NOT NULL GROUP BY host, prefix, s)
        WINDOW w AS (PARTITION BY host, prefix))),
u{k} AS MATERIALIZED (
  SELECT host, path, n, a, b, segs, CASE WHEN s IS NULL THEN tmpl ELSE list_append(tmpl, token) END AS tmpl
  FROM a{k} LEFT JOIN k{k} USING (host, prefix, s))""")
    steps.append(f"""
grown AS MATERIALIZED (
  SELECT host, path, n, a, b, CASE WHEN len(segs) > {U.DEPTH} THEN list_append(tmpl, '**') ELSE tmpl END AS tmpl FROM u{U.DEPTH}),
m{U.DEPTH + 1} AS MATERIALIZED (
  SELECT host, tmpl, tmpl AS merged, sum(n) AS n, sum(a) AS a, sum(b) AS b FROM grown GROUP BY host, tmpl)""")
    for j in range(U.DEPTH, 0, -1):
        steps.append(f"""
p{j} AS MATERIALIZED (
  SELECT *, array_to_string(merged[1 : {j - 1}], '') AS prefix, merged[{j}] AS tok,
         array_to_string(merged[{j + 1} :], '') AS suffix FROM m{j + 1}),
c{j} AS MATERIALIZED (
  SELECT *, sum(x) OVER (PARTITION BY host, prefix, suffix) AS pool, sum(x) OVER own AS own, sum(x) OVER whole - sum(x) OVER own AS rest,
         sum(a) OVER own AS la, sum(b) OVER own AS lb, sum(a) OVER whole - sum(a) OVER own AS lc,
         sum(b) OVER whole - sum(b) OVER own AS ld
  FROM (SELECT host, prefix, tok, suffix, CAST(sum(n) AS DOUBLE) AS x, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(b) AS DOUBLE) AS b
        FROM p{j} WHERE starts_with(tok, '/') GROUP BY host, prefix, tok, suffix)
  WINDOW own AS (PARTITION BY host, prefix, tok), whole AS (PARTITION BY host, prefix)),
f{j} AS MATERIALIZED (SELECT host, prefix, CAST(count(DISTINCT suffix) - 1 AS DOUBLE) AS df FROM c{j} GROUP BY host, prefix),
t{j} AS MATERIALIZED (
  SELECT host, prefix, tok,
         sum((x * rest - (pool - x) * own) * (x * rest - (pool - x) * own) / (own * rest * pool))
           + max(own / rest) * (max(rest) - sum(pool - x)) AS chi, max(df) AS df,
         max(la) AS la, max(lb) AS lb, max(lc) AS lc, max(ld) AS ld
  FROM c{j} JOIN f{j} USING (host, prefix) WHERE rest > 0 GROUP BY host, prefix, tok),
m{j} AS MATERIALIZED (
  SELECT host, tmpl, CASE WHEN t.tok IS NULL THEN merged ELSE merged[1 : {j - 1}] || ['~'] || merged[{j + 1} :] END AS merged, n, a, b
  FROM p{j} LEFT JOIN (
    SELECT host, prefix, tok FROM t{j}
    WHERE (df = 0 OR chi <= df * pow(1.0 - 2.0 / (9.0 * df) + {U.CRITICAL} * sqrt(2.0 / (9.0 * df)), 3.0))
      AND (la + lb > 0) = (lc + ld > 0)
      AND (la * ld - lb * lc) * (la * ld - lb * lc) * (la + lb + lc + ld)
          <= {U.CRITICAL_LABELS} * (la + lb) * (lc + ld) * (la + lc) * (lb + ld)) t USING (host, prefix, tok))""")
    steps.append(f"""
verdict AS (
  SELECT host, merged, n_allow, n_block,
         n_block > 0 AND (n_block + CAST({U.STRENGTH} AS DOUBLE) * prior) / (n_allow + n_block + CAST({U.STRENGTH} AS DOUBLE)) >= {U.REJECT} AS bad
  FROM (SELECT host, merged, sum(a) AS n_allow, sum(b) AS n_block FROM m1 GROUP BY host, merged),
       (SELECT CAST(coalesce(sum(b), 0) + 1 AS DOUBLE) / (coalesce(sum(a) + sum(b), 0) + 2) AS prior FROM m1))""")
    return "WITH" + ",".join(steps) + """
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN bad THEN 'block' ELSE 'allow' END) AS verdict,
       array_to_string(merged, '') AS template, CAST(n_allow AS BIGINT) AS n_allow, CAST(n_block AS BIGINT) AS n_block
FROM ruled JOIN grown USING (host, path) JOIN m1 USING (host, tmpl) JOIN verdict USING (host, merged)
"""


OP11 = _op11()


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": OP2, "op5_exact_dedup": OP5, "op9_chat_format": OP9,
            "op11_url_templates": OP11, "op12_filter_audit": OP12, "op13_source_divergence": OP13}
