"""DuckDB SQL for the queries that SQL can express, told from their contracts."""

from __future__ import annotations

# \\ and <| as the template of chat_tree escapes them.
_ESCAPED = "replace(replace({x}, '\\', '\\\\'), '<|', '<\\|')"

OP1 = f"""
WITH said AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r))
SELECT conv_id, COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
         AS turns_sha256,
       CAST(COALESCE(SUM(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(COALESCE(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(length('<|im_start|>') + length(replace({_ESCAPED.format(x="role")}, chr(10), '\\n')) + 1
                + length({_ESCAPED.format(x="text")}) + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM said GROUP BY conv_id"""

_VECTORS = """
v AS (SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
      WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_bool_or([y <> 0 FOR y IN embedding])
        AND NOT list_bool_or([y IS NULL OR NOT isfinite(y) FOR y IN embedding]))"""

OP4 = f"""
WITH {_VECTORS}
SELECT query_id, rank, vec_id, score FROM (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.x, c.x) AS score,
         CAST(ROW_NUMBER() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.x, c.x) DESC, c.vec_id) AS INT)
           AS rank
  FROM v q JOIN v c ON c.vec_id <> q.vec_id AND len(c.x) = len(q.x)
  WHERE q.vec_id % 20 = 0) r
WHERE rank <= 20"""

OP6 = """
WITH RECURSIVE words AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n
  FROM (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^ \\t-\\r]+') AS w FROM documents) d),
windows AS (
  SELECT doc_id, i, string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY i
                                               ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS seq
  FROM words QUALIFY i + 19 <= n),
again AS (
  SELECT doc_id, i FROM windows QUALIFY ROW_NUMBER() OVER (PARTITION BY seq ORDER BY doc_id, i) > 1),
kept AS (
  SELECT w.doc_id, w.word, w.i,
         COALESCE(SUM(CAST(a.i IS NOT NULL AS INT)) OVER (PARTITION BY w.doc_id ORDER BY w.i
                  ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), 0) = 0 AS stays
  FROM words w LEFT JOIN again a ON a.doc_id = w.doc_id AND a.i = w.i)
SELECT d.doc_id, COUNT(k.i) AS n_words, COUNT(k.i) FILTER (WHERE NOT k.stays) AS n_removed,
       sha256(COALESCE(string_agg(k.word, ' ' ORDER BY k.i) FILTER (WHERE k.stays), '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON k.doc_id = d.doc_id
GROUP BY d.doc_id"""

OP7 = f"""
WITH RECURSIVE {_VECTORS},
link AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x)
  WHERE list_inner_product(a.x, b.x) / sqrt(list_inner_product(a.x, a.x)) / sqrt(list_inner_product(b.x, b.x)) >= 0.9),
reach(a, b) AS (
  SELECT vec_id, vec_id FROM embeddings
  UNION
  SELECT r.a, l.b FROM reach r JOIN link l ON l.a = r.b),
least AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT vec_id, (SELECT COUNT(*) FROM link WHERE a = vec_id) AS n_links, component_id,
       vec_id = component_id AS kept
FROM least"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _share(n: str, total: str) -> str:
    return f"1 + (1000000000::HUGEINT * ({n} + 1)) // ({total})"


OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS doc, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
                  COALESCE(text, '') AS text FROM documents),
grp AS (SELECT DISTINCT lang, source FROM d),
word AS (SELECT doc, lang, source, unnest(regexp_extract_all(
           translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (
  SELECT lang, term, COUNT(*) AS n FROM word GROUP BY lang, term HAVING COUNT(DISTINCT doc) >= 3),
said AS MATERIALIZED (
  SELECT w.lang, w.source, w.term, COUNT(*) AS n FROM word w JOIN kept k ON k.lang = w.lang AND k.term = w.term
  GROUP BY w.lang, w.source, w.term),
lang_all AS (SELECT lang, COUNT(*) AS v, SUM(n) AS total FROM kept GROUP BY lang),
tot AS (SELECT g.lang, g.source, COALESCE(SUM(s.n), 0) + COALESCE(MAX(l.v), 0) AS total
        FROM grp g LEFT JOIN said s ON s.lang = g.lang AND s.source = g.source
        LEFT JOIN lang_all l ON l.lang = g.lang GROUP BY g.lang, g.source),
every AS MATERIALIZED (
  SELECT t.lang, t.source, k.term, COALESCE(s.n, 0) AS n, CAST({_share("COALESCE(s.n, 0)", "t.total")} AS BIGINT) AS p,
         CAST({_share("k.n", "l.total + l.v")} AS BIGINT) AS q
  FROM tot t JOIN kept k ON k.lang = t.lang JOIN lang_all l ON l.lang = t.lang
  LEFT JOIN said s ON s.lang = t.lang AND s.source = t.source AND s.term = k.term),
pair AS (
  SELECT a.lang, a.source, b.source AS item, SUM((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM every a JOIN every b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source
  GROUP BY a.lang, a.source, b.source),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(COALESCE(p.value, 0) AS BIGINT) AS value
  FROM grp a JOIN grp b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN pair p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM every WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(ROW_NUMBER() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INT) AS rank
  FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200"""



def _op11() -> str:
    """Six rounds of assignment and update, then the last assignment."""
    steps = ["""
v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, [CAST(floor(4096 * CAST(y AS DOUBLE)) AS BIGINT) FOR y IN embedding] AS x
  FROM embeddings WHERE len(embedding) > 0 AND NOT list_bool_or([y IS NULL OR NOT isfinite(y) FOR y IN embedding])),
part AS MATERIALIZED (
  SELECT r, vec_id, p, x[p * (len(x) // 8) + 1:(p + 1) * (len(x) // 8)] AS x FROM v, range(8) t(p)),
c0 AS (SELECT p, ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x FROM part
       QUALIFY ROW_NUMBER() OVER (PARTITION BY p ORDER BY vec_id) <= 16)"""]
    for i in range(7):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT r, part.p, min(16 * list_sum([(z[1] - z[2]) * (z[1] - z[2]) FOR z IN list_zip(part.x, c{i}.x)])::BIGINT + e) AS k
  FROM part JOIN c{i} ON c{i}.p = part.p GROUP BY r, part.p)""")
        if i == 6:
            break
        steps.append(f"""
s{i} AS (
  SELECT p, e, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY pos) AS x FROM (
    SELECT p, e, pos, SUM(y) AS total, COUNT(*) AS n FROM (
      SELECT part.p, k % 16 AS e, unnest(x) AS y, generate_subscripts(x, 1) AS pos
      FROM part JOIN a{i} ON a{i}.r = part.r AND a{i}.p = part.p) u GROUP BY p, e, pos) w GROUP BY p, e),
c{i + 1} AS MATERIALIZED (SELECT o.p, o.e, COALESCE(s.x, o.x) AS x FROM c{i} o LEFT JOIN s{i} s ON s.p = o.p AND s.e = o.e)""")
    return "WITH " + ",".join(steps) + """,
coded AS (SELECT r, string_agg(printf('%02x', k % 16), '' ORDER BY p) AS code, CAST(SUM(k // 16) AS BIGINT) AS error
          FROM a6 GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c6)
SELECT vec_id, code, error, CAST(SUM(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN coded USING (r), book"""


OP11 = _op11()

ORACLE_SQL = {"op1_chat_tree": OP1, "op4_nearest": OP4, "op6_substring": OP6, "op7_nn_descent": OP7,
              "op11_vector_codes": OP11, "op12_source_divergence": OP12}
