"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from promptframe.llm import licenses

BLANK = r"chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LINES = "string_split(coalesce(text, ''), chr(10))"

OP10 = f"""
WITH split AS (
  SELECT doc_id, unnest({LINES}) AS line, generate_subscripts({LINES}, 1) AS pos FROM documents
), keyed AS (
  SELECT doc_id, line, pos,
         translate(trim(line, {BLANK}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM split
), repeated AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10
  GROUP BY key HAVING count(DISTINCT doc_id) >= 2
), marked AS (
  SELECT k.doc_id, k.line, k.pos, r.key IS NOT NULL AND k.doc_id <> r.keeper AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP2 = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_cosine_similarity(q.v, c.v) AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

OP3 = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(concat(coalesce(doc_id::VARCHAR, ''), '|', concat_ws('|', source, text))), 1, 15))::BIGINT AS hash
  FROM documents
), sums AS (
  SELECT source, sum(size)::HUGEINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::HUGEINT AS weight FROM sums
), running AS (
  SELECT *, sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
         coalesce(sum(3 * source_size) OVER before, 0) AS caps_before, coalesce(sum(weight) OVER before, 0) AS weight_before
  FROM ranked WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), capped AS (
  SELECT *, 3 * source_size * (weights - weight_before) < weight * (total - caps_before) AS is_capped FROM running
), level AS (
  SELECT any_value(total) - coalesce(sum(3 * source_size) FILTER (is_capped), 0) AS rest,
         sum(weight) FILTER (NOT is_capped) AS shares FROM capped
), targets AS (
  SELECT source, source_size,
         CASE WHEN is_capped THEN 3.0::DOUBLE * source_size::DOUBLE ELSE (weight * rest)::DOUBLE / shares::DOUBLE END AS target
  FROM capped, level
), planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size::DOUBLE) ELSE 0 END AS repeats FROM targets
), placed AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.repeats, p.target - p.repeats * p.source_size::DOUBLE AS need,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS own,
         count(*) OVER (PARTITION BY s.source, s.hash) AS alike,
         row_number() OVER (PARTITION BY s.source, s.hash) AS place
  FROM sized s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (size * (repeats + CASE WHEN upto <= need OR (upto - own <= need AND place <= ceil((need - (upto - own)) * alike / own - 0.5)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

OP13 = r"""
WITH docs AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), firsts AS (
  SELECT t, min(doc_id) AS first FROM docs GROUP BY t
), marks AS (
  SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
), masked AS (
  SELECT d.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (len(d.words) < 200)::INT + 2 * (100 * len(list_distinct(d.words)) < 50 * len(d.words))::INT
         + 4 * (100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 2 * length(d.t))::INT
         + 8 * regexp_matches(d.t, '[#$%&*|]')::INT
         + 16 * (f.first IS NOT NULL AND (d.doc_id IS NULL OR d.doc_id > f.first))::INT AS mask
  FROM docs d JOIN firsts f ON d.t = f.t LEFT JOIN marks m ON d.doc_id = m.doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM masked GROUP BY part, mask
), filters AS (
  SELECT i, substr('ABCDE', i + 1, 1) AS letter, 1 << i AS bit FROM range(5) r(i)
), orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
         [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM filters a, filters b, filters c, filters d, filters e
  WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
), steps AS (
  SELECT filter_order, step, bits[step] AS bit, list_sum(list_append(bits[1:step - 1], 0))::INT AS before
  FROM orders, range(1, 6) s(step)
), done AS (
  SELECT c.part, s.filter_order, s.step::INT AS step, s.bit,
         sum(CASE WHEN c.mask & (s.before | s.bit) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.bit <> 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN c.mask & s.before <> 0 AND c.mask & s.bit <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN c.mask = s.bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.bit <> 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN c.mask & s.before = 0 AND c.mask & s.bit <> 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM counts c, steps s GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM done
"""


def _op12() -> str:
    rows = [*licenses.PHRASES, *licenses.default_rules()]
    quoted = lambda text: "'" + text.replace("'", "''") + "'"
    values = ",\n".join(f"({quoted(r.keyword)}, {quoted(r.label)}, {quoted(r.pattern)}, {r.priority}, {r.weight}::DOUBLE)" for r in rows)
    return rf"""
WITH rules(keyword, label, pattern, priority, weight) AS (VALUES {values}
), docs AS (
  SELECT row_number() OVER () AS k, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), words AS (
  SELECT k, words, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM docs
), places AS (
  SELECT DISTINCT w.k, w.i, w.word,
         array_to_string(list_concat(words[greatest(i - 24, 1):i - 1], ['<' || word || '>'], words[i + 1:i + 24]), ' ') AS win
  FROM words w SEMI JOIN rules r ON w.word = r.keyword
), hits AS (
  SELECT p.k, p.i, r.label, r.priority, r.weight, regexp_extract(win, '(?:^| )(' || pattern || ')(?: |$)', 1) AS hit
  FROM places p JOIN rules r ON p.word = r.keyword
), found AS (
  SELECT k, i - 1 - (len(string_split(string_split(hit, '<')[1], ' ')) - 1) AS a, len(string_split(hit, ' ')) AS size,
         label, priority, max(weight) AS weight
  FROM hits WHERE hit <> '' GROUP BY ALL
), kept AS (
  SELECT * FROM found f WHERE priority = 0 OR NOT EXISTS (
    SELECT 1 FROM found o WHERE o.k = f.k AND o.priority <= f.priority AND o.a <= f.a AND o.a + o.size >= f.a + f.size
      AND (o.a, -o.size, o.priority, o.label) < (f.a, -f.size, f.priority, f.label))
), by_label AS (
  SELECT k, label, max(weight) AS weight, count(*) FILTER (priority = 0) AS n,
         min(a) FILTER (priority = 0) AS first, max(a) FILTER (priority = 0) AS last
  FROM kept GROUP BY k, label
), by_doc AS (
  SELECT k, sum(n)::BIGINT AS n_base, min(first) AS first_word, max(last) AS last_word,
         string_agg(label, ',' ORDER BY label) FILTER (n > 0) AS base_labels, string_agg(label, ',' ORDER BY label) AS labels,
         1 - list_reduce(list_prepend(1.0::DOUBLE, list_transform(list_sort(list(weight)), lambda w: 1 - w)), lambda x, y: x * y) AS score
  FROM by_label GROUP BY k
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM docs d LEFT JOIN by_doc b ON d.k = b.k
"""


ORACLES = {
    "op2_block_neighbours": OP2,
    "op3_source_mix": OP3,
    "op10_line_dedup": OP10,
    "op12_signature_rules": _op12(),
    "op13_filter_audit": OP13,
}
