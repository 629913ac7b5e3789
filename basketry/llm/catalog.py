"""The queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from basketry.llm.balance import op10_sharding
from basketry.llm.block_search import op7_block_search
from basketry.llm.license_scan import DENSITY, GRAM, PHRASES, SHARE, SLACK, TEMPLATES, op11_license_scan
from basketry.llm.line_crf import op9_quality
from basketry.llm.lm_scores import op3_lm_scores
from basketry.llm.mixing import op6_mixing
from basketry.llm.nn_descent import op5_neighbours
from basketry.llm.periodic_runs import op13_periodic_runs
from basketry.llm.sentence_pieces import op4_sentence_pieces
from basketry.llm.simhash import op2_simhash
from basketry.llm.source_divergence import op12_source_divergence
from basketry.llm.token_counts import op8_token_counts
from basketry.llm.token_files import op1_token_files



def license_sql() -> str:
    """The license scan with its phrases and templates as tables; grams are compared as texts, not as hashes."""
    words = lambda text: (
        f"list_filter(regexp_split_to_array(translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
        r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    )
    quoted = lambda x: "'" + x.replace("'", "''") + "'"
    phrases = ", ".join(f"({quoted(label)}, {quoted(p)})" for label, p in PHRASES.items())
    texts = [(label, t) for label, held in TEMPLATES.items() for t in held]
    templates = ", ".join(f"({i}, {quoted(label)}, {quoted(t)})" for i, (label, t) in enumerate(texts))
    longest = max(GRAM, *(len(p.split()) for p in PHRASES.values()))
    leads = ", ".join(f"lead(w0, {i}) OVER o AS w{i}" for i in range(1, longest))
    follow = " AND ".join(f"(len(a) <= {i} OR w{i} = a[{i + 1}])" for i in range(1, longest))
    run = " || ' ' || ".join(f"w{i}" for i in range(GRAM))
    joined = lambda labels: f"coalesce(array_to_string(list_sort(list_distinct({labels})), ','), '')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("coalesce(text, '')")} AS w FROM documents),
word AS (SELECT r, unnest(range(len(w))) AS pos, unnest(w) AS w0 FROM d),
place AS (SELECT *, {leads} FROM word WINDOW o AS (PARTITION BY r ORDER BY pos)),
phrase AS (SELECT label, string_split(phrase, ' ') AS a FROM (VALUES {phrases}) AS t(label, phrase)),
base AS (SELECT r, count(*) AS n_base, min(pos) AS first_word, max(pos) AS last_word, list(label) AS labels
         FROM place JOIN phrase ON w0 = a[1] AND {follow} GROUP BY r),
template AS (SELECT template, label, {words("text")} AS w FROM (VALUES {templates}) AS t(template, label, text)),
gram AS (SELECT template, label, size, tpos, array_to_string(w[tpos + 1:tpos + {GRAM}], ' ') AS gram
         FROM (SELECT template, label, w, len(w) AS size, unnest(range(len(w) - {GRAM} + 1)) AS tpos FROM template)),
hit AS (SELECT r, template, label, size, pos, tpos, pos - tpos AS diagonal
        FROM (SELECT r, pos, {run} AS gram FROM place) JOIN gram USING (gram)),
step AS (SELECT r, template, diagonal, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal) > {SLACK}, false) AS apart
         FROM (SELECT DISTINCT r, template, diagonal FROM hit)),
island AS (SELECT r, template, diagonal, sum(CAST(apart AS INT)) OVER (PARTITION BY r, template ORDER BY diagonal) AS island FROM step),
covered AS (SELECT r, template, island, label, size, pos + i AS pos, tpos + i AS tpos
            FROM hit JOIN island USING (r, template, diagonal) CROSS JOIN range({GRAM}) AS x(i)),
span AS (SELECT r, label, count(DISTINCT tpos) / size AS share FROM covered GROUP BY r, template, island, label, size
         HAVING count(DISTINCT pos) >= (max(pos) + 1 - min(pos)) * {DENSITY}),
found AS (SELECT r, max(share) AS share, list(label) FILTER (share >= {SHARE}) AS labels FROM span GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       {joined("base.labels")} AS base_labels, {joined("list_concat(base.labels, found.labels)")} AS labels,
       CAST(CASE WHEN n_base > 0 THEN 1 ELSE coalesce(share, 0) END AS DOUBLE) AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN found USING (r)"""


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_simhash": op2_simhash,
    "op3_lm_scores": op3_lm_scores,
    "op4_sentence_pieces": op4_sentence_pieces,
    "op5_neighbours": op5_neighbours,
    "op6_mixing": op6_mixing,
    "op7_block_search": op7_block_search,
    "op8_token_counts": op8_token_counts,
    "op9_quality": op9_quality,
    "op10_sharding": op10_sharding,
    "op11_license_scan": op11_license_scan,
    "op12_source_divergence": op12_source_divergence,
    "op13_periodic_runs": op13_periodic_runs,
}
ORACLE = {
    "op11_license_scan": license_sql(),
    "op12_source_divergence": """
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(any_value(v.v), 0) AS v, coalesce(sum(c.n), 0) AS n
      FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN v USING (lang) GROUP BY ALL),
p AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n, kept.n AS ln,
      1 + CAST(1000000000 * (coalesce(c.n, 0) + 1)::HUGEINT // (g.n + g.v)::HUGEINT AS BIGINT) AS p
      FROM g JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p)::HUGEINT * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(pairs.value, 0) AS BIGINT) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source),
t AS (SELECT p.*, 1 + CAST(1000000000 * (p.ln + 1)::HUGEINT // (v.n + v.v)::HUGEINT AS BIGINT) AS q FROM p JOIN v USING (lang) WHERE p.n > 0),
own AS (SELECT lang, source, 'term' AS part, term AS item, CAST((p - q)::HUGEINT * (p - q) // q AS BIGINT) AS value FROM t WHERE p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM (SELECT * FROM every UNION ALL SELECT * FROM own)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 200""",
    "op7_block_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM p QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10""",
}
