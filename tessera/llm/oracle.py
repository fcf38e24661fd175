"""DuckDB SQL of the numbered queries that SQL can express, over the raw tables."""

from __future__ import annotations

_SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_FOLDED = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

SUBSTRING = f"""
WITH d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
firsts AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY s) AS f FROM windows),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM firsts WHERE f < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS t
         FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

DECONTAMINATION = f"""
WITH d AS (SELECT doc_id, {_FOLDED} AS w FROM documents),
b AS (SELECT item_id, {_FOLDED} AS w FROM benchmark),
wins AS (SELECT DISTINCT item_id, least(len(w), 13) AS m, array_to_string(w[i:i + 12], ' ') AS s
         FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM wins),
places AS (SELECT doc_id, m, i, array_to_string(w[i:i + m - 1], ' ') AS s
           FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, lengths WHERE len(w) >= m)),
hits AS (SELECT doc_id, i, m, item_id FROM places JOIN wins USING (m, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(k, ',' ORDER BY k) AS t
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS k FROM hits) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(t, '')) AS items_sha256, coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def _later_copies(length: int) -> str:
    """Characters inside later copies of runs of ``length`` words, by document."""
    run = ", ".join(f"w{k}" for k in range(length))
    return f"""
r{length} AS (SELECT doc_id, sum(length(w0)) AS c FROM runs SEMI JOIN (
    SELECT DISTINCT doc_id, unnest(range(p, p + {length})) AS p FROM (
        SELECT doc_id, p, row_number() OVER (PARTITION BY doc_id, {run} ORDER BY p) AS k
        FROM runs WHERE w{length - 1} IS NOT NULL)
    WHERE k > 1) USING (doc_id, p) GROUP BY doc_id)"""


_LIMITS = {5: "0.3", 6: "0.29", 7: "0.28", 8: "0.27", 9: "0.26", 10: "0.25"}

QUALITY_RULES = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, {_SPACED} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
chars AS (SELECT doc_id, sum(length(word)) AS c FROM words GROUP BY doc_id),
lines AS (SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line) AS k,
                 length(regexp_replace(line, '[\\x20\\x09-\\x0D]', '', 'g')) AS c
          FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
          WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
line_counts AS (SELECT doc_id, count(*) AS n, count(*) FILTER (k > 1) AS dup, coalesce(sum(c) FILTER (k > 1), 0) AS dup_c
                FROM lines GROUP BY doc_id),
runs AS (SELECT doc_id, p, word AS w0, {', '.join(f'lead(word, {k}) OVER o AS w{k}' for k in range(1, 10))}
         FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
triples AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, w0, w1, w2) AS n FROM runs WHERE w2 IS NOT NULL),
repeated AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM triples WHERE n > 1)
             GROUP BY doc_id),{','.join(map(_later_copies, _LIMITS))},
facts AS (SELECT d.doc_id, len(w) AS n_words, coalesce(chars.c, 0)::BIGINT AS word_chars,
                 length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup, 0) AS n_dup_lines,
                 coalesce(repeated.n, 0) AS n_repeat_words, coalesce(dup_c, 0)::BIGINT AS dup_line_chars,
                 coalesce(line_counts.n, 0) AS n_lines, greatest(coalesce(chars.c, 0), 1)::BIGINT AS total,
                 {', '.join(f'coalesce(r{n}.c, 0)::BIGINT AS c{n}' for n in _LIMITS)}
          FROM d LEFT JOIN chars USING (doc_id) LEFT JOIN line_counts USING (doc_id) LEFT JOIN repeated USING (doc_id)
          {' '.join(f'LEFT JOIN r{n} USING (doc_id)' for n in _LIMITS)}),
verdicts AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
                    {' OR '.join(f'c{n}::DOUBLE / total > {limit}::DOUBLE' for n, limit in _LIMITS.items())} AS over,
                    n_dup_lines > 0.5 * greatest(n_lines, 1) OR dup_line_chars::DOUBLE / total > 0.3::DOUBLE AS lines_bad,
                    greatest({', '.join(f'c{n}::DOUBLE / total' for n in _LIMITS)}) AS max_run_share FROM facts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR over OR lines_bad) AS kept, dup_line_chars, max_run_share,
       CASE WHEN base_failed THEN 'base' WHEN over THEN 'runs' WHEN lines_bad THEN 'lines' ELSE '' END AS reason
FROM verdicts
"""

HARD_NEGATIVES = """
WITH r AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END::BIGINT AS label,
                  list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
           FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scores AS (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same,
                  list_sum(list_transform(list_zip(a.v, c.v), lambda z: z[1] * z[2]))::BIGINT AS score
           FROM (SELECT DISTINCT * FROM r WHERE vec_id % 100 = 0) a JOIN r c ON a.vec_id <> c.vec_id),
positives AS (SELECT anchor_id, id, score FROM scores WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, row_number() OVER o AS rank, n.id AS negative_id, p.score AS positive_score,
       n.score AS negative_score
FROM positives p JOIN scores n ON n.anchor_id = p.anchor_id AND NOT n.same
     AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
WINDOW o AS (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id)
QUALIFY rank <= 5
"""

RANKED_SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_FOLDED} AS w FROM documents WHERE text IS NOT NULL),
full_docs AS (SELECT * FROM d WHERE len(w) > 0),
facts AS (SELECT count(*) AS n, sum(len(w))::BIGINT AS l FROM full_docs),
asked AS (SELECT row_number() OVER () AS q, item_id, {_FOLDED} AS w FROM benchmark WHERE text IS NOT NULL),
asked_terms AS (SELECT DISTINCT q, item_id, unnest(w) AS t FROM asked),
held AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS t FROM full_docs),
times AS (SELECT r, doc_id, n, t, count(*) AS tf FROM held SEMI JOIN asked_terms USING (t) GROUP BY ALL),
weights AS (SELECT t, floor(1000 * ln((2 * facts.n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
            FROM times, facts GROUP BY t, facts.n),
parts AS (SELECT r, doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * times.n * facts.n) // facts.l)))
                 AS part FROM times JOIN weights USING (t), facts),
scores AS (SELECT q, item_id, r, doc_id, sum(part)::BIGINT AS score FROM parts JOIN asked_terms USING (t) GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id) AS rank, doc_id, score FROM scores
WHERE score > 0 QUALIFY rank <= 10
"""

ORACLE: dict[str, str] = {"op5_substring_dedup": SUBSTRING, "op7_benchmark_decontamination": DECONTAMINATION,
                          "op9_quality_rules": QUALITY_RULES, "op11_strassen_hard_negatives": HARD_NEGATIVES,
                          "op13_shared_ranked_search": RANKED_SEARCH}
