"""The same queries in SQL, where SQL can express them."""

from __future__ import annotations

QUALITY = r"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, list_slice(words, i, i + 4) AS w FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM base)),
starts AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) >= 2),
repeats AS (
  SELECT r, sum(least(5, i - before)) AS n
  FROM (SELECT r, i, coalesce(lag(i) OVER (PARTITION BY r ORDER BY i), i - 5) AS before FROM starts) GROUP BY r),
counted AS (
  SELECT base.r, doc_id, lang, source, len(words)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(repeats.n, 0)::BIGINT AS n_repeat_words
  FROM base LEFT JOIN repeats ON base.r = repeats.r),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counted),
measured AS (
  SELECT *, 1000 * n_symbols // greatest(n_words, 1) AS symbol_rate, 1000 * n_dup_lines // greatest(n_words, 1) AS dup_line_rate,
         1000 * n_repeat_words // greatest(n_words, 1) AS repeat_rate, 100 * word_chars // greatest(n_words, 1) AS word_length
  FROM judged),
long AS (
  SELECT lang, source, measure, v, length(bin(v)) - 6 AS s FROM (
    UNPIVOT (SELECT lang, source, symbol_rate, dup_line_rate, repeat_rate, word_length FROM measured WHERE NOT base_failed)
    ON symbol_rate, dup_line_rate, repeat_rate, word_length INTO NAME measure VALUE v)),
floored AS (SELECT lang, source, measure, CASE WHEN v < 64 THEN v ELSE (v >> s) << s END AS v FROM long),
spread(measure, least_spread) AS (VALUES ('symbol_rate', 25), ('dup_line_rate', 10), ('repeat_rate', 25), ('word_length', 50)),
by_group AS (
  SELECT *, greatest(q1, q2 - s) - 6 * s AS low, least(q3, q2 + s) + 6 * s AS high
  FROM (
    SELECT q.*, greatest(2 * least(q2 - q1, q3 - q2), least_spread) AS s
    FROM (
      SELECT lang, source, measure, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS q2, quantile_disc(v, 0.75) AS q3
      FROM floored GROUP BY ALL) q
    JOIN spread ON spread.measure = q.measure)),
by_lang AS (
  SELECT *, greatest(q1, q2 - s) - 6 * s AS low, least(q3, q2 + s) + 6 * s AS high
  FROM (
    SELECT q.*, greatest(2 * least(q2 - q1, q3 - q2), least_spread) AS s
    FROM (
      SELECT lang, measure, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS q2, quantile_disc(v, 0.75) AS q3
      FROM floored GROUP BY ALL) q
    JOIN spread ON spread.measure = q.measure)),
by_all AS (
  SELECT *, greatest(q1, q2 - s) - 6 * s AS low, least(q3, q2 + s) + 6 * s AS high
  FROM (
    SELECT q.*, greatest(2 * least(q2 - q1, q3 - q2), least_spread) AS s
    FROM (
      SELECT measure, count(*) AS n, quantile_disc(v, 0.25) AS q1, quantile_disc(v, 0.5) AS q2, quantile_disc(v, 0.75) AS q3
      FROM floored GROUP BY ALL) q
    JOIN spread ON spread.measure = q.measure)),
chosen AS (
  SELECT g.lang, g.source, a.measure, l.n AS lang_n, l.high AS lang_high, a.high AS all_high,
         CASE WHEN b.n >= 100 THEN b.low WHEN l.n >= 100 THEN l.low ELSE a.low END AS low,
         CASE WHEN b.n >= 100 THEN b.high WHEN l.n >= 100 THEN l.high ELSE a.high END AS high
  FROM (SELECT DISTINCT lang, source FROM documents) g CROSS JOIN by_all a
  LEFT JOIN by_lang l ON l.lang IS NOT DISTINCT FROM g.lang AND l.measure = a.measure
  LEFT JOIN by_group b ON b.lang IS NOT DISTINCT FROM g.lang AND b.source IS NOT DISTINCT FROM g.source AND b.measure = a.measure),
fences AS (
  SELECT lang, source, measure, low,
         CASE WHEN measure = 'word_length' THEN high ELSE least(high, CASE WHEN lang_n >= 100 THEN 4 * lang_high END, 4 * all_high) END AS high
  FROM chosen),
wide AS (
  SELECT lang, source, max(high) FILTER (measure = 'symbol_rate') AS symbols, max(high) FILTER (measure = 'dup_line_rate') AS dups,
         max(high) FILTER (measure = 'repeat_rate') AS repeated, max(high) FILTER (measure = 'word_length') AS longest,
         max(low) FILTER (measure = 'word_length') AS shortest
  FROM fences GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, failed_rule IS NULL AS kept, failed_rule
FROM (
  SELECT m.*, CASE WHEN base_failed THEN 'base' WHEN symbol_rate > symbols THEN 'symbol_rate' WHEN dup_line_rate > dups THEN 'dup_line_rate'
    WHEN repeat_rate > repeated THEN 'repeat_rate' WHEN word_length > longest OR word_length < shortest THEN 'word_length' END AS failed_rule
  FROM measured m LEFT JOIN wide w ON m.lang IS NOT DISTINCT FROM w.lang AND m.source IS NOT DISTINCT FROM w.source)
"""

CHAT = r"""
WITH said AS (
  SELECT conv_id, turn::BIGINT AS turn, CASE WHEN trim(coalesce(role, '')) = '' THEN 'unknown' ELSE lower(trim(role)) END AS name,
         coalesce(text, '') AS text
  FROM conversations),
people AS (SELECT DISTINCT conv_id, name AS perspective FROM said WHERE name <> 'system'),
shown AS (
  SELECT said.*, perspective, '<|' || CASE WHEN name = 'system' THEN name WHEN name = perspective THEN 'assistant' ELSE 'user:' || name END
         || '|>' || chr(10) AS head
  FROM said JOIN people ON said.conv_id IS NOT DISTINCT FROM people.conv_id),
placed AS (
  SELECT *, head || text || '<|end|>' || chr(10) AS rendered,
         row_number() OVER w - 1 AS position,
         coalesce(sum(length(head) + length(text) + 8) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM shown WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, name, text))
SELECT conv_id, perspective, turn, position,
       CASE WHEN name = 'system' THEN name WHEN name = perspective THEN 'assistant' ELSE 'user' END AS role, rendered, start,
       CASE WHEN name = perspective THEN start + length(head) ELSE start END AS mask_start,
       CASE WHEN name = perspective THEN start + length(head) + length(text) + 7 ELSE start END AS mask_end
FROM placed
"""

MERKLE = r"""
WITH RECURSIVE spelled AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce('=' || lang, '') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') AS head,
         coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
         coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more,
         coalesce(strlen(text) || ':' || text, '-') AS t,
         xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)),
           lambda c, d: list_reduce(list_prepend(xor(c, d), range(8)), lambda x, k: xor(x >> 1, 3988292384 * (x & 1))))) AS crc
  FROM documents),
hashed AS (
  SELECT r, doc_id, tree, sha256(head || n || t) AS leaf, CASE WHEN doc_id IS NOT NULL AND crc % 7 = 0 THEN sha256(head || more || t) END AS changed FROM spelled),
leaves AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS i FROM hashed),
nodes(tree, level, i, h) AS (
  SELECT tree, 0, i, leaf FROM leaves
  UNION ALL
  SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes) WHERE n > 1 GROUP BY tree, level, i // 2),
subroots AS (
  SELECT tree, level, h, row_number() OVER (ORDER BY tree) - 1 AS i
  FROM (SELECT * FROM nodes QUALIFY level = max(level) OVER (PARTITION BY tree))),
tops(level, i, h) AS (
  SELECT 0, i, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
  FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, i // 2),
root AS (SELECT level, h FROM tops QUALIFY level = max(level) OVER ()),
paths(r, tree, level, i, h, beside) AS (
  SELECT r, tree, 0, i, coalesce(changed, leaf), '' FROM leaves
  UNION ALL
  SELECT p.r, p.tree, p.level + 1, p.i // 2,
         sha256(CASE WHEN s.h IS NULL THEN p.h WHEN p.i % 2 = 1 THEN s.h || p.h ELSE p.h || s.h END), p.beside || coalesce(s.h, '')
  FROM paths p JOIN subroots d ON p.tree = d.tree
  LEFT JOIN nodes s ON s.tree = p.tree AND s.level = p.level AND s.i = xor(p.i, 1)
  WHERE p.level < d.level),
climbs(r, level, i, h, beside) AS (
  SELECT p.r, 0, d.i, p.h, p.beside FROM paths p JOIN subroots d ON p.tree = d.tree AND p.level = d.level
  UNION ALL
  SELECT c.r, c.level + 1, c.i // 2,
         sha256(CASE WHEN s.h IS NULL THEN c.h WHEN c.i % 2 = 1 THEN s.h || c.h ELSE c.h || s.h END), c.beside || coalesce(s.h, '')
  FROM climbs c JOIN root ON true LEFT JOIN tops s ON s.level = c.level AND s.i = xor(c.i, 1)
  WHERE c.level < root.level)
SELECT l.doc_id, l.leaf, d.h AS subroot, root.h AS root, sha256(c.beside) AS proof_sha256, c.h AS folded_root, c.h = root.h AS verified
FROM leaves l JOIN subroots d ON l.tree = d.tree JOIN root ON true JOIN climbs c ON c.r = l.r AND c.level = root.level
"""


def _clusters(rounds: int = 3) -> str:
    """Every round spelled out: the nearest centroid of each vector, then the floor of the means."""

    def nearest(round_: int) -> str:
        return f"""near{round_} AS (
  SELECT r, vec_id, v, min(struct_pack(d := d, k := k)) AS best FROM (
    SELECT r, vec_id, kept.v, k, list_sum(list_transform(list_zip(kept.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
    FROM kept JOIN c{round_} c ON true)
  GROUP BY r, vec_id, v)"""

    def means(round_: int) -> str:
        return f"""part{round_} AS (SELECT best.k AS k, unnest(v) AS x, unnest(range(64)) AS j FROM near{round_ - 1}),
mean{round_} AS (
  SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY j) AS v
  FROM (SELECT k, j, sum(x)::HUGEINT AS s, count(*) AS n FROM part{round_} GROUP BY k, j) GROUP BY k),
c{round_} AS (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{round_ - 1} c LEFT JOIN mean{round_} m ON m.k = c.k)"""

    steps = [nearest(0)]
    for round_ in range(1, rounds + 1):
        steps += [means(round_), nearest(round_)]
    return (
        """WITH kept AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || coalesce(vec_id::VARCHAR, '')), v, r) - 1 AS k, v FROM kept QUALIFY k < 16),
"""
        + ",\n".join(steps)
        + f"""
SELECT vec_id, best.k::INTEGER AS cluster, best.d AS distance, (sum(best.d) OVER (PARTITION BY best.k))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{rounds} n JOIN c{rounds} c ON c.k = best.k
"""
    )


ORACLE: dict[str, str] = {
    "op2_chat_formatting": CHAT,
    "op9_quality_rules": QUALITY,
    "op12_merkle_manifest": MERKLE,
    "op13_centroid_clustering": _clusters(),
}
