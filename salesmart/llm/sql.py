"""DuckDB twins of the queries that SQL can express."""

from __future__ import annotations

from salesmart.llm import quality_rules, shard_table

BENCHMARK_CONTAINMENT = r"""
WITH body AS (
  SELECT 'd' AS kind, doc_id AS id, md5(lower(coalesce(text, ''))) AS body,
         list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents UNION
  SELECT 'b', item_id, md5(lower(coalesce(text, ''))),
         list_filter(string_split_regex(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '')
  FROM benchmark
), word AS (
  SELECT kind, id, body, len(w) AS n, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM body
), five AS (
  SELECT kind, id, body, i, n, [v, lead(v, 1) OVER t, lead(v, 2) OVER t, lead(v, 3) OVER t, lead(v, 4) OVER t] AS five
  FROM word WINDOW t AS (PARTITION BY kind, id, body ORDER BY i)
), size AS (
  SELECT DISTINCT least(n, 5) AS k FROM word WHERE kind = 'b'
), s AS (
  SELECT DISTINCT kind, id, body, array_to_string(five[1:k], ' ') AS s
  FROM five JOIN size ON i <= n - k + 1 AND (kind = 'd' OR k = least(n, 5))
), ds AS (
  SELECT id AS doc_id, body, s FROM s WHERE kind = 'd'
), bs AS (
  SELECT id AS item_id, body AS item, s FROM s WHERE kind = 'b'
), n AS (
  SELECT item, count(DISTINCT s) AS n_shingles FROM bs GROUP BY ALL
), hit AS (
  SELECT doc_id, body, item_id, item, count(*) AS shared FROM ds JOIN bs USING (s) GROUP BY ALL
)
SELECT DISTINCT doc_id, item_id, shared, n_shingles FROM hit JOIN n USING (item)
WHERE shared >= ceil(0.8 * n_shingles)
"""



SHARD_TABLE = r"""
WITH RECURSIVE shard AS (
  SELECT s, ('0x' || substr(md5('offset:shard-' || lpad(s::VARCHAR, 3, '0')), 1, 15))::BIGINT % {slots} AS first,
         ('0x' || substr(md5('skip:shard-' || lpad(s::VARCHAR, 3, '0')), 1, 15))::BIGINT % ({slots} - 1) + 1 AS skip
  FROM range({shards}) t(s)
), wish AS (
  SELECT s, list((first + k * skip) % {slots} ORDER BY k) AS wishes FROM shard, range({slots}) t(k) GROUP BY s
), fill AS (
  SELECT 0 AS turn, -1::BIGINT AS slot, list_transform(range({slots}), lambda x: false) AS taken
  UNION ALL
  SELECT turn + 1, pick, list_concat(taken[1:pick], [true], taken[pick + 2:])
  FROM (SELECT turn, taken, list_filter(wishes, lambda x: NOT taken[x + 1])[1] AS pick
        FROM fill JOIN wish ON s = turn % {shards} WHERE turn < {slots})
), owner AS (
  SELECT slot, ((turn - 1) % {shards})::INTEGER AS shard FROM fill WHERE turn > 0
)
SELECT doc_id, slot, shard, 'shard-' || lpad(shard::VARCHAR, 3, '0') AS shard_name
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {slots} AS slot FROM documents)
JOIN owner USING (slot)
"""

CHAT_SNAPSHOTS = r"""
WITH said AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL
), log AS (
  SELECT conv_id, list(role || chr(1) || text ORDER BY turn, md5(role || chr(0) || text)) AS turns FROM said GROUP BY conv_id
), once AS (
  SELECT turns, min(conv_id) AS conv_id FROM log GROUP BY turns
), kept AS (
  SELECT conv_id, len(turns) AS n_turns FROM once o WHERE NOT EXISTS (
    SELECT 1 FROM once l WHERE l.turns[1] = o.turns[1] AND len(l.turns) > len(o.turns)
      AND l.turns[1:len(o.turns)] = o.turns)
)
SELECT conv_id, floor(turn / 512)::BIGINT AS part, max(n_turns) AS n_turns,
       string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn, md5(role || chr(0) || text)) AS text
FROM said JOIN kept USING (conv_id) GROUP BY ALL
"""


def quality_rules_sql(alpha: float = 0.05, delta: float = 0.05) -> str:
    """Counts by windows over word rows; cutoffs by the binomial sum, written out with lgamma."""
    rules = ", ".join(f"('{r.name}', {r.sign}, {i}, {c}::DOUBLE)" for r in quality_rules.RULES for i, c in enumerate(r.cutoffs))
    ratios = " UNION ALL ".join(
        f"SELECT r, '{x.name}' AS rule, {x.numerator}::DOUBLE / nullif({x.denominator}, 0) AS ratio FROM counted"
        for x in quality_rules.RULES)
    n = len(quality_rules.RULES)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
), word AS (
  SELECT r, len(w) AS n, unnest(w) AS v, generate_subscripts(w, 1) AS i FROM split
), eight AS (
  SELECT *, lag(v) OVER t AS before, CASE WHEN i <= n - 7 THEN md5(concat_ws(' ', v, lead(v, 1) OVER t, lead(v, 2) OVER t,
         lead(v, 3) OVER t, lead(v, 4) OVER t, lead(v, 5) OVER t, lead(v, 6) OVER t, lead(v, 7) OVER t)) END AS s
  FROM word WINDOW t AS (PARTITION BY r ORDER BY i)
), often AS (
  SELECT *, s IS NOT NULL AND count(*) OVER (PARTITION BY r, s) > 1 AS twice FROM eight
), covered AS (
  SELECT r, v, before, max(twice) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN 7 PRECEDING AND CURRENT ROW) AS again FROM often
), per_text AS (
  SELECT r, count(*) FILTER (WHERE again) AS n_repeat_words, count(*) FILTER (WHERE v = before) AS n_same_words FROM covered GROUP BY r
), counted AS (
  SELECT r, doc_id, lang, text, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: len(x))), 0)::BIGINT AS word_chars,
         len(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines,
         len(regexp_replace(text, '[^A-ZÀ-ÖØ-Þ]', '', 'g'))::BIGINT AS n_upper, coalesce(n_same_words, 0)::BIGINT AS n_same_words
  FROM split LEFT JOIN per_text USING (r)
), based AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM counted
), ratios AS ({ratios}
), rules(rule, sign, step, cutoff) AS (VALUES {rules}
), good AS (
  SELECT min(r) AS r, lang FROM based WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) GROUP BY lang, text
), strata AS (
  SELECT lang, count(*) AS n FROM good GROUP BY lang
), tally AS (
  SELECT g.lang, rule, sign, step, cutoff, any_value(n) AS n,
         count(*) FILTER (WHERE CASE WHEN sign > 0 THEN ratio > cutoff ELSE ratio < cutoff END) AS k
  FROM good g JOIN strata s ON g.lang IS NOT DISTINCT FROM s.lang JOIN ratios USING (r) JOIN rules USING (rule)
  GROUP BY g.lang, rule, sign, step, cutoff
), tested AS (
  SELECT lang, rule, sign, step, cutoff, CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(0, k + 1), lambda i:
         exp(lgamma(n + 1) - (CASE WHEN i = 0 THEN 0 ELSE lgamma(i + 1) END) - lgamma(n - i + 1) + i * ln({alpha / n}) + (n - i) * ln(1 - {alpha / n})))) END
         <= {delta}::DOUBLE / ({n} * (SELECT count(*) FROM strata)) AS passes
  FROM tally
), chosen AS (
  SELECT lang, rule, arg_max(cutoff, step) AS cutoff, any_value(sign) AS sign FROM (
    SELECT *, min(passes) OVER (PARTITION BY lang, rule ORDER BY step) AS open FROM tested) WHERE open GROUP BY lang, rule
), judged AS (
  SELECT b.r, bool_or(CASE WHEN sign > 0 THEN ratio > cutoff ELSE ratio < cutoff END) AS rejected
  FROM based b JOIN ratios USING (r) JOIN chosen c USING (rule) WHERE b.lang IS NOT DISTINCT FROM c.lang GROUP BY b.r
)
SELECT doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper, n_same_words, base_failed,
       NOT base_failed AND NOT coalesce(rejected, false) AS kept
FROM based LEFT JOIN judged USING (r)
"""


def llm_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules_sql(),
            "op3_chat_snapshots": CHAT_SNAPSHOTS,
            "op6_shard_table": SHARD_TABLE.format(shards=shard_table.SHARDS, slots=shard_table.SLOTS),
            "op10_benchmark_containment": BENCHMARK_CONTAINMENT}
