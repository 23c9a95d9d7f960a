"""DuckDB SQL for the queries that SQL can express."""

from topicpulse.llm.quality import LIMITS, MAX_REPEATED, MIN_WORDS, WINDOW

_SHORT, _LONG = LIMITS["word_chars"]

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, [x FOR x IN regexp_split_to_array(t, '[\x09-\x0D\x20]+') IF x <> ''] AS w FROM d),
p AS (SELECT r, unnest(generate_series(1, len(w) - {WINDOW - 1})) AS i FROM w WHERE len(w) >= {WINDOW}),
g AS (SELECT p.r, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS g FROM p JOIN w USING (r)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words FROM (
          SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r),
l AS (SELECT r, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x09-\x0D\x20]')] AS l FROM d),
m AS (SELECT d.r, doc_id, t, w, l, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
             coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
      FROM d JOIN w USING (r) JOIN l USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR n_symbols > {LIMITS['symbols']} * n_words
            OR word_chars < {_SHORT} * n_words OR word_chars > {_LONG} * n_words
            OR n_dup_lines > {LIMITS['lines']} * len(l)
            OR len(regexp_extract_all(t, '!')) > {LIMITS['exclamations']} * n_words
            OR len(regexp_extract_all(t, '\p{{Lu}}')) > {LIMITS['capitals']} * word_chars
            OR len([i FOR i IN generate_series(2, len(w)) IF w[i] = w[i - 1]]) > {LIMITS['stutter']} * n_words) AS kept
FROM b
"""

ORACLE = {"op4_quality_rules": QUALITY}

EXACT = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
g AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, coalesce(n.doc_id = g.keep_id, false) AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
ORACLE["op12_exact_dedup"] = EXACT
