"""DuckDB statements that say what a query returns, where SQL can say it."""

from __future__ import annotations

from siltstone.llm import license_join, line_chunks, quality_rules, source_audit
from siltstone.llm.common import LOWER, UPPER

_RULES = quality_rules.Rules()
_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOW = f"translate(text, '{UPPER}', '{LOWER}')"

OP2 = rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT doc_id, lang, text, regexp_extract_all(text, {_WORDS}) AS ws, regexp_extract_all({_LOW}, {_WORDS}) AS low FROM d),
windows AS (SELECT doc_id, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
            FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 1)) AS i FROM w WHERE len(ws) >= 3)),
often AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM windows) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM often, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (SELECT doc_id, sum(n - 1) AS n FROM (SELECT doc_id, line, count(*) AS n FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY ALL) GROUP BY doc_id),
classes AS (SELECT doc_id, lang, unnest([
   {{'k': 'lower', 'n': length(text) - length(regexp_replace(text, '[a-z]', '', 'g'))}},
   {{'k': 'upper', 'n': length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))}},
   {{'k': 'digit', 'n': length(text) - length(regexp_replace(text, '[0-9]', '', 'g'))}},
   {{'k': 'space', 'n': length(text) - length(regexp_replace(text, '[ \t\x0b\x0c\r]', '', 'g'))}},
   {{'k': 'newline', 'n': length(text) - length(regexp_replace(text, '\n', '', 'g'))}},
   {{'k': 'symbol', 'n': length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g'))}},
   {{'k': 'other', 'n': length(text) - length(regexp_replace(text, '[^\x00-\x7F]', '', 'g'))}},
   {{'k': 'punctuation', 'n': length(regexp_replace(text, '[a-zA-Z0-9 \t\x0b\x0c\r\n#*$%&|<>]|[^\x00-\x7F]', '', 'g'))}}]) AS c FROM d),
tokens AS (SELECT doc_id, lang, unnest(low) AS word FROM w),
sums AS (SELECT lang, word, count(*) AS n FROM tokens GROUP BY ALL),
totals AS (SELECT lang, sum(n) AS total FROM sums GROUP BY lang),
common AS (SELECT lang, word, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS p FROM sums)
           WHERE p <= {_RULES.common_words} AND lang IN (SELECT lang FROM totals)),
ref_words AS (SELECT lang, word, n / total AS q FROM common JOIN totals USING (lang)
              UNION ALL SELECT lang, NULL, (total - sum(n)) / total FROM common JOIN totals USING (lang) GROUP BY lang, total),
found AS (SELECT t.doc_id, t.lang, c.word, count(*) AS n FROM tokens t LEFT JOIN common c ON t.lang = c.lang AND t.word = c.word GROUP BY ALL),
by_word AS (SELECT w.doc_id, r.word, r.q, coalesce(f.n, 0) / len(w.ws) AS p
            FROM w JOIN ref_words r ON w.lang = r.lang LEFT JOIN found f ON f.doc_id = w.doc_id AND f.word IS NOT DISTINCT FROM r.word
            WHERE len(w.ws) >= {_RULES.min_words}),
ref_classes AS (SELECT lang, c.k AS k, sum(c.n) / sum(sum(c.n)) OVER (PARTITION BY lang) AS q FROM classes
                WHERE lang IN (SELECT lang FROM totals) GROUP BY lang, c.k),
by_class AS (SELECT doc_id, r.q, c.n / length(text) AS p FROM classes JOIN d USING (doc_id, lang) JOIN ref_classes r ON r.lang = d.lang AND r.k = c.k
             WHERE length(text) >= {_RULES.min_chars}),
js AS (SELECT doc_id, kind, sqrt(greatest(0, sum(CASE WHEN p > 0 THEN p * log2(2 * p / (p + q)) ELSE 0 END
                                             + CASE WHEN q > 0 THEN q * log2(2 * q / (p + q)) ELSE 0 END) / 2)) AS x
       FROM (SELECT doc_id, 'w' AS kind, p, q FROM by_word UNION ALL SELECT doc_id, 'c', p, q FROM by_class) GROUP BY ALL),
base AS (SELECT w.doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
   (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
   coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
   a.x AS class_distance, b.x AS word_distance
   FROM w LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)
   LEFT JOIN js a ON a.doc_id = w.doc_id AND a.kind = 'c' LEFT JOIN js b ON b.doc_id = w.doc_id AND b.kind = 'w'),
failed AS (SELECT *, n_words < {_RULES.min_words} OR 100 * n_repeat_words > {_RULES.max_repeat_percent} * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
   NOT base_failed AND coalesce(class_distance, 0) <= {_RULES.max_class_distance} AND coalesce(word_distance, 0) <= {_RULES.max_word_distance} AS kept,
   round(class_distance, 6) AS class_distance, round(word_distance, 6) AS word_distance FROM failed
"""

OP5 = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, ls[i] AS line, i - 1 AS i, ('0x' || md5(ls[i])[1:8])::BIGINT AS h FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM d)),
b AS (SELECT *, i = 0 OR (lag(h, 2, 0) OVER w * {line_chunks.FACTOR} + lag(h, 1, 0) OVER w) % {line_chunks.DIVISOR} = 0 AS starts
      FROM l WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
n AS (SELECT *, sum(starts::INT) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM b),
chunks AS (SELECT doc_id, c, min(i) AS start, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS t,
           count(*) FILTER (WHERE regexp_matches(line, '[^\x20\x09-\x0D]')) >= 2 AS multi FROM n GROUP BY doc_id, c),
judged AS (SELECT *, multi AND row_number() OVER (PARTITION BY multi, t ORDER BY doc_id, start) > 1 AS gone FROM chunks)
SELECT doc_id, sum(n)::BIGINT AS n_lines, count(*)::BIGINT AS n_chunks, count(*) FILTER (WHERE gone)::BIGINT AS n_removed_chunks,
   coalesce(sum(n) FILTER (WHERE gone), 0)::BIGINT AS n_removed_lines,
   md5(coalesce(string_agg(t, chr(10) ORDER BY c) FILTER (WHERE NOT gone), '')) AS kept_md5
FROM judged GROUP BY doc_id
"""

_TEMPLATES = ", ".join(f"('{label}', {sorted(set(text.split()))}, {license_join.width(text)})" for label, text in license_join.TEMPLATES.items())
_GAPLESS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _phrases() -> str:
    each = []
    for phrase, label in license_join.PHRASES.items():
        parts = phrase.split()
        same = " AND ".join(f"ws[i + {k}] = '{p}'" for k, p in enumerate(parts))
        each.append(f"SELECT doc_id, '{label}' AS label, i - 1 AS place FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w) WHERE {same}")
    return " UNION ALL ".join(each)


OP6 = f"""
WITH d AS (SELECT doc_id, coalesce({_LOW}, '') AS text FROM documents),
w AS (SELECT doc_id, regexp_extract_all(text, {_GAPLESS}) AS ws FROM d),
base AS ({_phrases()}),
b AS (SELECT doc_id, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS labels FROM base GROUP BY doc_id),
templates(label, ts, width) AS (VALUES {_TEMPLATES}),
wanted AS (SELECT label, width, len(ts) AS tn, unnest(ts) AS word FROM templates),
own AS (SELECT w.doc_id, label, width, tn, i, word FROM (SELECT doc_id, ws[i] AS word, i FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)) w
        JOIN wanted USING (word)),
blocks AS (SELECT a.doc_id, a.label, a.tn, a.i, count(DISTINCT b.word) AS s FROM own a JOIN own b ON a.doc_id = b.doc_id AND a.label = b.label
           AND b.i BETWEEN a.i AND a.i + a.width - 1 GROUP BY ALL),
m AS (SELECT doc_id, label, s / tn AS score FROM blocks WHERE s >= ceil({license_join.CONTAINMENT} * tn - 1e-9)),
f AS (SELECT doc_id, list(DISTINCT label) AS labels, max(score) AS score FROM m GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
   array_to_string(list_sort(coalesce(b.labels, [])), ',') AS base_labels,
   array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ',') AS labels,
   coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)
"""

OP12 = rf"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
words AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY ALL HAVING count(DISTINCT row) >= {source_audit.MIN_DOCS}),
groups AS (SELECT DISTINCT lang, source FROM d),
vocabulary AS (SELECT g.lang, count(k.term) AS v FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN kept k USING (lang) GROUP BY g.lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, source, v + coalesce((SELECT sum(n) FROM counts c WHERE c.lang = groups.lang AND c.source = groups.source), 0) AS size
          FROM groups JOIN vocabulary USING (lang)),
p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, (1 + {source_audit.SCALE}::HUGEINT * (coalesce(c.n, 0) + 1) // s.size)::HUGEINT AS p,
      (1 + {source_audit.SCALE}::HUGEINT * (k.total + 1) // (sum(k.total) OVER (PARTITION BY s.lang, s.source) + v.v))::HUGEINT AS q
      FROM sizes s JOIN vocabulary v USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
apart AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT g.lang, g.source, 'pair' AS part, h.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM groups g JOIN groups h ON g.lang = h.lang AND g.source <> h.source
          LEFT JOIN apart a ON a.lang = g.lang AND a.source = g.source AND a.item = h.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {source_audit.TOP_TERMS}
"""

ORACLES = {"op2_divergence_rules": OP2, "op5_line_chunks": OP5, "op6_license_join": OP6, "op12_source_divergence": OP12}
