"""DuckDB SQL for the queries that SQL can express, over the whole tables."""

from __future__ import annotations

from levelscope.llm.license_rules import rules

#: Words that end at white space, of ``documents``.
SPACED = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
ALNUM = rf"regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH doc AS (SELECT doc_id, {ALNUM} AS w FROM documents),
item AS (SELECT item_id, {ALNUM} AS w FROM benchmark),
passage AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT item_id, w, least(10, len(w)) AS n, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT n FROM passage),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc, lengths WHERE len(w) >= n)),
hit AS (
  SELECT DISTINCT p.doc_id, p.n, p.i, q.item_id FROM place p JOIN passage q USING (n, words)),
covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM (SELECT DISTINCT doc_id, n, i FROM hit))
  GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
  coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

SUBSTRINGS = f"""
WITH doc AS (SELECT doc_id, {SPACED} AS w FROM documents),
place AS (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM doc)),
first AS (SELECT h, min(doc_id) AS owner FROM place GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, k FROM (
    SELECT doc_id, unnest(range(i, i + 50)) AS k FROM place JOIN first USING (h) WHERE doc_id > owner)),
word AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM doc),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY k) AS text, count(*) AS n
  FROM word ANTI JOIN gone USING (doc_id, k) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM doc LEFT JOIN kept USING (doc_id)
"""

#: A text's lines with a word, normalised.
LINES = r"""
line AS (
  SELECT doc_id, host, k, k_line, lower(regexp_replace(trim(regexp_replace(k_line, '[ \t-\r]+', ' ', 'g')), '[0-9]', '0', 'g')) AS line
  FROM (SELECT doc_id, coalesce(source, '') AS host, unnest(string_split(coalesce(text, ''), chr(10))) AS k_line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS k FROM documents)
  WHERE regexp_matches(k_line, '[^ \t-\r]'))"""

QUALITY = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text, md5(coalesce(text, '')) AS body,
         {SPACED} AS w FROM documents),
{LINES},
host AS (SELECT host, count(DISTINCT body) AS docs FROM doc GROUP BY host),
held AS (
  SELECT host, line, count(DISTINCT body) AS n, min(doc_id) AS first
  FROM line JOIN doc USING (doc_id, host) GROUP BY host, line),
frequent AS (
  SELECT host, line, first FROM held JOIN host USING (host) WHERE n > 20 AND n > 0.005 * docs),
judged AS (
  SELECT doc_id, line.line, k_line, frequent.line IS NOT NULL AS lost,
         len({SPACED.replace("coalesce(text, '')", "k_line")}) AS words
  FROM line LEFT JOIN frequent
    ON frequent.host = line.host AND frequent.line = line.line AND frequent.first <> line.doc_id),
left_over AS (
  SELECT doc_id, count(DISTINCT line) FILTER (lost) AS n_frequent_lines,
         coalesce(sum(words) FILTER (NOT lost), 0) AS kept_words,
         count(*) - count(DISTINCT k_line) AS n_dup_lines
  FROM judged GROUP BY doc_id),
place AS (
  SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM doc)),
again AS (
  SELECT doc_id, i FROM place
  QUALIFY count(*) OVER (PARTITION BY doc_id, words) > 1),
repeated AS (
  SELECT doc_id, sum(least(8, coalesce(i - before, 8))) AS n FROM (
    SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM again) GROUP BY doc_id),
base AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words,
    coalesce(n_frequent_lines, 0) AS n_frequent_lines, coalesce(kept_words, 0) AS kept_words
  FROM doc LEFT JOIN left_over USING (doc_id) LEFT JOIN repeated USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars,
  n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
  n_repeat_words::BIGINT AS n_repeat_words,
  (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AS base_failed,
  NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words)
    AND NOT (n_frequent_lines > 0 AND (kept_words < 10 OR kept_words < 0.3 * n_words)) AS kept,
  n_frequent_lines::INTEGER AS n_frequent_lines, kept_words::BIGINT AS kept_words
FROM base
"""

#: The 256 remainders of CRC-32, and the checksum of a text's UTF-8 bytes by them.
CRC_TABLE = """crc AS (
  SELECT list(list_reduce([b, 1, 1, 1, 1, 1, 1, 1, 1],
                          lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b))"""


def crc32(text: str) -> str:
    """SQL of the checksum of a non-null text, beside ``crc``."""
    code = f"hex(encode({text}))"
    byte = f"list_transform(range(octet_length(encode({text}))), lambda k: ('0x' || substr({code}, 2 * k + 1, 2))::BIGINT)"
    folded = f"list_reduce(list_prepend(4294967295::BIGINT, {byte}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]))"
    return f"xor({folded}, 4294967295)"


VARIANTS = f"""
WITH RECURSIVE {CRC_TABLE},
run AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
  WHERE length(r) >= 7 GROUP BY ALL),
marked AS (
  SELECT run, n, CASE WHEN doc_id IS NULL THEN 1 ELSE {crc32("concat(doc_id, ':', run)")} END AS h FROM run, crc),
altered AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
              ELSE run END AS word, n FROM marked),
word AS (
  SELECT word, sum(n)::BIGINT AS n FROM altered WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
cut AS (
  SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM word)),
pair AS (
  SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN word b ON a.rest = b.word
  UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN word b ON a.rest = b.word),
best AS (
  SELECT word, count(*) AS n_near, max(near_n) AS top, min(near) FILTER (near_n = most) AS near
  FROM (SELECT *, max(near_n) OVER (PARTITION BY word) AS most FROM pair) GROUP BY word),
step AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 10 * n THEN near END AS form,
         CASE WHEN top >= 10 * n THEN top END AS form_n
  FROM word LEFT JOIN best USING (word)),
way AS (
  SELECT word, word AS root FROM step
  UNION ALL SELECT way.word, step.form FROM way JOIN step ON step.word = way.root WHERE step.form IS NOT NULL),
root AS (SELECT word, arg_max(root, n) AS root FROM way JOIN (SELECT word AS root, n FROM word) USING (root) GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM step JOIN root USING (word)
"""

PERIODIC = f"""
WITH {CRC_TABLE},
doc AS (
  SELECT doc_id, {SPACED} AS w, CASE WHEN doc_id IS NULL THEN 1 ELSE {crc32("doc_id::VARCHAR")} END AS h
  FROM documents, crc),
sized AS (SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) END AS a FROM doc),
turned AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM sized),
word AS (
  SELECT doc_id, n, i, w[CASE WHEN h % 10 = 0 AND i >= a THEN a + (i - a) % p ELSE i END + 1] AS word
  FROM (SELECT *, unnest(range(n)) AS i FROM turned)),
same AS (
  SELECT x.doc_id, x.i, y.i - x.i AS q FROM word x JOIN word y USING (doc_id, word)
  WHERE y.i > x.i AND 2 * (y.i - x.i) <= x.n),
stretch AS (
  SELECT doc_id, q, min(i) AS start, count(*) + q AS length
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
  GROUP BY doc_id, q, island HAVING count(*) >= q AND count(*) + q >= 12),
run AS (SELECT doc_id, start, length, min(q) AS period FROM stretch GROUP BY doc_id, start, length),
gone AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM run),
listed AS (
  SELECT doc_id, count(*) AS n_runs,
    string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS lines,
    max(row(length, -start, -period)) AS top
  FROM run GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, (-top[2])::BIGINT AS start, top[1]::BIGINT AS length,
  (-top[3])::BIGINT AS period, (1000 * top[1] // -top[3])::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept.text, '')) AS collapsed_sha256
FROM doc LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

#: The signature rules as SQL rows; the laws that resolve their detections are stated in the query.
SIGNATURES = ", ".join(
    f"({rank}, '{rule.label}', '{rule.head}', '{rule.anchored}', {rule.confidence})" for rank, rule in enumerate(rules())
)

LICENSES = f"""
WITH rule AS (SELECT * FROM (VALUES {SIGNATURES}) AS t(rank, label, head, pattern, confidence)),
doc AS (SELECT doc_id, {ALNUM} AS w FROM documents),
word AS (SELECT doc_id, w, unnest(w) AS word, unnest(range(len(w))) AS i FROM doc),
place AS (
  SELECT doc_id, i, word AS head, array_to_string(w[i + 1:i + 24], ' ') AS words FROM word
  UNION ALL
  SELECT doc_id, i, word || ' ' || w[i + 2], array_to_string(w[i + 1:i + 24], ' ') FROM word WHERE i + 1 < len(w)),
tried AS (
  SELECT doc_id, i, rank, label, confidence, rtrim(regexp_extract(words, pattern)) AS found
  FROM place JOIN rule USING (head)),
sized AS (SELECT *, len(string_split(found, ' ')) AS size FROM tried WHERE found <> ''),
best AS (
  SELECT doc_id, i, size, rank, label, confidence FROM sized
  QUALIFY row_number() OVER (PARTITION BY doc_id, i ORDER BY size DESC, rank) = 1),
outer_most AS (
  SELECT * FROM best d WHERE NOT EXISTS (
    SELECT 1 FROM best a WHERE a.doc_id = d.doc_id AND a.i < d.i AND a.i + a.size >= d.i + d.size)),
left_over AS (
  SELECT * FROM outer_most d WHERE NOT EXISTS (
    SELECT 1 FROM outer_most a
    WHERE a.doc_id = d.doc_id AND a.i < d.i + d.size AND a.i + a.size > d.i AND a.rank < d.rank)),
base AS (
  SELECT doc_id, i, CASE head WHEN 'cc by' THEN 'cc-by' WHEN 'general public' THEN 'gpl' ELSE 'reserved' END AS label
  FROM place WHERE head = 'cc by' OR (head = 'general public' AND words SIMILAR TO 'general public license( .*)?')
    OR (head = 'all rights' AND words SIMILAR TO 'all rights reserved( .*)?')),
counted AS (
  SELECT doc_id, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY doc_id),
listed AS (
  SELECT doc_id, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(confidence) AS score
  FROM (SELECT doc_id, label, confidence FROM left_over UNION ALL SELECT doc_id, label, 0.5 FROM base)
  GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
  last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  coalesce(score, 0)::DOUBLE AS score
FROM doc LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

ORACLES = {
    "op13_license_scan": LICENSES,
    "op12_periodic_runs": PERIODIC,
    "op11_spelling_variants": VARIANTS,
    "op1_quality_rules": QUALITY,
    "op2_decontamination": DECONTAMINATION,
    "op6_substring_dedup": SUBSTRINGS,
}
