"""SQL that restates operators of this package whose results SQL can express."""

from __future__ import annotations

from . import quality

BINARY_SEARCH = """WITH given AS (SELECT vec_id, embedding FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0),
wide AS (SELECT len(embedding) AS n FROM given GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
codes AS (SELECT vec_id AS id, list_transform(embedding, lambda x: coalesce(x > 0, false)) AS bits FROM given WHERE len(embedding) = (SELECT n FROM wide)),
near AS (SELECT q.id AS query_id, c.id AS neighbour_id, len(list_filter(list_zip(q.bits, c.bits), lambda z: z[1] <> z[2])) AS distance
FROM codes q JOIN codes c ON q.id <> c.id WHERE q.id % 50 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, neighbour_id, CAST(distance AS INTEGER) AS distance
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbour_id) AS rank FROM near) WHERE rank <= 10"""

MIXING = """WITH RECURSIVE sizes AS (SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM documents GROUP BY source),
whole AS (SELECT sum(size) AS t, sum(sqrt(size)) FILTER (size > 0) AS w FROM sizes),
rates AS (SELECT source, CASE WHEN size > 0 THEN round(sqrt(size) / w * t / size, 9) ELSE 0.0 END AS rate FROM sizes, whole),
poisson AS (SELECT source, rate, 0 AS k, CASE WHEN rate > 0 THEN -rate ELSE 0.0 END AS log_p, CASE WHEN rate > 0 THEN exp(-rate) ELSE 1.0 END AS total FROM rates
UNION ALL SELECT source, rate, k + 1, log_p + ln(rate) - ln(k + 1.0), total + exp(log_p + ln(rate) - ln(k + 1.0)) FROM poisson WHERE rate > 0 AND k < rate + 12 * sqrt(rate) + 20),
drawn AS (SELECT d.*, ('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT / 4503599627370496.0 AS u FROM documents d),
counts AS (SELECT p.source, p.rate, list(p.total) AS totals FROM poisson p GROUP BY ALL),
counted AS (SELECT d.* EXCLUDE (u), CAST(len(list_filter(c.totals, lambda x: x <= d.u)) AS INTEGER) AS n_copies, c.rate FROM drawn d JOIN counts c ON d.source IS NOT DISTINCT FROM c.source)
SELECT * EXCLUDE (n_copies, rate), CAST(unnest(range(n_copies)) AS INTEGER) AS copy, n_copies, rate FROM counted WHERE n_copies > 0"""

NEAR_DUPLICATES = r"""WITH RECURSIVE words AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
ELSE list_sort(list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))) END AS s FROM words),
named AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n, s, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY md5(array_to_string(s, chr(10)))) ELSE doc_id END AS rep FROM sets),
each AS (SELECT doc_id AS id, n, unnest(s) AS x FROM named WHERE doc_id = rep),
shared AS (SELECT a.id AS a, b.id AS b, any_value(a.n + b.n) AS n, count(*) AS m FROM each a JOIN each b ON a.x = b.x AND a.id < b.id AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n) GROUP BY a.id, b.id),
links AS (SELECT a, b FROM shared WHERE 100 * m >= 85 * (n - m)), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT DISTINCT a AS id, a AS other FROM edges UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a),
roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id)
SELECT doc_id, n AS n_shingles, coalesce(root, rep) AS component_id, doc_id = coalesce(root, rep) AS kept FROM named LEFT JOIN roots ON rep = id"""

CAPTURES = r"""WITH given AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
parts AS (SELECT *, regexp_extract(url, '^[A-Za-z]+://([^/?#:]*)', 1) AS host, regexp_extract(url, '^[A-Za-z]+://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '^[^?#]*[?]([^#]*)', 1) AS asked FROM given),
keyed AS (SELECT *, array_to_string(list_reverse(string_split(regexp_replace(lower(host), '^www[.]', ''), '.')), ',') || ')' || CASE WHEN path = '' THEN '/' ELSE lower(path) END
|| CASE WHEN asked = '' THEN '' ELSE '?' || array_to_string(list_sort(string_split(lower(asked), '&')), '&') END AS url_key,
strftime(TIMESTAMP '2024-01-01' + to_seconds(coalesce(page_id, 0)), '%Y-%m-%dT%H:%M:%SZ') AS stamp, CASE WHEN page_id IS NOT NULL THEN min(page_id) OVER (PARTITION BY hex) END AS first FROM parts)
SELECT page_id, octet_length(encode(html)) AS payload_bytes, array_to_string(flatten(list_transform(range(8), lambda j: list_transform([15, 10, 5, 0], lambda b:
substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(hex, CAST(5 * j + 1 AS BIGINT), 5) AS BIGINT) >> b) & 31 AS BIGINT), 1)))), '') AS payload_digest,
CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to, url_key, stamp,
row_number() OVER (ORDER BY url_key, stamp, page_id NULLS FIRST) - 1 AS history_rank FROM keyed"""

_QUOTED = {k: v.replace("'", "''") for k, v in vars(quality).items() if k in ("SEPARATOR", "MENU", "SENTENCE", "BOILERPLATE", "CAPITAL", "LOUD")}

# The patterns are the operator's own: both sides read them as RE2.
QUALITY = rf"""WITH given AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM given),
windows AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM words)),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM windows) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT j) AS n FROM (SELECT r, unnest(range(i, i + 8)) AS j FROM twice) GROUP BY r),
split AS (SELECT r, unnest(string_split(t, chr(10))) AS l, generate_subscripts(string_split(t, chr(10)), 1) AS p FROM given),
lined AS (SELECT *, list_filter(string_split_regex(l, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM split),
measured AS (SELECT *, row_number() OVER (PARTITION BY r, l ORDER BY p) > 1 AS again, len(w) AS n_words, len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS stutters,
length(regexp_replace(l, '[\x20\x09-\x0D]', '', 'g')) AS chars, length(regexp_replace(l, '[^#*$%&|<>]', '', 'g')) AS marks, len(regexp_extract_all(l, '{_QUOTED["SEPARATOR"]}')) AS between,
len(regexp_extract_all(l, '{_QUOTED["CAPITAL"]}')) AS capitals, len(regexp_extract_all(l, '{_QUOTED["LOUD"]}')) AS loud FROM lined),
ruled AS (SELECT r, chars, again, CASE WHEN again THEN 'repeated' WHEN between >= 3 AND 5 * between >= n_words OR regexp_matches(l, '{_QUOTED["MENU"]}') THEN 'navigation'
WHEN marks >= 3 AND 2 * marks > n_words THEN 'symbols' WHEN n_words >= 8 AND 3 * stutters > n_words THEN 'stuttering' WHEN n_words >= 5 AND (10 * capitals > 4 * chars OR 4 * loud >= n_words) THEN 'shouting'
WHEN n_words <= 30 AND regexp_matches(l, '{_QUOTED["BOILERPLATE"]}') THEN 'boilerplate' WHEN NOT regexp_matches(l, '{_QUOTED["SENTENCE"]}') THEN 'punctuation' END AS rule FROM measured WHERE n_words > 0),
told AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(chars) FILTER (rule IS NOT NULL), 0) AS lost_chars, {", ".join(f"count(*) FILTER (rule = '{x}') AS lines_{x}" for x in quality.RULES)} FROM ruled GROUP BY r),
counted AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, CAST(coalesce(lost_chars, 0) AS BIGINT) AS lost_chars, {", ".join(f"coalesce(lines_{x}, 0) AS lines_{x}" for x in quality.RULES)}
FROM words LEFT JOIN told USING (r) LEFT JOIN covered c USING (r))
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words AND 100 * lost_chars <= 60 * word_chars AS kept FROM counted"""
