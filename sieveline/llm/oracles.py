"""DuckDB SQL that gives the rows of the registered queries on the same tables.

Not in SQL: spans of the entropy scan (op4) and of the added kinds of personal data (op6), the fitted models (op5, op8) and
the pipeline that begins with one. The tests compare those with brute force or by held-out accuracy.
"""

from __future__ import annotations

_WORDS = r"coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), [])"

_MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS}) AS size,
         ((('0x' || substr(md5(doc_id::VARCHAR || '|2023'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM documents
), favoured AS (
  SELECT *, floor(size * 1000 / (size + 500))::BIGINT AS favour FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, sum(favour * size)::BIGINT AS all_favour FROM favoured GROUP BY source
), weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM sources
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * source_size / weight, source) AS k,
         sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0) AS open_size,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM weighed
  WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT min(k) AS k, arg_min(open_size, k) AS open_size, arg_min(open_weight, k) AS open_weight
  FROM ordered WHERE weight * open_size <= 3 * source_size * open_weight
), targets AS (
  SELECT o.source, o.source_size, o.all_favour,
         CASE WHEN o.k < l.k THEN (3 * o.source_size)::DOUBLE
              ELSE (o.weight * l.open_size)::DOUBLE / l.open_weight::DOUBLE END AS target
  FROM ordered o, level l
), expected AS (
  SELECT d.*, t.source_size, t.target,
         least(3.0, greatest(0.0, t.target / t.source_size + 0.5 * least(t.target / t.source_size, 3.0 - t.target / t.source_size)
           * ((d.favour * t.source_size - t.all_favour)::DOUBLE / (1000.0 * t.source_size)))) AS e
  FROM favoured d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source
), drawn AS (
  SELECT *, floor(e)::BIGINT AS whole, e - floor(e) AS chance FROM expected
), ranked AS (
  SELECT *, u / (1 - u) / (chance / (1 - chance)) AS odds,
         target - sum(whole * size) OVER (PARTITION BY source) AS words_left
  FROM drawn
), cut AS (
  SELECT *, sum(size) OVER (PARTITION BY source, chance > 0 ORDER BY odds, doc_id::VARCHAR, size) AS through FROM ranked
)
SELECT doc_id, size, source_size, target,
       whole + (chance > 0 AND 2 * through - size <= 2 * words_left)::BIGINT AS copies,
       (whole + (chance > 0 AND 2 * through - size <= 2 * words_left)::BIGINT) * size AS taken
FROM cut
"""

_WARC = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload FROM pages
), facts AS (
  SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM payloads
), kept AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS largest FROM facts
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> largest THEN largest END AS refers_to
FROM kept
"""

# the table of the checksum, made by its rule: eight shifts of each byte with the reversed polynomial
_SHARDS = """
WITH RECURSIVE steps AS (
  SELECT i AS byte, i::BIGINT AS c, 0 AS k FROM range(256) t(i)
  UNION ALL
  SELECT byte, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8
), crc AS (
  SELECT list(c ORDER BY byte) AS t FROM steps WHERE k = 8
), bytes AS (
  SELECT doc_id, (strlen(coalesce(text, '')) + 1)::BIGINT AS size,
         list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT) AS b
  FROM documents
), sized AS (
  SELECT doc_id, size, xor(list_reduce(list_prepend(4294967295, b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) AS text_crc32
  FROM bytes, crc
), run AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id, text_crc32) - size AS start, sum(size) OVER () AS total FROM sized
), placed AS (
  SELECT *, ((2 * start + size) * 16 // (2 * total))::INT AS shard FROM run
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id, text_crc32) - 1 AS slot, NULL::INT AS grown_shard
FROM placed
"""

_SETS = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT doc_id, unnest(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [w]
                        ELSE list_transform(range(1, len(w) - 2), lambda i: w[i:i + 3]) END)) AS s
  FROM split
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
  GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * common >= 85 * (p.n + q.n - common)
), reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
)
SELECT r.a AS doc_id, coalesce(any_value(s.n), 0)::BIGINT AS n_shingles, min(r.b) AS component_id
FROM reached r LEFT JOIN sizes s ON s.doc_id = r.a
GROUP BY r.a
"""


# The stop words and the bounds of the quality rules, written out apart from the code they check.
_STOPS = (
    "a and are as at be by for from in is it of on or that the this to was were with you "
    "der die das und ist nicht ein eine einer mit von zu den dem im auf für sich des "
    "le la les de du des et est un une dans que pour en qui au avec pas elle il "
    "el los las y un una en por con para del se su no lo al como es"
)
_LIMITS = """n_words >= 10 AND mean_word_chars >= 1.5 AND mean_word_chars <= 14 AND symbols_per_word <= 0.15 AND upper_ratio <= 0.5
       AND letter_word_ratio >= 0.6 AND stop_word_ratio >= 0.02 AND dup_line_ratio <= 0.3 AND repeat_word_ratio <= 0.2
       AND ellipsis_line_ratio <= 0.3 AND bullet_line_ratio <= 0.9"""

_QUALITY = rf"""
WITH split AS (
  SELECT doc_id, coalesce(text, '') AS body, {_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3), lambda i: w[i:i + 4])) AS five FROM split
), marked AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, five) AS times FROM windows
), covered AS (
  SELECT doc_id, count(DISTINCT i + d) AS n FROM marked, range(5) r(d) WHERE times > 1 GROUP BY doc_id
), counted AS (
  SELECT doc_id, len(w) AS n_words, len(lines) AS n_lines,
         length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(body, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(c.n, 0) AS n_repeat_words,
         len(list_filter(regexp_split_to_array(lower(regexp_replace(body, '[.,;:!?]', '', 'g')), '[\x20\x09-\x0D]+'), lambda x: x IN ({", ".join(f"'{w}'" for w in _STOPS.split())}))) AS n_stop,
         len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_letter,
         len(list_filter(lines, lambda x: regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_ellipsis,
         len(list_filter(lines, lambda x: regexp_matches(x, '^[\x20\x09-\x0D]*[-*•‣]'))) AS n_bullet,
         len(regexp_extract_all(body, '\p{{Lu}}')) AS n_upper
  FROM split LEFT JOIN covered c USING (doc_id)
), measured AS (
  SELECT *,
         CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0.0 END AS mean_word_chars,
         CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0.0 END AS symbols_per_word,
         CASE WHEN word_chars > 0 THEN n_upper / word_chars ELSE 0.0 END AS upper_ratio,
         CASE WHEN n_words > 0 THEN n_letter / n_words ELSE 0.0 END AS letter_word_ratio,
         CASE WHEN n_words > 0 THEN n_stop / n_words ELSE 0.0 END AS stop_word_ratio,
         CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0.0 END AS dup_line_ratio,
         CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0.0 END AS repeat_word_ratio,
         CASE WHEN n_lines > 0 THEN n_ellipsis / n_lines ELSE 0.0 END AS ellipsis_line_ratio,
         CASE WHEN n_lines > 0 THEN n_bullet / n_lines ELSE 0.0 END AS bullet_line_ratio,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND {_LIMITS} AS kept
FROM measured
"""


_BENCHMARK = r"""
WITH cut AS (
  SELECT item_id AS id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), windows AS (
  SELECT id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 10 THEN [w] ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS x
  FROM cut
), items AS (
  SELECT x, len(x) AS width, list(DISTINCT id::VARCHAR) AS ids FROM windows GROUP BY x
), split AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), places AS (
  SELECT doc_id, width, unnest(range(1, len(w) - width + 2)) AS i, unnest(list_transform(range(1, len(w) - width + 2), lambda i: w[i:i + width - 1])) AS x
  FROM split, (SELECT DISTINCT width FROM items)
), hits AS (
  SELECT doc_id, i, p.width, ids FROM places p JOIN items USING (x)
), words AS (
  SELECT doc_id, count(DISTINCT k) AS n FROM (SELECT doc_id, unnest(range(i, i + width)) AS k FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, unnest(ids) AS id FROM hits) GROUP BY doc_id
)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(words.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM split s LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""

_NEGATIVES = """
WITH vectors AS (
  SELECT row_number() OVER () AS row, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.row AS anchor, a.vec_id AS anchor_id, a.label = r.label AS same, r.row, r.vec_id, list_inner_product(a.q, r.q)::BIGINT AS score
  FROM vectors a, vectors r WHERE a.vec_id % 100 = 0 AND a.row <> r.row
), positives AS (
  SELECT anchor, anchor_id, row AS positive, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST, row) <= 5
), ranked AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, n.vec_id AS negative_id, n.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor, p.positive ORDER BY n.score DESC, n.vec_id NULLS LAST, n.row)::INT AS rank
  FROM positives p JOIN scored n ON n.anchor = p.anchor
  WHERE NOT n.same AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 10
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, turn, role, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) t(turn, role)
), formatted AS (
  SELECT *, length('<turn>' || regexp_replace(role, '<(\\*)(/?turn)', '<\1\\\2', 'g')
                   || '<turn|>' || regexp_replace(text, '<(\\*)(/?turn)', '<\1\\\2', 'g') || '</turn>' || chr(10)) AS chars
  FROM turns
), run AS (
  SELECT *, row_number() OVER w AS place, sum(chars) OVER w AS until
  FROM formatted
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text ROWS UNBOUNDED PRECEDING)
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars,
       count(*) FILTER (role = 'assistant') AS n_examples,
       coalesce(sum(until) FILTER (role = 'assistant'), 0)::BIGINT AS example_chars
FROM run GROUP BY conv_id
"""

_AUDIT = rf"""
WITH texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body, {_WORDS} AS w,
         coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS e
  FROM documents
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
         {{'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
          'C': 100 * (length(body) - length(regexp_replace(body, '[A-Z]', '', 'g'))) > 3 * length(body),
          'D': regexp_matches(body, '[#$%&*|]'), 'E': e}} AS f
  FROM texts LEFT JOIN marks USING (doc_id)
), cells AS (
  SELECT part, f, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM failed GROUP BY part, f
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (
  SELECT filter_order, k AS step, filter_order[k] AS own, filter_order[1:k - 1] AS earlier FROM orders, range(1, 6) r(k)
), seen AS (
  SELECT *, [x FOR x IN ['A', 'B', 'C', 'D', 'E'] IF list_extract([f.A, f.B, f.C, f.D, f.E], ascii(x) - 64)] AS fails
  FROM cells
), audited AS (
  SELECT part, filter_order, step, own,
         coalesce(sum(n) FILTER (NOT list_contains(fails, own) AND len(list_filter(fails, lambda x: contains(earlier, x))) = 0), 0) AS kept,
         coalesce(sum(n) FILTER (list_contains(fails, own) AND len(list_filter(fails, lambda x: contains(earlier, x))) = 0), 0) AS removed,
         coalesce(sum(n) FILTER (list_contains(fails, own) AND len(list_filter(fails, lambda x: contains(earlier, x))) > 0), 0) AS redundant,
         coalesce(sum(n) FILTER (fails = [own]), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (list_contains(fails, own) AND len(list_filter(fails, lambda x: contains(earlier, x))) = 0), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (list_contains(fails, own) AND len(list_filter(fails, lambda x: contains(earlier, x))) = 0), 0) AS toxic_lost
  FROM seen, steps GROUP BY part, filter_order, step, own
)
SELECT part, filter_order, step::INT AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM audited
"""

ORACLES: dict[str, str] = {
    "op1_pareto_mix": _MIX,
    "op2_warc": _WARC,
    "op3_byte_shards": _SHARDS,
    "op7_jaccard": _SETS,
    "op9_quality_rules": _QUALITY,
    "op10_decontamination": _BENCHMARK,
    "op11_hard_negatives": _NEGATIVES,
    "op12_chat": _CHAT,
    "op13_filter_audit": _AUDIT,
}
