"""SQL for DuckDB with the results of those queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {}


def crc32_sql(number: str) -> str:
    """Unsigned CRC-32 of the decimal digits of an integer column; DuckDB has no function for it."""
    bits = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({number}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda c, b: {bits}), 4294967295)"

ORACLES["op4_warc"] = r"""
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, '')))::BIGINT AS size FROM pages),
marked AS (
  SELECT page_id, html, size, max(page_id) OVER (PARTITION BY html) AS last FROM payloads)
SELECT page_id, size AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN size >= 1000 AND last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND last <> page_id THEN last END AS refers_to
FROM marked"""

ORACLES["op5_source_mixture"] = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS place
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 2.0::DOUBLE * source_size AS cap,
         ([3.0, 1.0, 2.0]::DOUBLE[])[1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS weight
  FROM sums),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER ()
             - coalesce(sum(cap) OVER (ORDER BY cap / weight, encode(source) NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (ORDER BY cap / weight, encode(source) NULLS LAST
                        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM weighed),
targets AS (
  SELECT source, source_size, least(cap, weight * max(level) OVER ()) AS target FROM levels),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS copies,
         target - CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END * source_size AS budget
  FROM targets),
running AS (
  SELECT d.doc_id, d.size, b.source_size, b.target, b.copies, b.budget,
         sum(d.size) OVER (PARTITION BY d.source ORDER BY d.place RANGE UNBOUNDED PRECEDING) AS upto,
         sum(d.size) OVER (PARTITION BY d.source, d.place) AS here
  FROM sized d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto - here < budget AND (upto <= budget OR upto - budget < budget - (upto - here))
                THEN 1 ELSE 0 END))::BIGINT AS taken
FROM running"""

ORACLES["op6_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
escaped AS (
  SELECT *, regexp_replace(role, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS role_in,
         regexp_replace(text, '([<\[])(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g') AS text_in
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|turn|>') + length(role_in) + length('<|text|>') + length(text_in) + length('<|end|>'))::BIGINT
         AS formatted_chars
FROM escaped GROUP BY conv_id"""

ORACLES["op8_exact_dedup"] = r"""
WITH normal AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(norm) AS text_sha256
FROM normal WINDOW same AS (PARTITION BY norm)"""


ORACLES["op3_decontamination"] = r"""
WITH doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS words
  FROM documents),
item_words AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item, least(len(words), 10) AS size,
         array_to_string(words[i : i + least(len(words), 10) - 1], ' ') AS run
  FROM item_words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS spot(i) WHERE len(words) > 0),
runs AS (
  SELECT doc_id, i, size, array_to_string(words[i : i + size - 1], ' ') AS run
  FROM doc_words, (SELECT DISTINCT size FROM windows) AS sizes, unnest(range(1, len(words) - size + 2)) AS spot(i)),
found AS (
  SELECT doc_id, i, runs.size, item FROM runs JOIN windows ON runs.size = windows.size AND runs.run = windows.run),
hit AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM found, unnest(range(i, i + size)) AS spot(j) GROUP BY doc_id),
names AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, array_to_string(list_sort(list(DISTINCT item)), ',') AS items
  FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN names USING (doc_id)"""


# Runs out of equal strings of six words: a run has six equal words a period apart at least.
ORACLES["op11_periodic_runs"] = r"""
WITH split AS (
  SELECT doc_id, row_number() OVER () AS row, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS words,
         """ + crc32_sql("doc_id") + r""" AS h FROM documents),
sized AS (SELECT *, len(words) AS n, h // 10 AS g FROM split),
placed AS (SELECT *, CASE WHEN n > 0 THEN g % n END AS a FROM sized),
cyclic AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM placed),
texts AS (
  SELECT doc_id, row, CASE WHEN h % 10 = 0 AND n > 0 THEN
           [CASE WHEN i >= a THEN words[a + (i - a) % p + 1] ELSE words[i + 1] END for i in range(n)] ELSE words END AS words
  FROM cyclic),
tokens AS (SELECT row, i - 1 AS i, words[i] AS word FROM texts, unnest(range(1, len(words) + 1)) AS spot(i)),
grams AS (
  SELECT row, i - 1 AS i, array_to_string(words[i : i + 5], ' ') AS gram
  FROM texts, unnest(range(1, len(words) - 4)) AS spot(i)),
equal AS (
  SELECT x.row, x.i, y.i - x.i AS period FROM grams x JOIN grams y ON x.row = y.row AND x.gram = y.gram AND x.i < y.i),
islands AS (
  SELECT row, period, i, i - row_number() OVER (PARTITION BY row, period ORDER BY i) AS island FROM equal),
stretches AS (
  SELECT row, period, min(i) AS start, max(i) - min(i) + 6 AS same FROM islands GROUP BY row, period, island),
runs AS (
  SELECT row, start, same + period AS length, min(period) AS period FROM stretches
  WHERE same >= period AND same + period >= 12 GROUP BY row, start, same + period),
lists AS (
  SELECT row, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines,
         min_by({'start': start, 'length': length, 'period': period}, (-length, start, period)) AS best
  FROM runs GROUP BY row),
dropped AS (SELECT DISTINCT row, i FROM runs, unnest(range(start + period, start + length)) AS spot(i)),
kept AS (SELECT row, string_agg(word, ' ' ORDER BY i) AS kept FROM tokens ANTI JOIN dropped USING (row, i) GROUP BY row)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, best.start::BIGINT AS start, best.length::BIGINT AS length,
       best.period::BIGINT AS period, (1000 * best.length // best.period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM texts LEFT JOIN lists USING (row) LEFT JOIN kept USING (row)"""


ORACLES["op13_top_products"] = r"""
WITH numbers AS (
  SELECT vec_id, rowid AS row, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS vector
  FROM (SELECT *, row_number() OVER () AS rowid FROM embeddings)
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, q.row AS query_row, c.vec_id, list_inner_product(q.vector, c.vector)::BIGINT AS score
  FROM numbers q JOIN numbers c ON q.vec_id % 20 = 0 AND q.row <> c.row),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 20"""


ORACLES["op12_prefix_trie"] = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS lender, """ + crc32_sql("conv_id") + r""" % 6 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
rebuilt AS (
  SELECT c.conv_id, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.lender AND pos <= h
  UNION ALL SELECT c.conv_id, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND pos > h),
paths AS (
  SELECT conv_id, row_number() OVER way AS depth, length(text) AS chars,
         string_agg(sha256(role) || sha256(text), '') OVER (way ROWS UNBOUNDED PRECEDING) AS key,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM rebuilt WINDOW way AS (PARTITION BY conv_id ORDER BY pos)
  UNION ALL
  SELECT c.conv_id, 0, 0, '', (SELECT count(*) FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c),
nodes AS (
  SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n_turns = depth), '') AS ends
  FROM paths GROUP BY key, depth),
trees AS (
  SELECT n.key, p.conv_id AS parent, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.key[: 128 * n.depth] = n.key) AS n_children
  FROM nodes n LEFT JOIN nodes p ON p.depth = n.depth - 1 AND n.key[: 128 * p.depth] = p.key)
SELECT u.conv_id, u.depth, any_value(t.parent) AS parent_conv_id, any_value(u.n_convs) AS n_convs,
       any_value(t.n_children) AS n_children, count(*) FILTER (below.n_children = 0) AS n_leaves,
       sum((v.n_convs - 1) * v.chars)::BIGINT AS saved_tokens, any_value(sha256(u.ends)) AS ends_sha256
FROM nodes u JOIN trees t ON t.key = u.key JOIN nodes v ON v.depth >= u.depth AND v.key[: 128 * u.depth] = u.key
  JOIN trees below ON below.key = v.key
GROUP BY u.key, u.conv_id, u.depth"""


ORACLES["op9_repeated_passages"] = r"""
WITH texts AS (
  SELECT doc_id, row_number() OVER () AS row, hex(encode(coalesce(text, ''))) AS digits,
         octet_length(encode(coalesce(text, '')))::BIGINT AS n_bytes FROM documents),
starts AS MATERIALIZED (
  SELECT row, i, md5(substr(digits, 2 * i + 1, 800)) AS string FROM texts, unnest(range(n_bytes - 399)) AS spot(i)),
repeated AS (
  SELECT row, i FROM starts WHERE string IN (SELECT string FROM starts GROUP BY string HAVING count(*) > 1)),
marked AS (
  SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM repeated),
runs AS (
  SELECT row, min(i) AS begin, max(i) + 400 AS upto
  FROM (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS run FROM marked) GROUP BY row, run),
gaps AS (
  SELECT row, begin, upto, coalesce(lag(upto) OVER (PARTITION BY row ORDER BY begin), 0) AS before FROM runs),
cut AS (
  SELECT t.row, count(*) AS n_spans, sum(upto - begin)::BIGINT AS n_removed,
         string_agg(digits[2 * before + 1 : 2 * begin], '' ORDER BY begin) || any_value(digits)[2 * max(upto) + 1 :] AS kept
  FROM gaps JOIN texts t ON t.row = gaps.row GROUP BY t.row)
SELECT doc_id, n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(from_hex(coalesce(kept, digits))) AS kept_sha256
FROM texts LEFT JOIN cut USING (row)"""
