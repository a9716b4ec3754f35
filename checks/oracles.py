"""SQL for DuckDB with the same results as the registered queries."""

from __future__ import annotations

from titleloom.functions.minhash import MAX_HASH, PRIME, permutations

_NORM = "regexp_replace(regexp_replace({0}, '#.*$', ''), '/$', '')"
_NETLOC = "regexp_extract({0}, '^[a-z]+://([^/?#]*)', 1)"
_ORIGIN = "regexp_extract({0}, '^([a-z]+://[^/?#]*)', 1)"


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# Title texts that count as missing. A copy of its own, so that a change of the library shows.
NA_TITLES = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
_NA = ", ".join(_text(value) for value in NA_TITLES)

_VISIBLE = r"""visible AS (
  SELECT page_id, url, regexp_replace(html,
    '<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>', '', 'gis') AS html
  FROM pages)"""

_TITLES = (
    _VISIBLE
    + r""",
h1 AS (
  SELECT page_id, url, regexp_replace(
    regexp_extract(html, '<h1[^>]*>(.*?)</h1>', 1, 'is'), '</?[a-zA-Z][^>]*>', '', 'g') AS raw
  FROM visible WHERE regexp_matches(html, '<h1[^>]*>', 'i')),
titles AS (
  SELECT page_id, """
    + _NORM.format("url")
    + r""" AS url, regexp_replace(
    regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
      raw, '&lt;?', '<', 'g'), '&gt;?', '>', 'g'), '&quot;?', '"', 'g'), '&copy;?', '©', 'g'),
      '&middot;?', '·', 'g'), '&amp;?', '&', 'g'),
    '^\s+|\s+$', '', 'g') AS title
  FROM h1)"""
)

_LINKS = (
    _VISIBLE
    + r""",
found AS (
  SELECT page_id, """
    + _NORM.format("url")
    + r""" AS src,
    regexp_extract_all(html, '<a\s[^>]*?href\s*=\s*"([^"]*)"', 1, 'i') AS hrefs
  FROM visible),
hrefs AS (
  SELECT page_id, src, unnest(hrefs) AS href, generate_subscripts(hrefs, 1) - 1 AS pos FROM found),
links AS (
  SELECT page_id, src, """
    + _NORM.format(_ORIGIN.format("src") + " || href")
    + """ AS dst, pos FROM hrefs)"""
)

_IS_SEED = f"ends_with({_NETLOC.format('url')}, '.org')"
_SEEDS = f"seeds AS (SELECT url, page_id FROM pages WHERE {_IS_SEED})"
_DOMAINS = f"domains AS (SELECT DISTINCT {_NETLOC.format('url')} AS netloc FROM seeds)"

_CRAWL = f"""{_LINKS}, {_SEEDS}, {_DOMAINS},
level0 AS (
  SELECT url, row_number() OVER (ORDER BY place, url) AS place
  FROM (SELECT {_NORM.format('url')} AS url, min(page_id) AS place FROM seeds GROUP BY 1)),
firsts AS (SELECT {_NORM.format('url')} AS url, min(page_id) AS page_id FROM pages GROUP BY 1),
level1 AS (
  SELECT url, row_number() OVER (ORDER BY found) AS place FROM (
    SELECT dst AS url, min((level0.place, pos)) AS found
    FROM level0 JOIN firsts USING (url) JOIN links USING (page_id)
    WHERE {_NETLOC.format('dst')} IN (SELECT netloc FROM domains) AND dst NOT IN (SELECT url FROM level0)
    GROUP BY dst)),
level2 AS (
  SELECT url, row_number() OVER (ORDER BY found) AS place FROM (
    SELECT {_ORIGIN.format('url')} || '/hop/' || md5(url)[1] AS url, min(place) AS found FROM level1 GROUP BY 1)
  WHERE url NOT IN (SELECT url FROM level0) AND url NOT IN (SELECT url FROM level1)),
crawled AS (
  SELECT url, 0 AS depth, place FROM level0 UNION ALL SELECT url, 1, place FROM level1
  UNION ALL SELECT url, 2, place FROM level2)"""

_ACCEPTED = """url NOT LIKE '%#%' AND url NOT LIKE '%utm\\_source%' ESCAPE '\\'
  AND (url LIKE 'https:%' OR url NOT LIKE '%//www.%')"""


def _allowed(url: str) -> str:
    """Outcome of the derived robots answers for one URL."""
    host, path = _ORIGIN.format(url), f"regexp_replace({url}, '^[a-z]+://[^/?#]*', '')"
    return f"""CASE
      WHEN {host} LIKE '%://blog.%' THEN false
      WHEN {host} LIKE '%://m.%' THEN true
      WHEN {host} LIKE 'http://www.%' THEN true
      WHEN ends_with({host}, '.org') THEN NOT starts_with({path}, '/en/')
      WHEN ends_with({host}, '.net') THEN starts_with({path}, '/fr/1') OR NOT starts_with({path}, '/fr/')
      ELSE NOT starts_with({path}, '/de') END"""


def _words(text: str) -> str:
    return (
        f"list_distinct(list_filter(string_split_regex(lower({text}), '\\s+'), lambda w: w <> ''))"
    )


def _signatures(name: str, source: str, key: str, text: str) -> str:
    """Slots of each row: (key, slot, v), where empty texts have none."""
    a, b = permutations()
    coefficients = ", ".join(f"[{x}, {y}]" for x, y in zip(a.tolist(), b.tolist()))
    digest = "sha1(word)"
    number = f"('0x' || {digest}[7:8] || {digest}[5:6] || {digest}[3:4] || {digest}[1:2])::BIGINT"
    return f"""{name}_words AS (
  SELECT {key}, unnest({_words(text)}) AS word FROM {source}),
{name}_hashes AS (SELECT word, {number}::HUGEINT AS h FROM {name}_words GROUP BY word),
{name}_perms AS (
  SELECT unnest(range(128)) AS slot, unnest([{coefficients}]::HUGEINT[][]) AS ab),
{name}_values AS MATERIALIZED (
  SELECT word, slot,
    ((((ab[1] * h + ab[2]) % 18446744073709551616) % {PRIME}) & {MAX_HASH})::BIGINT AS v
  FROM {name}_hashes CROSS JOIN {name}_perms),
{name} AS MATERIALIZED (
  SELECT {key}, slot, min(v) AS v FROM {name}_words JOIN {name}_values USING (word) GROUP BY ALL)"""


def _forest(docs: str, asked: str) -> str:
    """Candidates and scores of every query by comparing all slots of all pairs."""
    return f"""{_signatures("dsig", docs, "id", "title")},
{_signatures("qsig", asked, "qid", "query")},
by_tree AS (
  SELECT qid, id, d.slot // 16 AS tree,
    coalesce(min(CASE WHEN d.v <> q.v THEN d.slot % 16 END), 16) AS depth,
    count(*) FILTER (WHERE d.v = q.v) AS same
  FROM dsig d JOIN qsig q USING (slot) GROUP BY ALL),
scored AS (
  SELECT qid, id, max(depth) AS depth, sum(same) / 128.0 AS similarity,
    min(tree) FILTER (WHERE depth = top) AS tree
  FROM (SELECT *, max(depth) OVER (PARTITION BY qid, id) AS top FROM by_tree)
  GROUP BY qid, id HAVING max(depth) > 0),
slots AS (SELECT id, slot // 16 AS tree, list(v ORDER BY slot) AS vs FROM dsig GROUP BY ALL),
candidates AS (
  SELECT * FROM (
    SELECT qid, scored.id, depth, similarity, row_number() OVER (
      PARTITION BY qid ORDER BY depth DESC, scored.tree, vs, scored.id) AS rank
    FROM scored JOIN slots ON scored.id = slots.id AND scored.tree = slots.tree)
  WHERE rank <= 100),
hits AS (
  SELECT qid, c.id::VARCHAR AS id, title, url, similarity
  FROM candidates c JOIN {docs} USING (id) WHERE similarity > 0.01)"""


_INDEXED = f"""docs AS (
  SELECT page_id AS id, title, url FROM titles WHERE title NOT IN ({_NA})),
asked AS (SELECT page_id AS qid, title AS query FROM titles)"""
_TITLE_FOREST = f"WITH {_TITLES}, {_INDEXED}, {_forest('docs', 'asked')}"
_DOCUMENT_FOREST = f"""WITH docs AS (
  SELECT doc_id AS id, text AS title, source AS url FROM documents
  WHERE text NOT IN ({_NA}) AND len({_words('text')}) > 0),
asked AS (SELECT item_id AS qid, text AS query FROM benchmark),
{_forest('docs', 'asked')}"""

_PLACED = """placed AS (
  SELECT *, row_number() OVER (PARTITION BY qid ORDER BY similarity DESC, id) AS position FROM hits)"""

_LF = "regexp_replace(text, '\\r\\n?', chr(10), 'g')"
_FREQS = f"""freqs AS (
  SELECT scope, ch, count(*) AS freq FROM (
    SELECT lang AS scope, unnest(string_split({_LF}, '')) AS ch FROM documents)
  WHERE ch <> '' GROUP BY ALL)"""

# The queue of a scope is merged step by step: the two lightest entries become one, ties by age.
_CODES = f"""WITH RECURSIVE {_FREQS},
aged AS (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY freq, ch) AS age FROM freqs),
merging AS (
  SELECT scope, list({{'w': freq::BIGINT, 'age': age::BIGINT,
      'leaves': [{{'ch': ch, 'freq': freq::BIGINT, 'code': ''}}]}} ORDER BY freq, age) AS q,
    (count(*) + 1)::BIGINT AS next_age
  FROM aged GROUP BY scope
  UNION ALL
  SELECT scope, list_sort(list_append(q[3:], {{
      'w': q[1].w + q[2].w, 'age': next_age,
      'leaves': list_concat(
        list_transform(q[1].leaves, lambda x: {{'ch': x.ch, 'freq': x.freq, 'code': '0' || x.code}}),
        list_transform(q[2].leaves, lambda x: {{'ch': x.ch, 'freq': x.freq, 'code': '1' || x.code}}))}})),
    next_age + 1
  FROM merging WHERE len(q) > 1),
leaves AS (SELECT scope, unnest(q[1].leaves) AS leaf FROM merging WHERE len(q) = 1),
codes AS (
  SELECT scope, leaf.ch AS ch, leaf.freq AS freq,
    CASE WHEN leaf.code = '' THEN '0' ELSE leaf.code END AS code
  FROM leaves)"""

_REPORT = f"""{_CODES},
sizes AS (
  SELECT scope, sum(freq * length(code))::BIGINT AS coded_bits,
    (sum(CASE WHEN ch IN ('"', '\\', chr(8), chr(9), chr(10), chr(12), chr(13)) THEN 2
        WHEN unicode(ch) BETWEEN 32 AND 126 THEN 1
        WHEN unicode(ch) > 65535 THEN 12 ELSE 6 END + length(code) + 6)
      + (count(*) - 1) * 2 + 2)::BIGINT AS header_bytes
  FROM codes GROUP BY scope),
original AS (SELECT lang AS scope, sum(strlen(text))::BIGINT AS original_bytes FROM documents GROUP BY lang),
report AS (
  SELECT scope, original_bytes, coded_bits, header_bytes,
    (coded_bits + 7) // 8 + 5 + header_bytes AS compressed_bytes
  FROM original JOIN sizes USING (scope))"""

ORACLES: dict[str, str] = {
    "normalize_urls": f"SELECT page_id, {_NORM.format('url')} AS url FROM pages",
    "page_origins": f"""SELECT page_id, regexp_extract(url, '^([a-z]+):', 1) AS scheme,
  {_NETLOC.format('url')} AS netloc, {_ORIGIN.format('url')} AS origin,
  {_ORIGIN.format('url')} || '/robots.txt' AS robots_url FROM pages""",
    "accepted_pages": f"SELECT page_id, url FROM pages WHERE {_ACCEPTED}",
    "page_titles": f"WITH {_TITLES} SELECT page_id, url, title FROM titles",
    "page_links": f"WITH {_LINKS} SELECT page_id, src, dst, pos::INTEGER AS pos FROM links",
    "links_per_domain": f"""WITH {_LINKS} SELECT {_NETLOC.format('dst')} AS netloc,
  count(*) AS links, count(DISTINCT dst) AS targets FROM links GROUP BY 1""",
    "seed_domains": f"WITH {_SEEDS}, {_DOMAINS} SELECT netloc FROM domains",
    "frontier_step": f"""WITH {_LINKS}, {_SEEDS}, {_DOMAINS}
SELECT dst AS url, arg_min(page_id, (page_id, pos)) AS parent_pos,
  arg_min(pos, (page_id, pos))::INTEGER AS link_pos
FROM links WHERE {_NETLOC.format('dst')} IN (SELECT netloc FROM domains)
  AND dst NOT IN (SELECT {_NORM.format('url')} FROM pages) GROUP BY dst""",
    "visited_after_step": f"""WITH {_LINKS}, {_SEEDS}, {_DOMAINS}
SELECT {_NORM.format('url')} AS url FROM seeds UNION
SELECT dst FROM links WHERE {_NETLOC.format('dst')} IN (SELECT netloc FROM domains)""",
    "robots_filter": f"""SELECT page_id, url FROM (
  SELECT page_id, {_NORM.format('url')} AS url FROM pages) WHERE {_allowed('url')}""",
    "robots_many_rules": """WITH own AS (
  SELECT page_id, page_id // 500 AS site, regexp_extract(url, '://[^/]+(/[A-Za-z0-9/._-]*)', 1) AS path FROM pages),
asked AS (SELECT * FROM own WHERE length(path) > 3),
rules AS (SELECT site, page_id AS place, page_id % 3 = 0 AS allow,
    CASE WHEN page_id % 3 = 0 THEN path ELSE left(path, length(path) - 1) END AS prefix FROM asked),
met AS (SELECT a.page_id, arg_min(r.allow, r.place) AS allow FROM asked a
  JOIN rules r ON r.site = a.site AND starts_with(a.path, r.prefix) GROUP BY a.page_id)
SELECT page_id, 'http://s' || site || '.example.com' || path AS url FROM asked JOIN met USING (page_id) WHERE allow""",
    "crawl_levels": f"""WITH {_TITLES}
SELECT url, 0 AS depth, min(page_id) AS page_id, arg_min(title, page_id) AS title
FROM titles WHERE {_IS_SEED} GROUP BY url""",
    "crawl_counters": f"""WITH {_LINKS}, {_SEEDS}, {_DOMAINS},
own AS (SELECT DISTINCT {_NORM.format('url')} AS url FROM seeds)
SELECT (SELECT count(*) FROM own) AS pages_crawled, count(*) AS unique_urls FROM (
  SELECT url FROM own UNION SELECT dst FROM links
  WHERE src IN (SELECT url FROM own) AND {_NETLOC.format('dst')} IN (SELECT netloc FROM domains))""",
    "crawl_with_robots": f"""WITH {_TITLES},
ok AS (SELECT page_id FROM pages WHERE {_ACCEPTED})
SELECT url, arg_min(title, page_id) AS title FROM titles
WHERE page_id IN (SELECT page_id FROM ok) AND {_IS_SEED} AND {_allowed('url')} GROUP BY url""",
    "title_tokens": f"""WITH {_TITLES} SELECT page_id, len({_words('title')})::INTEGER AS n_tokens,
  array_to_string(list_sort({_words('title')}), ' ') AS words FROM titles""",
    "document_tokens": f"""SELECT doc_id, len({_words('text')})::INTEGER AS n_tokens,
  md5(coalesce(array_to_string(list_sort({_words('text')}), ' '), '')) AS words_md5 FROM documents""",
    "dedup_last": f"""SELECT conv_id::VARCHAR AS id, min(turn) AS pos,
  arg_max(text, turn) AS title, arg_max(role, turn) AS url FROM conversations
WHERE text NOT IN ({_NA}) AND len({_words('text')}) > 0 GROUP BY conv_id""",
    "index_counts": f"""SELECT count(DISTINCT doc_id) AS documents FROM documents
WHERE text NOT IN ({_NA}) AND len({_words('text')}) > 0""",
    "minhash_signatures": f"""WITH {_signatures('sig', 'documents', 'doc_id', 'text')}
SELECT doc_id, string_agg(v::VARCHAR, ',' ORDER BY slot) AS signature FROM sig GROUP BY doc_id""",
    "forest_keys_of_titles": f"""WITH {_TITLES}, {_INDEXED},
{_signatures('sig', 'docs', 'id', 'title')}
SELECT id::VARCHAR AS id, (slot // 16)::INTEGER AS tree, min(v) FILTER (WHERE slot % 16 = 0) AS k0,
  string_agg(printf('%08X', v), '' ORDER BY slot) AS slots FROM sig GROUP BY 1, 2""",
    "jaccard_pairs": f"""WITH turns AS (
  SELECT conv_id, turn, row_number() OVER () AS n, text, {_words('text')} AS words FROM conversations),
{_signatures('sig', 'turns', 'n', 'text')},
pairs AS (
  SELECT a.conv_id, a.turn, a.n AS an, b.n AS bn, a.words AS aw, b.words AS bw
  FROM turns a JOIN turns b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1),
equal_slots AS (
  SELECT an, bn, count(*) AS same FROM pairs
  JOIN sig x ON x.n = an JOIN sig y ON y.n = bn AND y.slot = x.slot AND y.v = x.v GROUP BY ALL)
SELECT conv_id, turn, coalesce(same, 0) / 128.0 AS estimate,
  CASE WHEN len(aw) + len(bw) = 0 THEN 0.0 ELSE
    len(list_intersect(aw, bw))::DOUBLE / len(list_distinct(list_concat(aw, bw))) END AS exact
FROM pairs LEFT JOIN equal_slots USING (an, bn)""",
    "forest_candidates": f"""{_TITLE_FOREST}
SELECT qid, id::VARCHAR AS id, depth::INTEGER AS depth, rank::INTEGER AS rank FROM candidates""",
    "search_titles": f"{_TITLE_FOREST} SELECT qid, id, title, url, similarity FROM hits",
    "search_documents": f"""{_DOCUMENT_FOREST}
SELECT qid, id, url, similarity, md5(title) AS title_md5 FROM hits""",
    "search_saved_index": f"{_DOCUMENT_FOREST} SELECT qid, id, similarity FROM hits",
    "search_updated_index": f"{_DOCUMENT_FOREST} SELECT qid, id, similarity FROM hits",
    "search_streamed_index": f"{_TITLE_FOREST} SELECT qid, id, title, url, similarity FROM hits",
    "container_files": """WITH texts AS (
  SELECT conv_id, regexp_replace(string_agg(coalesce(role, '') || ': ' || coalesce(text, ''), chr(10) ORDER BY turn NULLS FIRST, role, text),
    '\r\n?', chr(10), 'g') AS text FROM conversations GROUP BY conv_id)
SELECT conv_id, length(text)::INTEGER AS chars, md5(text) AS text_md5 FROM texts""",
    "search_json": f"""{_TITLE_FOREST} SELECT qid, to_json({{
  'id': id, 'title': title, 'url': url, 'similarity': similarity}})::VARCHAR AS result FROM hits""",
    "search_positions": f"""{_TITLE_FOREST}, {_PLACED}
SELECT qid, id, similarity, position::INTEGER AS position, ((position - 1) // 10)::INTEGER AS page FROM placed""",
    "search_page": f"""{_TITLE_FOREST}, {_PLACED}
SELECT qid, id, position::INTEGER AS position, printf('[%.1f%%] %s', similarity * 100, title) AS label
FROM placed WHERE (position - 1) // 10 = 1""",
    "page_counts": f"""{_TITLE_FOREST} SELECT qid, count(*) AS results,
  ceil(count(*) / 10)::BIGINT AS pages FROM hits GROUP BY qid""",
    "crawl_two_levels": f"WITH {_CRAWL} SELECT url, depth FROM crawled",
    "crawl_resumed": f"WITH {_CRAWL} SELECT url, depth FROM crawled",
    "crawl_limit": f"WITH {_CRAWL} SELECT url, depth FROM crawled ORDER BY depth, place LIMIT 60",
    "whole_file_frequencies": f"""WITH {_FREQS} SELECT scope, ch, sum(freq)::BIGINT AS freq FROM (
      SELECT scope, ch, freq FROM freqs
      UNION ALL SELECT lang, chr(10), count(*) FROM documents GROUP BY lang) GROUP BY ALL""",
    "stream_remembered_urls": f"WITH {_TITLES} SELECT DISTINCT url FROM titles",
    "stream_recent_urls": f"WITH {_TITLES} SELECT DISTINCT url FROM titles",
    "char_frequencies": f"WITH {_FREQS} SELECT scope, ch, freq FROM freqs",
    "huffman_codes": f"{_CODES} SELECT scope, ch, freq, code, length(code)::INTEGER AS code_len FROM codes",
    "code_listing": f"""{_CODES} SELECT scope, CASE ch WHEN chr(10) THEN '''\\n'''
  WHEN chr(9) THEN '''\\t''' ELSE '''' || ch || '''' END AS char, code, length(code)::INTEGER AS code_len FROM codes""",
    "total_coded_bits": f"""{_CODES} SELECT scope, count(*) AS symbols,
  sum(freq * length(code))::BIGINT AS coded_bits FROM codes GROUP BY scope""",
    "code_table_sizes": f"""{_CODES} SELECT scope, count(*)::INTEGER AS symbols,
  sum(length(code))::INTEGER AS code_chars FROM codes GROUP BY scope""",
    "compression_report": f"""{_REPORT} SELECT *,
  (1 - compressed_bytes / original_bytes) * 100 AS saving_pct FROM report""",
    "compressed_documents": f"""{_CODES},
tables AS (SELECT scope, map(list(ch), list(code)) AS table_of FROM codes GROUP BY scope),
coded AS (
  SELECT doc_id, array_to_string(
    list_transform(string_split({_LF}, ''), lambda c: table_of[c]), '') AS bits
  FROM documents JOIN tables ON scope = lang),
padded AS (
  SELECT doc_id, (8 - length(bits) % 8) % 8 AS padding,
    (bits || repeat('0', ((8 - length(bits) % 8) % 8)::BIGINT))::BIT::BLOB AS body FROM coded)
SELECT doc_id, padding::INTEGER AS padding, octet_length(body)::INTEGER AS payload_bytes, md5(body) AS payload_md5 FROM padded""",
    "codec_roundtrip": f"SELECT doc_id, {_LF} = text AS equal, md5({_LF}) AS text_md5 FROM documents",
    "single_file_roundtrip": f"SELECT conv_id, turn, md5({_LF}) AS text_md5 FROM conversations",
    "titles_from_containers": f"""WITH {_TITLES}
SELECT page_id AS id, url, nullif(title, '') AS title FROM titles""",

    "titles_from_container_files": f"""WITH {_TITLES}
SELECT page_id AS id, url, nullif(title, '') AS title FROM titles""",
    "multiline_csv": """SELECT page_id, nullif(url, '') AS url, length(coalesce(html, ''))::INTEGER AS chars,
  md5(coalesce(html, '')) AS html_md5 FROM pages""",
    "titles_from_csv": f"""WITH {_TITLES}
SELECT page_id AS id, url, nullif(title, '') AS title FROM titles""",
    "appended_titles": f"WITH {_TITLES} SELECT url, title FROM titles",
    "stream_titles": f"WITH {_TITLES} SELECT page_id, url, title FROM titles",
    "stream_unique_urls": f"WITH {_TITLES} SELECT DISTINCT url FROM titles",
}
