"""DuckDB SQL computing, straight from the given tables, what each registered
query must return.  Written independently of the Spark code path: offsets via
window sums over ``unnest``, edit distance via DuckDB's ``levenshtein`` on the
ASCII-only derived strings, JSON results via the recipe they encode.
"""

from __future__ import annotations

TRIM = r"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"

POST0 = """
post0 AS (SELECT doc_id * 1000003 + i AS id, doc_id, i AS piece, text, lang, source, n_chars FROM (
  SELECT doc_id, lang, source, n_chars, unnest(p) AS text, unnest(range(0, len(p))) AS i FROM (
    SELECT *, CASE WHEN text IS NULL OR text = '' OR doc_id % 25 = 7 THEN [text]
                   WHEN regexp_matches(text, '[\\x{10000}-\\x{10FFFF}]') THEN regexp_extract_all(text, '(?s).{1,130}')
                   WHEN doc_id % 5 = 0 THEN regexp_extract_all(text, '(?s).{1,280}')
                   ELSE regexp_extract_all(text, '(?s).{1,260}') END AS p FROM documents)))"""

WORDS = POST0 + """,
d0 AS (SELECT id, text, regexp_extract_all(text, '[A-Za-z]+') AS w,
              string_split_regex(text, '[A-Za-z]+') AS g FROM post0),
w0 AS (SELECT id, unnest(range(0, len(w))) AS pos, unnest(w) AS word, unnest(g[1:len(w)]) AS gap FROM d0),
w1 AS (SELECT id, CAST(pos AS INTEGER) AS pos, word,
              CAST(sum(length(gap) + length(word)) OVER (PARTITION BY id ORDER BY pos
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(word) AS INTEGER) AS "offset"
       FROM w0)"""

ANN = WORDS + """,
ann AS (SELECT id, pos,
          'http://dbpedia.org/resource/' || CASE pos % 3 WHEN 0 THEN word WHEN 1 THEN reverse(word)
                                            ELSE word || '_' || lower(word) END AS uri,
          CAST((id * 11 + pos * 7) % 60 AS INTEGER) AS support,
          word AS surface_form, "offset",
          ((id * 7 + pos * 13) % 100) / CAST(100 AS DOUBLE) AS similarity_score,
          ((id * 3 + pos * 5) % 40) / CAST(100 AS DOUBLE) AS percentage_of_second_rank
        FROM w1 WHERE length(word) >= 5)"""

GATE = """
CASE WHEN {s} IS NULL OR {r} IS NULL OR {u} IS NULL OR {f} IS NULL THEN 'invalid_annotation'
     WHEN {s} < CAST(0.7 AS DOUBLE) THEN 'low_similarity'
     WHEN {r} > CAST(0.1 AS DOUBLE) AND NOT isnan({r}) THEN 'close_second_rank'
     WHEN 4 * levenshtein(replace(split_part({u}, '/', -1), '_', ' '), {f})
          > 3 * greatest(length(replace(split_part({u}, '/', -1), '_', ' ')), length({f}))
          THEN 'far_edit_distance'
     ELSE 'keep' END"""

GATED = ANN + """,
rs AS (SELECT *, 'https://en.wikipedia.org/wiki/' || split_part(uri, '/', -1) AS url, """ + GATE.format(
    s="similarity_score", r="percentage_of_second_rank", u="uri", f="surface_form") + """ AS reason FROM ann),
kept AS (SELECT * FROM rs WHERE reason = 'keep'),
kept_n AS (SELECT id, count(*) AS n FROM kept GROUP BY id)"""

#: Needs POST0 before it.
POSTS_ONLY = """
posts AS (SELECT id, text, lang, id % 97 AS user_id, source AS user_name,
                 CAST(n_chars AS INTEGER) AS followers, CAST(id % 10000 AS INTEGER) AS retweet_count,
                 CAST(n_chars % 100000 AS INTEGER) AS favorite_count,
                 1700000000000 + doc_id * 1000 + piece AS timestamp_ms,
                 length(""" + TRIM.format(x="text") + """) AS units,
                 id % 10 <> 0 OR starts_with(text, '{') AS is_json
          FROM post0)"""

POSTS = POST0 + "," + POSTS_ONLY

SUFFIX = """
sfx AS (SELECT *, ((id % 23) - 1) / CAST(20 AS DOUBLE) AS senti,
               length(""" + TRIM.format(x="text || ' (checked)'") + """) AS units2 FROM posts),
sfx_r AS (SELECT *, CASE WHEN NOT is_json THEN 'passthrough'
                         WHEN units > 280 OR senti < 0 OR senti > 1 OR units2 > 280 THEN 'quarantine'
                         ELSE 'enriched' END AS route,
                    CASE WHEN NOT is_json THEN NULL
                         WHEN units > 280 THEN 'text_too_long'
                         WHEN senti < 0 OR senti > 1 THEN 'sentiment_out_of_range'
                         WHEN units2 > 280 THEN 'text_too_long' END AS reason
          FROM sfx)"""

REPORT = """
CASE WHEN coalesce(k.n, 0) > 0 THEN 'Annotations or tweet: ' || p.id || chr(10) || (
  SELECT string_agg(chr(9) || x.surface_form || repeat(' ', greatest(25 - length(x.surface_form), 0))
                    || 'at ' || x."offset" || ':' || chr(9) || x.url || chr(10), '' ORDER BY x.pos)
  FROM kept x WHERE x.id = p.id) ELSE '' END"""

GAZ = """
gz_txt AS (SELECT text FROM benchmark),
gz_uni AS (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS sf FROM gz_txt),
gz_tok AS (SELECT t, unnest(range(1, len(t))) AS i FROM (SELECT string_split(text, ' ') AS t FROM gz_txt)),
gz_bi AS (SELECT t[i] || ' ' || t[i + 1] AS sf FROM gz_tok
          WHERE regexp_full_match(t[i], '[A-Za-z]{4,}') AND regexp_full_match(t[i + 1], '[A-Za-z]{4,}')),
gz_sf AS (SELECT DISTINCT sf FROM (SELECT sf FROM gz_uni WHERE length(sf) >= 6 UNION ALL SELECT sf FROM gz_bi)),
gaz AS (SELECT sf AS surface_form,
               'http://dbpedia.org/resource/' || CASE WHEN strpos(sf, ' ') > 0 THEN replace(sf, ' ', '_')
                                                 ELSE upper(substr(sf, 1, 1)) || substr(sf, 2) END AS uri,
               CAST(length(sf) * 10 AS INTEGER) AS support,
               ((length(sf) * 7 + ascii(sf)) % 50 + 50) / CAST(100 AS DOUBLE) AS similarity_score,
               (ascii(substr(sf, 2, 1)) % 20) / CAST(100 AS DOUBLE) AS percentage_of_second_rank
        FROM gz_sf)"""

DICT_OF_POSTS = POST0 + "," + GAZ + """,
dt AS (SELECT id, regexp_extract_all(text, '[\\p{L}\\p{N}]+') AS w,
              string_split_regex(text, '[\\p{L}\\p{N}]+') AS g FROM post0),
tk AS (SELECT id, unnest(range(0, len(w))) AS k, unnest(w) AS word, unnest(g[1:len(w)]) AS gap FROM dt),
tk2 AS (SELECT id, k, word,
               sum(length(gap) + length(word)) OVER (PARTITION BY id ORDER BY k
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - length(word) AS start,
               lead(word) OVER (PARTITION BY id ORDER BY k) AS word2,
               lead(gap) OVER (PARTITION BY id ORDER BY k) AS gap2 FROM tk),
grams AS (SELECT id, k, 1 AS n, word AS gram, start FROM tk2
          UNION ALL SELECT id, k, 2 AS n, word || gap2 || word2 AS gram, start FROM tk2 WHERE word2 IS NOT NULL),
cand AS (SELECT g.id, g.k, g.n, g.start, z.*, length(z.surface_form) * 1000000000 - g.start AS score
         FROM grams g JOIN gaz z ON g.gram = z.surface_form),
gl AS (SELECT id, list({'k': k, 'n': n, 'start': start, 'surface_form': surface_form, 'uri': uri, 'support': support,
                        'similarity_score': similarity_score, 'percentage_of_second_rank': percentage_of_second_rank}
                       ORDER BY score DESC) AS l FROM cand GROUP BY id),
gk AS (SELECT id, unnest(list_reduce(l, lambda a, x: CASE
           WHEN len(list_filter(a, lambda y: y.k < x.k + x.n AND x.k < y.k + y.n)) > 0 THEN a
           ELSE list_append(a, x) END, l[1:0])) AS m FROM gl),
dict AS (SELECT id, CAST(m.k AS INTEGER) AS pos, m.surface_form, m.uri, CAST(m.start AS INTEGER) AS "offset", m.support,
                m.similarity_score, m.percentage_of_second_rank FROM gk)"""

#: Over whole documents.
DICT = DICT_OF_POSTS.replace("dt AS (SELECT id,", "dt AS (SELECT doc_id AS id,").replace("AS g FROM post0", "AS g FROM documents")

DICT_GATED = DICT_OF_POSTS + """,
dg AS (SELECT *, """ + GATE.format(s="similarity_score", r="percentage_of_second_rank", u="uri",
                                  f="surface_form") + """ AS reason FROM dict)"""

CLIENT = WORDS + """,
cw AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS pos, word AS surface_form, "offset"
       FROM w1 WHERE length(word) >= 9)"""

ENRICH_STORED = "WITH " + GATED + "," + POSTS_ONLY + """
SELECT p.id AS key,
       CASE WHEN NOT p.is_json THEN 'passthrough' WHEN p.units > 280 THEN 'quarantine' ELSE 'enriched' END AS route,
       CASE WHEN p.is_json AND p.units > 280 THEN 'text_too_long' END AS reason,
       CASE WHEN p.is_json AND p.units <= 280 THEN coalesce(k.n, 0) END AS n_urls,
       CASE WHEN p.is_json AND p.units <= 280 THEN 0 END AS n_hashtags,
       CASE WHEN p.is_json AND p.units <= 280 THEN length(p.text) END AS text_len
FROM posts p LEFT JOIN kept_n k ON p.id = k.id"""

ENRICH_DICTIONARY = "WITH " + DICT_GATED + "," + POSTS_ONLY + """,
dn AS (SELECT id, count(*) AS n FROM dg WHERE reason = 'keep' GROUP BY id)
SELECT p.id AS key,
       CASE WHEN NOT p.is_json THEN 'passthrough' WHEN p.units > 280 THEN 'quarantine' ELSE 'enriched' END AS route,
       CASE WHEN p.is_json AND p.units > 280 THEN 'text_too_long' END AS reason,
       CASE WHEN p.is_json AND p.units <= 280 THEN coalesce(n, 0) END AS n_urls,
       CASE WHEN p.is_json AND p.units <= 280 THEN 0 END AS n_hashtags,
       CASE WHEN p.is_json AND p.units <= 280 THEN length(p.text) END AS text_len
FROM posts p LEFT JOIN dn ON p.id = dn.id"""

ENRICH_CLIENT = "WITH " + CLIENT + "," + POSTS_ONLY + """,
dn AS (SELECT id, count(*) AS n FROM cw GROUP BY id),
r AS (SELECT p.*, coalesce(n, 0) AS n,
             CASE WHEN NOT is_json THEN NULL WHEN units > 280 THEN 'text_too_long'
                  WHEN contains(text, chr(92)) THEN 'client_error: status 500' END AS reason
      FROM posts p LEFT JOIN dn ON p.id = dn.id)
SELECT id AS key, CASE WHEN NOT is_json THEN 'passthrough' WHEN reason IS NOT NULL THEN 'quarantine' ELSE 'enriched' END AS route,
       reason, CASE WHEN is_json AND reason IS NULL THEN n END AS n_urls, CASE WHEN is_json AND reason IS NULL THEN 0 END AS n_hashtags,
       CASE WHEN is_json AND reason IS NULL THEN length(text) END AS text_len FROM r"""

CONSUMED = POSTS + "," + SUFFIX + """,
consumed AS (SELECT id, 0 AS enriched FROM posts WHERE is_json AND units <= 280
             UNION ALL SELECT id, 1 AS enriched FROM sfx_r WHERE route = 'enriched')"""

ORACLE: dict[str, str] = {
    "annotation_links": "WITH " + GATED + """
SELECT id, pos, url, url AS expanded_url, surface_form AS display_url, "offset" AS idx_start,
       "offset" + length(surface_form) AS idx_end FROM kept""",

    "annotation_gate_reason": "WITH " + GATED + "\nSELECT id, pos, reason FROM rs",

    "annotation_gate_counts": "WITH " + GATED + "\nSELECT reason, count(*) AS n FROM rs GROUP BY reason",

    "min_support_confidence": "WITH " + ANN + """
SELECT id, pos, support, confidence FROM (
  SELECT *, ((id + pos) % 100) / CAST(100 AS DOUBLE) AS confidence FROM ann) WHERE support >= 20 AND confidence >= 0.7""",

    "page_label_parts": """
SELECT page_id, split_part(url, '/', -1) AS page, replace(split_part(url, '/', -1), '_', ' ') AS label
FROM pages""",

    "post_links_array": "WITH " + GATED + """
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INTEGER) AS link_idx, url,
       url AS expanded_url, surface_form AS display_url, "offset" AS idx_start,
       "offset" + length(surface_form) AS idx_end FROM kept""",

    "posts_without_links": "WITH " + GATED + """
SELECT d.id, CAST(coalesce(k.n, 0) AS INTEGER) AS n_links, 0 AS n_hashtags
FROM post0 d LEFT JOIN kept_n k ON d.id = k.id""",

    "enrich_stored": ENRICH_STORED,

    "json_guard_drop": "WITH " + POSTS + "\nSELECT id AS key FROM posts WHERE is_json",

    "json_guard_route": "WITH " + POSTS + """
SELECT id AS key, CASE WHEN is_json THEN 'enrich' ELSE 'pass' END AS route FROM posts""",

    "length_check": "WITH u AS (SELECT doc_id AS id, length(" + TRIM.format(x="text") + ") AS units FROM documents)"
                    "\nSELECT id, units, units <= 280 AS within_limit FROM u",

    "decode_posts": "WITH " + POSTS + """
SELECT id AS key, CASE WHEN units > 280 THEN 'text_too_long' END AS reason,
       CASE WHEN units <= 280 THEN id END AS id, CASE WHEN units <= 280 THEN lang END AS lang,
       CASE WHEN units <= 280 THEN user_id END AS user_id,
       CASE WHEN units <= 280 THEN user_name END AS user_name,
       CASE WHEN units <= 280 THEN followers END AS followers,
       CASE WHEN units <= 280 THEN retweet_count END AS retweet_count,
       CASE WHEN units <= 280 THEN favorite_count END AS favorite_count,
       CASE WHEN units <= 280 THEN timestamp_ms END AS timestamp_ms,
       CASE WHEN units <= 280 THEN length(text) END AS text_units
FROM posts WHERE is_json""",

    "roundtrip_posts": "WITH " + POSTS + """
SELECT id AS key, CAST(NULL AS VARCHAR) AS reason, id, lang, user_id, user_name, followers, retweet_count,
       favorite_count, timestamp_ms, length(text) AS text_units, text FROM posts""",

    "decode_annotations": "WITH " + ANN + """
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INTEGER) AS pos, uri, support,
       CASE pos % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS n_types,
       CASE pos % 4 WHEN 0 THEN 'Schema:Place|DBpedia:Place' WHEN 1 THEN 'DBpedia:Person|Schema:Person'
            ELSE '' END AS types_joined,
       surface_form, "offset", similarity_score, percentage_of_second_rank FROM ann""",

    "type_list": "WITH " + ANN + """
SELECT id, pos, CASE pos % 4 WHEN 0 THEN 2 WHEN 1 THEN 2 WHEN 2 THEN 1 ELSE 0 END AS n_types,
       CASE pos % 4 WHEN 0 THEN 'Schema:Place|DBpedia:Place' WHEN 1 THEN 'DBpedia:Person|Schema:Person'
            ELSE '' END AS types_joined,
       CASE pos % 4 WHEN 0 THEN 'Place' WHEN 1 THEN 'Person' ELSE '' END AS type_class FROM ann""",

    "annotation_report": "WITH " + GATED + """
SELECT p.id, """ + REPORT + """ AS report
FROM post0 p LEFT JOIN kept_n k ON p.id = k.id""",

    "text_suffix_enrich": "WITH " + POSTS + "," + SUFFIX + """
SELECT id AS key, route, reason,
       CASE WHEN route = 'enriched' THEN 1 END AS n_urls, CASE WHEN route = 'enriched' THEN 1 END AS n_hashtags,
       CASE WHEN route = 'enriched' THEN length(text) + 10 END AS text_len FROM sfx_r""",

    "sentiment_range_audit": """
SELECT event_type,
       count(*) FILTER (WHERE NOT (value IS NULL OR isnan(value / CAST(200 AS DOUBLE))
                        OR value / CAST(200 AS DOUBLE) < 0 OR value / CAST(200 AS DOUBLE) > 1)) AS n_in_range,
       count(*) FILTER (WHERE value IS NULL OR isnan(value / CAST(200 AS DOUBLE))
                        OR value / CAST(200 AS DOUBLE) < 0 OR value / CAST(200 AS DOUBLE) > 1) AS n_out_of_range
FROM events GROUP BY event_type""",

    "post_datetime": "WITH " + POSTS + """
SELECT id, strftime(make_timestamp(timestamp_ms * 1000), '%Y-%m-%dT%H:%M:%S') AS datetime FROM posts""",

    "topic_fanout": "WITH " + POSTS + """
SELECT t.topic, p.id AS key, lpad(upper(hex(p.id)), 16, '0') AS key_hex, p.is_json
FROM posts p, (VALUES ('raw_twitter_feed'), ('enriched_twitter_feed')) t(topic)""",

    "topic_union": "WITH " + POSTS + "," + SUFFIX + """
SELECT 'raw_twitter_feed' AS topic, id AS key, is_json FROM posts
UNION ALL SELECT 'enriched_twitter_feed' AS topic, id AS key, route = 'enriched' AS is_json
FROM sfx_r WHERE route <> 'quarantine'""",

    "bounded_collect": """
SELECT event_id AS "offset", user_id, props FROM events ORDER BY event_id LIMIT 1000""",

    "delivery_audit": "WITH " + CONSUMED + """
SELECT id, count(*) AS n_copies, CAST(sum(enriched) AS BIGINT) AS n_enriched,
       count(*) = 2 AND sum(enriched) = count(*) AS complete
FROM consumed GROUP BY id""",

    "unknown_ids": "WITH " + CONSUMED + """
SELECT id, count(*) AS n_results FROM consumed WHERE id % 7 = 0 GROUP BY id""",

    "delivery_total": "WITH " + CONSUMED + """
SELECT (SELECT count(*) FROM posts) AS n_inputs, count(*) AS n_delivered,
       count(*) FILTER (WHERE enriched = 1) AS n_rich, 2 * (SELECT count(*) FROM posts) AS n_expected
FROM consumed""",

    "positional_link_diff": "WITH " + GATED + """,
c AS (SELECT d.id, CAST(coalesce(k.n, 0) AS INTEGER) AS n FROM post0 d LEFT JOIN kept_n k ON d.id = k.id)
SELECT id, n AS n_actual,
       CASE WHEN id % 13 = 0 THEN -1 WHEN id % 5 = 1 AND n > 0 THEN n - 1 ELSE n END AS n_expected,
       CASE WHEN id % 13 = 0 THEN -1 WHEN id % 5 = 0 THEN n WHEN id % 5 = 1 AND n > 0 THEN -1 ELSE 0 END AS n_mismatch
FROM c""",

    "track_terms": "WITH " + POST0 + """,
ws AS (SELECT id, string_split_regex(lower(text), '[^\\p{L}\\p{N}]+') AS w FROM post0)
SELECT id FROM ws
WHERE list_has_any(w, ['that', 'with', 'released']) OR (list_contains(w, 'mit') AND list_contains(w, 'license'))""",

    "message_dump_ingest": "WITH " + POSTS.replace("id % 10 <> 0 OR", "id % 1000 <> 2 AND id % 10 <> 0 OR") + """
SELECT CASE WHEN id % 1000 = 2 THEN 'oversize' WHEN NOT is_json THEN 'malformed_json' WHEN units > 280 THEN 'text_too_long' END AS reason,
       CASE WHEN is_json AND units <= 280 THEN id END AS id,
       CASE WHEN is_json AND units <= 280 THEN lang END AS lang,
       CASE WHEN is_json AND units <= 280 THEN user_id END AS user_id,
       CASE WHEN is_json AND units <= 280 THEN user_name END AS user_name,
       CASE WHEN is_json AND units <= 280 THEN followers END AS followers,
       CASE WHEN is_json AND units <= 280 THEN retweet_count END AS retweet_count,
       CASE WHEN is_json AND units <= 280 THEN favorite_count END AS favorite_count,
       CASE WHEN is_json AND units <= 280 THEN timestamp_ms END AS timestamp_ms,
       CASE WHEN is_json AND units <= 280 THEN length(text) END AS text_units
FROM posts WHERE """ + TRIM.format(x="text") + " <> ''",

    "dictionary_annotate": "WITH " + DICT + """
SELECT id, pos, surface_form, uri, "offset", support FROM dict""",

    "dictionary_links": "WITH " + DICT_GATED + """
SELECT id, CAST(row_number() OVER (PARTITION BY id ORDER BY pos) - 1 AS INTEGER) AS link_idx,
       'https://en.wikipedia.org/wiki/' || split_part(uri, '/', -1) AS url,
       'https://en.wikipedia.org/wiki/' || split_part(uri, '/', -1) AS expanded_url,
       surface_form AS display_url, "offset" AS idx_start, "offset" + length(surface_form) AS idx_end
FROM dg WHERE reason = 'keep'""",

    "stream_enrich": ENRICH_STORED,

    "stream_report": "WITH " + GATED + "," + POSTS_ONLY + """
SELECT p.id, """ + REPORT + """ AS report
FROM posts p LEFT JOIN kept_n k ON p.id = k.id WHERE p.is_json AND p.units <= 280""",

    "client_annotate": "WITH " + CLIENT + """
SELECT w.id, CAST(w.pos AS INTEGER) AS pos, w.surface_form, w."offset", CAST(NULL AS VARCHAR) AS reason
FROM cw w JOIN post0 d ON d.id = w.id WHERE NOT contains(d.text, chr(92))
UNION ALL SELECT id, NULL, NULL, NULL, 'client_error: status 500' FROM post0 WHERE contains(text, chr(92))""",

    "enrich_dictionary": ENRICH_DICTIONARY,

    "stream_enrich_dictionary": ENRICH_DICTIONARY,

    "enrich_client": ENRICH_CLIENT,

    "track_terms_join": "WITH " + POST0 + """,
t AS (SELECT item_id, w FROM (SELECT item_id, string_split_regex(text, '[^A-Za-z]+') AS w FROM benchmark) WHERE len(w) > 4),
ws AS (SELECT id, string_split_regex(lower(text), '[^\\p{L}\\p{N}]+') AS d,
              regexp_extract_all(lower(text), '[#@][\\p{L}\\p{N}]+') AS m FROM post0)
SELECT DISTINCT id FROM ws JOIN t ON CASE item_id % 3
  WHEN 0 THEN list_contains(d, lower(w[2]))
  WHEN 1 THEN list_contains(d, lower(w[2])) AND list_contains(d, lower(w[4]))
  ELSE list_contains(m, '#' || lower(w[2])) END""",

    "stream_topics": "WITH " + CONSUMED + """
SELECT CASE WHEN enriched = 1 THEN 'enriched_twitter_feed' ELSE 'raw_twitter_feed' END AS topic, c.id,
       length(p.text) + 10 * enriched AS units
FROM consumed c JOIN posts p ON p.id = c.id""",

    "stream_track_landing": "WITH " + POSTS + """,
m AS (SELECT id, CASE WHEN id % 10 = 0 THEN 'malformed_json' WHEN id % 1000 = 2 THEN 'oversize' WHEN units > 280 THEN 'text_too_long' END AS reason,
             string_split_regex(lower(text), '[^\\p{L}\\p{N}]+') AS w FROM posts)
SELECT 'accepted' AS sink, id, NULL AS reason, CAST(1 AS BIGINT) AS n FROM m
WHERE reason IS NULL AND (list_has_any(w, ['that', 'with', 'released']) OR (list_contains(w, 'mit') AND list_contains(w, 'license')))
UNION ALL SELECT 'rejected' AS sink, NULL AS id, reason, count(*) AS n FROM m WHERE reason IS NOT NULL GROUP BY reason""",

    "stream_drain": """
SELECT event_id AS "offset", user_id, props, CASE WHEN row_number() OVER (ORDER BY event_id) <= 1000 THEN 1 ELSE 2 END AS run
FROM events ORDER BY event_id LIMIT 2000""",

    "stream_report_text": "WITH " + GATED + "," + POSTS_ONLY + """,
t AS (SELECT p.lang, """ + REPORT + """ AS report FROM posts p LEFT JOIN kept_n k ON p.id = k.id WHERE p.is_json AND p.units <= 280)
SELECT lang, line FROM (SELECT lang, unnest(string_split(report, chr(10))) AS line FROM t) WHERE line <> ''""",

    "roundtrip_entities": "WITH " + POST0 + """,
e AS (SELECT id, lang, regexp_extract_all(text, '[A-Za-z]+')[1:2] AS w FROM post0),
h AS (SELECT id, unnest(range(0, len(w))) AS pos, unnest(w) AS word FROM e WHERE id % 4 <> 3)
SELECT id AS key, 'hashtag' AS kind, CAST(pos AS INTEGER) AS pos, '#' || word AS label, NULL AS url, NULL AS expanded,
       CAST(pos * 100 AS INTEGER) AS "first", CAST(pos * 100 + length(word) AS INTEGER) AS "last" FROM h
UNION ALL SELECT id, 'url', 0, lang, 'https://e.org/?a=1&b=' || id, '<x> "y"', CAST(id % 7 AS INTEGER), CAST(id % 7 + 5 AS INTEGER)
FROM e WHERE id % 4 <> 3 AND id % 3 = 0
UNION ALL SELECT id, 'none', 0, NULL, NULL, NULL, NULL, NULL FROM e WHERE id % 4 = 3""",
}
ORACLE["stream_fanout"] = """WITH """ + POSTS + """
SELECT t.topic, p.id AS key, p.is_json FROM posts p, (VALUES ('raw_twitter_feed'), ('enriched_twitter_feed')) t(topic)"""
