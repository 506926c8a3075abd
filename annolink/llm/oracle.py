"""DuckDB SQL for the queries whose results SQL can express on whole tables.

Language ID, toxicity, token ids and packing need a trained model or the
tokenizer, fuzzy line and word statistics need all pairs, which SQL can't do on whole
tables: these are tested against brute force, exact round trips or held-out
accuracy in ``tests/llm``.
"""

_RULES = [("example.org", "/en/1", "block"), ("example.org", "/es/", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
          ("org", "/", "allow")]


def _first_fit(what: str) -> str:
    whens = []
    for host, path, verdict in _RULES:  # longest first
        name = host + path if what == "rule" else verdict
        whens.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{path}') THEN '{name}'")
    return "CASE " + " ".join(whens) + " END"


URLS = f"""
WITH u AS (SELECT page_id,
             translate(coalesce(regexp_extract(url, '://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
c AS (SELECT *, CASE WHEN host <> '' THEN regexp_replace(host, '^(www|m)\\.', '') ||
                    regexp_replace(regexp_replace(path, '/+$', ''), '\\.html?$', '') END AS canonical FROM u),
l AS (SELECT canonical FROM c WHERE canonical IS NOT NULL GROUP BY canonical HAVING count(*) >= 2)
SELECT page_id, host, path, {_first_fit('rule')} AS rule,
       coalesce({_first_fit('verdict')}, CASE WHEN l.canonical IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       l.canonical IS NOT NULL AS listed
FROM c LEFT JOIN l ON c.canonical = l.canonical"""

_WORDS = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{}')"

#: Items have at least one word; those of fewer than 13 are one window.
CONTAMINATION = f"""
WITH i AS (SELECT item_id, {_WORDS.format('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM benchmark WHERE item_id IS NOT NULL),
wi AS (SELECT DISTINCT item_id, array_to_string(w[s:s + n - 1], ' ') AS phrase, n
       FROM (SELECT item_id, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS.format('[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM wi),
g AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS phrase
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT g.doc_id, g.s, g.n, wi.item_id FROM g JOIN wi ON g.n = wi.n AND g.phrase = wi.phrase),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN t ON d.doc_id = t.doc_id"""

#: All pairs by shared shingles, for tables of the correctness size.
JACCARD = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                              '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) c ON c.node = w.doc_id"""

EMBEDDINGS = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
                     WHERE label IS NOT NULL AND len(embedding) > 0
                       AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
                       AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id < b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT vec_id AS node, vec_id AS root FROM embeddings UNION SELECT e.b, r.root FROM r JOIN e ON r.node = e.a)
SELECT x.vec_id, coalesce(k.n, 0) AS n_links, c.component_id, c.component_id = x.vec_id AS kept
FROM embeddings x LEFT JOIN (SELECT a, count(*) AS n FROM e GROUP BY a) k ON k.a = x.vec_id
JOIN (SELECT node, min(root) AS component_id FROM r GROUP BY node) c ON c.node = x.vec_id"""


def _crc32(text: str) -> str:
    """The unsigned crc32 of a text's UTF-8 bytes, bit by bit."""
    octets = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda x: CAST('0x' || x AS BIGINT))"
    steps = f"flatten(list_transform({octets}, lambda b: [b, -1, -1, -1, -1, -1, -1, -1, -1]))"
    bit = "lambda c, e: CASE WHEN e >= 0 THEN xor(c, e) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {steps}), {bit}), 4294967295)"


def _repair_edges() -> str:
    """(state, initial, inserts and edit, cost, next state, inserted lines, new role): one row's
    edits after up to two inserts.  States and initials: 0 nothing or other, 1 s, 2 u, 3 a; -1 must go."""
    after = {0: 2, 1: 2, 2: 3, 3: 2}
    role = {2: "user", 3: "assistant"}
    keeps = {(0, 1): 1, (0, 2): 2, (1, 2): 2, (3, 2): 2, (2, 3): 3}
    out = []
    for state in range(4):
        at, lines = state, ""
        for n in range(3):
            for cls in (-1, 0, 1, 2, 3):
                out.append((state, cls, "I" * n + "D", 3 * n + 4, at, lines, None))
                if cls >= 0:
                    out.append((state, cls, "I" * n + "R", 3 * n + 3, after[at], lines, role[after[at]]))
                    if (at, cls) in keeps:
                        out.append((state, cls, "I" * n + "K", 3 * n, keeps[at, cls], lines, None))
            at = after[at]
            lines += role[at] + ":|"
    text = lambda x: "NULL" if x is None else f"'{x}'" if isinstance(x, str) else str(x)
    return ", ".join("(" + ", ".join(map(text, row)) + ")" for row in out)


#: Forward over the rows, the least (cost, audit) of each state; the repaired lines go along.
REPAIR = f"""
WITH RECURSIVE
f AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
             {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS fault FROM conversations),
d AS (SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
             CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
             unnest(CASE WHEN fault = 3 THEN [0, 1] ELSE [0] END) AS copy FROM f WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn,
             row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
             regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS ink FROM d),
r AS (SELECT *, ink = '' AS blank, ink <> '' AND again AS duplicate, ink <> '' AND NOT again AND right(ink, 1) NOT IN ('.', '!', '?') AS truncated,
             lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || left(role, 1) NOT IN ('su', 'ua', 'au') AS illegal,
             CASE WHEN ink = '' OR again THEN -1 WHEN role LIKE 's%' THEN 1 WHEN role LIKE 'u%' THEN 2 WHEN role LIKE 'a%' THEN 3 ELSE 0 END AS cls FROM n),
e(q, cls, ops, cost, t, ins, new_role) AS (VALUES {_repair_edges()}),
w AS (SELECT coalesce(conv_id, -9223372036854775808) AS conv, 1 AS rn, 0 AS q, {{'c': 0, 'a': '', 'o': ''}} AS v FROM r WHERE rn = 1
      UNION ALL
      SELECT w.conv, w.rn + 1, e.t, min({{'c': w.v.c + e.cost + CASE WHEN r.truncated AND NOT ends_with(e.ops, 'D') THEN 3 ELSE 0 END, 'a': w.v.a || e.ops,
             'o': w.v.o || replace(e.ins, '|', chr(10)) || CASE WHEN ends_with(e.ops, 'D') THEN '' ELSE coalesce(e.new_role, r.role) || ':' || r.text || chr(10) END}})
      FROM w JOIN r ON coalesce(r.conv_id, -9223372036854775808) = w.conv AND r.rn = w.rn JOIN e ON e.q = w.q AND e.cls = r.cls GROUP BY 1, 2, 3),
z AS (SELECT conv, rn, min({{'c': v.c + CASE q WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 'a': v.a || CASE q WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END,
             'o': v.o || CASE q WHEN 1 THEN 'user:' || chr(10) || 'assistant:' || chr(10) WHEN 2 THEN 'assistant:' || chr(10) ELSE '' END}}) AS v FROM w GROUP BY 1, 2),
s AS (SELECT coalesce(conv_id, -9223372036854775808) AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
             count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE truncated) AS truncated,
             count(*) FILTER (WHERE illegal) AS illegal, max(rn) + 1 AS last FROM r GROUP BY 1),
c AS (SELECT DISTINCT conv_id FROM conversations)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(coalesce(z.v.c, 0) AS BIGINT) AS cost, coalesce(z.v.a, '') AS audit,
       sha256(coalesce(left(z.v.o, greatest(length(z.v.o) - 1, 0)), '')) AS repaired_sha256
FROM c LEFT JOIN s ON s.conv = coalesce(c.conv_id, -9223372036854775808) LEFT JOIN z ON z.conv = s.conv AND z.rn = s.last"""


def _escaped(text: str) -> str:
    return f"""regexp_replace({text}, '([<\\[])(\\\\*)(<SYS>>|</SYS>>|INST\\]|/INST\\]|s>|/s>|ROLE\\]|TEXT\\]|/ROLE\\])', '\\1\\\\\\2\\3', 'g')"""


CHAT = f"""
WITH r AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
n AS (SELECT *, row_number() OVER o AS k, lag(role) OVER o AS before FROM r WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
f AS (SELECT *, length({_escaped('text')}) + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
                                             ELSE 19 + length({_escaped('role')}) END AS chars,
             coalesce(before, '') || '>' || role NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user') AS fault FROM n)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars, NOT bool_or(fault) AND arg_max(role, k) = 'assistant' AS valid,
       min(k - 1) FILTER (WHERE fault) AS first_fault
FROM f GROUP BY conv_id"""

#: Near: equal when one word loses a code point, or both lose the one at the same place.
SPELLING = f"""
WITH RECURSIVE
t AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
u AS (SELECT run, c, {_crc32("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM (SELECT doc_id, run, count(*) AS c FROM t GROUP BY 1, 2)),
w AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
        SELECT CASE WHEN h % 97 = 0 THEN left(run, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, c FROM u)
      WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
d AS (SELECT word, n, i, left(word, CAST(i AS INTEGER)) || substr(word, CAST(i AS INTEGER) + 2) AS less FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM w)),
p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT a.word, b.word, b.n FROM w a JOIN d b ON a.word = b.less
      UNION SELECT b.word, a.word, a.n FROM w a JOIN d b ON a.word = b.less),
b AS (SELECT word, count(*) AS n_near, min({{'less': -near_n, 'near': near}}) AS best FROM p GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 2 * w.n THEN best.near END AS form,
             CASE WHEN -best.less >= 2 * w.n THEN -best.less END AS form_n FROM w LEFT JOIN b ON w.word = b.word),
r AS (SELECT word, word AS root, 0 AS depth FROM f UNION ALL SELECT r.word, f.form, r.depth + 1 FROM r JOIN f ON f.word = r.root WHERE f.form IS NOT NULL)
SELECT f.word, f.form, x.root, f.n, f.n_near, f.form_n FROM f JOIN (SELECT word, arg_max(root, depth) AS root FROM r GROUP BY word) x ON x.word = f.word"""

ORACLE: dict[str, str] = {"op5_ngram_join": JACCARD, "op6_embedding_dedup": EMBEDDINGS, "op9_url_filters": URLS,
                          "op10_decontamination": CONTAMINATION, "op11_conversation_repair": REPAIR, "op12_chat_format": CHAT, "op13_spelling_variants": SPELLING}
