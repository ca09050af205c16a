"""DuckDB SQL for the operators whose whole result SQL can express on small tables."""

from __future__ import annotations

# Words as the operators take them: A-Z folded, then runs of digits, a-z and all past ASCII.
WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

# Every string of 400 bytes, in hexadecimal.
SUFFIX_DEDUP = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS bytes, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
starts AS (
    SELECT doc_id, p, md5(substr(bytes, 2 * p + 1, 800)) AS string
    FROM (SELECT doc_id, bytes, unnest(range(n - 399)) AS p FROM texts WHERE n >= 400)
), twice AS (
    SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY string) AS c FROM starts) WHERE c > 1
), marked AS (
    SELECT doc_id, p, p > 400 + lag(p, 1, -1000) OVER (PARTITION BY doc_id ORDER BY p) AS opens FROM twice
), numbered AS (
    SELECT doc_id, p, sum(CAST(opens AS INTEGER)) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), runs AS (SELECT doc_id, run, min(p) AS a, max(p) + 400 AS b FROM numbered GROUP BY doc_id, run),
kept AS (
    SELECT doc_id, substr(bytes, 2 * from_ + 1, 2 * (a - from_)) AS piece, a
    FROM (SELECT doc_id, a, lag(b, 1, 0) OVER (PARTITION BY doc_id ORDER BY a) AS from_
          FROM (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, n, n FROM texts))
    JOIN texts USING (doc_id)
), joined AS (SELECT doc_id, string_agg(piece, '' ORDER BY a) AS left_ FROM kept GROUP BY doc_id),
sums AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id)
SELECT doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(left_)) AS kept_sha256
FROM texts JOIN joined USING (doc_id) LEFT JOIN sums USING (doc_id)
"""

DECONTAMINATE = f"""
WITH spoken AS (SELECT doc_id, {WORDS} AS ws FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {WORDS} AS ws FROM benchmark),
sized AS (SELECT item, ws, least(10, len(ws)) AS n FROM items WHERE len(ws) > 0),
patterns AS (
    SELECT DISTINCT item, n, array_to_string(ws[i:i + n - 1], ' ') AS gram
    FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS i FROM sized)
), grams AS (
    SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS gram
    FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
          FROM spoken CROSS JOIN (SELECT DISTINCT n FROM patterns))
), hits AS (SELECT doc_id, n, i, item FROM grams JOIN patterns USING (n, gram)),
hit_words AS (SELECT doc_id, count(DISTINCT place) AS n_hit
              FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM hits) GROUP BY doc_id),
hit_items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
              FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM spoken LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

# All pairs of classes that share an n-gram, and what links lead to.
NGRAM_JOIN = f"""
WITH RECURSIVE spoken AS (SELECT doc_id, {WORDS} AS ws FROM documents),
sets AS (
    SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(ws) - least(5, len(ws)) + 2),
             lambda i: array_to_string(ws[i:i + least(5, len(ws)) - 1], ' ')))) AS grams
    FROM spoken
), classes AS (
    SELECT CASE WHEN ws_none THEN [] ELSE grams END AS grams, min(doc_id) AS class_id, count(*) AS class_size
    FROM (SELECT s.doc_id, s.grams, len(w.ws) = 0 AS ws_none FROM sets s JOIN spoken w USING (doc_id))
    GROUP BY 1
), members AS (SELECT class_id, len(grams) AS n, unnest(grams) AS gram FROM classes),
links AS (
    SELECT a.class_id AS a, b.class_id AS b
    FROM members a JOIN members b ON a.gram = b.gram AND a.class_id <> b.class_id
    GROUP BY a.class_id, b.class_id, a.n, b.n
    HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))
), reached AS (
    SELECT class_id AS head, class_id FROM classes
    UNION
    SELECT head, b FROM reached JOIN links ON a = class_id WHERE head < b
), heads AS (SELECT class_id, min(head) AS head FROM reached GROUP BY class_id),
known AS (
    SELECT grams, c.class_id, class_size, head, (SELECT count(*) FROM links WHERE a = c.class_id) AS n_links
    FROM classes c JOIN heads USING (class_id)
)
SELECT s.doc_id, k.class_id, k.class_size, k.n_links,
       CASE WHEN len(w.ws) = 0 THEN s.doc_id ELSE head END AS group_id,
       len(w.ws) = 0 OR s.doc_id = head AS stays
FROM sets s JOIN spoken w USING (doc_id)
JOIN known k ON k.grams = CASE WHEN len(w.ws) = 0 THEN [] ELSE s.grams END
"""

#: crc32 is folded bit by bit; a prefix is named by the joined digests of its turns.
PREFIX_TRIE = """
WITH turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS pos, digest, words
    FROM (SELECT conv_id, turn,
                 sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest,
                 len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
          FROM conversations WHERE conv_id IS NOT NULL)
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS family,
           xor(list_reduce(list_prepend(4294967295::BIGINT,
                   list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
               lambda acc, x: list_reduce(list_prepend(xor(acc, x), range(8)),
                   lambda a, k: xor(a >> 1, CASE WHEN a % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295::BIGINT) % 4 AS h
    FROM (SELECT DISTINCT conv_id FROM turns)
), rebuilt AS (
    SELECT c.conv_id, row_number() OVER (PARTITION BY c.conv_id ORDER BY part, t.pos) AS pos, digest, words
    FROM convs c JOIN (SELECT 0 AS part, * FROM turns UNION ALL SELECT 1, * FROM turns) t
      ON (part = 0 AND t.conv_id = c.family AND t.pos <= c.h) OR (part = 1 AND t.conv_id = c.conv_id AND t.pos > c.h)
), prefixes AS (
    SELECT conv_id, pos AS depth, words,
           string_agg(digest, '') OVER (PARTITION BY conv_id ORDER BY pos) AS name,
           pos = count(*) OVER (PARTITION BY conv_id) AS ended
    FROM rebuilt
    UNION ALL
    SELECT conv_id, 0, 0, '', conv_id NOT IN (SELECT conv_id FROM rebuilt) FROM convs
), nodes AS (
    SELECT depth, sha256(name) AS name, min(conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends_sha256
    FROM prefixes GROUP BY depth, name
), named AS (
    SELECT p.conv_id AS member, n.* FROM prefixes p JOIN nodes n ON n.depth = p.depth AND n.name = sha256(p.name)
), paths AS (
    SELECT below.depth, below.conv_id, below.n_convs, below.words, above.depth AS up_depth, above.conv_id AS up_id
    FROM nodes below JOIN named above ON above.member = below.conv_id AND above.depth <= below.depth
), children AS (
    SELECT up_id AS conv_id, up_depth AS depth, count(*) AS n_children FROM paths WHERE depth = up_depth + 1 GROUP BY ALL
), sums AS (
    SELECT up_id AS conv_id, up_depth AS depth, count(*) FILTER (n_children IS NULL) AS n_leaves,
           sum((n_convs - 1) * words)::BIGINT AS saved_tokens
    FROM paths LEFT JOIN children USING (conv_id, depth) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.up_id AS parent_conv_id, n.n_convs, coalesce(c.n_children, 0) AS n_children,
       s.n_leaves, s.saved_tokens, n.ends_sha256
FROM nodes n JOIN sums s USING (conv_id, depth) LEFT JOIN children c USING (conv_id, depth)
LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth AND p.up_depth = n.depth - 1
"""
