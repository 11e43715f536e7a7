"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

from candela.llm import chat

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(f'coalesce({column}, {chr(39) * 2})')}, '{pattern}')"


def jaccard(size: int, percent: int) -> str:
    """Every pair that shares a shingle, and the closure of the links."""
    return rf"""
WITH RECURSIVE texts AS (
    SELECT doc_id, {_words('text', r'[^\x20\x09-\x0D]+')} AS w FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE WHEN len(w) >= {size}
        THEN list_transform(range(1, len(w) - {size} + 2), lambda i: array_to_string(w[i:i + {size} - 1], ' '))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM texts),
tokens AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS MATERIALIZED (
    SELECT a.doc_id AS x, b.doc_id AS y FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id <> b.doc_id
    GROUP BY 1, 2 HAVING 100 * count(*) >= {percent} * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT doc_id, len(s)::BIGINT AS n_shingles,
    least(doc_id, coalesce((SELECT min(y) FROM reach WHERE x = doc_id), doc_id)) AS component_id
FROM sets"""


def decontamination(window: int, slop: int) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH texts AS MATERIALIZED (SELECT doc_id, {_words('text', pattern)} AS w FROM documents),
items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words('text', pattern)} AS w FROM benchmark),
windows AS MATERIALIZED (
    SELECT DISTINCT item, unnest(CASE WHEN len(w) >= {window}
        THEN list_transform(range(1, len(w) - {window} + 2), lambda i: w[i:i + {window} - 1])
        WHEN len(w) > 0 THEN [w] ELSE [] END) AS g FROM items),
starts AS (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p
    FROM texts, (SELECT DISTINCT len(g) AS k FROM windows) WHERE len(w) >= k),
found AS MATERIALIZED (SELECT doc_id, item, p, k FROM starts JOIN windows ON len(g) = k AND g = w[p:p + k - 1]),
hits AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + k)) AS q FROM found) GROUP BY 1),
held AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS ids FROM found GROUP BY 1),
terms AS (SELECT g, unnest(list_distinct(g)) AS t, len(list_distinct(g)) AS n FROM (SELECT DISTINCT g FROM windows)),
whole AS (
    SELECT doc_id, g FROM terms JOIN (SELECT doc_id, unnest(list_distinct(w)) AS t FROM texts) USING (t)
    GROUP BY doc_id, g HAVING count(*) = any_value(n)),
near AS (
    SELECT doc_id, count(DISTINCT item) AS n FROM (
        SELECT doc_id, g, w, unnest(range(1, greatest(1, len(w) - len(g) - {slop} + 1) + 1)) AS p FROM whole JOIN texts USING (doc_id))
    JOIN windows USING (g) WHERE list_has_all(w[p:p + len(g) + {slop} - 1], g) GROUP BY 1)
SELECT t.doc_id, len(t.w)::BIGINT AS n_words, coalesce(hits.n, 0)::BIGINT AS n_hit, coalesce(held.n, 0)::BIGINT AS n_items,
    sha256(coalesce(held.ids, '')) AS items_sha256, coalesce(hits.n, 0) > 0 AS contaminated,
    coalesce(near.n, 0)::BIGINT AS n_near
FROM texts t LEFT JOIN hits USING (doc_id) LEFT JOIN held USING (doc_id) LEFT JOIN near USING (doc_id)"""


def collocations(least: int, top: int) -> str:
    return rf"""
WITH texts AS (SELECT coalesce(lang, 'und') AS lang, {_LOWER.format("coalesce(text, '')")} AS t FROM documents),
pieces AS (
    SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM texts),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY 1),
grams AS (
    SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: w[i:i + m - 1])) AS g
    FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m),
counted AS MATERIALIZED (SELECT lang, m, g, count(*) AS f FROM grams GROUP BY 1, 2, 3 HAVING count(*) >= {least}),
longer AS (
    SELECT lang, p, max(f) AS f FROM (
        SELECT lang, unnest(flatten(list_transform(range(2, m), lambda k: list_transform(range(1, m - k + 2), lambda i: g[i:i + k - 1])))) AS p, f
        FROM counted WHERE m > 2) GROUP BY 1, 2),
kept AS (SELECT c.* FROM counted c LEFT JOIN longer x ON x.lang = c.lang AND x.p = c.g
         WHERE c.m > 1 AND (x.f IS NULL OR 100 * x.f < 100 * c.f)),
cuts AS (SELECT lang, g, f, k, g[1:k] AS a, g[k + 1:m] AS b FROM (SELECT *, unnest(range(1, m)) AS k FROM kept)),
scored AS (
    SELECT c.lang, c.g, c.f AS a, c.k, x.f AS l, y.f AS r, t.n, (1000::HUGEINT * c.f * t.n) // (x.f::HUGEINT * y.f) AS score
    FROM cuts c JOIN counted x ON x.lang = c.lang AND x.g = c.a JOIN counted y ON y.lang = c.lang AND y.g = c.b
    JOIN totals t ON t.lang = c.lang),
best AS (
    SELECT *, array_to_string(g, ' ') AS phrase FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best) WHERE rank <= {top}"""


#: crc32 of the decimal digits of c, bit by bit
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii((c::VARCHAR)[i])::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
    lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

TRIE = f"""
WITH own AS (
    SELECT conv_id AS c, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, ''))
        ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
    FROM conversations WHERE conv_id IS NOT NULL GROUP BY 1),
hashed AS (SELECT c, t, {_CRC} % 6 AS h FROM own),
built AS MATERIALIZED (
    SELECT x.c, list_concat(coalesce(b.t, [])[1:x.h], x.t[x.h + 1:]) AS t
    FROM hashed x LEFT JOIN own b ON b.c = x.c - ((x.c % 100) + 100) % 100),
members AS (SELECT c, t[1:d] AS p, d, d = len(t) AS ends FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM built)),
nodes AS MATERIALIZED (
    SELECT p, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
        coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '') AS ids FROM members GROUP BY p),
kids AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
own_sums AS (
    SELECT x.p, x.depth, (coalesce(k.n, 0) = 0)::BIGINT AS leaf, CASE WHEN x.depth = 0 THEN 0 ELSE (x.n_convs - 1) * length(x.p[x.depth].t) END AS saved
    FROM nodes x LEFT JOIN kids k ON k.p = x.p),
sums AS (
    SELECT p[1:d] AS p, sum(leaf) AS leaves, sum(saved) AS saved
    FROM (SELECT p, leaf, saved, unnest(range(0, depth + 1)) AS d FROM own_sums) GROUP BY 1)
SELECT x.conv_id, x.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, x.n_convs::BIGINT AS n_convs, coalesce(k.n, 0)::BIGINT AS n_children,
    s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(x.ids) AS ends_sha256
FROM nodes x JOIN sums s ON s.p = x.p LEFT JOIN kids k ON k.p = x.p
LEFT JOIN nodes up ON x.depth > 0 AND up.p = x.p[1:x.depth - 1] AND up.depth = x.depth - 1"""


def build() -> dict[str, str]:
    return {
        "op1_jaccard": jaccard(4, 85),
        "op5_decontamination": decontamination(10, 2),
        "op8_chat": chat.ORACLE_SQL,
        "op11_collocations": collocations(100, 2000),
        "op12_trie": TRIE,
    }
