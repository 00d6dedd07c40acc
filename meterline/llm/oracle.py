"""DuckDB SQL that gives the same rows as the queries that SQL can express."""

from __future__ import annotations

from .license_scan import FULL_TEXTS, TEMPLATES, THRESHOLD
from .mixing import HASH_BITS, MAX_REPEAT, WEIGHTS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _ascii_lower(text: str) -> str:
    return f"translate({text}, '{_UPPER}', '{_LOWER}')"


OP1 = f"""
WITH d AS (SELECT doc_id, sha256({_ascii_lower("coalesce(text, '')")}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, d.text_sha256
FROM d JOIN g USING (text_sha256)
"""

def _quoted(text: str) -> str:
    return "'" + " ".join(text.split()).replace("'", "''") + "'"


_MARKS = ", ".join(f"({i}, '{name}', {_quoted(text)})" for i, (name, text) in enumerate(
    [*sorted(TEMPLATES.items()), *sorted(FULL_TEXTS.items())]))

OP2 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(lower(coalesce(text, '')), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
given(t, name, text) AS (VALUES {_MARKS}),
tw AS (SELECT t, name, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM given),
marks AS (SELECT t, w[i] || ' ' || w[i + 1] AS b, min(i) - 1 AS place FROM tw, unnest(range(1, len(w))) AS u(i) GROUP BY t, b),
sizes AS (SELECT t, any_value(name) AS name, any_value(len(w) - 1) AS size, count(*) AS n FROM tw JOIN marks USING (t) GROUP BY t),
b AS (SELECT r, i - 1 AS p, w[i] || ' ' || w[i + 1] AS b FROM d, unnest(range(1, greatest(len(w), 1))) AS u(i)),
-- every window that begins where an occurrence of a bigram puts the template
starts AS (SELECT DISTINCT r, t, p - place AS s FROM b JOIN marks USING (b)),
scored AS (SELECT starts.r, t, s, 2.0::DOUBLE * count(DISTINCT b.b) FILTER (WHERE marks.b IS NOT NULL)
                  / (count(DISTINCT b.b) + any_value(sizes.n)) AS score
           FROM starts JOIN sizes USING (t) JOIN b ON b.r = starts.r AND b.p >= s AND b.p < s + sizes.size
           LEFT JOIN marks ON marks.t = starts.t AND marks.b = b.b GROUP BY starts.r, starts.t, s),
best AS (SELECT r, name, max(score) AS score FROM scored JOIN sizes USING (t)
         WHERE score >= {THRESHOLD}::DOUBLE GROUP BY r, name),
f AS (SELECT r, count(*) AS n_matches, string_agg(name, ',' ORDER BY name) AS licenses,
             arg_min(name, (-score, name)) AS best_license, max(score) AS best_score FROM best GROUP BY r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_matches, 0) AS n_matches, coalesce(licenses, '') AS licenses,
       best_license, best_score
FROM d LEFT JOIN f USING (r)
"""

OP3 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_ascii_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
      FROM w, unnest(range(1, greatest(len(w) - 2, 2))) AS u(i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.s = y.s AND x.doc_id <> y.doc_id
          JOIN n p ON p.doc_id = x.doc_id JOIN n q ON q.doc_id = y.doc_id
          GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 85 * (any_value(p.n) + any_value(q.n) - count(*))),
reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(min(reach.b), d.doc_id)) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

_ITEM_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_ascii_lower("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({_ascii_lower("coalesce(text, '')")}, '{_ITEM_WORD}') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[p:p + 9], ' ') AS s
        FROM i, unnest(range(1, greatest(len(w) - 8, 2))) AS u(p) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
runs AS (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS s
         FROM d, sizes, unnest(range(1, greatest(len(w) - n + 2, 1))) AS u(p)),
found AS (SELECT doc_id, p, n, item_id FROM runs JOIN win USING (n, s)),
hit AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM found, unnest(range(p, p + n)) AS u(k) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM found GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CONTROL = "<\\\\*(?:/?s>|\\|endoftext\\|>)|\\[\\\\*/?INST\\]"

OP6 = f"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM c),
g AS (SELECT conv_id, count(*) AS n_turns,
             sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
             coalesce(string_agg(text, '' ORDER BY k) FILTER (WHERE role = 'assistant'), '') AS loss,
             sum(length(role) + length(text) + 16 + len(regexp_extract_all(role, '{_CONTROL}'))
                 + len(regexp_extract_all(text, '{_CONTROL}'))) + 4 AS formatted_chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       formatted_chars::BIGINT AS formatted_chars FROM g
"""

_WEIGHT = "CASE (r - 1) % {n} {cases} END".format(
    n=len(WEIGHTS), cases=" ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WEIGHTS)))

OP9 = f"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, {HASH_BITS // 4}))::BIGINT AS h FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) AS r FROM d GROUP BY source),
w AS (SELECT *, {_WEIGHT} AS w FROM s),
-- sources fill up in the order of cap over weight; the first level that no open source exceeds holds
o AS (SELECT *, row_number() OVER (ORDER BY n / w::DOUBLE, r) AS k FROM w),
c AS (SELECT *, sum(n) OVER () - coalesce(sum({MAX_REPEAT} * n) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
             sum(w) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight FROM o),
first AS (SELECT min(k) AS k FROM c WHERE rest * w <= {MAX_REPEAT} * n * weight),
level AS (SELECT rest, weight, k FROM c WHERE k = (SELECT k FROM first)),
t AS (SELECT c.source, c.n, CASE WHEN c.k < level.k THEN ({MAX_REPEAT} * c.n)::DOUBLE
                                 ELSE (level.rest * c.w)::DOUBLE / level.weight::DOUBLE END AS target FROM c, level),
p AS (SELECT *, CASE WHEN n > 0 THEN least({MAX_REPEAT}, floor(target / n))::BIGINT ELSE 0 END AS passes FROM t),
hashes AS (SELECT d.source, h, sum(size) AS m FROM d GROUP BY d.source, h),
run AS (SELECT source, h, m, sum(m) OVER (PARTITION BY source ORDER BY h) - m AS before FROM hashes),
taken AS (SELECT run.source, h FROM run JOIN p ON run.source IS NOT DISTINCT FROM p.source
          WHERE n > 0 AND target > passes * n
            AND (before + m <= target - passes * n
                 OR before <= target - passes * n AND before + m - (target - passes * n) < target - passes * n - before))
SELECT d.doc_id, d.size, p.n AS source_size, p.target,
       (d.size * least({MAX_REPEAT}, p.passes + CASE WHEN taken.h IS NOT NULL THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source
LEFT JOIN taken ON taken.source IS NOT DISTINCT FROM d.source AND taken.h = d.h
"""

OP10 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha1(coalesce(html, '')) AS digest FROM pages),
g AS (SELECT digest, max(page_id) AS refers_to FROM p WHERE n >= 1000 GROUP BY digest)
SELECT p.page_id, p.n::BIGINT AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN g.refers_to IS DISTINCT FROM p.page_id AND g.refers_to IS NOT NULL THEN 'revisit' ELSE 'response' END
         AS record_type,
       CASE WHEN g.refers_to IS DISTINCT FROM p.page_id THEN g.refers_to END AS refers_to
FROM p LEFT JOIN g ON p.digest = g.digest AND p.n >= 1000
"""

# crc32, bit by bit: for each byte its value, then eight steps.
_CRC32 = """xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(
  string_split(c::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
  lambda s, o: CASE WHEN o >= 0 THEN xor(s, o) ELSE xor(s >> 1, 3988292384 * (s & 1)) END))"""

OP12 = f"""
WITH t AS (
  SELECT conv_id AS c, turn, coalesce(text, '') AS text,
         sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list({{'k': k, 'w': len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'))}} ORDER BY turn NULLS FIRST, k) AS ts
        FROM t GROUP BY c),
hs AS (SELECT c, ts, ({_CRC32}) % 4 AS h FROM own),
r AS (SELECT a.c, list_concat(coalesce(b.ts, [])[1:a.h], a.ts[a.h + 1:]) AS ts
      FROM hs a LEFT JOIN own b ON b.c = a.c - a.c % 20),
p AS (SELECT c, d, d = len(ts) AS ends, ts[d].w AS w,
             array_to_string(list_transform(ts[1:d], lambda x: x.k), ',') AS name,
             CASE WHEN d > 0 THEN array_to_string(list_transform(ts[1:d - 1], lambda x: x.k), ',') END AS parent
      FROM r, unnest(range(0, len(ts) + 1)) AS u(d)),
n AS (SELECT name, d, min(c) AS conv_id, any_value(parent) AS parent, count(*) AS n_convs, coalesce(any_value(w), 0) AS w,
             bool_and(ends) AS leaf, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE ends) AS ids
      FROM p GROUP BY name, d),
below AS (SELECT a.name, count(*) FILTER (WHERE m.leaf) AS n_leaves, sum((m.n_convs - 1) * m.w) AS saved
          FROM n m JOIN p a ON a.c = m.conv_id AND a.d <= m.d GROUP BY a.name),
kids AS (SELECT parent AS name, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent)
SELECT n.conv_id, n.d AS depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children,
       below.n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n JOIN below ON below.name = n.name LEFT JOIN kids ON kids.name = n.name
LEFT JOIN n AS up ON up.name = n.parent
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_exact_dedup": OP1, "op2_license_scan": OP2, "op3_ngram_jaccard_join": OP3, "op4_decontaminate": OP4,
            "op6_chat_format": OP6, "op9_mix_sources": OP9, "op10_warc": OP10, "op12_prefix_trie": OP12}
