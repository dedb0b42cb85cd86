"""DuckDB SQL of the queries that SQL can express; the others are tested against brute force."""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = (
    "list_filter(string_split_regex(translate(coalesce(text, ''), '" + _UPPER + "', '" + _UPPER.lower() + "'), "
    "'[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"
)

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL),
i AS (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[s : s + 9], ' ') AS t FROM i),
lens AS (SELECT DISTINCT n FROM win),
p AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS s FROM d),
dw AS (SELECT r, s, n, array_to_string(w[s : s + n - 1], ' ') AS t FROM p, lens WHERE s + n - 1 <= len(w)),
hit AS (SELECT dw.r, dw.s, dw.n, win.item FROM dw JOIN win ON dw.t = win.t AND dw.n = win.n),
pos AS (SELECT r, count(DISTINCT x) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS x FROM hit) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
        FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(pos.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(its.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(its.ids, '')) AS items_sha256,
       coalesce(pos.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN pos ON d.r = pos.r LEFT JOIN its ON d.r = its.r
"""

_DRAWS = ", ".join(
    f"CAST('0x' || substr(sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')), {8 * i + 1}, 8) AS BIGINT) AS h{i + 1}"
    for i in range(4)
)

OP12 = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
           {_DRAWS} FROM documents),
r AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo,
             greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi FROM d),
c AS (SELECT *, array_to_string(u[1 : lo], '') AS p, array_to_string(u[lo + 1 : hi], '') AS m,
             array_to_string(u[hi + 1 : n], '') AS s,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                  THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM r)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(p || m || s) AS restored_sha256
FROM c
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term FROM (SELECT DISTINCT lang, r, term FROM t) GROUP BY ALL HAVING count(*) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
n AS (SELECT lang, source, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(n.n, 0) AS n, v.v FROM g JOIN v USING (lang) LEFT JOIN n USING (lang, source)),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.c, 0) AS c,
             1 + (1000000000 * (coalesce(c.c, 0) + 1)) // (gn.n + gn.v) AS p
      FROM gn JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (1000000000 * (c + 1)) // (n + v) AS q
      FROM (SELECT lang, term, CAST(sum(c) AS BIGINT) AS c FROM c GROUP BY ALL)
      JOIN (SELECT lang, CAST(sum(c) AS BIGINT) AS n FROM c GROUP BY ALL) USING (lang) JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item,
                 CAST(sum((a.p - b.p) * (a.p - b.p) // b.p) AS BIGINT) AS value
          FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
          UNION ALL
          SELECT a.lang, a.source, 'pair', b.source, 0 FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          WHERE a.lang NOT IN (SELECT lang FROM v)),
terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
          FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 200
"""

_PLAIN_WORDS = "regexp_extract_all({t}, '[^\\x20\\x09-\\x0D]+')"

OP4 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, {_PLAIN_WORDS.format(t="t")} AS w FROM d),
line AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT l) AS n_dup FROM line
          WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
p AS (SELECT r, w, unnest(range(1, len(w) - 6)) AS s FROM w WHERE len(w) >= 8),
win AS (SELECT r, s, array_to_string(w[s : s + 7], ' ') AS k FROM p),
again AS (SELECT r, unnest(range(s, s + 8)) AS x FROM (SELECT *, count(*) OVER (PARTITION BY r, k) AS m FROM win) WHERE m > 1),
rep AS (SELECT r, count(DISTINCT x) AS n_repeat FROM again GROUP BY r),
m AS (SELECT w.doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines,
             coalesce(n_repeat, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
             len(regexp_extract_all(t, '[A-Za-z]|[^\\x00-\\x7F]')) AS n_letters,
             len(regexp_extract_all(t, '[A-Z]')) AS n_upper, len(regexp_extract_all(t, '!')) AS n_exclaim
      FROM w LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
b AS (SELECT *, CASE WHEN n_words < 20 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 30 * n_words THEN 2 ELSE 0 END
        + CASE WHEN 100 * n_symbols > 25 * n_words THEN 4 ELSE 0 END
        + CASE WHEN n_lines >= 4 AND 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END
        + CASE WHEN word_chars < 2 * n_words OR word_chars > 20 * n_words THEN 16 ELSE 0 END
        + CASE WHEN 100 * n_letters < 60 * word_chars THEN 32 ELSE 0 END
        + CASE WHEN 100 * n_upper > 50 * n_letters AND n_letters > 0 THEN 64 ELSE 0 END
        + CASE WHEN 100 * n_exclaim > 30 * n_words THEN 128 ELSE 0 END AS bits FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
       CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
       CAST(n_repeat_words AS BIGINT) AS n_repeat_words, bits % 4 > 0 AS base_failed, bits = 0 AS kept,
       CAST(bits AS BIGINT) AS fail_bits
FROM b
"""

OP7 = f"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, {_PLAIN_WORDS.format(t="translate(coalesce(text, ''), '" + _UPPER + "', '" + _UPPER.lower() + "')")} AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + 3], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (
  SELECT p.x, p.y FROM (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id GROUP BY ALL) p
  JOIN n nx ON nx.doc_id = p.x JOIN n ny ON ny.doc_id = p.y WHERE 100 * p.c >= 85 * (nx.n + ny.n - p.c)),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.least, d.doc_id)) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id
LEFT JOIN (SELECT x, min(y) AS least FROM reach GROUP BY x) c ON c.x = d.doc_id
"""

ORACLE_SQL = {
    "op1_decontaminate": OP1, "op4_quality_rules": OP4, "op7_jaccard_join": OP7,
    "op12_fill_middle": OP12, "op13_source_divergence": OP13,
}
