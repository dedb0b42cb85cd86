"""DuckDB oracle SQL for the registered queries (views: the driver tables).

Each statement is written independently of the Spark code, from the operator's
definition; column names and types equal the Spark result's. Shared fragments (the trip
views, the wrapped document lines) mirror ``sparkloom.sources.tables``.
"""

from __future__ import annotations

from sparkloom.functions.text import ASCII_PUNCTUATION, EDGE_CHARS, PY_WHITESPACE, WORD_PATTERN


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def char_class(chars: str) -> str:
    return "[" + "".join("\\" + c if c in "\\]^-[" else c for c in chars) + "]"


ORACLE_SQL: dict[str, str] = {}

# ---------------------------------------------------------------- words and vocabulary
TOK_LETTERS = "string_split(lower(regexp_replace({t}, '[^a-zA-Z]+', ' ', 'g')), ' ')"

ORACLE_SQL["word_count"] = f"""
SELECT word, count(*) AS count
FROM (SELECT unnest({TOK_LETTERS.format(t='text')}) AS word FROM documents)
WHERE word <> ''
GROUP BY word
"""

ORACLE_SQL["word_count_raw"] = """
SELECT word, count(*) AS count
FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word
"""

VOCAB_CTE = f"""
vocab_counts AS (
  SELECT word, count(*) AS count
  FROM (SELECT unnest({TOK_LETTERS.format(t='text')}) AS word FROM documents)
  WHERE word <> '' GROUP BY word),
vocab AS (
  SELECT word, count, CAST(row_number() OVER (ORDER BY count DESC, word) - 1 AS INTEGER) AS pos
  FROM vocab_counts
  QUALIFY row_number() OVER (ORDER BY count DESC, word) <= 20000)
"""

ORACLE_SQL["vocab_topk"] = f"WITH {VOCAB_CTE} SELECT word, count, pos FROM vocab"

ORACLE_SQL["vocab_tail20"] = f"WITH {VOCAB_CTE} SELECT word, count, pos FROM vocab ORDER BY pos DESC LIMIT 20"

WIKI_LINES = """
wiki AS (
  SELECT '<doc id="' || CAST(doc_id AS VARCHAR) || '" url="http://' || lang || '.example.org/'
         || CAST(doc_id AS VARCHAR) || '" title="' || source || '">' || text || '</doc>' AS value
  FROM documents)
"""


def py_slice(v: str, start0: str, end0: str) -> str:
    n = f"length({v})"
    s = f"(CASE WHEN ({start0}) < 0 THEN greatest({n} + ({start0}), 0) ELSE ({start0}) END)"
    e = f"(CASE WHEN ({end0}) < 0 THEN greatest({n} + ({end0}), 0) ELSE ({end0}) END)"
    return f"substr({v}, {s} + 1, greatest({e} - {s}, 0))"


BODY_FROM_GT = py_slice("value", "instr(value, '>') - 1", "instr(value, '</doc>') - 1")
EDGE = char_class(EDGE_CHARS)

ORACLE_SQL["vocab_stripped_tokens"] = f"""
WITH {WIKI_LINES},
toks AS (SELECT unnest(regexp_split_to_array({BODY_FROM_GT}, {lit(PY_WHITESPACE + '+')})) AS raw FROM wiki),
words AS (SELECT regexp_replace(lower(raw), {lit('^' + EDGE + '+|' + EDGE + '+$')}, '', 'g') AS word
          FROM toks WHERE raw <> ''),
counts AS (SELECT word, count(*) AS count FROM words WHERE length(word) >= 2 GROUP BY word)
SELECT word, count, CAST(row_number() OVER (ORDER BY count DESC, word) - 1 AS INTEGER) AS pos
FROM counts
QUALIFY row_number() OVER (ORDER BY count DESC, word) <= 20000
"""

# ---------------------------------------------------------------- trips
TRIPS_CTE = """
trips AS (
  SELECT l_suppkey AS medallion, l_partkey AS hack_license, l_shipdate AS pickup_datetime,
         CAST(trunc(l_quantity * 60) AS INTEGER) AS trip_time_secs,
         l_quantity * (CAST(1 AS DOUBLE) + l_discount) AS trip_distance,
         l_extendedprice / CAST(1000 AS DOUBLE) AS fare_amount,
         l_discount AS surcharge, l_tax AS mta_tax,
         CAST(l_linenumber AS DOUBLE) AS tolls_amount,
         (l_extendedprice / CAST(1000 AS DOUBLE)) * (CAST(1 AS DOUBLE) + l_tax) AS total_amount
  FROM lineitem)
"""
F1 = "(trip_distance IS NOT NULL AND fare_amount IS NOT NULL)"
F2 = (f"({F1} AND trip_time_secs IS NOT NULL AND trip_time_secs <> 0 "
      "AND total_amount IS NOT NULL AND total_amount <> 0)")
F3 = f"({F2} AND trip_distance <> 0 AND surcharge IS NOT NULL AND surcharge <> 0)"
F4 = (f"({F1} AND trip_time_secs BETWEEN 120 AND 3600 AND trip_distance BETWEEN 1 AND 50 "
      "AND fare_amount BETWEEN 3 AND 200 AND tolls_amount >= 3)")

ORACLE_SQL["active_key_top10"] = f"""
WITH {TRIPS_CTE}
SELECT medallion, count(*) AS trips FROM trips WHERE {F1}
GROUP BY medallion ORDER BY trips DESC, medallion LIMIT 10
"""

ORACLE_SQL["ratio_of_sums_top10"] = f"""
WITH {TRIPS_CTE}
SELECT hack_license,
       round(sum(total_amount) / (CAST(sum(trip_time_secs) AS DOUBLE) / CAST(60 AS DOUBLE)), 9) AS dollars_per_minute
FROM trips WHERE {F2}
GROUP BY hack_license ORDER BY dollars_per_minute DESC, hack_license LIMIT 10
"""

ORACLE_SQL["hourly_ratio_top10"] = """
WITH e AS (
  SELECT ts, value, TRY_CAST(regexp_extract(props, '"k":\\s*(-?[0-9]+)', 1) AS DOUBLE) AS k FROM events),
t AS (SELECT strftime(ts, '%H') AS hour, value AS surcharge, k AS trip_distance,
             CAST(trunc(k * 60) AS INTEGER) AS trip_time_secs, value AS total_amount, value AS fare_amount
      FROM e)
SELECT hour, round(sum(surcharge) / sum(trip_distance), 9) AS surcharge_per_distance
FROM t
WHERE trip_distance IS NOT NULL AND fare_amount IS NOT NULL AND trip_time_secs IS NOT NULL
  AND trip_time_secs <> 0 AND total_amount IS NOT NULL AND total_amount <> 0
  AND trip_distance <> 0 AND surcharge IS NOT NULL AND surcharge <> 0
GROUP BY hour ORDER BY surcharge_per_distance DESC, hour LIMIT 10
"""

ORACLE_SQL["csv_roundtrip_clean"] = f"""
WITH {TRIPS_CTE}
SELECT count(*) AS n_lines,
       CAST(count(*) FILTER (WHERE {F1}) AS BIGINT) AS n_f1,
       CAST(count(*) FILTER (WHERE {F2}) AS BIGINT) AS n_f2,
       CAST(count(*) FILTER (WHERE {F3}) AS BIGINT) AS n_f3,
       CAST(count(*) FILTER (WHERE {F4}) AS BIGINT) AS n_f4,
       round(sum(total_amount) FILTER (WHERE {F4}), 6) AS f4_total
FROM trips
"""

ORACLE_SQL["range_filter_clean"] = f"""
WITH {TRIPS_CTE}
SELECT medallion, hack_license, trip_time_secs, trip_distance, fare_amount, tolls_amount, total_amount
FROM trips WHERE {F4}
"""

# ---------------------------------------------------------------- TF / DF / IDF
def terms_cte(docs: str, vocab: str = "vocab", name: str = "terms") -> str:
    return f"""
{name}_toks AS (SELECT doc_id, unnest({TOK_LETTERS.format(t='text')}) AS word FROM {docs}),
{name} AS (SELECT t.doc_id, v.pos, count(*) AS cnt FROM {name}_toks t JOIN {vocab} v ON t.word = v.word
           GROUP BY t.doc_id, v.pos),
{name}_tf AS (SELECT doc_id, pos, cnt, cnt / sum(cnt) OVER (PARTITION BY doc_id) AS tf FROM {name})
"""


def vocab_cte_over(docs: str, name: str = "vocab") -> str:
    return f"""
{name}_counts AS (
  SELECT word, count(*) AS count
  FROM (SELECT unnest({TOK_LETTERS.format(t='text')}) AS word FROM {docs})
  WHERE word <> '' GROUP BY word),
{name} AS (
  SELECT word, count, CAST(row_number() OVER (ORDER BY count DESC, word) - 1 AS INTEGER) AS pos
  FROM {name}_counts
  QUALIFY row_number() OVER (ORDER BY count DESC, word) <= 20000)
"""


def idf_cte(docs: str, terms: str = "terms", smoothing: bool = False, name: str = "idf") -> str:
    df = "(CAST(df AS DOUBLE) + CAST(1 AS DOUBLE))" if smoothing else "CAST(df AS DOUBLE)"
    return f"""
{name}_df AS (SELECT pos, count(*) AS df FROM {terms} GROUP BY pos),
{name} AS (SELECT pos, df, ln(CAST((SELECT count(*) FROM {docs}) AS DOUBLE) / {df}) AS idf FROM {name}_df)
"""


ORACLE_SQL["term_frequency"] = f"WITH {VOCAB_CTE}, {terms_cte('documents')} SELECT doc_id, pos, cnt, tf FROM terms_tf"

ORACLE_SQL["document_frequency"] = f"""
WITH {VOCAB_CTE}, {terms_cte('documents')}
SELECT t.pos, v.word, count(*) AS df FROM terms t JOIN vocab v ON t.pos = v.pos GROUP BY t.pos, v.word
"""

for _name, _smooth in (("tfidf", False), ("tfidf_smoothed", True)):
    ORACLE_SQL[_name] = f"""
WITH {VOCAB_CTE}, {terms_cte('documents')}, {idf_cte('documents', smoothing=_smooth)}
SELECT t.doc_id, t.pos, round(t.tf * i.idf, 9) AS tfidf FROM terms_tf t JOIN idf i ON t.pos = i.pos
"""

ORACLE_SQL["idf_train_apply_test"] = f"""
WITH train AS (SELECT * FROM documents WHERE doc_id % 5 <> 0),
test AS (SELECT * FROM documents WHERE doc_id % 5 = 0),
{vocab_cte_over('train')}, {terms_cte('train', name='trterms')}, {idf_cte('train', 'trterms')},
{terms_cte('test', name='teterms')}
SELECT t.doc_id, t.pos, round(t.tf * i.idf, 9) AS tfidf FROM teterms_tf t JOIN idf i ON t.pos = i.pos
"""

ORACLE_SQL["word_presence_by_class"] = f"""
WITH {VOCAB_CTE},
ld AS (SELECT l.quality AS label, {TOK_LETTERS.format(t='d.text')} AS toks
       FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
probes(word) AS (VALUES ('applicant'), ('and'), ('attack'), ('protein'), ('court')),
hits AS (SELECT p.word, ld.label, count(*) AS n_docs,
                count(*) FILTER (WHERE list_contains(ld.toks, p.word)) AS n_with_word
         FROM probes p CROSS JOIN ld GROUP BY p.word, ld.label)
SELECT h.word, v.pos, h.label, h.n_docs, h.n_with_word, round(h.n_with_word / h.n_docs, 9) AS rate
FROM hits h LEFT JOIN vocab v ON h.word = v.word
"""

ORACLE_SQL["category_join"] = """
SELECT d.doc_id, d.source, d.lang, l.quality, l.toxic
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
"""

BODY = ("CASE WHEN instr(value, '\">') > 0 THEN substr(value, instr(value, '\">') + 2, "
        "greatest(length(value) - instr(value, '\">') - 1 - 6, 0)) END")

ORACLE_SQL["doc_line_parse"] = f"""
WITH {WIKI_LINES}
SELECT regexp_extract(value, 'id="(.*?)" url=', 1) AS doc_id,
       regexp_extract(value, '(<[^>]+>)', 1) AS header,
       length({BODY}) AS body_chars, md5({BODY}) AS body_md5,
       length({BODY_FROM_GT}) AS gt_body_chars, md5({BODY_FROM_GT}) AS gt_body_md5
FROM wiki WHERE contains(value, 'id') AND contains(value, 'url=')
"""

ORACLE_SQL["page_tag_strip"] = """
SELECT page_id, regexp_extract(html, '(<[^>]+>)', 1) AS header,
       length(regexp_replace(html, '<[^>]+>', '', 'g')) AS stripped_chars,
       md5(regexp_replace(html, '<[^>]+>', '', 'g')) AS stripped_md5
FROM pages
"""

ORACLE_SQL["label_from_text"] = """
SELECT doc_id, CASE WHEN contains(source, '1') THEN 1 ELSE 0 END AS label,
       CASE WHEN contains(source, '1') THEN 1 ELSE -1 END AS signed_label
FROM documents
"""

# ---------------------------------------------------------------- kNN
def knn_text_sql(cosine: bool, categories: str = "SELECT doc_id, source AS category FROM documents") -> str:
    score = "sum(q.w * d.w)"
    if cosine:
        score = ("CASE WHEN max(qn.nrm) * max(dn.nrm) > 0 THEN sum(q.w * d.w) / (max(qn.nrm) * max(dn.nrm)) "
                 "ELSE 0 END")
    return f"""
WITH {VOCAB_CTE}, {terms_cte('documents')}, {idf_cte('documents')},
dv AS (SELECT t.doc_id, t.pos, t.tf * i.idf AS w FROM terms_tf t JOIN idf i ON t.pos = i.pos),
qd AS (SELECT item_id AS doc_id, text FROM benchmark),
{terms_cte('qd', name='qterms')},
qv AS (SELECT t.doc_id AS query_id, t.pos, t.tf * i.idf AS w FROM qterms_tf t JOIN idf i ON t.pos = i.pos),
dn AS (SELECT doc_id, sqrt(sum(w * w)) AS nrm FROM dv GROUP BY doc_id),
qn AS (SELECT query_id, sqrt(sum(w * w)) AS nrm FROM qv GROUP BY query_id),
pairs AS (SELECT qn.query_id, dn.doc_id FROM qn CROSS JOIN dn),
dots AS (SELECT q.query_id, d.doc_id, {score} AS s
         FROM qv q JOIN dv d ON q.pos = d.pos JOIN qn ON qn.query_id = q.query_id JOIN dn ON dn.doc_id = d.doc_id
         GROUP BY q.query_id, d.doc_id),
cand AS (SELECT p.query_id, p.doc_id, c.category, round(coalesce(x.s, 0), 9) AS score
         FROM pairs p LEFT JOIN dots x ON p.query_id = x.query_id AND p.doc_id = x.doc_id
         JOIN ({categories}) c ON c.doc_id = p.doc_id),
top AS (SELECT * FROM cand
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, category, doc_id) <= 10),
votes AS (SELECT query_id, category, count(*) AS votes FROM top GROUP BY query_id, category)
SELECT query_id, category, votes,
       row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, category) AS vote_rank
FROM votes
"""


ORACLE_SQL["knn_text_votes"] = knn_text_sql(False)
ORACLE_SQL["knn_text_cosine"] = knn_text_sql(True)
ORACLE_SQL["knn_text_multi_category"] = knn_text_sql(False, """
  SELECT doc_id, source AS category FROM documents WHERE source IS NOT NULL
  UNION ALL SELECT doc_id, lang FROM documents WHERE lang IS NOT NULL""")

ORACLE_SQL["knn_dense_votes"] = """
WITH base AS (SELECT vec_id, CAST(label AS VARCHAR) AS category, CAST(embedding AS DOUBLE[]) AS v
              FROM embeddings WHERE vec_id % 5 <> 0),
q AS (SELECT vec_id AS query_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id % 5 = 0),
cand AS (SELECT q.query_id, b.vec_id, b.category, round(list_dot_product(q.v, b.v), 9) AS score
         FROM q CROSS JOIN base b),
top AS (SELECT * FROM cand
        QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, category, vec_id) <= 10),
votes AS (SELECT query_id, category, count(*) AS votes FROM top GROUP BY query_id, category)
SELECT query_id, category, votes,
       row_number() OVER (PARTITION BY query_id ORDER BY votes DESC, category) AS vote_rank
FROM votes
"""

# ---------------------------------------------------------------- gradient descent on moments
def dbl(x: float) -> str:
    return f"CAST('{x!r}' AS DOUBLE)"


def sql_dot(a: list[str], b: list[str]) -> str:
    acc = f"({a[0]} * {b[0]})"
    for i in range(1, len(a)):
        acc = f"({acc} + ({a[i]} * {b[i]}))"
    return acc


def moments_cte(source: str, xs: list[str], y: str) -> str:
    """Moments of the augmented features (1, xs) as one row: n, g{i}_{j}, c{i}, syy."""
    aug = ["CAST(1 AS DOUBLE)"] + xs
    parts = ["CAST(count(*) AS DOUBLE) AS n"]
    for i in range(len(aug)):
        for j in range(i, len(aug)):
            parts.append(f"sum({aug[i]} * {aug[j]}) AS g{i}_{j}")
    for i in range(len(aug)):
        parts.append(f"sum({aug[i]} * {y}) AS c{i}")
    parts.append(f"sum({y} * {y}) AS syy")
    return f"mom AS (SELECT {', '.join(parts)} FROM {source})"


def gd_sql(prefix_ctes: str, d1: int, theta0: list[float], lr: float, iterations: int,
           grad_scale: str, cost_scale: str, names: list[str]) -> str:
    """Recursive CTE running batch GD with the bold-driver rule on the moments row."""
    th = [f"t{i}" for i in range(d1)]
    g = [[f"g{min(i, j)}_{max(i, j)}" for j in range(d1)] for i in range(d1)]
    c = [f"c{i}" for i in range(d1)]
    gt = [sql_dot(g[i], th) for i in range(d1)]
    sse = f"((syy - ({dbl(2.0)} * {sql_dot(th, c)})) + {sql_dot(th, gt)})"
    cost = f"({sse} * ({cost_scale}))"
    steps = [f"(t{i} - (lr * (({grad_scale}) * (c{i} - {gt[i]}))))" for i in range(d1)]
    init = ", ".join(dbl(float(t)) for t in theta0)
    cols = ", ".join(th)
    new_lr = (f"CASE WHEN cost < old THEN lr * {dbl(1.05)} WHEN cost > old THEN lr * {dbl(0.5)} "
              "ELSE lr END")
    new_old = "CASE WHEN cost < old OR cost > old THEN cost ELSE old END"
    out = ", ".join(f"round(t{i}, 6) AS {names[i + 1]}" for i in range(d1))
    return f"""
WITH RECURSIVE {prefix_ctes},
it(iteration, cost, {cols}, lr, old) AS (
  SELECT 0, CAST(NULL AS DOUBLE), {init}, {dbl(lr)}, {dbl(0.0)}
  UNION ALL
  SELECT iteration + 1, cost, {', '.join(f'n{i}' for i in range(d1))}, {new_lr}, {new_old}
  FROM (SELECT it.iteration, it.lr, it.old, {cost} AS cost,
               {', '.join(f'{steps[i]} AS n{i}' for i in range(d1))}
        FROM it CROSS JOIN mom WHERE it.iteration < {iterations}) s)
SELECT iteration, round(cost, 6) AS {names[0]}, {out}, lr AS learning_rate
FROM it WHERE iteration > 0
"""


CLEAN_TRIPS = f"{TRIPS_CTE}, clean AS (SELECT * FROM trips WHERE {F4})"

ORACLE_SQL["linreg_closed_form"] = f"""
WITH {CLEAN_TRIPS}
SELECT count(*) AS n, round(regr_slope(fare_amount, trip_distance), 6) AS slope,
       round(regr_intercept(fare_amount, trip_distance), 6) AS intercept
FROM clean
"""

ORACLE_SQL["linreg_gd"] = gd_sql(
    f"{CLEAN_TRIPS}, {moments_cte('clean', ['trip_distance'], 'fare_amount')}",
    2, [0.1, 0.1], 1e-4, 100, f"{dbl(-2.0)} / n", f"{dbl(1.0)} / n", ["cost", "b", "m"],
)

_MULTI = ["trip_time_secs", "trip_distance", "fare_amount", "surcharge"]
_Z = ", ".join(f"(CAST({f} AS DOUBLE) - mu_{f}) / (CASE WHEN sd_{f} > 0 THEN sd_{f} ELSE {dbl(1.0)} END) AS z_{f}"
               for f in _MULTI)
_ZSTATS = ", ".join(f"avg({f}) AS mu_{f}, stddev_pop({f}) AS sd_{f}" for f in _MULTI)
ORACLE_SQL["linreg_gd_multi"] = gd_sql(
    f"{CLEAN_TRIPS}, zs AS (SELECT {_ZSTATS} FROM clean), "
    f"z AS (SELECT {_Z}, total_amount FROM clean CROSS JOIN zs), "
    f"{moments_cte('z', [f'z_{f}' for f in _MULTI], 'total_amount')}",
    5, [0.1] * 5, 1e-3, 100, f"{dbl(-1.0)} / n", f"{dbl(0.5)} / n", ["cost", "b", "w1", "w2", "w3", "w4"],
)

# ---------------------------------------------------------------- GD classifiers on embeddings
def _sdot(a: list[str], b: list[str]) -> str:
    acc = f"({a[0]} * {b[0]})"
    for i in range(1, len(a)):
        acc = f"({acc} + ({a[i]} * {b[i]}))"
    return acc


def gd_classifier_sql(loss: str, lr: float, iterations: int, reg: float, tol: float, grow_on_equal: bool,
                      d: int = 64, w0: float = 0.1) -> str:
    signed = loss != "logistic"
    y = "CASE WHEN label >= 5 THEN 1 ELSE {neg} END".format(neg=-1 if signed else 0)
    xs = [f"x{i}" for i in range(d)]
    ws = [f"w{i}" for i in range(d)]
    feats = ", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS x{i}" for i in range(d))
    one, zero, two = dbl(1.0), dbl(0.0), dbl(2.0)
    z = f"({xs[0]} * {ws[0]})"
    for i in range(1, d):
        z = f"({z} + ({xs[i]} * {ws[i]}))"
    score, z = z, "z"  # computed once per row, below the sums
    if loss == "logistic":
        row_loss = f"((greatest({z}, {zero}) + ln({one} + exp(-abs({z})))) - (y * {z}))"
        grads = [f"({x} * (({one} / ({one} + exp(-{z}))) - y))" for x in xs]
    else:
        margin = f"({one} - (y * {z}))"
        if loss == "hinge":
            row_loss = f"greatest({zero}, {margin})"
            grads = [f"CASE WHEN {margin} >= {zero} THEN ((-y) * {x}) ELSE {zero} END" for x in xs]
        else:
            weight = "(CASE WHEN y > 0 THEN nr ELSE pr END)"
            row_loss = f"({weight} * greatest({zero}, {margin}))"
            grads = [f"CASE WHEN {margin} >= {zero} THEN (((-{weight}) * y) * {x}) ELSE {zero} END" for x in xs]
    ww = _sdot(ws, ws)
    if loss == "logistic":
        cost = f"(loss + ({dbl(reg)} * {ww}))"
        new = [f"(p.w{i} - (p.lr * (g{i} + (({two} * {dbl(reg)}) * p.w{i}))))" for i in range(d)]
    elif loss == "hinge":
        cost = f"((({one} / ({two} * (n * {dbl(reg)}))) * {ww}) + (loss / n))"
        new = [f"(p.w{i} - (p.lr * ((({one} / (n * {dbl(reg)})) * p.w{i}) + (g{i} / n))))" for i in range(d)]
    else:
        cost = "loss"
        new = [f"(p.w{i} - (p.lr * g{i}))" for i in range(d)]
    ctes = [f"data AS (SELECT {feats}, CAST({y} AS DOUBLE) AS y FROM embeddings)",
            "cnt AS (SELECT CAST(count(*) AS DOUBLE) AS n, "
            "avg(CASE WHEN y <= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS nr, "
            "avg(CASE WHEN y > 0 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pr FROM data)",
            f"p0 AS (SELECT 0 AS it, {', '.join(f'{dbl(w0)} AS w{i}' for i in range(d))}, {dbl(lr)} AS lr, "
            f"{zero} AS old, CAST(NULL AS DOUBLE) AS cost, false AS done, false AS emit)"]
    outs = []
    for k in range(1, iterations + 1):
        prev = f"p{k - 1}"
        ctes.append(f"s{k} AS (SELECT sum({row_loss}) AS loss, "
                    + ", ".join(f"sum({g}) AS g{i}" for i, g in enumerate(grads))
                    + f" FROM (SELECT *, {score} AS z FROM data CROSS JOIN cnt "
                    f"CROSS JOIN (SELECT {', '.join(ws)} FROM {prev}) wt))")
        if loss == "logistic":
            old_norm = f"sqrt({_sdot(['p.' + w for w in ws], ['p.' + w for w in ws])})"
            new_norm = f"sqrt({_sdot([f'n{i}' for i in range(d)], [f'n{i}' for i in range(d)])})"
        else:
            old_norm = f"sqrt(abs({_sdot(['p.' + w for w in ws], ['p.' + w for w in ws])}))"
            new_norm = f"sqrt(abs({_sdot(['p.' + w for w in ws], [f'n{i}' for i in range(d)])}))"
        grow = "c.cost <= c.old" if grow_on_equal else "c.cost < c.old"
        ctes.append(
            f"u{k} AS (SELECT p.done AS was_done, p.lr, p.old, "
            + ", ".join(f"p.w{i}" for i in range(d)) + ", "
            + f"{cost.replace('wt.', 'p.').replace(ww, _sdot(['p.' + w for w in ws], ['p.' + w for w in ws]))} AS cost, "
            + ", ".join(f"{new[i]} AS n{i}" for i in range(d))
            + f" FROM {prev} p CROSS JOIN s{k} CROSS JOIN cnt)")
        ctes.append(
            f"v{k} AS (SELECT *, abs({old_norm.replace('p.', 'u.')} - {new_norm.replace('p.', 'u.')}) <= {dbl(tol)} "
            f"AS stop FROM u{k} u)")
        ctes.append(
            f"p{k} AS (SELECT {k} AS it, "
            + ", ".join(f"CASE WHEN c.was_done THEN c.w{i} ELSE c.n{i} END AS w{i}" for i in range(d)) + ", "
            + f"CASE WHEN c.was_done OR c.stop THEN c.lr WHEN {grow} THEN c.lr * {dbl(1.05)} "
            + f"WHEN c.cost > c.old THEN c.lr * {dbl(0.5)} ELSE c.lr END AS lr, "
            + f"CASE WHEN c.was_done OR c.stop THEN c.old WHEN {grow} OR c.cost > c.old THEN c.cost ELSE c.old END AS old, "
            + "c.cost AS cost, c.was_done OR c.stop AS done, NOT c.was_done AS emit "
            + f"FROM v{k} c)")
        outs.append(f"SELECT CAST(it AS BIGINT) AS iteration, round(cost, 6) AS cost, "
                    + ", ".join(f"round(w{i}, 6) AS w{i + 1}" for i in range(d))
                    + f", lr AS learning_rate FROM p{k} WHERE emit")
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL\n".join(outs)


ORACLE_SQL["logreg_gd_fixed_iters"] = gd_classifier_sql("logistic", 1e-3, 5, 1e-5, 1e-6, True)
ORACLE_SQL["svm_gd_fixed_iters"] = gd_classifier_sql("hinge", 0.5, 5, 100.0, 5e-5, False)
ORACLE_SQL["svm_weighted_gd_fixed_iters"] = gd_classifier_sql("weighted_hinge", 1.0, 5, 0.0, 5e-5, False)



def svm_descent_sql(weighted: bool, lr: float, most: int, reg: float, tol: float, d: int = 64) -> str:
    """Hinge descent to its stop rule or ``most`` iterations, as a recursion over one row of
    state (the weights as a list)."""
    weight = "(CASE WHEN y > 0 THEN nr ELSE pr END)" if weighted else "1.0::DOUBLE"
    sums = ", ".join(f"sum(step * x[{i}])" for i in range(1, d + 1))
    cost = "loss" if weighted else f"(1.0::DOUBLE / (2.0::DOUBLE * (n * {dbl(reg)}))) * list_dot_product(w, w) + loss / n"
    new = "w[i] - lr * g[i]" if weighted else f"w[i] - lr * ((1.0::DOUBLE / (n * {dbl(reg)})) * w[i] + g[i] / n)"
    return f"""
WITH RECURSIVE data AS MATERIALIZED (
  SELECT list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS x, CASE WHEN label >= 5 THEN 1.0 ELSE -1.0 END::DOUBLE AS y
  FROM embeddings WHERE embedding IS NOT NULL),
cnt AS MATERIALIZED (SELECT CAST(count(*) AS DOUBLE) AS n,
  avg(CASE WHEN label >= 5 THEN 0.0 ELSE 1.0 END)::DOUBLE AS nr, avg(CASE WHEN label >= 5 THEN 1.0 ELSE 0.0 END)::DOUBLE AS pr FROM embeddings),
state AS (
  SELECT 0::BIGINT AS it, list_transform(range({d}), lambda i: {dbl(0.1)}) AS w, {dbl(lr)} AS lr, {dbl(0.0)} AS old,
         {dbl(0.0)} AS cost, false AS done
  UNION ALL
  SELECT it, new, CASE WHEN stop THEN lr WHEN cost < old THEN lr * {dbl(1.05)} WHEN cost > old THEN lr * {dbl(0.5)} ELSE lr END,
         CASE WHEN stop THEN old ELSE cost END, cost, stop
  FROM (SELECT *, abs(sqrt(abs(list_dot_product(w, w))) - sqrt(abs(list_dot_product(w, new)))) <= {dbl(tol)} AS stop
        FROM (SELECT it + 1 AS it, w, lr, old, {cost} AS cost,
                     list_transform(range(1, {d + 1}), lambda i: {new}) AS new
              FROM (SELECT it, any_value(w) AS w, any_value(lr) AS lr, any_value(old) AS old, any_value(n) AS n,
                           sum(hinge) AS loss, [{sums}] AS g
                    FROM (SELECT *, {weight} * greatest(0.0::DOUBLE, margin) AS hinge,
                                 CASE WHEN margin >= 0 THEN -{weight} * y ELSE 0.0::DOUBLE END AS step
                          FROM (SELECT s.it, s.w, s.lr, s.old, c.n, c.nr, c.pr, t.x, t.y,
                                       1.0::DOUBLE - t.y * list_dot_product(t.x, s.w) AS margin
                                FROM state s CROSS JOIN cnt c CROSS JOIN data t WHERE NOT s.done AND s.it < {most}))
                    GROUP BY it))))
SELECT it AS iteration, round(cost, 6) AS cost, {", ".join(f"round(w[{i}], 6) AS w{i}" for i in range(1, d + 1))}, lr AS learning_rate
FROM state WHERE it > 0
"""


ORACLE_SQL["svm_gd"] = svm_descent_sql(False, 0.5, 300, 100.0, 5e-5)
ORACLE_SQL["svm_weighted_gd"] = svm_descent_sql(True, 1.0, 300, 0.0, 5e-5)

# ---------------------------------------------------------------- evaluation
_SCORED = f"""
scored AS (
  SELECT vec_id, CASE WHEN label >= 5 THEN 1 ELSE 0 END AS label,
         CASE WHEN {_sdot([f'CAST(embedding[{i + 1}] AS DOUBLE)' for i in range(64)],
                          [dbl(w) for w in (1.0, -1.0) * 32])} >= 0 THEN 1 ELSE 0 END AS prediction
  FROM embeddings)
"""

ORACLE_SQL["confusion_f1"] = f"""
WITH {_SCORED},
c AS (SELECT count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp,
             count(*) FILTER (WHERE label <> 1 AND prediction = 1) AS fp,
             count(*) FILTER (WHERE label = 1 AND prediction <> 1) AS fn,
             count(*) FILTER (WHERE label <> 1 AND prediction <> 1) AS tn FROM scored)
SELECT tp, fp, fn, tn,
       round(CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END, 9) AS f1
FROM c
"""

ORACLE_SQL["confusion_matrix"] = f"""
WITH {_SCORED}
SELECT label, prediction, count(*) AS n FROM scored GROUP BY label, prediction
"""

ORACLE_SQL["false_positives"] = f"""
WITH {_SCORED}
SELECT vec_id, label, prediction FROM scored WHERE label = 0 AND prediction = 1 ORDER BY vec_id LIMIT 3
"""


def cluster_top_sql(assign_cte: str) -> str:
    return f"""
WITH {assign_cte},
sizes AS (SELECT cluster, count(*) AS n_docs FROM a GROUP BY cluster),
ranked AS (SELECT cluster, n_docs, row_number() OVER (ORDER BY n_docs DESC, cluster) AS size_rank FROM sizes),
counts AS (SELECT cluster, label, count(*) AS label_count FROM a GROUP BY cluster, label),
top AS (SELECT cluster, label, label_count,
               row_number() OVER (PARTITION BY cluster ORDER BY label_count DESC, label) AS label_rank
        FROM counts QUALIFY label_rank <= 3)
SELECT t.cluster, r.n_docs, r.size_rank, t.label, t.label_count, t.label_rank,
       round(t.label_count / r.n_docs, 9) AS share
FROM top t JOIN ranked r ON t.cluster = r.cluster
"""


ORACLE_SQL["cluster_label_top3"] = cluster_top_sql("a AS (SELECT source AS cluster, lang AS label FROM documents)")

_ASSIGN = """
lines AS (SELECT '(' || regexp_extract(source, '([0-9]+)', 1) || ', ''<doc id="20_newsgroups/' || lang || '/'
                 || CAST(doc_id AS VARCHAR) || '" url="" title="' || source || '">'')' AS value FROM documents),
a AS (SELECT TRY_CAST(regexp_extract(value, '^\\((-?[0-9]+),', 1) AS INTEGER) AS cluster,
             regexp_extract(value, '20_newsgroups/[^/]+/([^"]*)"', 1) AS doc_id,
             regexp_extract(value, '20_newsgroups/([^/]+)/', 1) AS label FROM lines)
"""

ORACLE_SQL["assignment_parse"] = f"""
WITH {_ASSIGN},
sizes AS (SELECT cluster, count(*) AS n_docs FROM a GROUP BY cluster)
SELECT cluster, n_docs, row_number() OVER (ORDER BY n_docs DESC, cluster) AS size_rank FROM sizes
"""

ORACLE_SQL["assignment_newsgroups"] = cluster_top_sql(_ASSIGN)

# ---------------------------------------------------------------- topic model
PUNCT = char_class(ASCII_PUNCTUATION)


def topic_base(vocab_size: int) -> str:
    return f"""
tv_toks AS (SELECT unnest(regexp_split_to_array(text, {lit(PY_WHITESPACE + '+')})) AS raw FROM documents),
tv_words AS (SELECT regexp_replace(lower(raw), {lit('^' + EDGE + '+|' + EDGE + '+$')}, '', 'g') AS word
             FROM tv_toks WHERE raw <> ''),
tv_counts AS (SELECT word, count(*) AS count FROM tv_words WHERE length(word) >= 2 GROUP BY word),
tvocab AS (SELECT word, CAST(row_number() OVER (ORDER BY count DESC, word) - 1 AS INTEGER) AS pos FROM tv_counts
           QUALIFY row_number() OVER (ORDER BY count DESC, word) <= {vocab_size}),
dt_raw AS (SELECT doc_id, unnest(string_split(text, ' ')) AS raw FROM documents),
dt AS (SELECT doc_id, regexp_replace(lower(raw), {lit('^' + PUNCT + '+|' + PUNCT + '+$')}, '', 'g') AS word
       FROM dt_raw WHERE regexp_matches(raw, {lit(WORD_PATTERN)})),
dcnt AS (SELECT d.doc_id, v.pos, count(*) AS cnt FROM dt d JOIN tvocab v ON d.word = v.word
         WHERE length(d.word) > 2 GROUP BY d.doc_id, v.pos),
dc AS (SELECT doc_id, TRY_CAST(regexp_extract(source, '([0-9]+)', 1) AS INTEGER) AS cluster FROM documents),
kall AS (SELECT DISTINCT cluster FROM dc WHERE cluster IS NOT NULL),
ct AS (SELECT dc.cluster, dcnt.pos, sum(dcnt.cnt) AS cnt FROM dcnt JOIN dc ON dc.doc_id = dcnt.doc_id
       GROUP BY dc.cluster, dcnt.pos),
gc AS (SELECT k.cluster, v.pos, CAST(coalesce(ct.cnt, 0) AS BIGINT) AS cnt
       FROM kall k CROSS JOIN tvocab v LEFT JOIN ct ON ct.cluster = k.cluster AND ct.pos = v.pos)
"""


ORACLE_SQL["topic_cluster_counts"] = f"WITH {topic_base(20000)} SELECT cluster, pos, cnt FROM gc"

ORACLE_SQL["topic_words_fixed"] = f"""
WITH {topic_base(20000)},
pr AS (SELECT cluster, pos, (CAST(cnt AS DOUBLE) + {dbl(0.1)})
              / (CAST(sum(cnt) OVER (PARTITION BY cluster) AS DOUBLE)
                 + CAST(count(*) OVER (PARTITION BY cluster) AS DOUBLE) * {dbl(0.1)}) AS prob FROM gc),
top AS (SELECT cluster, pos, prob, row_number() OVER (PARTITION BY cluster ORDER BY prob DESC, pos) AS rank
        FROM pr QUALIFY rank <= 100)
SELECT t.cluster AS topic, t.rank, v.word, round(t.prob, 9) AS prob FROM top t JOIN tvocab v ON t.pos = v.pos
"""

ORACLE_SQL["topic_assign_step"] = f"""
WITH {topic_base(20000)},
ks AS (SELECT cluster, count(*) AS n FROM dc GROUP BY cluster),
logpi AS (SELECT k.cluster,
                 ln((CAST(coalesce(ks.n, 0) AS DOUBLE) + {dbl(0.1)})
                    / (CAST((SELECT count(*) FROM dc) AS DOUBLE)
                       + CAST((SELECT count(*) FROM kall) AS DOUBLE) * {dbl(0.1)})) AS lp
          FROM kall k LEFT JOIN ks ON ks.cluster = k.cluster),
sm AS (SELECT cluster, pos, CAST(cnt AS DOUBLE) + {dbl(0.1)} AS s FROM gc),
logmu AS (SELECT cluster, pos, ln(s) - ln(sum(s) OVER (PARTITION BY cluster)) AS lm FROM sm),
dots AS (SELECT d.doc_id, m.cluster, sum(CAST(d.cnt AS DOUBLE) * m.lm) AS s
         FROM dcnt d JOIN logmu m ON d.pos = m.pos GROUP BY d.doc_id, m.cluster),
scores AS (SELECT d.doc_id, p.cluster, p.lp + coalesce(x.s, 0) AS score
           FROM documents d CROSS JOIN logpi p
           LEFT JOIN dots x ON x.doc_id = d.doc_id AND x.cluster = p.cluster),
g AS (SELECT doc_id, cluster, score,
             score - ln(-ln((CAST(('0x' || substr(md5(concat_ws(':', '42', '0', CAST(doc_id AS VARCHAR),
                 CAST(cluster AS VARCHAR))), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0)) AS key
      FROM scores),
mx AS (SELECT doc_id, max(score) AS m FROM g GROUP BY doc_id),
z AS (SELECT g.doc_id, sum(exp(g.score - mx.m)) AS zs FROM g JOIN mx ON g.doc_id = mx.doc_id GROUP BY g.doc_id),
pick AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY key DESC, cluster) = 1)
SELECT p.doc_id, p.cluster, round(exp(p.score - mx.m) / z.zs, 6) AS posterior
FROM pick p JOIN mx ON p.doc_id = mx.doc_id JOIN z ON p.doc_id = z.doc_id
"""

# ---- a Gibbs fit of three sweeps, draw by draw (20 clusters, seed 42, alpha = beta = 0.1)


def _uniform_sql(*parts: str) -> str:
    text = "concat_ws(':', '42', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"((CAST(('0x' || substr(md5({text}), 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0)"


def _trials_sql(source: str, it: int, first: int, last: int) -> str:
    """Accepted trials (cluster, pos, j, lg) of the cells of ``source``."""
    text = f"concat_ws(':', '42', '{it}', CAST(s.cluster AS VARCHAR), CAST(s.pos AS VARCHAR), CAST(r.range AS VARCHAR))"
    u0, u1, u2 = (f"((CAST(('0x' || substr(h, {s}, 10)) AS BIGINT) + 0.5) / 1099511627776.0)" for s in (1, 11, 21))
    return f"""
SELECT cluster, pos, j, ln(d) + 3 * ln(root) AS lg FROM (
  SELECT *, 1 + x / sqrt(9 * d) AS root FROM (
    SELECT *, sqrt(-2 * ln({u0})) * cos(2 * pi() * {u1}) AS x, ln({u2}) AS lu FROM (
      SELECT s.cluster, s.pos, s.d, CAST(r.range AS INTEGER) AS j, md5({text}) AS h FROM {source} s CROSS JOIN range({first}, {last}) r)))
WHERE root > 0 AND lu < 0.5 * x * x + d - d * exp(3 * ln(greatest(root, 1e-300))) + d * 3 * ln(greatest(root, 1e-300))
"""


def _draw_sql(it: int) -> str:
    cnt = "coalesce(c.cnt, 0)" if it else "0"
    join = f"LEFT JOIN c{it} c ON c.cluster = g.cluster AND c.pos = g.pos" if it else ""
    boost = _uniform_sql(str(it), "s.cluster", "s.pos", "'boost'")
    return f"""
s{it} AS MATERIALIZED (SELECT cluster, pos, a, (CASE WHEN a < 1 THEN a + 1 ELSE a END) - {dbl(1)} / 3 AS d
  FROM (SELECT g.cluster, g.pos, CAST({cnt} AS DOUBLE) + {dbl(0.1)} AS a FROM cells g {join})),
early{it} AS MATERIALIZED (SELECT cluster, pos, arg_min(lg, j) AS lg FROM ({_trials_sql(f's{it}', it, 0, 2)}) GROUP BY cluster, pos),
rest{it} AS MATERIALIZED (SELECT s.* FROM s{it} s ANTI JOIN early{it} e ON s.cluster = e.cluster AND s.pos = e.pos),
late{it} AS MATERIALIZED (SELECT cluster, pos, arg_min(lg, j) AS lg FROM ({_trials_sql(f'rest{it}', it, 2, 12)}) GROUP BY cluster, pos),
g{it} AS MATERIALIZED (SELECT s.cluster, s.pos,
    coalesce(e.lg, l.lg, ln(s.d)) + CASE WHEN s.a < 1 THEN ln({boost}) / s.a ELSE 0 END AS g
  FROM s{it} s LEFT JOIN early{it} e ON s.cluster = e.cluster AND s.pos = e.pos
  LEFT JOIN late{it} l ON s.cluster = l.cluster AND s.pos = l.pos),
lm{it} AS MATERIALIZED (SELECT g.cluster, g.pos, g.g - (t.top + ln(z.total)) AS lm FROM g{it} g
  JOIN (SELECT cluster, max(g) AS top FROM g{it} WHERE pos >= 0 GROUP BY cluster) t ON g.cluster = t.cluster
  JOIN (SELECT a.cluster, sum(exp(a.g - b.top)) AS total FROM g{it} a
        JOIN (SELECT cluster, max(g) AS top FROM g{it} WHERE pos >= 0 GROUP BY cluster) b ON a.cluster = b.cluster
        WHERE a.pos >= 0 GROUP BY a.cluster) z ON g.cluster = z.cluster
  WHERE g.pos >= 0)"""


def _sweep_sql(it: int) -> str:
    """Assignment ``it`` under the parameters of draw ``it`` - 1, and its counts."""
    return f"""
sc{it} AS MATERIALIZED (SELECT d.doc_id, p.cluster, p.g + coalesce(x.s, 0) AS score
  FROM documents d CROSS JOIN (SELECT cluster, g FROM g{it - 1} WHERE pos = -1) p
  LEFT JOIN (SELECT t.doc_id, m.cluster, sum(CAST(t.cnt AS DOUBLE) * m.lm) AS s
             FROM dcnt t JOIN lm{it - 1} m ON t.pos = m.pos GROUP BY t.doc_id, m.cluster) x
    ON x.doc_id = d.doc_id AND x.cluster = p.cluster),
pick{it} AS MATERIALIZED (SELECT doc_id, cluster, score FROM sc{it}
  QUALIFY row_number() OVER (PARTITION BY doc_id
    ORDER BY score - ln(-ln({_uniform_sql(str(it), 'doc_id', 'cluster')})) DESC, cluster) = 1),
c{it} AS MATERIALIZED (SELECT p.cluster, t.pos, sum(t.cnt) AS cnt FROM dcnt t JOIN pick{it} p ON p.doc_id = t.doc_id GROUP BY p.cluster, t.pos
  UNION ALL SELECT cluster, -1, count(*) FROM pick{it} GROUP BY cluster)"""


def gibbs_sql(sweeps: int, last_draw: bool) -> str:
    parts = [topic_base(20000).replace("dcnt AS (", "dcnt AS MATERIALIZED ("),
             "\ncells AS MATERIALIZED (SELECT CAST(k.range AS INTEGER) AS cluster, p.pos FROM range(20) k "
             "CROSS JOIN (SELECT -1 AS pos UNION ALL SELECT pos FROM tvocab) p)"]
    for it in range(sweeps):
        parts += [_draw_sql(it), _sweep_sql(it + 1)]
    if last_draw:
        parts.append(_draw_sql(sweeps))
    return "WITH " + ",".join(parts)


ORACLE_SQL["topic_gibbs_short"] = f"""
{gibbs_sql(3, False)}
SELECT p.doc_id, p.cluster, round(exp(p.score - m.top) / m.total, 6) AS posterior FROM pick3 p
JOIN (SELECT s.doc_id, any_value(t.top) AS top, sum(exp(s.score - t.top)) AS total FROM sc3 s
      JOIN (SELECT doc_id, max(score) AS top FROM sc3 GROUP BY doc_id) t ON s.doc_id = t.doc_id GROUP BY s.doc_id) m
  ON p.doc_id = m.doc_id
"""

ORACLE_SQL["topic_gibbs_short_words"] = f"""
{gibbs_sql(3, True)}
SELECT t.cluster AS topic, CAST(t.rank AS INTEGER) AS rank, v.word, round(t.lm, 6) AS log_prob
FROM (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY lm DESC, pos) AS rank FROM lm3 QUALIFY rank <= 100) t
JOIN tvocab v ON t.pos = v.pos
"""
