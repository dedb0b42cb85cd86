"""Secret scans with a randomness test battery, DataFrame functions only.

Three fixed patterns give the base spans. Beyond them, every long token of key characters is
tested. Its encoding is inferred from the characters it uses; over that alphabet the battery
asks whether it looks drawn at random: chi-squared uniformity of the symbols, the runs test
above and below the middle of the alphabet, and lag-1 serial correlation (Bonferroni over the
three). Random-looking is not enough, since short words pass weak tests: the p-value of the
token under ordinary text (changes of character class, index of coincidence) goes through
Benjamini-Hochberg false-discovery control over all tested tokens of the corpus, in strata of
length, so short tokens need more evidence where there are many of them. A token is a
secret if it is discovered and the battery does not reject randomness.

Positions count code points; ends are exclusive. Texts that no pattern touches cost one scan
per pattern and nothing else; only digests, spans and tested tokens are shuffled.

Empty and edge input: NULL and empty texts have no spans; every row is answered, repeated or
not; a NULL id is an id. Spans depend on the text alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkloom.llm.tables import split_by_slot
from sparkloom.session import materialize

# fixed values: the base patterns and least lengths; kinds in their order
ASSIGN = r"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_VALUE = 8

TOKEN = r"[A-Za-z0-9+/_-]{20,}={0,2}"
FALSE_DISCOVERY = 1e-3
RANDOM_LEVEL = 1e-4
TEXT_CLASS_CHANGES = 0.1  # per adjacent pair, in ordinary tokens
TEXT_COINCIDENCE = 0.066
STRATA = (32, 64, 128)
_SPAN = "array<struct<start:int,kind:int,end:int>>"
_LOWER, _UPPER, _DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"


def _matches(text: Column, pattern: str, value_group: int = 0) -> Column:
    """``array<struct<start,end,value>>`` of all matches, from the gaps between them."""
    found = F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hit"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("value"),
    )
    empty = F.expr("cast(array() as array<struct<start:int,end:int,value:string>>)")

    def step(state, x):
        start = state["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["hit"]), F.lit(0))
        one = F.array(F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value")))
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), state["out"]).otherwise(F.concat(state["out"], one)).alias("out"))

    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))
    folded = F.aggregate(found, start, step, lambda s: s["out"])
    return F.when(text.rlike(pattern), folded).otherwise(empty)


def _spans(found: Column, kind: int) -> Column:
    return F.transform(found, lambda x: F.struct(x["start"].alias("start"), F.lit(kind).alias("kind"), x["end"].alias("end")))


def base_spans(text: Column) -> Column:
    assign = F.filter(_matches(text, ASSIGN, 1), lambda x: F.length(x["value"]) >= LEAST_VALUE)
    return F.array_sort(F.concat(_spans(assign, 0), _spans(_matches(text, ACCESS), 1), _spans(_matches(text, HEX), 2)))


def _normal_tail(z: Column) -> Column:
    """P(Z > z): the tanh approximation near 0, the leading tail term beyond 3."""
    near = 0.5 * (1 - F.tanh(0.7978845608 * (z + 0.044715 * z * z * z)))
    far = F.exp(-z * z / 2) / (z * 2.50662827463)
    return F.when(z > 3, far).otherwise(near)


def battery(tokens: DataFrame, token_col: str = "token") -> DataFrame:
    """``tokens`` with ``encoding``, the three test p-values, ``p_random`` and ``p_text``."""
    body = F.regexp_replace(token_col, "=+$", "")
    cases = (
        ("digits", "^[0-9]+$", _DIGIT),
        ("hex", "^(?=.*[0-9])([0-9a-f]+|[0-9A-F]+)$", _DIGIT + "abcdef"),
        ("lower", "^[a-z]+$", _LOWER),
        ("upper", "^[A-Z]+$", _UPPER),
        ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
        ("alphanumeric", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGIT),
    )
    encoding, alphabet = F, F
    for name, pattern, symbols in cases:
        encoding = encoding.when(F.col("body").rlike(pattern), name)
        alphabet = alphabet.when(F.col("encoding") == name, symbols)
    alphabet = alphabet.otherwise(_UPPER + _LOWER + _DIGIT + "+/-_")
    rows = tokens.withColumn("body", body).withColumn("encoding", encoding.otherwise("base64")).withColumn("alphabet", alphabet)
    symbols = F.regexp_extract_all(F.when(F.col("encoding") == "hex", F.lower("body")).otherwise(F.col("body")), F.lit("(?s)."), F.lit(0))
    rows = rows.withColumn("symbols", symbols)
    rows = rows.withColumn("v", F.expr("transform(symbols, c -> cast(instr(alphabet, c) - 1 as double))"))
    n = F.size("v").cast("double")
    # base64 has two spellings of its last two symbols, so 66 characters stand for 64
    m = F.least(F.length("alphabet"), F.lit(64)).cast("double")
    rows = rows.withColumns({
        "n": n, "m": m,
        "squares": F.expr("aggregate(array_distinct(v), 0D, (t, x) -> t + pow(size(filter(v, y -> y = x)), 2))"),
        "mean": F.expr("aggregate(v, 0D, (t, x) -> t + x) / size(v)"),
        "high": F.expr("transform(v, x -> x >= length(alphabet) / 2)"),
        "class": F.expr("transform(symbols, c -> CASE WHEN c BETWEEN '0' AND '9' THEN 0 WHEN c BETWEEN 'a' AND 'z' THEN 1 WHEN c BETWEEN 'A' AND 'Z' THEN 2 ELSE 3 END)"),
    })
    rows = rows.withColumns({
        "chi2": F.col("m") * F.col("squares") / F.col("n") - F.col("n"),
        "n1": F.expr("cast(size(filter(high, x -> x)) as double)"),
        "runs": F.expr("1D + size(filter(sequence(1, size(high) - 1), i -> high[i] <> high[i - 1]))"),
        "changes": F.expr("cast(size(filter(sequence(1, size(class) - 1), i -> class[i] <> class[i - 1])) as double)"),
        "lag": F.expr("aggregate(sequence(1, size(v) - 1), 0D, (t, i) -> t + (v[i] - mean) * (v[i - 1] - mean))"),
        "spread": F.expr("aggregate(v, 0D, (t, x) -> t + (x - mean) * (x - mean))"),
    })
    k = F.col("m") - 1
    z_chi = (F.pow(F.col("chi2") / k, F.lit(1 / 3)) - (1 - 2 / (9 * k))) / F.sqrt(2 / (9 * k))
    n, n1, n2 = F.col("n"), F.col("n1"), F.col("n") - F.col("n1")
    mean_runs = 1 + 2 * n1 * n2 / n
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    z_runs = F.when(var_runs > 0, (F.col("runs") - mean_runs) / F.sqrt(var_runs)).otherwise(-n)
    z_lag = F.when(F.col("spread") > 0, F.col("lag") / F.col("spread") * F.sqrt(n)).otherwise(n)
    rows = rows.withColumns({
        "p_uniform": _normal_tail(z_chi),
        "p_runs": 2 * _normal_tail(F.abs(z_runs)),
        "p_serial": 2 * _normal_tail(F.abs(z_lag)),
    })
    pairs = n - 1
    z_change = (F.col("changes") - TEXT_CLASS_CHANGES * pairs) / F.sqrt(TEXT_CLASS_CHANGES * (1 - TEXT_CLASS_CHANGES) * pairs)
    coincidence = (F.col("squares") - n) / (n * (n - 1))
    z_same = (TEXT_COINCIDENCE - coincidence) / F.sqrt(2 * TEXT_COINCIDENCE / (n * (n - 1)))
    return rows.withColumns({
        "p_random": F.least(F.lit(1.0), 3 * F.least("p_uniform", "p_runs", "p_serial")),
        "p_text": F.greatest(F.lit(1e-40), F.least(F.lit(1.0), 2 * F.least(_normal_tail(z_change), _normal_tail(z_same)))),
    }).drop("body", "alphabet", "symbols", "v", "high", "class", "squares", "mean", "n1", "lag", "spread")


def discovered(tested: DataFrame, level: float = FALSE_DISCOVERY) -> DataFrame:
    """The rows of ``tested`` that Benjamini-Hochberg rejects as text in their length stratum
    and that pass the battery. Ranks come from a histogram of -log10 p (quarter steps, at most
    161 bins a stratum), so no task sees all tokens."""
    stratum = F.lit(0)
    for s in STRATA:
        stratum = stratum + (F.col("n") >= s).cast("int")
    rows = tested.withColumns({"stratum": stratum, "bin": F.floor(-4 * F.log10("p_text")).cast("int")})
    counts = rows.groupBy("stratum", "bin").agg(F.count("*").alias("n"))
    down = W.partitionBy("stratum").orderBy(F.desc("bin"))
    ranked = counts.withColumns({
        "rank": F.sum("n").over(down), "all": F.sum("n").over(W.partitionBy("stratum"))})
    # the largest p-value of a bin stands for the bin
    passing = ranked.filter(F.pow(F.lit(10.0), -F.col("bin") / 4) * F.col("all") <= level * F.col("rank"))
    cut = passing.groupBy("stratum").agg(F.min("bin").alias("cut"))
    good = (F.col("bin") >= F.col("cut")) & (F.col("p_random") >= RANDOM_LEVEL) & (F.col("encoding") != "digits")
    return rows.join(F.broadcast(cut), "stratum").filter(good)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, text_key, base, spans)``, one row per row of ``docs``: arrays of (start,
    kind index into KINDS, end) sorted by start and kind. ``text_key`` is the text's hash."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = materialize(docs.select(
        F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_key"),
        base_spans(text).cast(_SPAN).alias("base"), _matches(text, TOKEN).alias("tokens")))
    tokens = (
        rows.filter(F.size("tokens") > 0).dropDuplicates(["doc_id", "text_key"])
        .select("doc_id", "text_key", "base", F.explode("tokens").alias("t"))
        .select("doc_id", "text_key", F.col("t.start").alias("start"), F.col("t.end").alias("end"), F.col("t.value").alias("token"),
                F.exists("base", lambda b: (b["start"] < F.col("t.end")) & (b["end"] > F.col("t.start"))).alias("known"))
    )
    new = discovered(materialize(battery(tokens))).filter("not known")
    added = new.groupBy("doc_id", "text_key").agg(
        F.collect_list(F.struct("start", F.lit(3).alias("kind"), "end")).cast(_SPAN).alias("more")
    ).select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), "more")
    both = rows.join(added, rows.doc_id.eqNullSafe(added["__d"]) & (rows.text_key == added["__t"]), "left")
    none = F.expr(f"cast(array() as {_SPAN})")
    return both.select("doc_id", "text_key", "base", F.array_sort(F.concat("base", F.coalesce("more", none))).alias("spans"))


def rendered(spans: Column) -> Column:
    """``kind:start:end`` joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every span of a text replaced by ``mark``; other columns stay."""
    found = scan(docs, id_col, text_col).filter(F.size("spans") > 0).dropDuplicates(["doc_id", "text_key"])
    found = materialize(found.select(F.col("doc_id").alias("__d"), F.col("text_key").alias("__t"), F.col("spans").alias("__spans")))
    key = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    near, far = split_by_slot(docs, key, found, F.col("__t"))
    both = near.join(found, near[id_col].eqNullSafe(found["__d"]) & (key == found["__t"]), "left")

    def step(state, s):
        between = F.substring(F.col(text_col), state["at"] + 1, s["start"] - state["at"])
        cut = F.struct(s["end"].alias("at"), F.concat(state["out"], between, F.lit(mark)).alias("out"))
        inside = F.struct(F.greatest(state["at"], s["end"]).alias("at"), state["out"].alias("out"))
        return F.when(s["start"] >= state["at"], cut).otherwise(inside)

    rest = F.aggregate("__spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                       lambda s: F.concat(s["out"], F.substring(F.col(text_col), s["at"] + 1, F.length(text_col))))
    clean = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(rest)
    both = both.select(*[clean.alias(c) if c == text_col else F.col(c) for c in docs.columns])
    return both.unionAll(far.select(*docs.columns))
