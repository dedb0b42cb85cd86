"""Mixing sources to target weights by pivotal dependent rounding, DataFrame functions only.

A source's rate (target words / own words) gives each of its documents a whole number of
copies and the same fractional probability of one more. Two documents of a source are paired:
mass (size times probability, so that words are preserved exactly) moves at random from one
to the other until one probability is 0 or 1 and that document is settled; the other goes on
with what is left, and its expectation is unchanged. A block of documents ends in at most one
unsettled document, the blocks' residuals are blocked again, and so on: a reduction tree whose
depth is the logarithm of the largest source. The root residual of a source is rounded to the
nearer side, so a source misses its target by at most half of one document.

All random numbers are hashes of (seed, level, document), so reruns agree. Hot sources are
many blocks; rows that are equal in all of (id, source, size) are one weighted unit, of which
as many rows as settled get the extra copy.

Empty and edge input: NULL text or no words is size 0, which is never worth a draw; a NULL
source is the last source; an empty table gives an empty mix; NULL and repeated ids are rows
like any other.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from sparkloom.session import materialize

WORD = r"[^\x20\x09-\x0D]+"  # fixed value
WEIGHTS = (5, 2, 1)
MOST = 3  # copies of a document, and target of a source in multiples of its size
BLOCK = 64
_SALTS = 64

_UNIT = "struct<doc_id:{id},source:string,size:bigint,m:bigint,whole:bigint,source_size:bigint,target:double>"


def with_rank(rows: DataFrame, *order) -> DataFrame:
    """``rows`` with their 0-based rank, without one task seeing all of them: ranges are
    numbered inside, and shifted by the counts of the ranges before."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = materialize(rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()))
    before, shift = 0, {}
    for part, n in sorted(dealt.groupBy("__part").count().toPandas().itertuples(index=False)):
        shift[part], before = before, before + n
    if not shift:
        return dealt.withColumn("rank", F.lit(0).cast("long")).drop("__part")
    shifts = spark.createDataFrame(list(shift.items()), "__part int, __shift long")
    number = F.row_number().over(W.partitionBy("__part").orderBy(*order)) - 1
    return dealt.join(F.broadcast(shifts), "__part").withColumn("rank", number + F.col("__shift")).drop("__part", "__shift")


def targets(sources: DataFrame, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources (source, source_size, ...)`` with ``target``: shares of all words by weight,
    at most ``most`` times the source's own, the excess shared again among the others."""
    ranked = with_rank(sources, F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = materialize(ranked.withColumn("weight", weight))
    total, everything = ranked.agg(F.sum("source_size"), F.sum("weight")).first()
    level, cap = (total or 0) / everything if everything else 0.0, most * F.col("source_size")
    while True:  # each round caps at least one more source
        full, their = ranked.filter(F.col("weight") * F.lit(level) > cap).agg(F.sum(cap), F.sum("weight")).first()
        free = (everything or 0) - (their or 0)
        again = (total - (full or 0)) / free if free > 0 else level
        if again <= level:
            break
        level = again
    return ranked.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(float(level))))


def _uniform(*columns):
    """[0, 1) from a hash."""
    return f"(shiftrightunsigned(xxhash64({', '.join(columns)}), 11) / 9007199254740992D)"


def _pivot(unit: str, item: str, level: int, seed: int) -> str:
    """SQL: fold a block's items into (cur, done); see the module text for the step."""
    a, b, p, q = "s.cur.u.size", "x.u.size", "s.cur.p", "x.p"
    up, down = f"least(1 - {p}, {q} * {b} / {a})", f"least({p}, (1 - {q}) * {b} / {a})"
    draw = _uniform(str(seed), str(level), "s.cur.h", "x.h")

    def settled(who, bit, other, prob):
        return (
            f"named_struct('cur', named_struct('neg', {other}.neg, 'h', {other}.h, 'p', {prob}, 'u', {other}.u),"
            f" 'done', concat(s.done, array(named_struct('u', {who}.u, 'bit', {bit}))))"
        )

    step = f"""
      CASE WHEN s.cur IS NULL THEN named_struct('cur', x, 'done', s.done)
      WHEN {draw} * ({up} + {down}) < {down} THEN
        CASE WHEN 1 - {p} <= {q} * {b} / {a} THEN {settled('s.cur', 1, 'x', f'{q} - (1 - {p}) * {a} / {b}')}
        ELSE {settled('x', 0, 's.cur', f'{p} + {q} * {b} / {a}')} END
      ELSE
        CASE WHEN {p} <= (1 - {q}) * {b} / {a} THEN {settled('s.cur', 0, 'x', f'{q} + {p} * {a} / {b}')}
        ELSE {settled('x', 1, 's.cur', f'{p} - (1 - {q}) * {b} / {a}')} END
      END"""
    start = f"named_struct('cur', cast(null as {item}), 'done', cast(array() as array<struct<u:{unit},bit:int>>))"
    return f"aggregate(items, {start}, (s, x) -> {step})"


def settle(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", seed: int = 17, block: int = BLOCK) -> DataFrame:
    """One row per distinct (doc_id, source, size): ``m`` rows of it, ``whole`` copies of each
    and ``extra`` more copies in all, with its source's ``source_size`` and ``target``."""
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    units = materialize(
        docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), size.alias("size"))
        .groupBy("doc_id", "source", "size").agg(F.count("*").alias("m"))
    )
    sources = targets(units.groupBy("source").agg(F.sum(F.col("size") * F.col("m")).alias("source_size"), F.count("*").alias("units")))
    # one row per source, dealt over salts so that a hot source is not one join key
    salted = sources.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))).withColumnRenamed("source", "__s")
    h = F.xxhash64(F.lit(seed), "doc_id", "size")
    rows = units.withColumn("salt", F.pmod(h, F.lit(_SALTS)).cast("int"))
    rows = rows.join(salted, (rows.salt == salted.salt) & rows.source.eqNullSafe(salted["__s"]))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    mass = F.col("m") * (rate - F.floor(rate))
    rows = rows.select(
        "doc_id", "source", "size", "m", "source_size", "target", "units", "rank", h.alias("h"),
        F.floor(rate).cast("long").alias("whole"), F.floor(mass).cast("long").alias("sure"), (mass - F.floor(mass)).alias("p"),
    )
    rows = materialize(rows)
    id_type = units.schema["doc_id"].dataType.simpleString()
    unit = _UNIT.format(id=id_type)
    item = f"struct<neg:bigint,h:bigint,p:double,u:{unit}>"
    draws = (F.col("p") > 0) & (F.col("size") > 0)
    columns = ["doc_id", "source", "size", "m", "whole", "source_size", "target"]
    sure = rows.filter(~draws).select(*columns, F.col("sure").alias("extra"))
    largest = rows.agg(F.max("units")).first()[0] or 0
    level, spread, done = 0, block, []
    current = rows.filter(draws).select(
        "rank", "units",
        F.expr(f"cast(named_struct('neg', -size, 'h', h, 'p', p, 'u', named_struct({', '.join(f'{chr(39)}{c}{chr(39)}, {c}' for c in columns)})) as {item})").alias("item"))
    while True:
        blocks = F.ceil(F.col("units") / F.lit(spread))
        folded = (
            current.groupBy("rank", "units", F.pmod(F.xxhash64("item.h", F.lit(level)), blocks).alias("block"))
            .agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select("rank", "units", F.expr(_pivot(unit, item, level, seed)).alias("s"))
        )
        folded = materialize(folded.select("rank", "units", "s.cur", "s.done"))
        done.append(folded.select(F.inline("done")))
        current = folded.select("rank", "units", F.col("cur").alias("item"))
        if spread >= largest:
            break
        level, spread = level + 1, spread * block
    done.append(current.select(F.col("item.u").alias("u"), F.when(F.col("item.p") >= 0.5, 1).otherwise(0).alias("bit")))
    drawn = done[0]
    for part in done[1:]:
        drawn = drawn.unionAll(part)
    # the sure part of a repeated row's mass follows from its source's rate, as above
    again = F.col("u.target") / F.col("u.source_size")
    whole_mass = F.floor(F.col("u.m") * (again - F.floor(again))).cast("long")
    return sure.unionAll(drawn.select("u.*", (whole_mass + F.col("bit")).alias("extra")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, source, size, source_size, target, copies, taken)``, one row per row of ``docs``."""
    units = settle(docs, **options)
    rows = units.withColumn("j", F.explode(F.sequence(F.lit(1).cast("long"), F.col("m"))))
    return _copies(rows).select("doc_id", "source", "size", "source_size", "target", "copies", "taken")


def _copies(rows: DataFrame) -> DataFrame:
    share = F.floor(F.col("extra") / F.col("m")) + F.when(F.col("j") <= F.col("extra") % F.col("m"), 1).otherwise(0)
    rows = rows.withColumn("copies", (F.col("whole") + share).cast("long"))
    return rows.withColumn("taken", F.col("copies") * F.col("size"))


def mix_documents(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", **options) -> DataFrame:
    """``docs`` with ``mix_size``, ``mix_target``, ``mix_copies`` and ``mix_taken``."""
    units = materialize(settle(docs, id_col, text_col, source_col, **options))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")

    def key(*columns):  # NULL fields of two structs are equal; one exchange serves join and window
        return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(columns)])

    left = docs.withColumn("__size", size)
    right = units.select(
        key(F.col("doc_id"), F.col("source"), F.col("size")).alias("__key"), F.col("m").alias("__m_u"),
        F.col("whole").alias("__whole_u"), F.col("extra").alias("__extra_u"), F.col("target").alias("__mix_target_u"))
    # cast here: where only the nullability of a field differs, the join would cast by itself, and
    # the window would then shuffle the texts once more by the key without the cast
    own = key(F.col(id_col), F.col(source_col).cast("string"), F.col("__size"))
    left = left.withColumn("__key", own.cast(right.schema["__key"].dataType))
    both = left.join(right, "__key")
    number = F.when(F.col("__m_u") > 1, F.row_number().over(W.partitionBy("__key").orderBy(F.lit(0)))).otherwise(F.lit(1))
    share = F.floor(F.col("__extra_u") / F.col("__m_u")) + F.when(number <= F.col("__extra_u") % F.col("__m_u"), 1).otherwise(0)
    copies = (F.col("__whole_u") + share).cast("long")
    out = both.withColumn("mix_copies", copies)
    return out.select(
        *docs.columns, F.col("__size").alias("mix_size"), F.col("__mix_target_u").alias("mix_target"), "mix_copies",
        (F.col("mix_copies") * F.col("__size")).alias("mix_taken"))
