"""Mixing sources to target weights by a low-discrepancy schedule.

Sizes are words. Sources in code point order (null last) take the weights in turn; targets are the shares of all words
by weight, stopped at ``max_epochs`` times the source's size, with the excess shared out again by weight
(``target = min(cap, level * weight)``, the level found from the sources sorted by ``cap / weight``).

The words of a source are laid end to end, documents shuffled by the MD5 of their id, and cut into blocks of
``block`` words; a new epoch starts where the line ends. Slot ``i`` of the schedule has the golden-ratio point
``i * g mod 1``; the cumulative target shares map it to a source, and its rank among the source's slots is the number
of the block it takes. Each source takes exactly ``floor(target)`` words: slots past them stay void, and slots that the
finite point sequence misses (a few per source) are added at the end.

The schedule decides when a document comes: every row of the result has its first and last slot, and ``mixed`` returns
the documents in this order, pass by pass, so that any stretch of the mix holds the sources in their shares.

Hot sources: a document's place on the line is a prefix sum over hash ranges and a window inside one range; slot ranks
are prefix sums over runs of slots. Rows equal in source, id and text are counted once with their number of copies.
Only totals are collected; sources are numbered and summed up in parts, too.

Defined results: null text and texts without words have size 0 and take nothing; a null source is a source, after all
others; a null id is an id like any other (hashed as the empty text); repeated rows each have their own place; an empty
table gives an empty result. Only the id, source and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.modeling import add_surrogate_key
from .common import stored, word_count, words

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
BLOCK = 256
#: Golden-ratio step on a circle of 2^31 points; their product stays below 2^62.
CIRCLE, STEP = 1 << 31, 1327217885
#: The unit interval is cut into cells for the join of points with sources; slots are ranked in runs.
CELLS, RUN, RANGE_ROWS = 4096, 1 << 16, 2000
#: Sources whose words are summed up before the shares are cumulated.
GROUP = 4096


def source_key(source: Column) -> Column:
    """A key that orders sources by code point with null last and joins null with null."""
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source))


def _digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")))


def sizes(docs: DataFrame, id_col: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """One row per (source, id, size, text's digest) with its number of copies; stored, as the later steps read it several
    times."""
    d = docs.select(source_key(F.col(source)).alias("skey"), F.col(id_col).alias("doc_id"),
                    word_count(F.col(text)).alias("size"), _digest(F.col(text)).alias("digest"))
    return stored(d.groupBy("skey", "doc_id", "size", "digest").agg(F.count("*").alias("copies")), "mix-sizes")


def _level(s: DataFrame, total: int, weights: int) -> float | None:
    """The level at which all targets ``min(cap, level * weight)`` add up to ``total``: sources above their cap are set to
    it and the rest is shared again, until no more are; None if all are. Every round is one aggregate over the sources."""
    level, before = total / weights if weights else None, None
    while level is not None and level != before:
        row = s.where(F.lit(level) * F.col("weight") > F.col("cap")).agg(F.sum("cap"), F.sum("weight")).first()
        free = weights - (row[1] or 0)
        before, level = level, (total - (row[0] or 0)) / free if free else None
    return level


def targets(sized: DataFrame, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per source: size, weight, target, whole words to take, and its interval of cumulative shares. Sources are numbered
    in order over range partitions, and summed up by ``GROUP`` of them, so that they may be as many as web hosts."""
    s = sized.groupBy("skey").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
    s = add_surrogate_key(s, ["skey"], "turn", start=0)
    cycle = F.array(*[F.lit(int(w)) for w in weights])
    s = s.withColumn("weight", F.element_at(cycle, (F.col("turn") % len(weights) + 1).cast("int")).cast("long"))
    s = stored(s.withColumn("cap", F.col("source_size") * max_epochs), "mix-sources")
    row = s.agg(F.sum("source_size"), F.sum("weight")).first()
    level = _level(s, row[0] or 0, row[1] or 0)
    cap = F.col("cap").cast("double")
    s = s.withColumn("target", cap if level is None else F.least(cap, F.lit(level) * F.col("weight")))
    s = s.withColumn("words", F.floor("target")).withColumn("group", F.expr(f"turn div {GROUP}"))
    groups = s.groupBy("group").agg(F.sum("words").alias("sum"))
    all_words = groups.agg(F.sum("sum")).first()[0] or 0
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("sum").over(earlier(Window.orderBy("group"))), F.lit(0))  # one row per GROUP sources
    inner = F.coalesce(F.sum("words").over(earlier(Window.partitionBy("group").orderBy("turn"))), F.lit(0))
    s = s.join(groups.select("group", first.alias("first")), "group").withColumn("upto", F.col("first") + inner)
    share = lambda c: c.cast("double") / F.lit(float(max(1, all_words)))
    return s.select("skey", "source_size", "weight", "target", "words", share(F.col("upto")).alias("lo"),
                    share(F.col("upto") + F.col("words")).alias("hi"))


def schedule(goal: DataFrame, slots: int, block: int = BLOCK) -> DataFrame:
    """(slot, skey, rank): which block of which source every slot takes."""
    spark = goal.sparkSession
    cells = max(CELLS, 1 << goal.count().bit_length())  # a point meets few sources' intervals, however many there are
    point = F.pmod((F.col("id") % CIRCLE) * STEP, F.lit(CIRCLE)) / F.lit(float(CIRCLE))
    points = spark.range(slots).select(F.col("id").alias("slot"), point.alias("u")).withColumn(
        "cell", F.floor(F.col("u") * cells))
    spans = goal.where("words > 0").select("skey", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * cells), F.least(F.floor(F.col("hi") * cells), F.lit(cells - 1)))).alias("cell"))
    hits = points.join(spans, "cell").where("u >= lo AND u < hi").select(
        "slot", "skey", F.floor(F.col("slot") / RUN).alias("run"))
    runs = hits.groupBy("skey", "run").agg(F.count("*").alias("n"))
    runs = runs.select("skey", "run", F.coalesce(F.sum("n").over(
        Window.partitionBy("skey").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inner = F.row_number().over(Window.partitionBy("skey", "run").orderBy("slot")) - 1
    ranked = hits.withColumn("inner", inner).join(runs, ["skey", "run"]).select(
        "slot", "skey", (F.col("first") + F.col("inner")).alias("rank"))
    need = goal.select("skey", F.ceil(F.col("words") / block).alias("need"))
    used = ranked.join(need, "skey").where("rank < need").select("slot", "skey", "rank")
    have = ranked.groupBy("skey").agg(F.count("*").alias("have"))
    missing = need.join(have, "skey", "left").withColumn("have", F.coalesce("have", F.lit(0))).where("have < need")
    tail = missing.select("skey", F.explode(F.sequence(F.col("have"), F.col("need") - 1)).alias("rank"))
    return used.unionByName(tail.select((F.lit(slots) + F.col("rank")).alias("slot"), "skey", "rank"))


def _places(sized: DataFrame) -> DataFrame:
    """``sized`` with the first word's place on its source's line."""
    n = sized.count()
    digits = max(1, min(8, math.ceil(math.log(max(1, n / RANGE_ROWS), 16))))
    keyed = sized.withColumn("key", F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).withColumn(
        "range", F.substring("key", 1, digits)).withColumn("span", F.col("size") * F.col("copies"))
    ranges = keyed.groupBy("skey", "range").agg(F.sum("span").alias("span"))
    ranges = ranges.select("skey", "range", F.coalesce(F.sum("span").over(
        Window.partitionBy("skey").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("first"))
    inside = Window.partitionBy("skey", "range").orderBy("key", "doc_id", "size", "digest").rowsBetween(
        Window.unboundedPreceding, -1)
    return (keyed.withColumn("inner", F.coalesce(F.sum("span").over(inside), F.lit(0)))
            .join(ranges, ["skey", "range"]).withColumn("start", F.col("first") + F.col("inner"))
            .select("skey", "doc_id", "size", "digest", "copies", "start"))


KEYS = ["skey", "doc_id", "size", "digest", "copy"]


def passes(sized: DataFrame, block: int = BLOCK, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per document row (copies numbered by ``copy``) and epoch in which the schedule reaches it: the words taken,
    its first word's place on the line of all epochs, and the first and last slot that take it. A row that is not reached
    stands once, without epoch and slots.

    Every document is cut at the block borders of each epoch; the pieces join the scheduled blocks on (source, block
    number), which spreads a hot source over all tasks."""
    goal = stored(targets(sized, weights, max_epochs), "mix-targets")
    total = goal.agg(F.sum("words")).first()[0] or 0
    plan = schedule(goal, math.ceil(total / block), block)
    rows = _places(sized).join(goal.select("skey", "source_size", "target", "words"), "skey")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    rows = rows.withColumn("start", F.col("start") + F.col("copy") * F.col("size"))
    reached = (F.col("size") > 0) & (F.col("start") < F.col("words"))
    last = F.floor((F.col("words") - 1 - F.col("start")) / F.greatest(F.col("source_size"), F.lit(1)))
    rows = rows.withColumn("epoch", F.explode_outer(F.when(reached, F.sequence(F.lit(0).cast("long"), last))))
    rows = rows.withColumn("p0", F.col("epoch") * F.col("source_size") + F.col("start")).withColumn(
        "p1", F.least(F.col("p0") + F.col("size"), F.col("words")))
    rows = rows.withColumn("rank", F.explode_outer(F.when(F.col("epoch").isNotNull(), F.sequence(
        F.floor(F.col("p0") / block), F.floor((F.col("p1") - 1) / block)))))
    overlap = F.least(F.col("p1"), (F.col("rank") + 1) * block) - F.greatest(F.col("p0"), F.col("rank") * block)
    joined = rows.withColumn("overlap", overlap).join(plan, ["skey", "rank"], "left")
    return joined.groupBy(*KEYS, "epoch").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.coalesce(F.sum(F.when(F.col("slot").isNotNull(), F.col("overlap"))), F.lit(0)).cast("long").alias("taken"),
        F.min("p0").alias("place"), F.min("slot").alias("first_slot"), F.max("slot").alias("last_slot"))


def mix(sized: DataFrame, block: int = BLOCK, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Per document row: its source's size and target, the words the schedule takes, and its first and last slot."""
    return passes(sized, block, weights, max_epochs).groupBy(*KEYS).agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.sum("taken").alias("taken"), F.min("first_slot").alias("first_slot"), F.max("last_slot").alias("last_slot"))


def mixed(docs: DataFrame, block: int = BLOCK, weights=WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mix itself, with the columns of ``docs`` (which has doc_id, source, text, n_chars), in the schedule's order:
    one row per pass over a document, at its first slot; the leading words for the pass in which its source's target
    ends. Documents the mix does not reach are left out. Partitions hold ranges of slots and are sorted, so that files
    written from them, and jobs that read these in order, follow the schedule."""
    take = passes(sizes(docs), block, weights, max_epochs).where("taken > 0").select(
        *KEYS, "taken", "first_slot", "place")
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                      source_key(F.col("source")).alias("skey"), F.col("doc_id"),
                      word_count(F.col("text")).alias("size"), _digest(F.col("text")).alias("digest"))
    # rows of one id and text are alike for the schedule: any of them is the first copy
    order = Window.partitionBy("skey", "doc_id", "size", "digest").orderBy(F.xxhash64("row"))
    own = own.withColumn("copy", (F.row_number().over(order) - 1).cast("long"))
    same = [F.col(f"o.{c}").eqNullSafe(F.col(f"t.{c}")) if c == "doc_id" else F.col(f"o.{c}") == F.col(f"t.{c}")
            for c in KEYS]
    both = own.alias("o").join(take.alias("t"), same).select(
        "row", F.col("o.size"), F.col("t.taken"), F.col("t.first_slot"), F.col("t.place"), F.col("t.skey"))
    order = ["first_slot", "skey", "place"]
    both = both.repartitionByRange(*order).sortWithinPartitions(*order)
    text = F.when(F.col("taken") >= F.col("size"), F.col("row.text")).otherwise(
        F.array_join(F.slice(words(F.col("row.text")), 1, F.col("taken").cast("int")), " "))
    new = {"text": text, "n_chars": F.length(text).cast("long")}
    return both.select(*[new.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def report(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken, first_slot, last_slot."""
    return mix(sizes(docs)).select("doc_id", "size", "source_size", "target", "taken", "first_slot", "last_slot")


OP10_SQL = """
WITH d AS (SELECT doc_id, source, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS skey,
                  len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size,
             [5, 2, 1][((row_number() OVER (ORDER BY skey)) - 1) % 3 + 1] AS weight FROM d GROUP BY skey),
c AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total FROM s),
l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
             / sum(weight) OVER (ORDER BY cap / weight, skey ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
m AS (SELECT *, max(CASE WHEN level * weight <= cap THEN level END) OVER () AS water FROM l),
t AS (SELECT skey, source_size, least(cap::DOUBLE, coalesce(water * weight, cap::DOUBLE)) AS target FROM m),
p AS (SELECT row_number() OVER () AS rid, doc_id, skey, size, source_size, target, floor(target)::BIGINT AS want,
             coalesce(sum(size) OVER (PARTITION BY skey ORDER BY md5(coalesce(doc_id::VARCHAR, '')), doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM d JOIN t USING (skey)),
k AS (SELECT skey, floor(target)::BIGINT AS words, sum(floor(target)::BIGINT) OVER (ORDER BY skey)::BIGINT AS upto,
             sum(floor(target)::BIGINT) OVER ()::BIGINT AS every FROM t),
i AS (SELECT skey, (words + 255) // 256 AS need, (upto - words)::DOUBLE / greatest(1, every)::DOUBLE AS lo,
             upto::DOUBLE / greatest(1, every)::DOUBLE AS hi FROM k),
z AS (SELECT (max(every) + 255) // 256 AS slots FROM k),
u AS (SELECT unnest(range((SELECT slots FROM z))) AS slot),
g AS (SELECT slot, (slot % 2147483648 * 1327217885 % 2147483648)::DOUBLE / 2147483648::DOUBLE AS u FROM u),
h AS (SELECT slot, skey, row_number() OVER (PARTITION BY skey ORDER BY slot) - 1 AS rank FROM g JOIN i ON u >= lo AND u < hi),
f AS (SELECT i.skey, need, count(h.slot) AS have FROM i LEFT JOIN h USING (skey) GROUP BY ALL),
q AS (SELECT slot, h.skey, rank FROM h JOIN i USING (skey) WHERE rank < need
      UNION ALL SELECT (SELECT slots FROM z) + rank, skey, rank FROM (
        SELECT skey, unnest(range(have, need)) AS rank FROM f WHERE have < need)),
e AS (SELECT rid, skey, size, want, source_size * unnest(range((want - 1 - start) // source_size + 1)) + start AS p0
      FROM p WHERE size > 0 AND start < want),
b AS (SELECT rid, skey, unnest(range(p0 // 256, (least(p0 + size, want) - 1) // 256 + 1)) AS rank FROM e),
v AS (SELECT rid, min(slot) AS first_slot, max(slot) AS last_slot FROM b JOIN q USING (skey, rank) GROUP BY rid)
SELECT doc_id, size, source_size, target,
       CASE WHEN size = 0 THEN 0 ELSE (want // source_size) * size
            + greatest(0, least(size, want % source_size - start)) END::BIGINT AS taken, first_slot, last_slot
FROM p LEFT JOIN v USING (rid)"""
