"""Quality rules as a bitmask ledger (DataFrame functions only).

Every rule is evaluated once for every document. The ledger keeps the measurements and one bit per failed rule
(``fail_bits``). A policy is a versioned set of rule bits; applying one is ``fail_bits & mask = 0``, so a new policy
or an ablation never reads the texts again.

Defined results: a null or empty text has no words, all measurements are 0 and it fails ``few_words``. Repeated rows
are judged alike, each on its own. Rows never meet, so ties and skewed keys do not matter; an empty table gives an
empty ledger. Only the id and text columns are read; columns of other names do not clash, because ``ledger`` returns
its own columns and ``with_verdict`` drops what it adds.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, let, words

SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

#: Rules in bit order: name -> SQL condition over the measurements under which a document fails.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "100 * n_symbols > 15 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "word_length": "word_chars < 2 * n_words OR word_chars > 14 * n_words",
    "upper_case": "100 * n_upper > 40 * word_chars",
}
BASE = ("few_words", "repeated_words")

#: Versioned policies: version -> rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {"v1": BASE, "v2": tuple(RULES)}
DEFAULT_POLICY = "v2"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper")


def mask(names, rules: Mapping[str, str] = RULES) -> int:
    """The bits of the named rules."""
    order = list(rules)
    return sum(1 << order.index(n) for n in set(names))


def _repeat_words(w: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more. Windows are 64-bit hashes sorted with their
    positions, so equal windows are neighbours: n log n per text, whatever repeats."""
    n = F.size(w)
    windows = F.transform(F.sequence(F.lit(0), n - 3),
                          lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    def covered(h: Column) -> Column:
        pairs = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        twice = let(pairs, lambda p: F.sort_array(F.transform(
            F.filter(p, lambda x, k: F.coalesce(F.get(p, k + 1)["h"] == x["h"], F.lit(False))
                     | ((k > 0) & F.coalesce(F.get(p, F.greatest(k - 1, F.lit(0)))["h"] == x["h"], F.lit(False)))),
            lambda x: x["i"])))
        return let(twice, lambda t: F.aggregate(
            F.transform(t, lambda x, k: F.when(k == 0, 3).otherwise(
                F.least(F.lit(3), x - F.get(t, F.greatest(k - 1, F.lit(0)))))),
            F.lit(0), lambda a, b: a + b))

    some = let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))
    return F.when(n < 4, 0).otherwise(some).cast("long")


def _measures(text: Column) -> Column:
    t = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(WORD))
    return let(words(t), lambda w: let(lines, lambda ls: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        F.size(ls).cast("long").alias("n_lines"),
        (F.size(ls) - F.size(F.array_distinct(ls))).cast("long").alias("n_dup_lines"),
        _repeat_words(w).alias("n_repeat_words"),
        F.regexp_count(t, F.lit(r"\p{Lu}")).cast("long").alias("n_upper"))))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the measurement columns. ``inline`` is a plan barrier: a filter on a measurement is not pushed
    below it, so the measurements are computed once."""
    return docs.select("*", F.inline(F.array(_measures(F.col(text)))))


def fail_bits(rules: Mapping[str, str] = RULES) -> Column:
    """One bit per failed rule."""
    bits = F.lit(0).cast("long")
    for k, sql in enumerate(rules.values()):
        bits = bits + F.when(F.expr(sql), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long"))
    return bits


def passes(policy: str = DEFAULT_POLICY, bits: Column | None = None) -> Column:
    """Whether a document passes a policy version, from its bits alone."""
    bits = F.col("fail_bits") if bits is None else bits
    return bits.bitwiseAND(F.lit(mask(POLICIES[policy])).cast("long")) == 0


def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text",
           rules: Mapping[str, str] = RULES) -> DataFrame:
    """The ledger: id, measurements, ``fail_bits``. One pass, no shuffle."""
    m = measured(docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")))
    return m.select("doc_id", *MEASURES, fail_bits(rules).alias("fail_bits"))


def ablation(led: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """For each rule of a policy: documents it fails, documents only it rejects (they would return without it), and
    documents kept without it. Documents are first counted per distinct bit pattern (at most 2^rules rows)."""
    order, full = list(RULES), mask(POLICIES[policy])
    patterns = led.groupBy(F.col("fail_bits").bitwiseAND(F.lit(full).cast("long")).alias("bits")).agg(
        F.count("*").alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << order.index(r)).cast("long").alias("bit"))
                               for r in POLICIES[policy]])).alias("r")
    hit = F.col("bits").bitwiseAND(F.col("r.bit"))
    rest = F.col("bits").bitwiseAND(F.lit(full).cast("long") - F.col("r.bit"))
    count = lambda cond: F.sum(F.when(cond, F.col("n")).otherwise(0)).cast("long")
    return patterns.select("bits", "n", rule).groupBy(F.col("r.rule").alias("rule")).agg(
        count(hit != 0).alias("failed"),
        count((hit != 0) & (rest == 0)).alias("rejected_alone"),
        count(rest == 0).alias("kept_without"),
        F.sum("n").cast("long").alias("documents"))


def accepted(docs: DataFrame, text: str = "text", policy: str = DEFAULT_POLICY) -> DataFrame:
    """The rows of ``docs`` that pass a policy, with the columns of ``docs``."""
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(f"`{text}`").alias("text"))
    return (measured(inner).withColumn("fail_bits", fail_bits()).where(passes(policy))
            .select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def report(docs: DataFrame, policy: str = DEFAULT_POLICY) -> DataFrame:
    """Per document: measurements, bits, ``base_failed`` and ``kept`` under a policy (which holds the base rules)."""
    base = F.lit(mask(BASE)).cast("long")
    return ledger(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (F.col("fail_bits").bitwiseAND(base) != 0).alias("base_failed"),
        passes(policy).alias("kept"), "n_lines", "n_upper", "fail_bits")


def op2_sql() -> str:
    """DuckDB SQL for ``report`` over the table ``documents``."""
    bits = " + ".join(f"(CASE WHEN {sql} THEN {1 << k} ELSE 0 END)" for k, sql in enumerate(RULES.values()))
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT rid, doc_id, text, list_filter(regexp_split_to_array(text, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS ws,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls FROM d),
o AS (SELECT rid, unnest(range(len(ws))) AS i, unnest(ws) AS x FROM w),
g AS (SELECT rid, i, x, lead(x) OVER (PARTITION BY rid ORDER BY i) AS y, lead(x, 2) OVER (PARTITION BY rid ORDER BY i) AS z FROM o),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, x, y, z) AS c FROM g WHERE z IS NOT NULL),
r AS (SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM t WHERE c >= 2) GROUP BY rid),
m AS (SELECT doc_id, len(ws)::BIGINT AS n_words, length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g'))::BIGINT AS word_chars,
             (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
             len(ls)::BIGINT AS n_lines, len(regexp_extract_all(text, '\\p{{Lu}}'))::BIGINT AS n_upper
      FROM w LEFT JOIN r USING (rid)),
b AS (SELECT *, ({bits})::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, fail_bits & {mask(POLICIES[DEFAULT_POLICY])} = 0 AS kept,
       n_lines, n_upper, fail_bits FROM b"""
