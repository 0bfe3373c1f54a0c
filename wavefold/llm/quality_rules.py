"""Quality rules as a ledger of bits (operator 8), DataFrame functions only.

Every rule is evaluated once for each document: its measurements are kept, and
a failure sets the rule's bit in ``failures``. A policy is a version of a set of
rules, that is a mask; a document is kept if it fails none of them. Policies can
be changed, compared and ablated on the ledger alone, by bit operations over the
few distinct values of ``failures``, without reading a text again.

Words are runs of anything but ASCII white space. Repeats are found inside the
row: hashes of all 8-word windows, sorted with their places, and only in texts
where two windows have the same hash. Nothing is exploded or shuffled.

Defined cases: a null or empty text has no words and fails ``few_words``;
repeated rows and null ids are judged row by row; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
SPACE = r"[\x20\x09-\x0D]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once (inside lambdas a plain expression is computed for each element)."""
    return F.transform(F.array(value), body)[0]


def _repeated_words(windows: Column) -> Column:
    """Words covered by windows whose hash occurs twice or more."""

    def covered(places: Column) -> Column:
        begin = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("total"))
        step = lambda a, x: F.struct(
            x.alias("last"), (a["total"] + F.least(F.lit(WINDOW), x - a["last"])).alias("total"))
        return F.aggregate(places, begin, step, lambda a: a["total"])

    def places(found: Column) -> Column:
        twice = F.filter(found, lambda s, k: (k > 0) & (F.get(found, k - 1)["h"] == s["h"])
                         | (F.get(found, k + 1)["h"] == s["h"]))
        return F.array_sort(F.transform(twice, lambda s: s["i"]))

    found = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(covered(_let(found, places)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document row its measurements, all long."""
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(docs[id_col].cast("long").alias("doc_id"), text.alias("text"))
    words = F.array_remove(F.split("text", SPACE), "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))

    def from_words(w: Column) -> Column:
        hashes = F.transform(w, lambda x: F.xxhash64(x))

        def from_hashes(h: Column) -> Column:
            n = F.size(h)
            windows = F.when(n >= WINDOW, F.transform(F.sequence(F.lit(1), F.greatest(n - WINDOW + 1, F.lit(1))),
                                                      lambda i: F.xxhash64(F.slice(h, i, WINDOW)))
                             ).otherwise(F.array().cast("array<bigint>"))
            stutter = F.size(F.filter(h, lambda x, k: (k > 0) & (F.get(h, k - 1) == x)))
            return F.struct(n.alias("n_words"), stutter.alias("n_stutter"),
                            _let(windows, _repeated_words).alias("n_repeat_words"))

        return F.struct(_let(hashes, from_hashes).alias("h"), F.length(F.array_join(w, "")).alias("word_chars"))

    found = base.select(
        "doc_id", _let(words, from_words).alias("w"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), F.size(F.array_distinct(x)).alias("d"))).alias("l"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).alias("n_symbols"), F.regexp_count("text", F.lit("!")).alias("n_exclaims"))
    values = {"n_words": F.col("w.h.n_words"), "word_chars": F.col("w.word_chars"), "n_symbols": F.col("n_symbols"),
              "n_lines": F.col("l.n"), "n_dup_lines": F.col("l.n") - F.col("l.d"),
              "n_repeat_words": F.col("w.h.n_repeat_words"), "n_stutter": F.col("w.h.n_stutter"),
              "n_exclaims": F.col("n_exclaims")}
    return found.select("doc_id", *(v.cast("long").alias(k) for k, v in values.items()))


#: Every rule ever used, in the order of its bit; the SQL says when it fails. New rules go at the end.
RULES: dict[str, str] = {
    "few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "exclaims": "2 * n_exclaims > n_words",
    "stutter": "100 * n_stutter > 40 * n_words",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
}
#: Versioned policies: the rules a document must pass.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "exclaims", "stutter"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(r) for r in POLICIES[policy])


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Measurements and ``failures``, the bits of the rules that a document fails."""
    failures = F.lit(0).cast("long")
    for rule, fails in RULES.items():
        failures = failures.bitwiseOR(F.when(F.expr(fails), F.lit(bit(rule)).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, id_col, text_col).withColumn("failures", failures)


def passes(policy: str) -> Column:
    """Whether a ledger row is kept under a policy."""
    return F.col("failures").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """Per rule of a policy: documents that fail it, that only it rejects, and that are kept without it.

    Folds the ledger to its distinct bit patterns first (at most two to the
    number of rules), so the rest works on a handful of rows.
    """
    full = F.lit(mask(policy)).cast("long")
    patterns = ledger_rows.groupBy(F.col("failures").bitwiseAND(full).alias("failures")).agg(F.count("*").alias("n"))
    rules = F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(bit(r)).cast("long").alias("bit")) for r in POLICIES[policy]))
    each = patterns.select("failures", "n", F.explode(rules).alias("r")).select("failures", "n", "r.rule", "r.bit")
    count = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).alias
    return each.groupBy("rule").agg(
        count(F.col("failures").bitwiseAND(F.col("bit")) != 0)("n_fail"),
        count(F.col("failures") == F.col("bit"))("n_only"),
        count((F.col("failures") == 0) | (F.col("failures") == F.col("bit")))("n_kept_without"))

