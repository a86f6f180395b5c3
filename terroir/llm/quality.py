"""Quality rules as a ledger of bits.

Every rule is evaluated once per document; the ledger keeps the measurements and one bit per failed rule. A policy is a
versioned set of rules, so applying another one, or asking what each rule alone changes, reads the ledger and never the
texts. All of it is column expressions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"

# Rules in the order of their bits: a rule never changes its bit, new ones are appended.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 50",
    "repeated_windows": "100 * n_repeat_words > 50 * n_words",
    "many_symbols": "10 * n_symbols > n_words",
    "repeated_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 15 * n_words",
    "shouting": "100 * n_upper > 50 * word_chars",
}

# Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": ("too_few_words", "repeated_windows"),
    "2024": ("too_few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    "2025": tuple(RULES),
}


def bit(rule: str) -> int:
    return 1 << list(RULES).index(rule)


def mask(policy: str) -> int:
    return sum(bit(rule) for rule in POLICIES[policy])


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then`` of a value that is computed once: the value becomes a lambda variable."""
    return F.element_at(F.transform(F.array(value), then), 1)


def repeated_words(words: Column) -> Column:
    """Number of words in three-word windows that occur twice or more.

    Windows are compared by 64-bit hashes. Texts whose hashes are all distinct are done; in others the hashes are
    sorted with their places, those equal to a neighbour are kept, and each counts as many words as the next leaves it.
    """

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        twice = let(placed, lambda s: F.filter(s, lambda x, j: (
            F.coalesce(x["h"] == F.get(s, j - 1)["h"], F.lit(False)) | F.coalesce(x["h"] == F.get(s, j + 1)["h"], F.lit(False)))))
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        steps = let(starts, lambda p: F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3)))))
        return F.aggregate(steps, F.lit(0), lambda total, x: total + x)

    def windows(w: Column) -> Column:
        return F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))

    return let(let(words, windows), lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), F.lit(0)).otherwise(covered(h)))


def ledger(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """The id, the measurements and fail_bits, per row; whole texts are read, nothing is shuffled.

    n_words, word_chars (code points in words), n_symbols, n_lines (lines with a word), n_dup_lines (those equal to an
    earlier one), n_repeat_words and n_upper (A-Z). A null or empty text has no words: all measurements are 0. Repeated
    rows get equal results; other columns are not read.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    measured = docs.select(F.col(id_col).alias("id__"), body.alias("body")).select(
        F.col("id__"), "body",
        F.array_remove(F.split("body", "[\\x20\\x09-\\x0D]+"), "").alias("words"),
        F.filter(F.split("body", "\n"), lambda line: F.length(F.translate(line, " \t\x0b\x0c\r", "")) > 0).alias("lines"),
    )

    def count(signs: str) -> Column:
        return (F.length("body") - F.length(F.translate(F.col("body"), signs, ""))).cast("long")

    measured = measured.select(
        F.col("id__").alias(id_col),
        F.size("words").cast("long").alias("n_words"),
        (F.length("body") - count(" \t\n\x0b\x0c\r")).cast("long").alias("word_chars"),
        count(SYMBOLS).alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("words")).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        count("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
    )
    bits = [F.when(F.expr(condition), F.lit(bit(rule))).otherwise(F.lit(0)) for rule, condition in RULES.items()]
    return measured.withColumn("fail_bits", sum(bits[1:], bits[0]).cast("long"))


def apply_policy(found: DataFrame, policy: str) -> DataFrame:
    """The ledger with base_failed and kept: no rule of the policy, nor of the base policy, has failed."""
    failed = F.col("fail_bits").bitwiseAND(F.lit(mask("base"))) != 0
    rejected = F.col("fail_bits").bitwiseAND(F.lit(mask(policy) | mask("base"))) != 0
    return found.withColumn("base_failed", failed).withColumn("kept", ~rejected)


def ablations(found: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, that fail it alone, and that the policy keeps without it.

    Documents are counted per pattern of bits first, at most two to the number of rules, so the rules are compared on
    those few rows.
    """
    patterns = found.groupBy(F.col("fail_bits").bitwiseAND(F.lit(mask(policy))).alias("bits")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.lit(bit(rule)).cast("long").alias("bit")) for rule in POLICIES[policy]]))
    each = patterns.select("bits", "n", rules.alias("r")).select("bits", "n", "r.rule", "r.bit")
    fails = F.col("bits").bitwiseAND(F.col("bit")) != 0
    return each.groupBy("rule").agg(
        F.coalesce(F.sum(F.when(fails, F.col("n"))), F.lit(0)).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n"))), F.lit(0)).alias("failed_alone"),
        F.coalesce(F.sum(F.when((F.col("bits") == 0) | (F.col("bits") == F.col("bit")), F.col("n"))), F.lit(0)).alias("kept_without"),
    )
