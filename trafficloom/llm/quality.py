"""Quality rules as a ledger of failure bits, read by versioned policies.

``ledger`` evaluates every rule once per document and stores one bit per failed rule
next to the measurements. A policy is a version and the set of rules it enforces;
applying it, changing it, or asking what one of its rules costs reads only the bits.
Everything is built from DataFrame functions and stays within the row, so there is
no shuffle and no group.

Defined cases: a null or empty text has no words and fails ``too_few_words``; repeated
rows are judged one by one; columns of the input other than id and text play no part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trafficloom.llm.common import WORD, bound

WINDOW = 8

#: Measurements in the order of the ledger's columns.
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")

#: Rule and the condition under which it fails, over the struct of measurements. The
#: place in this list is the bit, so rules are only ever added at the end.
RULES = (
    ("too_few_words", lambda m: m["n_words"] < 20),
    ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbol_heavy", lambda m: 10 * m["n_symbols"] > 3 * m["n_words"]),
    ("short_words", lambda m: m["word_chars"] < 2 * m["n_words"]),
    ("long_words", lambda m: m["word_chars"] > 20 * m["n_words"]),
    ("repeated_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
)
BIT = {name: 1 << place for place, (name, _) in enumerate(RULES)}
BASE = BIT["too_few_words"] | BIT["repeated_windows"]


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[rule] for rule in self.rules)


POLICIES = (
    Policy("2024-base", ("too_few_words", "repeated_windows")),
    Policy("2024-symbols", ("too_few_words", "repeated_windows", "symbol_heavy")),
    Policy("2025-full", ("too_few_words", "repeated_windows", "symbol_heavy", "short_words", "long_words", "repeated_lines")),
)
CURRENT = POLICIES[-1]


def _covered(windows: Column) -> Column:
    """Words in windows found twice or more, from the windows' digests by position."""

    def positions(ordered: Column) -> Column:
        def same(entry: Column, place: Column) -> Column:
            digest = entry.getField("digest")
            left = F.when(place > 0, F.get(ordered, place - 1).getField("digest") == digest)
            right = F.get(ordered, place + 1).getField("digest") == digest
            return F.when(F.coalesce(left, F.lit(False)) | F.coalesce(right, F.lit(False)), entry.getField("at"))

        return F.sort_array(F.filter(F.transform(ordered, same), lambda at: at.isNotNull()))

    def words(found: Column) -> Column:
        gaps = F.transform(found, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(found, k + 1) - at, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap)

    paired = F.transform(windows, lambda digest, at: F.struct(digest.alias("digest"), at.alias("at")))
    return bound(bound(F.sort_array(paired), positions), words)


def _windows(words: Column) -> Column:
    """Digests of all windows of the words."""
    starts = F.sequence(F.lit(1), F.size(words) - (WINDOW - 1))
    digests = F.transform(starts, lambda at: F.xxhash64(F.slice(words, at, WINDOW)))
    return F.when(F.size(words) >= WINDOW, digests).otherwise(F.array().cast("array<bigint>"))


def judged(text: Column) -> Column:
    """A struct of the measurements, all long, and the bits of all failed rules, ``failures``.

    Words, lines, windows and measurements are each bound to a name and computed once, also
    where the optimizer moves the expression into a filter.
    """
    text = F.coalesce(text, F.lit(""))

    def measured(words: Column, windows: Column, lines: Column) -> Column:
        distinct = F.size(F.array_distinct(windows)) == F.size(windows)
        values = {
            "n_words": F.size(words),
            "word_chars": F.length(F.translate(text, " \t\n\x0b\x0c\r", "")),
            "n_symbols": F.length(text) - F.length(F.translate(text, "#*$%&|<>", "")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": F.when(distinct, F.lit(0)).otherwise(_covered(windows)),
        }
        return F.struct(*(values[m].cast("long").alias(m) for m in MEASURES))

    def with_failures(measures: Column) -> Column:
        bits = F.lit(0).cast("long")
        for name, fails in RULES:
            bits = bits.bitwiseOR(F.when(fails(measures), F.lit(BIT[name])).otherwise(F.lit(0)).cast("long"))
        return F.struct(*(measures[m].alias(m) for m in MEASURES), bits.alias("failures"))

    all_lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    measures = bound(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda words: bound(
            _windows(words), lambda windows: bound(all_lines, lambda lines: measured(words, windows, lines))
        ),
    )
    return bound(measures, with_failures)


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: its id, the measurements and ``failures``."""
    return docs.select(F.col(id_col), judged(F.col(text_col)).alias("ledger")).select(id_col, "ledger.*")


def passes(policy: Policy = CURRENT, failures: str = "failures") -> Column:
    return F.col(failures).bitwiseAND(F.lit(policy.mask).cast("long")) == 0


def sole_failure(policy: Policy = CURRENT, failures: str = "failures") -> Column:
    """The rule without which the policy would keep the document, if there is one such rule."""
    failing = F.col(failures).bitwiseAND(F.lit(policy.mask).cast("long"))
    return F.coalesce(*(F.when(failing == BIT[rule], F.lit(rule)) for rule in policy.rules))


def kept(docs: DataFrame, policy: Policy = CURRENT, text_col: str = "text") -> DataFrame:
    """The documents the policy lets through, columns as given."""
    return docs.filter(judged(F.col(text_col))["failures"].bitwiseAND(F.lit(policy.mask).cast("long")) == 0)


def ablations(rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """For each policy and rule: documents, those kept, those failing the rule, and
    those that dropping the rule alone would bring back.

    The ledger is first reduced to one row per set of failed rules, of which there
    are at most two to the number of rules, so the rest works on a few rows.
    """
    sets = rows.groupBy("failures").agg(F.count("*").alias("docs"))
    cases = F.array(
        *(
            F.struct(
                F.lit(policy.version).alias("policy"),
                F.lit(policy.mask).cast("long").alias("mask"),
                F.lit(rule).alias("rule"),
                F.lit(BIT[rule]).cast("long").alias("bit"),
            )
            for policy in policies
            for rule in policy.rules
        )
    )
    failing = F.col("failures").bitwiseAND(F.col("case.mask"))
    return (
        sets.withColumn("case", F.explode(cases))
        .groupBy("case.policy", "case.rule")
        .agg(
            F.sum("docs").alias("docs"),
            F.sum(F.when(failing == 0, F.col("docs")).otherwise(0)).alias("kept"),
            F.sum(F.when(failing.bitwiseAND(F.col("case.bit")) != 0, F.col("docs")).otherwise(0)).alias("failing"),
            F.sum(F.when(failing == F.col("case.bit"), F.col("docs")).otherwise(0)).alias("freed"),
        )
    )
