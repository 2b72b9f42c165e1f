"""Quality rules kept as a bitmask ledger.

Every rule is evaluated once per document. The ledger stores the measurements and
one failure bit per rule; policies are versioned sets of rules applied to the bits
later, and the effect of leaving a rule out is a count over the bits. All of it is
built-in functions over one row, so nothing is shuffled to make a ledger.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logtide.llm.expressions import WHITE, let, words_of

WINDOW = 8
MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals",
]


def _pairs(values: Column, count: Column, step: int) -> Column:
    """Hashes of the values ``step`` apart, for the first ``count`` positions."""
    count = F.greatest(count, F.lit(0))
    return F.zip_with(
        F.slice(values, F.lit(1), count), F.slice(values, F.lit(1 + step), count),
        lambda a, b: F.xxhash64(a, b),
    )


def _covered(words: Column, hashes: Column) -> Column:
    """Words inside windows whose words also start elsewhere in the text.

    Windows with equal hashes are neighbours once sorted; the words decide.
    """

    def of_sorted(windows: Column) -> Column:
        def same(k: Column, other: Column) -> Column:
            a, b = F.get(windows, k), F.get(windows, other)
            return (a["h"] == b["h"]) & (
                F.slice(words, a["at"] + 1, F.lit(WINDOW)) == F.slice(words, b["at"] + 1, F.lit(WINDOW))
            )

        places = F.sequence(F.lit(0), F.size(windows) - 1)
        repeated = F.filter(
            places,
            lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False)),
        )
        starts = F.array_sort(F.transform(repeated, lambda k: F.get(windows, k)["at"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
            lambda acc, at: F.struct(
                (acc["n"] + at + WINDOW - F.greatest(at, acc["end"])).cast("long").alias("n"),
                (at + WINDOW).alias("end"),
            ),
        )["n"]

    windows = F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("at")))
    return let(F.array_sort(windows), of_sorted)


def _repeat_words(words: Column) -> Column:
    def of_hashes(hashes: Column) -> Column:
        repeats = F.size(F.array_distinct(hashes)) < F.size(hashes)
        return F.when(repeats, _covered(words, hashes)).otherwise(F.lit(0).cast("long"))

    n = F.size(words)
    one = F.transform(words, lambda w: F.xxhash64(w))
    two = let(one, lambda h: _pairs(h, n - 1, 1))
    four = let(two, lambda h: _pairs(h, n - 3, 2))
    eight = let(four, lambda h: _pairs(h, n - 7, 4))
    return let(eight, of_hashes)


def measurements(text: Column) -> Column:
    """All measurements of a text as one struct of longs.

    ``word_chars`` counts code points in words, ``n_symbols`` characters of
    ``#*$%&|<>``, ``n_dup_lines`` lines with a word that equal an earlier line,
    ``n_repeat_words`` words in windows of 8 words found twice or more in the
    text, ``n_lines`` lines with a word, ``n_capitals`` upper-case letters. A null
    text measures like an empty one.
    """
    text = F.coalesce(text.cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^ \t-\r]"))

    def of_words(words: Column) -> Column:
        return let(
            lines,
            lambda kept: F.struct(
                F.size(words).cast("long").alias("n_words"),
                F.char_length(F.array_join(words, "")).cast("long").alias("word_chars"),
                F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                (F.size(kept) - F.size(F.array_distinct(kept))).cast("long").alias("n_dup_lines"),
                _repeat_words(words).alias("n_repeat_words"),
                F.size(kept).cast("long").alias("n_lines"),
                F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
            ),
        )

    return let(words_of(text), of_words)


@dataclass(frozen=True)
class Rule:
    """A document fails when ``share_of`` percent of ``of`` is less than ``measure``.

    With ``least`` it fails when ``measure`` is below that number instead.
    """

    bit: int
    name: str
    measure: str
    of: str | None = None
    percent: int = 0
    least: int | None = None

    def failed(self, value) -> Column:
        if self.least is not None:
            return value(self.measure) < self.least
        return 100 * value(self.measure) > self.percent * value(self.of)


RULES = [
    Rule(0, "few_words", "n_words", least=20),
    Rule(1, "repeated_words", "n_repeat_words", of="n_words", percent=30),
    Rule(2, "symbols", "n_symbols", of="word_chars", percent=5),
    Rule(3, "repeated_lines", "n_dup_lines", of="n_lines", percent=50),
    Rule(4, "capitals", "n_capitals", of="word_chars", percent=50),
]
# Versioned policies: the names of the rules each one applies.
POLICIES = {
    "base-1": ["few_words", "repeated_words"],
    "strict-1": ["few_words", "repeated_words", "symbols", "repeated_lines", "capitals"],
}
DEFAULT_POLICY = "strict-1"


def policy_mask(policy: str, rules: list[Rule] | None = None) -> int:
    names = POLICIES[policy]
    return sum(1 << rule.bit for rule in rules or RULES if rule.name in names)


def ledger(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: list[Rule] | None = None
) -> DataFrame:
    """One row per document: id, the measurements, and ``failure_bits``.

    Repeated documents have a row each, a null id stays null. An empty table gives
    an empty ledger. Other columns are not read.
    """
    measured = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), measurements(F.col(f"`{text_col}`")).alias("m")
    )
    return measured.select(
        "doc_id",
        *(F.col("m")[name].alias(name) for name in MEASURES),
        _failure_bits(F.col("m"), rules or RULES).alias("failure_bits"),
    )


def _failure_bits(measured: Column, rules: list[Rule]) -> Column:
    bits = F.lit(0).cast("long")
    for rule in rules:
        failed = rule.failed(lambda name: measured[name])
        bits = bits.bitwiseOR(F.when(failed, F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return bits


def accepted(text: Column, policy: str = DEFAULT_POLICY, rules: list[Rule] | None = None) -> Column:
    """Verdict of a policy on a text, with all rules evaluated once."""
    mask = F.lit(policy_mask(policy, rules)).cast("long")
    return let(measurements(text), lambda m: _failure_bits(m, rules or RULES).bitwiseAND(mask) == 0)


def passes(policy: str, rules: list[Rule] | None = None) -> Column:
    """True where no rule of the policy has its failure bit set."""
    return F.col("failure_bits").bitwiseAND(F.lit(policy_mask(policy, rules)).cast("long")) == 0


def ablations(ledger_rows: DataFrame, policy: str, rules: list[Rule] | None = None) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those it alone rejects.

    Ledger rows are reduced to one row per bit pattern first; there are at most as
    many patterns as sets of rules, whatever the number of documents.
    """
    mask = policy_mask(policy, rules)
    patterns = ledger_rows.groupBy("failure_bits").agg(F.count("*").alias("n"))
    chosen = [r for r in rules or RULES if mask >> r.bit & 1]
    named = F.explode(
        F.array(*(F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in chosen))
    ).alias("r")
    bits = F.col("failure_bits").bitwiseAND(F.lit(mask).cast("long"))

    def counted(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("long")

    bit = F.col("r")["bit"]
    return (
        patterns.select("failure_bits", "n", named)
        .groupBy(F.col("r")["rule"].alias("rule"))
        .agg(
            counted(bits.bitwiseAND(bit) != 0).alias("n_failed"),
            counted(bits == bit).alias("n_failed_alone"),
            counted(bits.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"),
        )
    )
