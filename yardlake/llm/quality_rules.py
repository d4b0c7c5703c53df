"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per failed
rule; policies are bit masks over it, so a new policy version or an ablation never reads a text again.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import struct_of, text_column

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper", "n_stutters")


def repeat_words(words: list[str]) -> int:
    """Words that lie in a WINDOW-word window found at least twice.

    Windows are numbered by doubling: a window of 2k words is the pair of the numbers of its halves.
    """
    n = len(words)
    if n <= WINDOW:
        return 0
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(number.__getitem__, words), np.int64, n)
    span = 1
    while span < WINDOW:
        _, at = np.unique(at[:-span] * (at.max() + 1) + at[span:], return_inverse=True)
        span *= 2
    found = np.flatnonzero(np.bincount(at)[at] > 1)
    if not len(found):
        return 0
    edge = np.zeros(n + 1, np.int64)
    edge[found] += 1
    edge[found + WINDOW] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def measure(text: str | None) -> tuple[int, ...]:
    """MEASURES of one text; a null text has no words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    letters = "".join(filter(str.isalpha, text)) if not text.isascii() else re.sub("[^A-Za-z]+", "", text)
    return (
        len(words),
        sum(map(len, words)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(letters),
        len(re.sub("[^A-Z]+", "", letters)) if letters.isascii() else sum(map(str.isupper, letters)),
        sum(map(str.__eq__, words, words[1:])),
    )


@dataclass(frozen=True)
class Rule:
    """fails: Column over MEASURES, true where the document breaks the rule."""

    bit: int
    name: str
    fails: Column


def rules(ledger: str = "ledger") -> list[Rule]:
    """The catalogue. Bits are never reused, so that old ledgers stay readable."""
    c = {m: F.col(f"{ledger}.{m}") for m in MEASURES}
    return [
        Rule(0, "few_words", c["n_words"] < 20),
        Rule(1, "repeated_windows", 100 * c["n_repeat_words"] > 30 * c["n_words"]),
        Rule(2, "symbols", 100 * c["n_symbols"] > 30 * c["n_words"]),
        Rule(3, "duplicate_lines", 100 * c["n_dup_lines"] > 50 * c["n_lines"]),
        Rule(4, "shouting", 100 * c["n_upper"] > 50 * c["n_letters"]),
        Rule(5, "long_words", c["word_chars"] > 40 * c["n_words"]),
        Rule(6, "few_letters", 2 * c["n_letters"] < c["word_chars"]),
        Rule(7, "stutter", 100 * c["n_stutters"] > 40 * c["n_words"]),
    ]


BASE_BITS = 0b11


@dataclass(frozen=True)
class Policy:
    """Documents go that fail any rule of `any_of`, or at least `at_least` rules of `several_of`."""

    version: str
    any_of: int
    several_of: int = 0
    at_least: int = 1
    notes: str = field(default="", compare=False)


#: The production policy and its predecessor, kept so that both can be compared on one ledger.
POLICIES = {
    "v1": Policy("v1", any_of=0b11, notes="length and repetition only"),
    "v2": Policy("v2", any_of=0b11111111, notes="all rules"),
}
PRODUCTION = "v2"


def ledger(df: DataFrame, text: str = "text", into: str = "ledger") -> DataFrame:
    """df with a struct column: MEASURES and fail_bits (long). A column of that name is replaced.

    A null or empty text has zero words and fails rule 0; repeated and null ids keep a row each;
    an empty table gives an empty ledger.
    """

    def make():
        def work(texts: list) -> pa.Array:
            found = [measure(x) for x in texts]
            return struct_of(**{m: pa.array([x[i] for x in found], pa.int64()) for i, m in enumerate(MEASURES)})

        return work

    measured = df.withColumn(into, text_column(", ".join(f"{m} long" for m in MEASURES), make)(F.col(text)))
    bits = F.lit(0).cast("long")
    for rule in rules(into):
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << rule.bit)).otherwise(F.lit(0)).cast("long"))
    return measured.withColumn(into, F.col(into).withField("fail_bits", bits))


def allows(policy: Policy, bits: Column) -> Column:
    """True where the policy keeps a document with these failure bits."""
    kept = bits.bitwiseAND(F.lit(policy.any_of)) == 0
    if policy.several_of:
        kept &= F.bit_count(bits.bitwiseAND(F.lit(policy.several_of))) < policy.at_least
    return kept


def ablations(ledger_df: DataFrame, policy: Policy, ledger: str = "ledger") -> DataFrame:
    """Per rule of the policy: rule, failed, sole (failed it and no other of the policy), kept_without.

    The ledger is first counted per bit pattern, at most 2 ** rules rows, and never expanded.
    """
    mask = policy.any_of | policy.several_of
    patterns = ledger_df.groupBy(F.col(f"{ledger}.fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    catalogue = [F.struct(F.lit(1 << r.bit).cast("long").alias("flag"), F.lit(r.name).alias("rule")) for r in rules() if mask >> r.bit & 1]
    each = patterns.select("bits", "n", F.explode(F.array(*catalogue)).alias("r"))
    failed = F.col("bits").bitwiseAND(F.col("r.flag")) != 0
    without = F.col("bits").bitwiseAND(F.bitwise_not("r.flag"))
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        total(failed).alias("failed"), total(failed & (without == 0)).alias("sole"), total(allows(policy, without)).alias("kept_without")
    )


def verdicts(df: DataFrame, version: str = PRODUCTION, text: str = "text", into: str = "ledger") -> DataFrame:
    """The ledger with base_failed and kept under a policy version; what base_failed rejects is never kept."""
    bits = F.col(f"{into}.fail_bits")
    base = bits.bitwiseAND(F.lit(BASE_BITS)) != 0
    verdict = F.col(into).withField("base_failed", base).withField("kept", ~base & allows(POLICIES[version], bits))
    return ledger(df, text, into).withColumn(into, verdict)
