"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document. The ledger holds the measurements and one bit per failed
rule; a policy is a version of which bits reject. Changing a policy, or asking what one rule costs
(``ablation``), reads the ledger and no text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import SPACES, let, window_hashes, words

SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: name -> fails, of a struct of measurements. The position is the bit; new rules go to the end.
RULES: dict[str, Callable[[Column], Column]] = {
    "few_words": lambda m: m["n_words"] < 20,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "duplicate_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "word_length": lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    "shouting": lambda m: (2 * m["n_upper"] > m["n_letters"]) & (m["n_letters"] > 0),
    "word_runs": lambda m: (5 * m["n_runs"] > m["n_words"]) & (m["n_words"] > 0),
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A named version of the rules that reject."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
CURRENT = Policy("2", tuple(RULES))


def _covered(hashes: Column, width: int) -> Column:
    """Positions under windows whose hash occurs twice or more. Sorting brings equal windows together."""
    entries = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def positions(e: Column) -> Column:
        twice = F.filter(e, lambda x, k: (x.h == F.get(e, k - 1).h) | (x.h == F.get(e, k + 1).h))
        # get() beyond an end is null, and null OR false rejects
        return F.sort_array(F.transform(twice, lambda x: x.i))

    def total(p: Column) -> Column:
        steps = F.transform(p, lambda x, k: F.least(F.lit(width), F.coalesce(F.get(p, k + 1) - x, F.lit(width))))
        return F.aggregate(steps, F.lit(0), lambda a, b: a + b)

    return let(let(entries, positions), total)


def _repeat_words(w: Column, width: int) -> Column:
    windows = window_hashes(w, width)
    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h, width)))


def measurements(text: Column) -> Column:
    """All measurements of a text as one struct, every part of the text cut once.

    Words are cut at ASCII white space; lines are cut at \\n and count if they hold a word; a run is
    a word equal to the word before it. A null text has none of anything."""

    def of(t: Column, w: Column, lines: Column) -> Column:
        size = F.length(t)
        found = {
            "n_words": F.size(w),
            "word_chars": F.length(F.translate(t, SPACES, "")),
            "n_symbols": size - F.length(F.translate(t, SYMBOLS, "")),
            "n_lines": F.size(lines),
            "n_dup_lines": F.size(lines) - F.size(F.array_distinct(lines)),
            "n_repeat_words": _repeat_words(w, WINDOW),
            "n_runs": F.size(F.filter(w, lambda x, i: x == F.get(w, i - 1))),
            "n_upper": size - F.length(F.regexp_replace(t, r"\p{Lu}+", "")),
            "n_letters": size - F.length(F.regexp_replace(t, r"\p{L}+", "")),
        }
        return F.struct(*[c.cast("long").alias(name) for name, c in found.items()])

    def lines(t: Column) -> Column:
        return F.filter(F.split(t, "\n", -1), lambda x: F.btrim(x, F.lit(SPACES)) != "")

    return let(F.coalesce(text, F.lit("")), lambda t: let(words(t), lambda w: let(lines(t), lambda x: of(t, w, x))))


def failed_bits(m: Column) -> Column:
    bits = [F.when(fails(m), BIT[name]).otherwise(0) for name, fails in RULES.items()]
    return reduce(Column.bitwiseOR, bits)


def ledger(docs: DataFrame) -> DataFrame:
    """Per row doc_id, the measurements and ``failed``, the bits of the failed rules. Repeated rows are
    measured each; no rows give no rows."""
    rows = docs.select("doc_id", measurements(F.col("text")).alias("m"))
    return rows.select("doc_id", "m.*", failed_bits(F.col("m")).alias("failed"))


def rejected(policy: Policy) -> Column:
    return F.col("failed").bitwiseAND(policy.mask) != 0


def apply_policy(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    return ledger_rows.withColumn("policy", F.lit(policy.version)).withColumn("kept", ~rejected(policy))


def ablation(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, and those that would stay without it.

    One row per different failure mask is aggregated first; the rest is arithmetic on masks."""
    masks = ledger_rows.groupBy("failed").agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in policy.rules]))
    each = masks.select("*", rules.alias("r")).select("failed", "n", "r.*")
    hit = F.col("failed").bitwiseAND(F.col("bit")) != 0
    only = F.col("failed").bitwiseAND(policy.mask) == F.col("bit")
    return each.groupBy("rule").agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("failing"),
        F.sum(F.when(only, F.col("n")).otherwise(0)).alias("rejected_by_it_alone"),
    )


def keep_good(docs: DataFrame, policy: Policy = CURRENT) -> DataFrame:
    """Rows of docs that the policy does not reject, with all their columns.

    The verdict is one expression on the row itself: no join, no shuffle, each measurement once."""
    failed = let(measurements(F.col("text")), failed_bits)
    return docs.filter(failed.bitwiseAND(policy.mask) == 0)
