"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger row holds the measurements and one bit per
failed rule; policies, given as versioned masks, are applied to the bits later, and the effect of
leaving a rule out is counted from the bits alone. All of it is column expressions on one scan:
the windows of a text are compared inside its row and nothing is shuffled.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coldtrace.llm.common import WHITE_PATTERN, words

WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """A named test; `fails` is true for documents that break it."""

    bit: int
    name: str
    fails: Column


def rules() -> list[Rule]:
    """All rules, over the measurement columns. Bits are never given to another rule."""
    c, n = F.col, F.col("n_words")
    return [
        Rule(0, "too_few_words", n < 20),
        Rule(1, "repeated_windows", 100 * c("n_repeat_words") > 30 * n),
        Rule(2, "many_symbols", 10 * c("n_symbols") > n),
        Rule(3, "repeated_lines", (c("n_dup_lines") > 2) & (100 * c("n_dup_lines") > 30 * c("n_lines"))),
        Rule(4, "shouting", 100 * c("n_exclaimed") > 20 * n),
        Rule(5, "odd_word_length", (c("word_chars") < 2 * n) | (c("word_chars") > 25 * n)),
    ]


BASE = ("too_few_words", "repeated_windows")
#: Policy versions: the rules that reject a document. Add versions, don't edit them.
POLICIES = {
    1: BASE,
    2: (*BASE, "many_symbols", "repeated_lines", "shouting", "odd_word_length"),
}
POLICY = 2


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once per row."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(hashes: Column) -> Column:
    """Words of an array that lie in a window found twice or more in the same array."""
    last = F.size(hashes) - WINDOW

    def of_windows(windows: Column) -> Column:
        placed = F.sort_array(
            F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        )
        # Equal windows stand side by side after the sort.
        twice = _let(
            placed,
            lambda s: F.filter(
                F.transform(
                    s,
                    lambda x, k: F.when(
                        (x["h"] == F.get(s, k - 1)["h"])
                        | (x["h"] == F.get(s, k + 1)["h"]),
                        x["i"],
                    ),
                ),
                lambda i: i.isNotNull(),
            ),
        )
        # Each start covers up to the next one, a window's length at most.
        covered = _let(
            F.sort_array(twice),
            lambda p: F.aggregate(
                F.transform(
                    p,
                    lambda x, k: F.least(
                        F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))
                    ),
                ),
                F.lit(0),
                lambda total, x: total + x,
            ),
        )
        repeats = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(repeats, covered).otherwise(0)

    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.xxhash64(*[F.get(hashes, i + k) for k in range(WINDOW)]),
    )
    return F.when(last >= 1, _let(windows, of_windows)).otherwise(0).cast("long")


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements of every whole text; a NULL text counts as an empty one."""
    body = F.coalesce(F.col(text), F.lit(""))
    hashes = _let(words(body), lambda w: F.transform(w, lambda x: F.xxhash64(x)))
    counted = _let(
        hashes,
        lambda h: F.struct(F.size(h).cast("long").alias("n"), _repeat_words(h).alias("r")),
    )
    lines = _let(
        F.filter(F.split(body, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\x0b\f\r"))) > 0),
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("d"),
        ),
    )
    without = lambda characters: F.length(body) - F.length(F.regexp_replace(body, characters, ""))
    return docs.withColumns(
        {
            "__words": counted,
            "__lines": lines,
            "word_chars": F.length(F.regexp_replace(body, WHITE_PATTERN + "+", "")).cast("long"),
            "n_symbols": without(r"[#*$%&|<>]").cast("long"),
            "n_exclaimed": without("!").cast("long"),
        }
    )


def ledger(docs: DataFrame) -> DataFrame:
    """One row per document: id, measurements and `failed`, the bits of the rules it breaks.

    Empty texts have no words and break the first rule. Repeated rows give repeated ledger rows.
    """
    measured = measure(docs.select("doc_id", "text")).select(
        "doc_id",
        F.col("__words.n").alias("n_words"),
        "word_chars",
        "n_symbols",
        F.col("__lines.d").alias("n_dup_lines"),
        F.col("__words.r").alias("n_repeat_words"),
        F.col("__lines.n").alias("n_lines"),
        "n_exclaimed",
    )
    bits = F.lit(0).cast("long")
    for rule in rules():
        bits = bits.bitwiseOR(F.when(rule.fails, F.lit(1 << rule.bit)).otherwise(0))
    return measured.withColumn("failed", bits)


def policy_mask(names: tuple[str, ...]) -> int:
    bit_of = {rule.name: rule.bit for rule in rules()}
    return sum(1 << bit_of[name] for name in names)


def apply_policy(kept_ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """Adds `kept` under a policy version."""
    mask = F.lit(policy_mask(POLICIES[version])).cast("long")
    return kept_ledger.withColumn("kept", F.col("failed").bitwiseAND(mask) == 0)


def ablation(kept_ledger: DataFrame, version: int = POLICY) -> DataFrame:
    """Per rule of a policy: documents that break it, and those that only it rejects."""
    names = POLICIES[version]
    mask = policy_mask(names)
    bit_of = {rule.name: rule.bit for rule in rules()}
    rejected = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    sums = []
    for name in names:
        bit = F.lit(1 << bit_of[name]).cast("long")
        sums.append(
            F.struct(
                F.lit(name).alias("rule"),
                F.count_if(rejected.bitwiseAND(bit) != 0).alias("n_failed"),
                F.count_if(rejected == bit).alias("n_only"),
            )
        )
    return kept_ledger.agg(F.array(*sums).alias("r")).select(F.inline("r"))
