"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements
and one failure bit per rule; a versioned policy is a mask over those bits, so
a new policy, or an ablation of one, never reads a text again.

Defined cases: a null text has no words and all measurements are 0; an empty
text likewise (both fail ``too_few_words``). Repeated rows are judged one by
one, texts of any length whole; a measurement equal to a rule's bound passes it;
an empty table gives no rows. Columns of the input that clash with a ledger
column are replaced.
"""

from __future__ import annotations

from collections import Counter
from operator import eq

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ASCII_SPACE, add_text_columns, others

# Fixed values of the contract: symbol set, window length, base thresholds.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LONG_TEXT_WORDS = 200_000

MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words",
            "n_stutter"]

# One bit per rule, in this order; a rule keeps its bit for ever.
RULES: dict[str, str] = {
    "too_few_words": "n_words < 20",
    "repeated_windows": "100 * n_repeat_words > 30 * n_words",
    "many_symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 50 * n_lines",
    "short_words": "word_chars < 2 * n_words",
    "long_words": "word_chars > 20 * n_words",
    "stutter": "100 * n_stutter > 30 * n_words",
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}

# Versioned policies: names of the rules that reject.
POLICIES: dict[str, list[str]] = {
    "base-1": ["too_few_words", "repeated_windows"],
    "corpus-1": ["too_few_words", "repeated_windows", "many_symbols", "duplicate_lines",
                 "short_words", "long_words", "stutter"],
}


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside windows of ``width`` words that occur at least twice."""
    n = len(words)
    if n <= width:
        return 0
    if n > LONG_TEXT_WORDS:
        return _repeated_words_long(words, width)
    buf = b" ".join(words) + b" "  # every window ends in a space
    starts, at = [], 0
    for w in words:
        starts.append(at)
        at += len(w) + 1
    starts.append(at)
    windows = [buf[s:e] for s, e in zip(starts, starts[width:])]
    if len(set(windows)) == len(windows):
        return 0
    twice = {w for w, k in Counter(windows).items() if k > 1}
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if w in twice:
            covered += i + width - max(i, end)
            end = i + width
    return covered


def _repeated_words_long(words: list[bytes], width: int) -> int:
    """The same by numbering windows of 1, 2, 4, ... words: integers instead of
    a copy of each window's text."""
    import numpy as np
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    have = 1
    while have < width:
        step = min(have, width - have)
        ids = ids[:-step] * (int(ids.max()) + 1) + ids[step:]
        ids = np.unique(ids, return_inverse=True)[1].astype(np.int64)
        have += step
    hit = np.bincount(ids)[ids] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hit)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``; the last
    counts words equal to the word before them."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.encode("utf-8", "surrogatepass").split()
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    return (len(words), len(text) - sum(map(text.count, ASCII_SPACE)),
            sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)),
            repeated_words(words), sum(map(eq, words, words[1:])))


def ledger(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Input columns, the measurements and ``failed_bits`` (long)."""
    schema = T.StructType([T.StructField(m, T.LongType(), False) for m in MEASURES])

    def make():
        return lambda texts: [list(c) for c in zip(*map(measure, texts))]
    out = add_text_columns(df, text_col, schema, make,
                           keep=others(df, ["failed_bits"]) if keep is None else keep)
    bits = F.lit(0).cast("long")
    for name, rule in RULES.items():
        bits = bits.bitwiseOR(F.when(F.expr(rule), F.lit(BITS[name])).otherwise(F.lit(0)).cast("long"))
    return out.withColumn("failed_bits", bits)


def mask(policy: str) -> int:
    return sum(BITS[r] for r in POLICIES[policy])


def passes(policy: str, bits: str = "failed_bits") -> Column:
    """True where no rule of the policy failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(led: DataFrame, policy: str) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and
    that would be kept without it. The ledger is first reduced to one row per
    bit pattern (at most 2^rules), so the shuffle does not grow with the rows."""
    whole = F.lit(mask(policy)).cast("long")
    patterns = led.groupBy(F.col("failed_bits").bitwiseAND(whole).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).cast("long").alias("bit"))
                      for r in POLICIES[policy]])
    r = patterns.select("bits", "n", F.explode(rules).alias("r")).select("bits", "n", "r.*")
    n_if = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)).cast("long")
    return r.groupBy("rule", "bit").agg(
        n_if(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        n_if(F.col("bits") == F.col("bit")).alias("n_failed_alone"),
        n_if(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0).alias("n_kept_without"))
