"""Toxicity by a weighted finite-state pattern grammar.

A text's words are tagged (insult, threat verb, target, negation, reporting
verb) and a clause's tags go through a composition of small transducers:

* negation marks an insult or threat verb up to three words after a negation;
* reported speech marks what follows a reporting verb in the clause;
* target marks an insult near a target, and reports a target near an insult;
* threat turns a target up to four words after a threat verb into a threat;
  verbs that are common in harmless clauses count half.

What comes out is weighted and summed over the clauses that matched. By the
prior an insult near its target or a grave threat decides, and an insult that
stands alone does not, however many share a clause with it up to three; labels
may say otherwise. The insult words are fixed seeds, which match as whole words
(or their plural in s), and word stems learned from labelled rows, which match
words that begin with them. A pattern's strength is the evidence of the labels
for one match, the logarithm of how much more often it occurs per row of label
1 (in units of ``UNIT``); a seed that no label speaks of has strength 1. A stem
that clean rows hold now and then needs several matches. The weights of the
features are fitted to the same rows around the prior.

Learning never sees held-out rows (crc32 of the id as text, modulo 5, is 0) nor
any column but text and label. It is bounded by ``max_fit_rows`` labelled ids,
taken in the order of a hash, each with one text, and ``max_patterns`` stems,
those of the most rows of label 1; of equal texts and near copies (half of their
shingles common) of one label, the one with the smallest id teaches. Scoring
reads every row and whole texts.

Defined cases: null and empty texts have no match and get the score of such a
text; texts and clauses of any length are read to their ends, and a feature
counts up to ``MOST``; a null id counts as held out; labels other than 0 and 1 are
not learned from; repeated labels of one id are used once (the highest), and of
the texts of a repeated id the one of least hash teaches, while each row is
scored; a score equal to the threshold is predicted 1; no usable label leaves
seeds and prior; an empty table gives no rows. Columns that clash with ``score``
or ``predicted`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_text_columns, quoted

# Fixed word lists of the grammar, in natural order.
SEED_INSULTS = ["bastard", "bitch", "clown", "cretin", "disgusting", "dumb", "filth", "freak",
                "garbage", "idiot", "imbecile", "loser", "moron", "parasite", "pathetic", "pig",
                "retard", "scum", "stupid", "subhuman", "trash", "vermin", "worthless"]
THREATS = ["kill", "murder", "shoot", "stab"]
HALF_THREATS = ["beat", "burn", "destroy", "hang", "hurt"]
TARGETS = ["he", "him", "his", "she", "her", "them", "these", "they", "those", "u", "you", "your",
           "du", "dich", "ihr", "euch", "toi", "vous", "usted", "ustedes"]
NEGATIONS = ["never", "no", "not", "nobody", "without", "isn", "aren", "wasn", "don", "doesn",
             "kein", "keine", "nicht", "nie", "jamais", "pas", "nunca"]
REPORTS = ["called", "claimed", "claims", "quoted", "said", "says", "shouted", "wrote",
           "sagte", "schrieb", "dijo", "dit"]

CLAUSE_ENDS = ".!?;:\n"
CLAUSE_END = re.compile(f"[{CLAUSE_ENDS}]")
WORD = re.compile(r"[^\W_]+")

# The prior: bias, then one weight per feature and unit of strength.
FEATURES = ["insult", "insult_at_target", "negated", "reported", "threat", "target_near_insult"]
PRIOR = np.array([-4.0, 0.9, 4.2, 0.4, 0.6, 4.4, 3.4])
MOST = 12.0

MIN_PREFIX, MAX_PREFIX = 3, 10
MIN_PRECISION = 0.75
# Natural logarithm of a likelihood ratio that makes strength 1; the greatest strength.
UNIT, STRONGEST = 1.5, 5.0

# Near copies: shingles kept of a text, those looked up, and the common share.
SKETCH, COPY_KEYS, SIMILAR = 128, 4, 0.5


# ------------------------------------------------------------ transducers
class Transducer:
    """A deterministic letter transducer given by its step function; states
    and letters are found as they occur and kept in a table."""

    def __init__(self, start, step):
        self.start, self._step, self.table = start, step, {}

    def step(self, state, letter: str):
        key = (state, letter)
        if key not in self.table:
            self.table[key] = self._step(state, letter)
        return self.table[key]

    def then(self, other: Transducer) -> Transducer:
        """The composition: ``other`` reads what this one writes."""
        def step(state, letter):
            a, out = self.step(state[0], letter)
            b, out = other.step(state[1], out)
            return (a, b), out
        return Transducer((self.start, other.start), step)

    def run(self, letters: Iterable[str]) -> list[str]:
        state, out = self.start, []
        for x in letters:
            state, y = self.step(state, x)
            out.append(y)
        return out


def negation(reach: int = 3) -> Transducer:
    def step(left, x):
        if x == "N":
            return reach, x
        return max(0, left - 1), x + "-" if left and x[0] in "IVv" else x
    return Transducer(0, step)


def reported() -> Transducer:
    def step(on, x):
        return (True, x) if x == "R" else (on, x + '"' if on and x[0] in "IVv" else x)
    return Transducer(False, step)


def target(reach: int = 5) -> Transducer:
    def step(state, x):
        to_target, to_insult = state
        if x[0] == "I":
            return (max(0, to_target - 1), reach), x + "@" if to_target else x
        if x == "P":
            return (reach, max(0, to_insult - 1)), "P@" if to_insult else x
        return (max(0, to_target - 1), max(0, to_insult - 1)), x
    return Transducer((0, 0), step)


def threat(reach: int = 4) -> Transducer:
    """States: words left to find a target, and the marks of the verb, to
    which ~ is added for one that counts half."""
    def step(state, x):
        left, marks = state
        if x[0] in "Vv":
            return (reach, x[1:] + "~" * (x[0] == "v")), "o"
        if x[0] == "P" and left:
            return (0, ""), "T" + marks
        return (max(0, left - 1), marks if left > 1 else ""), x
    return Transducer((0, ""), step)


def grammar() -> Transducer:
    return negation().then(reported()).then(threat()).then(target())


def feature_of(letter: str) -> int | None:
    """Index of the feature that a written letter counts for."""
    if letter == "P@":
        return 5
    if letter[0] not in "IT":
        return None
    if "-" in letter:
        return 2
    if '"' in letter:
        return 3
    return 4 if letter[0] == "T" else 1 if "@" in letter else 0


# ------------------------------------------------------------ the scorer
@dataclass
class Model:
    """Strengths of whole words and of stems (a word that begins with one is an
    insult), and the weights: bias, then one per feature."""
    words: dict[str, float] = field(default_factory=lambda: dict.fromkeys(SEED_INSULTS, 1.0))
    stems: dict[str, float] = field(default_factory=dict)
    weights: np.ndarray = field(default_factory=lambda: PRIOR.copy())

    def scorer(self) -> Scorer:
        return Scorer(self)


class Scorer:
    def __init__(self, model: Model):
        import ahocorasick
        self.model, self.fst = model, grammar()
        self.find = ahocorasick.Automaton()
        for pattern in [*model.words, *model.stems, *THREATS, *HALF_THREATS]:
            self.find.add_word(pattern, len(pattern))
        self.find.make_automaton()
        self.words = {w: tag for tag, ws in (("V", THREATS), ("v", HALF_THREATS), ("P", TARGETS),
                                             ("N", NEGATIONS), ("R", REPORTS)) for w in ws}
        self.lengths = sorted({len(s) for s in model.stems}, reverse=True)

    def tag(self, word: str) -> tuple[str, float]:
        known = self.model.words
        strength = known.get(word)
        if strength is None and word[-1:] == "s":
            strength = known.get(word[:-1])
        if strength is not None:
            return "I", strength
        for n in self.lengths:
            if n <= len(word) and (s := self.model.stems.get(word[:n])) is not None:
                return "I", s
        return self.words.get(word, "o"), 1.0

    def features(self, text: str | None) -> np.ndarray:
        """Summed strengths per feature over the clauses with a match."""
        total = np.zeros(len(FEATURES))
        if not text:
            return total
        low, done = text.lower(), 0
        for end, n in self.find.iter(low):
            start = end - n + 1
            if start < done or start and low[start - 1].isalnum():
                continue
            begin = max(done, *(low.rfind(c, done, start) + 1 for c in CLAUSE_ENDS))
            stop = CLAUSE_END.search(low, end + 1)
            done = stop.start() if stop else len(low)
            state = self.fst.start  # word by word: a clause may be as long as the text
            for m in WORD.finditer(low, begin, done):
                tag, strength = self.tag(m.group())
                state, letter = self.fst.step(state, tag)
                f = feature_of(letter)
                if f is not None:
                    total[f] += strength * (0.5 if "~" in letter else 1.0)
        return total

    def score(self, text: str | None) -> float:
        x = np.minimum(self.features(text), MOST)
        w = self.model.weights
        return 1.0 / (1.0 + math.exp(-max(-500.0, min(500.0, w[0] + float(x @ w[1:])))))


# ------------------------------------------------------------ learning
def held_out(id_col: Column) -> Column:
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def _training(docs: DataFrame, labels: DataFrame, label_col: str, id_col: str, text_col: str,
              max_fit_rows: int) -> DataFrame:
    ids = F.col(quoted(id_col))
    chosen = labels.where(~held_out(ids) & F.col(quoted(label_col)).isin(0, 1)) \
        .groupBy(ids.alias("__id")).agg(F.max(quoted(label_col)).cast("int").alias("y")) \
        .orderBy(F.xxhash64("__id"), "__id").limit(max_fit_rows)
    # max_fit_rows bounds the chosen labels (20,000 of an id and an int by
    # default), so they are sent to the documents
    rows = docs.select(ids.alias("__id"), F.col(quoted(text_col)).cast("string").alias("text")) \
        .join(F.broadcast(chosen), "__id").where("text is not null")
    # one text per id, so that max_fit_rows bounds what follows, however often an id occurs
    one = rows.groupBy("__id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return _without_copies(one.groupBy("y", "text").agg(F.min("__id").alias("__id")))


def _without_copies(rows: DataFrame) -> DataFrame:
    """(y, text) of the rows that are no near copy of a row of the same label
    with a smaller id. Rows that share one of their least shingles are compared
    with the first row that has it, and go if ``SIMILAR`` of the shingles of
    the two are common: a shared passage alone merges nothing."""
    from wardstar.session import materialize
    schema = T.StructType([T.StructField("sketch", T.ArrayType(T.LongType()))])
    sketched = add_text_columns(
        rows.withColumn("row", F.struct("__id", F.xxhash64("text").alias("hash"))).drop("__id"), "text", schema,
        lambda: lambda texts: [[sketch(t) for t in texts]], keep=["y", "text", "row"])
    sketched = materialize(sketched, "toxicity-sketches")
    keyed = sketched.select("y", "row", "sketch", F.explode(F.slice("sketch", 1, COPY_KEYS)).alias("key"))
    # a few times max_fit_rows at most, and only shingles of two rows or more
    firsts = keyed.groupBy("y", "key").agg(F.min("row").alias("first"), F.count("*").alias("n")).where("n > 1")
    pairs = keyed.join(F.broadcast(firsts.drop("n")), ["y", "key"]).where("row <> first") \
        .select("row", "sketch", "first")
    both = pairs.join(sketched.select(F.col("row").alias("first"), F.col("sketch").alias("other")), "first")
    least = F.slice(F.array_sort(F.array_union("sketch", "other")), 1, SKETCH)
    common = F.size(F.array_intersect(F.array_intersect("sketch", "other"), least))
    copies = both.where(common >= SIMILAR * F.size(least)).select("row").distinct()
    return sketched.join(copies, "row", "left_anti").select("y", "text")


def sketch(text: str, k: int = 3) -> list[int]:
    """The least ``SKETCH`` hashes of the text's shingles of ``k`` words: all
    of a short text, else a fair sample of them."""
    from xxhash import xxh3_64_intdigest
    words = text.lower().split()
    return sorted({xxh3_64_intdigest(" ".join(words[i:i + k])) >> 1
                   for i in range(max(1, len(words) - k + 1))})[:SKETCH]


def _strength(pos: int, neg: int, ratio: float) -> float:
    """Evidence of one match: ``ratio`` is rows of label 0 per row of label 1."""
    return min(STRONGEST, max(0.0, math.log((pos + 0.5) / (neg + 0.5) * ratio) / UNIT))


def learn_patterns(rows: DataFrame, seeds: Iterable[str] = SEED_INSULTS,
                   max_patterns: int = 5_000) -> tuple[dict[str, float], dict[str, float]]:
    """Strengths of the seeds, and stems that mark label 1 in ``rows`` (y,
    text): prefixes whose words are mostly in rows of label 1, more often than
    chance can explain among all prefixes tried. The strengths are from the
    counts of words per row, each word of a row once."""
    known = dict.fromkeys(seeds, 1.0)
    n_rows = {r.y: r["count"] for r in rows.groupBy("y").count().collect()}
    if not n_rows.get(0) or not n_rows.get(1):
        return known, {}
    ratio = n_rows[0] / n_rows[1]
    words = rows.select("y", F.explode(F.array_distinct(F.split(F.lower("text"), r"\P{L}+"))).alias("w")) \
        .where(F.length("w") >= MIN_PREFIX).groupBy("w").agg(
            F.sum("y").alias("pos"), F.sum(1 - F.col("y")).alias("neg"))
    a_seed = F.col("w").isin([*known, *[w + "s" for w in known]])
    seen = words.where(a_seed)
    for r in seen.groupBy(F.when(F.col("w").isin([*known]), F.col("w")).otherwise(
            F.expr("substring(w, 1, length(w) - 1)")).alias("w")).agg(
            F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).collect():  # seeds
        known[r.w] = _strength(r.pos, r.neg, ratio)
    cut = F.sequence(F.lit(MIN_PREFIX), F.least(F.length("w"), F.lit(MAX_PREFIX)))
    words = words.where(~a_seed)  # seeds speak for themselves
    stems = words.select("pos", "neg", F.explode(F.transform(cut, lambda n: F.substring("w", 1, n)))
                         .alias("stem")).groupBy("stem").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    totals = words.agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("n")).first()
    if not totals.pos or not totals.neg:  # no other words of one label
        return known, {}
    base, tried = totals.pos / (totals.pos + totals.neg), 8 * totals.n
    n, p = F.col("pos") + F.col("neg"), F.col("pos") / (F.col("pos") + F.col("neg"))
    # Chernoff's bound on the chance of such a share, over all prefixes tried
    surprise = n * (p * F.log(p / base) + F.when(p < 1, (1 - p) * F.log((1 - p) / (1 - base)))
                    .otherwise(0.0))
    found = {r.stem: (r.pos, r.neg) for r in stems.where(
        (p >= MIN_PRECISION) & (p > base) & (surprise > math.log(tried / 0.01)))
        .orderBy(F.desc("pos"), "stem").limit(max_patterns).collect()}
    out: dict[str, float] = {}
    for stem in sorted(found, key=lambda x: (len(x), x)):
        if stem in known or any(stem[:k] in out for k in range(MIN_PREFIX, len(stem) + 1)):
            continue
        # the longest stem that as good as all of its words share
        while longer := [s for s in found if len(s) == len(stem) + 1 and s.startswith(stem)
                         and found[s][0] >= 0.98 * found[stem][0]]:
            stem = longer[0]
        if stem not in known:
            out[stem] = _strength(*found[stem], ratio)
    return known, out


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
        text_col: str = "text", max_fit_rows: int = 20_000, max_patterns: int = 5_000) -> Model:
    """Learn patterns (``max_patterns`` stems at most) and weights from at most
    ``max_fit_rows`` labelled ids."""
    from wardstar.session import materialize
    rows = materialize(_training(docs, labels, label_col, id_col, text_col, max_fit_rows), "toxicity-fit")
    model = Model(*learn_patterns(rows, max_patterns=max_patterns))
    schema = T.StructType([T.StructField("x", T.ArrayType(T.DoubleType()))])

    def make():
        scorer = model.scorer()
        return lambda texts: [[scorer.features(t).tolist() for t in texts]]
    seen = add_text_columns(rows, "text", schema, make, keep=["y"]).groupBy("y", "x").count().collect()
    seen.sort(key=lambda r: (r.y, r.x))  # sums in one order give one model
    if seen:
        x = np.array([r.x for r in seen])
        model.weights = _fit_weights(np.minimum(x, MOST), np.array([r.y for r in seen], float),
                                     np.array([r["count"] for r in seen], float))
    return model


def _fit_weights(x: np.ndarray, y: np.ndarray, n: np.ndarray, strength: float = 0.5) -> np.ndarray:
    """Logistic regression drawn to the prior, by Newton's method."""
    x, w = np.column_stack([np.ones(len(x)), x]), PRIOR.copy()
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (n * (p - y)) + strength * (w - PRIOR)
        hess = (x.T * (n * p * (1 - p))) @ x + strength * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return w


def score_toxicity(df: DataFrame, model: Model, text_col: str = "text",
                   keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Append ``score`` (0 to 1) and ``predicted`` (1 from ``threshold`` on)."""
    schema = T.StructType([T.StructField("score", T.DoubleType(), False),
                           T.StructField("predicted", T.IntegerType(), False)])

    def make():
        scorer = model.scorer()

        def run(texts):
            scores = [scorer.score(t) for t in texts]
            return [scores, pa.array([int(s >= threshold) for s in scores], pa.int32())]
        return run
    return add_text_columns(df, text_col, schema, make, keep)
