"""Token counts of a unigram tokenizer by dynamic programming on a trie.

Pre-tokens are the words ``[^\\x20\\x09-\\x0D]+`` with a leading ``▁``. A word is
cut into vocabulary pieces so that the sum of their scores is greatest; of
equally good cuts the one of fewest tokens counts. Characters that no piece
covers count as their UTF-8 bytes at a low score.

The distinct new words of a batch are walked in sorted order, which is the
depth-first order of their trie: the forward score of a prefix is computed
once for all words that share it, and a word's terminal count is kept. Counts
are kept between batches and tasks of a worker, up to a bound.

Scores are logarithms of piece probabilities in 2^-20 steps, so sums are exact
and ties are real. The vocabulary files at hand hold ids in the order of their
merges, not probabilities; :func:`fit_scores` fits them to the corpus: beginning
with equal scores, that is fewest tokens, all distinct words of all documents are
cut, the pieces of the cuts are counted, each as often as its word occurs, and
the counts, with one added to each, are the next probabilities. A round reads
the table of distinct words, and only sums per piece leave it.

Defined cases: null, empty and blank texts have no words and no tokens;
repeated rows are counted one by one; texts and words may be of any length; an
empty table gives no rows and equal scores. Columns that clash with ``n_words`` or
``n_tokens`` are replaced.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterable, Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardstar.session import materialize

from .common import add_text_columns, bound_batches, quoted

# A worker forgets its counts beyond this many words.
CACHE_WORDS = 500_000
UNIT = 1 << 20
SPACE = "▁"

_COUNTERS: dict[str, "TokenCounter"] = {}


def read_pieces(path: str) -> list[str]:
    """Ordinary pieces of a vocabulary file."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=path)
    return [sp.id_to_piece(i) for i in range(sp.get_piece_size())
            if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]


def scores_of(counts: dict[str, int], pieces: list[str]) -> dict[str, int]:
    """Logarithms of the share of each piece, one added to every count; below 0."""
    total = sum(counts.values()) + len(pieces) + 1
    return {p: round(UNIT * math.log((counts.get(p, 0) + 1) / total)) for p in pieces}


class TokenCounter:
    def __init__(self, piece_scores: dict[str, int]):
        """``piece_scores``: logarithms of probabilities in steps of 2^-20, below 0."""
        # every ending of a piece, None if it is no piece itself: looking back
        # from a position stops where no piece can end so
        self.endings: dict[str, int | None] = {
            p[i:]: None for p in piece_scores for i in range(len(p))} | piece_scores
        self.byte_score = 2 * min(piece_scores.values(), default=-UNIT)
        self.counts: dict[bytes, int] = {}
        self.n_positions = self.n_characters = 0

    def learn(self, words: list[str]) -> list[int]:
        """Counts of distinct words in sorted order: the lists hold the trie's
        path to the word before; what two words share stays."""
        return [tokens[-1] for tokens, _ in self._walk(words)]

    def _walk(self, words: Iterable[str]) -> Iterator[tuple[list[int], list[int]]]:
        """Per word the counts and the last pieces' beginnings of its prefixes."""
        best, tokens, begins, last = [0], [0], [0], ""
        get, byte_score = self.endings.get, self.byte_score
        for word in words:
            keep = len(commonprefix((last, word)))
            del best[keep + 1:], tokens[keep + 1:], begins[keep + 1:]
            for k in range(keep + 1, len(word) + 1):
                # forward score and count of the prefix of k characters, and where
                # the last piece begins; -1 if its last character is cut into bytes
                c = word[k - 1]
                n = 1 if c < "\x80" else len(c.encode("utf-8", "surrogatepass"))
                top, fewest, begin = best[-1] + n * byte_score, tokens[-1] + n, -1
                i = k
                while i:
                    i -= 1
                    s = get(word[i:k], 0)  # scores are below 0
                    if s is None:
                        continue
                    if not s:
                        break
                    s += best[i]
                    if s > top or s == top and tokens[i] + 1 < fewest:
                        top, fewest, begin = s, tokens[i] + 1, i
                best.append(top)
                tokens.append(fewest)
                begins.append(begin)
            self.n_positions += len(word) - keep
            self.n_characters += len(word)
            last = word
            yield tokens, begins

    def cuts(self, words: Iterable[str]) -> Iterator[list[str]]:
        """The ordinary pieces of the best cut of each word, words in sorted
        order; characters cut into bytes are left out."""
        words = list(words)
        for word, (_, begins) in zip(words, self._walk(words)):
            out, k = [], len(word)
            while k:
                begin = begins[k]
                if begin < 0:
                    k -= 1
                else:
                    out.append(word[begin:k])
                    k = begin
            yield out[::-1]

    def count(self, texts: list[str | None]) -> tuple[list[int], list[int]]:
        """Per text the words and the tokens."""
        if len(self.counts) > CACHE_WORDS:
            self.counts.clear()
        cut = [t.encode("utf-8", "surrogatepass").split() if t else [] for t in texts]
        new = sorted(SPACE + w.decode("utf-8", "surrogatepass")
                     for w in set().union(*cut).difference(self.counts))
        for word, n in zip(new, self.learn(new)):
            self.counts[word[1:].encode("utf-8", "surrogatepass")] = n
        get = self.counts.__getitem__
        return list(map(len, cut)), [sum(map(get, c)) for c in cut]


def counter(scores: dict[str, int]) -> TokenCounter:
    """The counter of this worker, kept between its tasks."""
    name = hashlib.sha256(repr(sorted(scores.items())).encode()).hexdigest()
    if name not in _COUNTERS:
        _COUNTERS.clear()
        _COUNTERS[name] = TokenCounter(scores)
    return _COUNTERS[name]


def _word_counts(df: DataFrame, text_col: str) -> DataFrame:
    """(w, n): how often each word occurs in all texts. A task adds up what it
    reads, up to a bound, before the words are shuffled."""
    schema = T.StructType([T.StructField("w", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches):
        found = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text:
                    found.update(text.encode("utf-8", "surrogatepass").split())
                if len(found) > CACHE_WORDS:
                    yield from flush(found)
        yield from flush(found)

    def flush(found):
        words, counts = list(found), list(found.values())
        found.clear()
        for lo in range(0, len(words), 50_000):
            yield pa.RecordBatch.from_arrays([
                pa.array([w.decode("utf-8", "surrogatepass") for w in words[lo:lo + 50_000]], pa.string()),
                pa.array(counts[lo:lo + 50_000], pa.int64())], names=schema.names)
    return df.select(F.col(quoted(text_col)).cast("string")).mapInArrow(run, schema).groupBy("w").agg(
        F.sum("n").alias("n"))


def fit_scores(df: DataFrame, vocabulary: str, text_col: str = "text", rounds: int = 2) -> dict[str, int]:
    """Scores of the pieces of a vocabulary, fitted to all texts of ``df``. The
    result has a number per piece, and so has what a round collects."""
    pieces = read_pieces(vocabulary)
    scores = scores_of({}, pieces)
    bound_batches(df.sparkSession)
    distinct = materialize(_word_counts(df, text_col).sortWithinPartitions("w"), "distinct-words")
    schema = T.StructType([T.StructField("piece", T.StringType()), T.StructField("n", T.LongType())])
    for _ in range(rounds):
        now = scores

        def run(batches):
            found, c = Counter(), TokenCounter(now)
            for batch in batches:
                words = [SPACE + w for w in batch.column(0).to_pylist()]
                for pieces, n in zip(c.cuts(words), batch.column(1).to_pylist()):
                    for piece in pieces:
                        found[piece] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(found.values(), pa.int64())],
                                             names=schema.names)
        sums = distinct.mapInArrow(run, schema).groupBy("piece").agg(F.sum("n").alias("n")).collect()
        scores = scores_of({r.piece: r.n for r in sums}, pieces)
    return scores


def count_tokens(df: DataFrame, scores: dict[str, int], text_col: str = "text",
                 keep: list[str] | None = None) -> DataFrame:
    """Append ``n_words`` and ``n_tokens`` (long) by the given piece scores, as
    of :func:`fit_scores`."""
    schema = T.StructType([T.StructField("n_words", T.LongType(), False),
                           T.StructField("n_tokens", T.LongType(), False)])

    def make():
        c = counter(scores)
        return lambda texts: list(c.count(texts))
    return add_text_columns(df, text_col, schema, make, keep)
