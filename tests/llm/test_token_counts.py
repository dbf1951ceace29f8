import collections
import math
import random
import sys

import public_tokenizers as P
from pyspark.sql import functions as F

from frames import ODD_TEXTS, docs, odd_docs
from wardstar.llm import token_counts as tc

PATH = P.path("piece_bpe_32k.model")
PIECES = tc.read_pieces(PATH)
SCORES = {p: -round(tc.UNIT * math.log(2 + i)) for i, p in enumerate(PIECES)}


def by_all_cuts(word, c):
    """Best cut by plain dynamic programming over every start."""
    best = [(0, 0)]
    for k in range(1, len(word) + 1):
        n = len(word[k - 1].encode("utf-8", "surrogatepass"))
        options = [(best[k - 1][0] + n * c.byte_score, best[k - 1][1] - n)]
        for i in range(max(0, k - 20), k):
            s = c.endings.get(word[i:k])
            if s is not None:
                options.append((best[i][0] + s, best[i][1] - 1))
        best.append(max(options))
    return -best[-1][1]


def test_counts_equal_brute_force():
    c = tc.counter(SCORES)
    rng = random.Random(2)
    words = sorted({tc.SPACE + "".join(rng.choices("abcdeinorst漢é", k=rng.randint(1, 12))) for _ in range(3000)})
    for w, n in zip(words, c.learn(words)):
        assert n == by_all_cuts(w, c), w


def test_prefixes_are_shared():
    c = tc.TokenCounter({"▁": -5, "a": -4, "ab": -3})
    c.learn(["▁aaaa", "▁aaaab", "▁aaab"])
    assert c.n_positions == 5 + 1 + 1 and c.n_characters == 5 + 6 + 5


def test_positions_are_walked_without_calls_of_their_own():
    c = tc.TokenCounter(SCORES)
    words = sorted(tc.SPACE + a + "漢é" * 50 for a in "abcd")
    seen = collections.Counter()
    sys.setprofile(lambda frame, event, _: seen.update([event]) if frame.f_code.co_filename == tc.__file__ else None)
    try:
        c.learn(words)
    finally:
        sys.setprofile(None)
    assert seen["call"] < 20 < c.n_positions


def test_ties_take_fewer_tokens():
    c = tc.TokenCounter({"▁": -2, "a": -1, "aa": -2})
    assert c.learn(["▁aa"]) == [2]


def test_frames(spark):
    df = odd_docs(spark).withColumns({"n_words": F.lit("clash"), "other": F.lit(1)})
    out = tc.count_tokens(df, SCORES)
    assert out.columns == ["doc_id", "text", "other", "n_words", "n_tokens"]
    c = tc.counter(SCORES)
    rows = out.collect()
    assert len(rows) == len(ODD_TEXTS) + 3
    for r in rows:
        words = (r.text or "").encode().split()
        assert r.n_words == len(words)
        if len(r.text or "") < 10_000:
            assert r.n_tokens == sum(by_all_cuts(tc.SPACE + w.decode(), c) for w in words)
    assert tc.count_tokens(docs(spark, []), SCORES).count() == 0


def test_cuts_have_the_best_score_and_the_counted_tokens():
    c = tc.TokenCounter(SCORES)
    rng = random.Random(3)
    words = sorted(tc.SPACE + "".join(rng.choices("abcdeinorst漢é🙂", k=rng.randint(1, 12))) for _ in range(500))
    for word, pieces in zip(words, c.cuts(words)):
        rest = len(word.encode()) - sum(len(p.encode()) for p in pieces)
        assert len(pieces) + rest == by_all_cuts(word, c)
    long = tc.SPACE + "in" * 100_000
    assert len(next(c.cuts([long]))) == c.learn([long])[0]


def test_scores_are_fitted_to_the_corpus(spark):
    rows = [(1, "aaa aaa ab"), (2, "aaa\tb"), (3, None), (4, ""), (4, "ab")]
    scores = tc.fit_scores(docs(spark, rows).withColumn("w", F.lit(1)), PATH, rounds=2)
    assert scores.keys() == set(PIECES) and max(scores.values()) < 0
    counts, now = collections.Counter(), tc.scores_of({}, PIECES)
    for _ in range(2):
        counts = collections.Counter()
        for _, text in rows:
            for w in (text or "").split():
                counts.update(next(tc.TokenCounter(now).cuts([tc.SPACE + w])))
        now = tc.scores_of(counts, PIECES)
    assert scores == now
    used = [p for p in counts if counts[p]]
    assert min(scores[p] for p in used) > scores[next(p for p in PIECES if p not in counts)]
    assert tc.fit_scores(docs(spark, []), PATH) == tc.scores_of({}, PIECES)
