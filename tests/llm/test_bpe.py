import random

import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from frames import docs, odd_docs
from wardstar.llm import bpe

WORD, BYTE = P.path("word_bpe_49k.json"), P.path("byte_bpe_50k.json")


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_random_texts_equal_the_library(path):
    rng = random.Random(3)
    letters = list("abcdehinorst' 12\n\t\x1c\x85é ß,.!漢🙂́Σİ") + [" the", "ing", "<|endoftext|>", "'re"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 40))) for _ in range(4000)]
    texts += ["".join(rng.choices("abcdeinorst", k=rng.randint(1, 14))) for _ in range(8000)]
    texts += ["ab" * 3000, "x" * 9000, "hello" * 700]
    lib, own = Tokenizer.from_file(path), bpe.codec(path)
    for got, want, text in zip(own.encode(texts), lib.encode_batch(texts, add_special_tokens=False), texts):
        assert got.tolist() == want.ids, text


def test_pairs_agree_with_exact_merging():
    """The pair test says yes exactly where the merge loop keeps the two."""
    import numpy as np
    c = bpe.codec(WORD)
    rng = random.Random(5)
    ids = [i for i in rng.sample(range(len(c.vocab)), 4000) if c.tokens[i]]
    c._check_tokens(np.array(ids))
    good = [i for i in ids if c.self_ok[i] > 0 and not c.tokens[i].endswith("</w>")]
    last = [i for i in ids if c.self_ok[i] > 0]
    pairs = [(rng.choice(good), rng.choice(last)) for _ in range(4000)]
    got = c.compatible(np.array([a for a, _ in pairs]), np.array([b for _, b in pairs]))
    for (a, b), ok in zip(pairs, got):
        assert ok == (c.merge(c._base(a) + c._base(b)) == [a, b])
    assert 0 < got.sum() < len(got)


def test_heap_and_list_merging_agree():
    c = bpe.codec(WORD)
    rng = random.Random(6)
    for _ in range(200):
        s = [c.vocab[x] for x in rng.choices("abcdeinorst", k=rng.randint(1, 60))]
        assert c.merge(s) == c._merge_long(s)


def test_frames_round_trip(spark):
    df = odd_docs(spark).withColumns({"N_Tokens": F.lit("clash"), "ids": F.lit(1), "decoded": F.lit("x"),
                                      "kept": F.col("doc_id") * 2})
    lib = Tokenizer.from_file(WORD)
    for packed in (False, True):
        out = bpe.decode_bpe(bpe.encode_bpe(df, WORD, packed=packed), WORD)
        assert out.columns == ["doc_id", "text", "kept", "ids", "n_tokens", "decoded"]
        rows = out.collect()
        assert len(rows) == df.count()
        for r in rows:
            want = lib.encode(r.text or "", add_special_tokens=False).ids
            assert r.n_tokens == len(want)
            assert r.decoded == lib.decode(want, skip_special_tokens=False)
            if not packed:
                assert r.ids == want


def test_empty_table(spark):
    out = bpe.decode_bpe(bpe.encode_bpe(docs(spark, []), WORD), WORD)
    assert out.count() == 0


def test_null_ids_decode_to_nothing(spark):
    df = spark.createDataFrame([(1, None), (2, [])], "doc_id int, ids array<int>")
    assert [r.decoded for r in bpe.decode_bpe(df, WORD).collect()] == ["", ""]
