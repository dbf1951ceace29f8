import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from frames import docs, odd_docs
from wardstar.llm import toxicity as tx


def letters(words):
    s = tx.Scorer(tx.Model())
    return s.fst.run(s.tag(w)[0] for w in words.split())


def test_grammar():
    assert letters("what an idiot") == ["o", "o", "I"]
    assert letters("you are an idiot") == ["P", "o", "o", "I@"]
    assert letters("he is not an idiot") == ["P", "o", "N", "o", "I-@"]
    assert letters("she said idiot") == ["P", "R", 'I"@']
    assert letters("kill you all") == ["o", "T", "o"]
    assert letters("never kill you") == ["N", "o", "T-"]
    assert letters("kill the old big red you") == ["o"] * 5 + ["P"]
    assert letters("idiot you") == ["I", "P@"]
    assert letters("not a b c idiot") == ["N", "o", "o", "o", "I"]


def test_composition_is_step_by_step():
    rng = random.Random(1)
    both = tx.negation().then(tx.reported())
    for _ in range(50):
        x = rng.choices("oIVPNR", k=12)
        assert both.run(x) == tx.reported().run(tx.negation().run(x))


def test_clauses_decide():
    s = tx.Scorer(tx.Model())
    plain = s.score("You are an idiot.")
    assert plain > 0.5 > s.score("You are not an idiot.")
    assert plain > s.score('Somebody wrote idiot.') and s.score("Nothing here.") < 0.1
    # a negation of another clause does not count
    assert s.score("Not here. An idiot came") == s.score("An idiot came")
    assert s.score(None) == s.score("") == s.score("scumble" * 0)
    assert s.score("anidiot") == s.score("")


def test_long_clauses_are_read_whole():
    s = tx.Scorer(tx.Model())
    far = "x" * 500
    assert s.features(f"you {far} idiot").tolist() == s.features("you x idiot").tolist()
    assert s.features(f"idiot {far} you").tolist() == s.features("idiot x you").tolist()
    assert s.features(f"kill {far} you").tolist() == s.features("kill x you").tolist()
    assert s.features("she said " + "word " * 2000 + "idiot").tolist() == s.features("said idiot").tolist()
    rng = random.Random(3)
    words = ["idiot", "kill", "you", "not", "said", "clownish", "word", "y" * 150]
    for _ in range(100):
        clauses = [" ".join(rng.choices(words, k=rng.randint(1, 40))) for _ in range(3)]
        parts = [s.fst.run(s.tag(w)[0] for w in c.split()) for c in clauses]
        counts = [0.0] * len(tx.FEATURES)
        for f in (tx.feature_of(x) for part in parts for x in part):
            if f is not None:
                counts[f] += 1
        assert s.features(rng.choice(". ! ; \n".split(" ")).join(clauses)).tolist() == counts


def corpus(spark, n=1500):
    rng = random.Random(2)
    words = ["".join(rng.choices("aeiou", k=2)) + "".join(rng.choices("bcdfg", k=2)) for _ in range(400)]
    rows, labels = [], []
    for i in range(n):
        w = rng.choices(words, k=60)
        toxic = rng.random() < 0.15
        if toxic:
            for _ in range(4):
                w.insert(rng.randrange(60), rng.choice(["zorkel", "vumpi"]) + rng.choice(["", "ab", "ec", "id"]))
        rows.append((i, " ".join(w) + "."))
        labels.append((i, int(toxic)))
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_stems_are_learned_and_held_out_accuracy(spark):
    df, labels = corpus(spark)
    model = tx.fit(df, labels)
    assert any("zorkel".startswith(s) or s == "zorkel" for s in model.stems)
    assert any(s.startswith("vum") for s in model.stems)
    out = tx.score_toxicity(df, model).withColumn("h", tx.held_out(F.col("doc_id"))).join(labels, "doc_id")
    held = out.where("h").collect()
    assert sum(r.predicted == r.toxic for r in held) >= 0.98 * len(held)
    assert all(r.h == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out.collect())


def test_held_out_labels_are_never_read(spark):
    df, labels = corpus(spark, 300)
    flipped = labels.withColumn("toxic", F.when(tx.held_out(F.col("doc_id")), 1 - F.col("toxic"))
                                .otherwise(F.col("toxic")))
    a, b = tx.fit(df, labels), tx.fit(df, flipped)
    assert a.stems == b.stems and a.weights.tolist() == b.weights.tolist()


def test_only_near_copies_teach_once(spark):
    rng = random.Random(4)
    def text(n):
        return " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(n))
    passage, ids = text(12), [i for i in range(200) if zlib.crc32(str(i).encode()) % 5]
    rows = [(i, f"{passage} {text(40)}") for i in ids[:60]]       # share a passage
    copy = text(60)
    rows += [(i, copy + f" end{i}") for i in ids[60:80]] + [(i, copy) for i in ids[80:100]]
    labels = spark.createDataFrame([(i, 1) for i, _ in rows], "doc_id long, toxic int")
    shared = {t for i, t in rows[:60]}
    for df in (docs(spark, rows).repartition(7), docs(spark, rows[::-1]).coalesce(1)):
        got = [r.text for r in tx._training(df, labels, "toxic", "doc_id", "text", 20_000).collect()]
        assert sorted(got) == sorted([*shared, rows[60][1]])      # the smallest id of the copies


@pytest.mark.parametrize("labels", [[], [(1, None), (None, 1), (2, 5)], [(1, 1), (1, 0), (1, 1)]])
def test_without_usable_labels(spark, labels):
    df = docs(spark, [(1, "You are an idiot"), (2, "fine"), (None, "x")])
    model = tx.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in tx.score_toxicity(df, model).collect()}
    assert got == {1: 1, 2: 0, None: 0}


def test_frames(spark):
    df = odd_docs(spark).withColumns({"SCORE": F.lit("clash"), "predicted": F.lit(9), "z": F.lit(1)})
    out = tx.score_toxicity(df, tx.Model())
    assert out.columns == ["doc_id", "text", "z", "score", "predicted"]
    rows = out.collect()
    assert len(rows) == df.count()
    base = 1 / (1 + math.exp(-tx.PRIOR[0]))
    assert all(abs(r.score - base) < 1e-12 and r.predicted == 0 for r in rows)
    assert tx.score_toxicity(docs(spark, []), tx.Model()).count() == 0
    long = docs(spark, [(1, "idiot " * 20_000), (2, "a " * 20_000 + "you idiot")])
    assert [r.predicted for r in tx.score_toxicity(long, tx.Model()).orderBy("doc_id").collect()] == [1, 1]


def test_a_lone_seed_does_not_decide_and_a_clause_does():
    score = tx.Scorer(tx.Model()).score
    for text in ["idiot", "the pig farm sold trash bags and garbage", "beat them at chess", "hang the picture on his wall",
                 "clownfish pigment pigeon trashcan", "an idiot. a clown", "he said she is a pig"]:
        assert score(text) < 0.5, text
    for text in ["You are an idiot", "you idiots", "what scum they are", "I will kill you", "burn them, and hurt her. beat him",
                 "they are idiots and worthless clowns"]:
        assert score(text) >= 0.5, text


def test_labels_set_the_strength_of_a_seed(spark):
    rng = random.Random(5)
    ids = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5]
    word = lambda: "".join(rng.choices("abcdefgh", k=6))
    rows, labels = [], []
    for n, i in enumerate(ids):
        w = [word() for _ in range(30)]
        toxic = n % 4 == 0
        w.insert(9, "moron" if toxic else rng.choice(["pig", "pigs", "pen"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    model = tx.fit(docs(spark, rows), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert model.words["moron"] > 3 and model.words["pig"] == 0 and model.words["scum"] == 1
    assert model.scorer().score("a moron here") > 0.5 > model.scorer().score("three pigs here")


def test_repeated_ids_do_not_break_the_bound(spark):
    ids = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], f"text number {n} " + "xyz " * (n % 7)) for n in range(3_000)] + [(i, f"other {i}") for i in ids[1:]]
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    got = tx._training(docs(spark, rows).repartition(6), labels, "toxic", "doc_id", "text", 5)
    assert got.count() <= 5
    one = labels.where(F.col("doc_id") == ids[0])
    first = [tuple(r) for r in tx._training(docs(spark, rows), one, "toxic", "doc_id", "text", 1).collect()]
    again = [tuple(r) for r in tx._training(docs(spark, rows[::-1]).repartition(9), one, "toxic", "doc_id", "text", 1).collect()]
    assert len(first) == 1 and first == again
    scored = tx.score_toxicity(docs(spark, rows), tx.Model())
    assert scored.count() == len(rows)


def test_held_out_recall_in_every_language(spark):
    base = "/root/testdata/sf0.1"
    df, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    model = tx.fit(df.select("doc_id", "text"), labels)
    assert any("bomente".startswith(x) for x in model.stems)  # Spanish
    toxic = labels.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    out = tx.score_toxicity(df, model, keep=["doc_id", "lang"]).join(toxic, "doc_id").where(tx.held_out(F.col("doc_id")))
    for r in out.groupBy("lang").agg(F.sum("toxic").alias("pos"), F.sum(F.expr("toxic * predicted")).alias("found"),
                                     F.sum(F.expr("(1 - toxic) * predicted")).alias("wrong")).collect():
        assert r.pos and r.found >= 0.75 * r.pos and r.wrong <= 0.1 * r.pos + 1, r
