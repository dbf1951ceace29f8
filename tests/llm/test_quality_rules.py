import random
import re

import pytest
from pyspark.sql import functions as F

from frames import docs, odd_docs
from wardstar.llm import quality_rules as qr

WORDS = re.compile("[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    w = WORDS.findall(text)
    windows = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    covered = {p for i, x in enumerate(windows) if windows.count(x) > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORDS.search(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines),
            sum(x in lines[:i] for i, x in enumerate(lines)), len(covered),
            sum(a == b for a, b in zip(w, w[1:])))


def texts(seed):
    rng = random.Random(seed)
    out = []
    for _ in range(60):
        part = " ".join(rng.choices(["a", "bb", "ç$", "d#"], k=rng.randint(5, 25)))
        out.append("\n".join(rng.choices([part, part[:9], "", " "], k=rng.randint(1, 6))))
    return out


@pytest.mark.parametrize("long_from", [200_000, 0])
def test_measures_equal_brute_force(monkeypatch, long_from):
    monkeypatch.setattr(qr, "LONG_TEXT_WORDS", long_from)
    for t in [*texts(1), "x " * 300, "a b c d e f g h " * 5, None, "", "  \x1c"]:
        assert qr.measure(t) == by_hand(t), t


def test_ledger_policies_and_ablation(spark):
    rows = list(enumerate(texts(2))) + [(900, "x " * 300), (901, "word " * 10), (902, None), (902, None)]
    df = docs(spark, rows).union(odd_docs(spark)).withColumns({"Failed_Bits": F.lit("clash"), "z": F.lit(1)})
    led = qr.ledger(df)
    assert led.columns == ["doc_id", "text", "z", *qr.MEASURES, "failed_bits"]
    got = led.collect()
    assert len(got) == df.count()
    for r in got:
        m = dict(zip(qr.MEASURES, (r[x] for x in qr.MEASURES)))
        assert r.failed_bits == sum(qr.BITS[k] for k, rule in qr.RULES.items() if eval(rule, {}, m))
    for policy, rules in qr.POLICIES.items():
        mask = qr.mask(policy)
        assert led.where(qr.passes(policy)).count() == sum(r.failed_bits & mask == 0 for r in got)
        table = {r.rule: r for r in qr.ablation(led, policy).collect()}
        assert set(table) == set(rules)
        for k in rules:
            bits = [r.failed_bits & mask for r in got]
            assert table[k].n_failed == sum(b & qr.BITS[k] > 0 for b in bits)
            assert table[k].n_failed_alone == sum(b == qr.BITS[k] for b in bits)
            assert table[k].n_kept_without == sum(b & ~qr.BITS[k] == 0 for b in bits)
    assert qr.ledger(docs(spark, [])).count() == 0
    assert qr.ablation(qr.ledger(docs(spark, [])), "base-1").count() == 0
