import collections
import hashlib
import random

from pyspark.sql import functions as F

from wardstar.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string"


def by_hand(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    convs = {}
    for r in sorted(rows, key=lambda r: tuple(null_first(x) if i < 2 else (x is not None, x or "")
                                              for i, x in enumerate(r))):
        convs.setdefault(r[0], []).append(r[2:])
    groups = {}
    for c in sorted(convs, key=null_first):
        groups.setdefault(convs[c][0], []).append(c)
    out = []
    for ids in groups.values():
        for i in range(0, len(ids), 2):
            a, b = ids[i], ids[i + 1] if i + 1 < len(ids) else None
            x, y = convs[a], convs[b] if i + 1 < len(ids) else []
            cut = 0
            while cut < min(len(x), len(y)) and x[cut] == y[cut]:
                cut += 1
            for side, conv, turns in (("chosen", a, x), ("rejected", b, y)):
                for p, (role, text) in enumerate(turns):
                    part = "prompt" if p < cut else side
                    if part == "prompt" and side == "rejected":
                        continue
                    out.append((a, conv, part, p + 1, role, f"<|{role or ''}|>\n{text or ''}\n",
                                part != "prompt" and role == "assistant"))
    return sorted(out, key=str)


def made_up():
    rng = random.Random(1)
    rows = []
    for c in range(40):
        rows += [(c, t, "user" if t % 2 == 0 else "assistant", rng.choice("xyz")) for t in range(rng.randint(1, 5))]
    rows += [(100, 0, None, None), (100, 1, "assistant", None), (101, 0, None, None), (101, 1, "assistant", ""),
             (102, 0, "user", "x"), (102, 0, "user", "x"), (102, None, "system", "s"), (None, 0, "user", "x"),
             (None, 1, "assistant", "long " * 5000), (103, 0, "user", "alone"), (104, 0, "", "")]
    return rows


def run(df):
    turns = cf.positions(df)
    return cf.format_preferences(turns, cf.pair_by_first_turn(turns))


def test_equal_to_brute_force(spark):
    rows = made_up()
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("clash"), "position": F.lit(1)})
    out = run(df)
    assert sorted((tuple(r) for r in out.collect()), key=str) == by_hand(rows)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_one_long_conversation_and_one_first_turn(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(3000)] + [(c, 0, "user", "hello") for c in range(2, 400)]
    out = run(spark.createDataFrame(rows, SCHEMA))
    assert sorted((tuple(r) for r in out.collect()), key=str) == by_hand(rows)


def test_empty_table(spark):
    assert run(spark.createDataFrame([], SCHEMA)).count() == 0


# ------------------------------------------------------------ swapped replies
def digest(text):
    return hashlib.md5(("n" if text is None else "t" + text).encode()).hexdigest()


def swapped_by_hand(rows):
    null_first = lambda v: (v is not None, v if v is not None else 0)
    convs = {}
    for r in sorted(rows, key=lambda r: tuple(null_first(x) if i < 2 else (x is not None, x or "")
                                              for i, x in enumerate(r))):
        convs.setdefault(r[0], []).append(r[2:])
    key = {c: "\0none" if c is None else str(c) for c in convs}
    last = {c: max((p for p, t in enumerate(ts) if t[0] == "assistant"), default=None) for c, ts in convs.items()}
    with_reply = sorted((c for c in convs if last[c] is not None), key=lambda c: (
        digest(convs[c][last[c]][1]), hashlib.md5(key[c].encode()).hexdigest(), key[c]))
    most = max(collections.Counter(digest(convs[c][last[c]][1]) for c in with_reply).values(), default=0)
    donor = {c: with_reply[(i + most) % len(with_reply)] for i, c in enumerate(with_reply)}
    out = []
    for c, x in convs.items():
        y = x if last[c] is None else [*x[:last[c]], convs[donor[c]][last[donor[c]]]]
        cut = 0
        while cut < min(len(x), len(y)) and x[cut] == y[cut]:
            cut += 1
        for side, turns in (("chosen", x), ("rejected", y)):
            for p, (role, text) in enumerate(turns):
                if p < cut and side == "rejected":
                    continue
                whose = donor[c] if side == "rejected" and p == last[c] else c
                out.append((key[c], c, whose, "prompt" if p < cut else side, p if p < cut else p - cut, p + 1, role,
                            f"<|{role or ''}|>\n{text or ''}\n", p >= cut and role == "assistant"))
    return sorted(out, key=str)


def run_swapped(df):
    return cf.format_samples(cf.with_swapped_reply(cf.positions(df)))


def test_swapped_replies_equal_brute_force(spark):
    hot = [(1000 + c, t, "user" if t % 2 == 0 else "assistant", "same" if t == 1 else f"q{c}")
           for c in range(25) for t in range(2)]
    long = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(2000)]
    for rows in (made_up(), made_up() + hot, long + hot[:8], hot, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]):
        df = spark.createDataFrame(rows, SCHEMA).withColumns({"digest": F.lit("clash"), "branch": F.lit(1)})
        out = run_swapped(df)
        assert sorted((tuple(r) for r in out.collect()), key=str) == swapped_by_hand(rows)
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan
    assert run_swapped(spark.createDataFrame([], SCHEMA)).count() == 0


def test_the_given_table_forms_whole_samples(spark):
    conv = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    out = run_swapped(conv).toPandas()
    replied = {r.conv_id for r in conv.where("role = 'assistant'").select("conv_id").distinct().collect()}
    parts = out.groupby("pair_id").part.agg(set)
    assert len(replied) > 80
    assert all((parts[c] == {"prompt", "chosen", "rejected"}) for c in replied)
    trained = out[out.train].groupby("pair_id").part.agg(set)
    assert all(trained[c] == {"chosen", "rejected"} for c in replied)
    assert (out[(out.part == "rejected") & out.train].conv_id != out[(out.part == "rejected") & out.train].pair_id).all()
    one = out.sort_values("segment")
    for _, g in list(one.groupby(["sample_id", "part"]))[:50]:
        assert list(g.segment) == list(range(len(g)))
