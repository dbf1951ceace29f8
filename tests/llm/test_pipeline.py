import corpus_pipeline as cp
import duckdb
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer

from test_decontaminate import by_hand as contaminated
from test_simhash import classes
from wardstar.llm import pii, queries, simhash, toxicity
from wardstar.session import materialize

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    """What each stage was given and returned."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in cp.STAGES:
        new = materialize(stage(spark, docs, SF), "test-pipeline")
        out.append((docs, new))
        docs = new
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stages_keep_the_columns_of_documents(steps):
    for before, after in steps[:-1]:
        assert after.columns == before.columns


def test_toxicity_stage(spark, steps):
    before, after = steps[0]
    model = toxicity.fit(before, spark.read.parquet(f"{SF}/labels.parquet"))
    score = model.scorer().score
    assert set(rows(after)) == {i for i, r in rows(before).items() if score(r.text) < 0.5}


def test_near_duplicate_stage(steps):
    before, after = map(rows, steps[1])
    prints = {i: simhash.fingerprint(r.text) for i, r in before.items()}
    low = classes(sorted(set(prints.values())), 2)
    least = {}
    for i, p in prints.items():
        least[low[p]] = min(i, least.get(low[p], i))
    assert set(after) == set(least.values())
    assert all(after[i] == before[i] for i in after)


def test_decontamination_stage(spark, steps):
    before, after = map(rows, steps[2])
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(after) == {i for i, r in before.items() if not contaminated(r.text, items, 10)[-1]}
    assert len(after) < len(before)


def test_pii_stage(spark, steps):
    import hashlib
    before, after = map(rows, steps[3])
    key = hashlib.blake2b(queries.pii_key(spark).encode(), digest_size=32).digest()
    for i, r in before.items():
        found = pii.find(r.text, key)
        assert after[i].text == pii.replace(r.text, found)
        assert all(r.text[a:b] not in after[i].text for a, b, _, _ in found)
        assert after[i].n_chars == (len(after[i].text) if found else r.n_chars)
    assert any(after[i].text != r.text for i, r in before.items())


def test_bpe_stage_and_run(spark, steps):
    before, after = map(rows, steps[4])
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert {i: r.ids for i, r in after.items()} == {
        i: lib.encode(r.text, add_special_tokens=False).ids for i, r in before.items()}
    assert {r.doc_id: r.ids for r in cp.run(spark, SF).select("doc_id", "ids").collect()} == {
        i: r.ids for i, r in after.items()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_duckdb(spark, name):
    import oracle_compare as oc
    con = oc.duck(SF)
    assert isinstance(con, duckdb.DuckDBPyConnection)
    assert oc.spark_digest(queries.QUERIES[name](spark, SF)) == oc.duck_digest(con, queries.ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_give_one_row_per_input_row(spark, name):
    source = {"op4_url_filter": "pages", "op8_chat_format": None, "op13_hard_negatives": None}.get(name, "documents")
    if source:
        assert queries.QUERIES[name](spark, SF).count() == spark.read.parquet(f"{SF}/{source}.parquet").count()
