"""Training corpus pipeline: five operators over the documents table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's documents. A stage works
on all that the one before kept; all but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.llm import bpe, decontaminate, pii, simhash, toxicity
from wardstar.llm.common import table
from wardstar.llm.queries import pii_key, tokenizer_path
from wardstar.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator predicts to be toxic go."""
    model = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), max_fit_rows=20_000)
    return toxicity.score_toxicity(docs, model).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.deduplicate(docs, max_bits=2, shingle_words=3)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"), window=10)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data becomes pseudonyms; the length column follows the text."""
    out = pii.pseudonymize(docs, pii_key(spark))
    length = F.when(F.size("pii") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return out.withColumn("n_chars", length).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document that is left."""
    return bpe.encode_bpe(docs, tokenizer_path("word_bpe_49k.json"),
                          keep=["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("bpe", encode),
]

# Learned scores, fingerprints and pseudonyms are beyond SQL; tests/llm holds
# the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
