"""Queries of the training-data operators, for the driver entry.

Each query applies one operator with production parameters to its whole table
and adds the digest columns of its contract. ``ORACLE_SQL`` holds the DuckDB
statement where SQL can express the result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardstar.session import scratch_path

from . import (bpe, chat_format, decontaminate, hard_negatives, merkle, pii, quality_rules, sharding,
               simhash, token_counts, token_files, toxicity, url_filter)
from .common import ascii_lower, table
from .oracles import OP6_SQL, OP8_SQL, OP9_SQL, OP11_SQL, OP13_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def _query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_SQL[name] = sql
        return fn
    return deco


@_query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode_bpe(bpe.encode_bpe(docs, path, keep=["doc_id"], packed=True), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@_query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scores = token_counts.fit_scores(docs, tokenizer_path("piece_bpe_32k.model"), rounds=2)
    return token_counts.count_tokens(docs, scores, keep=["doc_id"])


def pii_key(spark: SparkSession) -> str:
    """A deployment sets its own secret; the fallback is for trials only."""
    return spark.conf.get("spark.wardstar.piiKey", "wardstar-query-key")


@_query("op3_pii")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.pseudonymize(docs, pii_key(spark))
    return out.select("doc_id", "text", "pii", F.size("pii").cast("long").alias("n_pii"))


# Fixed values of the contract.
URL_RULES = [url_filter.Rule("allow", "org/"), url_filter.Rule("block", "example.org/es/"),
             url_filter.Rule("block", "example.org/en/1"), url_filter.Rule("allow", "com/fr/"),
             url_filter.Rule("block", "com/de/")]


@_query("op4_url_filter")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table: urls that a rule decides, 4096 at most."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    labelled = url_filter.apply_rules(pages, URL_RULES).where("rule is not null").select(
        "url", (F.col("rule_verdict") == "block").cast("int").alias("label"))
    classifier = url_filter.fit(labelled, max_fit_rows=4_096)
    return url_filter.judge_urls(pages, URL_RULES, classifier).select(
        "page_id", "host", "path", "rule", "verdict", "block_probability")


@_query("op5_simhash")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"), max_bits=2, shingle_words=3)
    return out.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"),
                      "component_id")


@_query("op6_decontamination", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(
        table(spark, sf_dir, "documents").select("doc_id", "text"),
        table(spark, sf_dir, "benchmark"), window=10, keep=["doc_id"])


@_query("op7_toxicity")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), max_fit_rows=20_000)
    return toxicity.score_toxicity(docs, model, keep=["doc_id"]).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query("op8_chat_format", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation is a chosen side; another one's last reply stands in
    its rejected side."""
    turns = chat_format.positions(table(spark, sf_dir, "conversations"))
    return chat_format.format_samples(chat_format.with_swapped_reply(turns))


@_query("op9_quality_rules", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    led = quality_rules.ledger(docs, keep=["doc_id"])
    return led.select("doc_id", *quality_rules.MEASURES, "failed_bits",
                      (~quality_rules.passes("base-1")).alias("base_failed"),
                      quality_rules.passes("corpus-1").alias("kept"))


@_query("op10_token_files")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = token_files.write_token_files(docs, tokenizer_path("byte_bpe_50k.json"), end_id=0)
    return token_files.read_token_files(spark, folder, docs.schema["doc_id"].dataType,
                                        with_ids=False)


@_query("op11_merkle_manifest", OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every third row, by the checksum of its id, claims a text in lower case."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.leaf_digest(*head, F.col("text"))
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    claim = F.when(tampered, merkle.leaf_digest(*head, ascii_lower(F.col("text")))).otherwise(leaf)
    manifest = merkle.build_manifest(docs, leaf, "lang", "doc_id",
                                     carry=[F.col("doc_id"), claim.alias("claim")])
    return merkle.audit(manifest, F.col("row.claim")).select(
        "row.doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("witness")).alias("proof_sha256"),
        "folded_root", "verified")


@_query("op12_sharding")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole documents are written into shards; sizes and checksums are those of
    the texts that the shards hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.shard_by_bytes(docs, n_shards=16, tolerance=0.01, folder=scratch_path(spark, "shards"))
    return out.select("doc_id", *sharding.measures(F.col("text")), F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@_query("op13_hard_negatives", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every seventh row is given the next label."""
    vec_id, label = F.col("vec_id"), F.col("label")
    rows = table(spark, sf_dir, "embeddings").withColumn(
        "label", F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label))
    return hard_negatives.mine_hard_negatives(rows, vec_id % 100 == 0, n_positives=5, n_negatives=10,
                                              low_percent=30, high_percent=90, scale=256)
