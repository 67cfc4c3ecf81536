"""Registered queries of the document operators, over the whole tables."""

from __future__ import annotations

import public_tokenizers

from tessera.llm import (byte_bpe, conversations, decontamination, embedding_dedup, fingerprint, hard_negatives, katz,
                         language_id, line_dedup, packing, repeats, secret_scan, simhash)
from tessera.llm.common import documents

QUERIES = {}
ORACLE: dict[str, str] = {}


def query(name):
    def add(fn):
        QUERIES[name] = fn
        return fn
    return add


@query("op1_katz_score")
def q_katz_score(spark, sf_dir):
    """Katz backoff score of every text, learned from nine tenths of them."""
    return katz.score_documents(documents(spark, sf_dir))


@query("op2_line_dedup")
def q_line_dedup(spark, sf_dir):
    """Documents without the lines that ten documents or more share."""
    return line_dedup.dedup_digests(documents(spark, sf_dir))


ORACLE["op2_line_dedup"] = line_dedup.ORACLE


@query("op3_fingerprint")
def q_fingerprint(spark, sf_dir):
    """Fingerprints of every document and its edited copy, and their likeness."""
    return fingerprint.fingerprint_documents(documents(spark, sf_dir))


@query("op4_byte_bpe")
def q_byte_bpe(spark, sf_dir):
    """Encode and decode every text; digests of the ids and the decoded bytes."""
    return byte_bpe.encode_documents(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
        public_tokenizers.PATTERN, digest=True)


@query("op5_secret_scan")
def q_secret_scan(spark, sf_dir):
    """Secrets in every text and in the layers encoded in it."""
    return secret_scan.scan_documents(documents(spark, sf_dir))


@query("op6_embedding_dedup")
def q_embedding_dedup(spark, sf_dir):
    """Links and components of the vectors of each label."""
    return embedding_dedup.link_vectors(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


ORACLE["op6_embedding_dedup"] = embedding_dedup.ORACLE


@query("op7_language_id")
def q_language_id(spark, sf_dir):
    """Predicted language of every text, learned from two thirds of the rows."""
    docs = documents(spark, sf_dir)
    model = language_id.blocks(language_id.train(language_id.learned_rows(docs)))
    return language_id.identify(docs, model)


@query("op8_repeats")
def q_repeats(spark, sf_dir):
    """Every text without the bytes of its repeated 400-byte strings."""
    return repeats.remove_repeats(documents(spark, sf_dir)).drop("spans")


@query("op9_simhash")
def q_simhash(spark, sf_dir):
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.simhash_documents(documents(spark, sf_dir))


@query("op10_packing")
def q_packing(spark, sf_dir):
    """All documents packed into windows of 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json"))


@query("op11_conversation_repair")
def q_conversation_repair(spark, sf_dir):
    """Faults and cheapest repair of every damaged conversation."""
    rows = spark.read.parquet(f"{sf_dir.rstrip('/')}/conversations.parquet")
    return conversations.repair_conversations(conversations.damage(rows))


ORACLE["op11_conversation_repair"] = conversations.ORACLE


@query("op12_decontamination")
def q_decontamination(spark, sf_dir):
    """Words of every text that windows of benchmark items cover, and the items."""
    bench = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return decontamination.contamination(documents(spark, sf_dir), bench).drop("longest_match")


ORACLE["op12_decontamination"] = decontamination.ORACLE


@query("op13_hard_negatives")
def q_hard_negatives(spark, sf_dir):
    """Hard negatives of every hundredth vector and each of its positives."""
    return hard_negatives.hard_negatives(spark.read.parquet(f"{sf_dir.rstrip('/')}/embeddings.parquet"))


ORACLE["op13_hard_negatives"] = hard_negatives.ORACLE
