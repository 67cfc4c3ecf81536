"""Corpus preparation: documents to packed training windows, stage by stage.

Each stage is (name, function of (spark, docs, sf_dir)); its result is written
as Parquet and reread as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers

from tessera.llm import language_id, line_dedup, packing, secret_scan, simhash
from tessera.llm.common import documents, stage


def identify_language(spark, docs, sf_dir):
    """Documents whose language can be told stay."""
    return language_id.keep_identified(docs)


def dedup_lines(spark, docs, sf_dir):
    """Lines that ten documents or more share go."""
    return line_dedup.drop_common_lines(docs)


def dedup_documents(spark, docs, sf_dir):
    """One document of each near-duplicate group stays."""
    return simhash.keep_one(docs)


def redact_secrets(spark, docs, sf_dir):
    """Every secret found, in any layer, is replaced by a mark."""
    return secret_scan.redact_documents(docs)


def pack(spark, docs, sf_dir):
    """Pieces of the packed windows."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("simhash_dedup", dedup_documents),
    ("secret_scan", redact_secrets),
    ("packing", pack),
]
#: SQL can express neither the classifier nor the layered scan nor the tokenizer.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table."""
    docs = documents(spark, sf_dir)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
