"""From raw documents to tokens: text operators as stages, each over all that the one before it kept.

``STAGES`` are (name, function) pairs; a function takes ``(spark, docs,
sf_dir)`` and returns a frame that is written as Parquet and read again as the
next one's documents. All but the last return the columns of ``documents``.
Nulls, empty texts, repeated rows and empty tables are treated as the operators
say; a stage without rows hands on none.
"""

from __future__ import annotations

import public_tokenizers

from rowlake.llm import bpe, decontaminate, nearcopies, quality, secrets
from rowlake.llm.common import table
from rowlake.workspace import new_folder


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier scores below 0.5 go; it learns from these documents and the labels."""
    return quality.keep_good(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def simhash_near_dedup(spark, docs, sf_dir):
    """Of each group of near copies (five-word shingles, similarity 0.8 or more) the document with the smallest id stays."""
    return nearcopies.keep_one(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents with a window of the benchmark go."""
    return decontaminate.remove_documents(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark, docs, sf_dir):
    """All documents stay; each secret is replaced by a mark."""
    return secrets.redact(docs)


def bpe_encoding(spark, docs, sf_dir):
    """``doc_id, n_tokens, ids`` of every document, and ``decoded_sha256`` of what the ids decode to."""
    return bpe.coded(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_scans),
    ("bpe_encoding", bpe_encoding),
]


def run(spark, sf_dir):
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        folder = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return docs


#: The classifier and the tokenizer are beyond SQL; tests compare with brute force.
ORACLE_SQL = None
