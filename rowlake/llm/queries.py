"""One registered query per operator, over its whole table, with production parameters.

``QUERIES``: name -> (callable(spark, sf_dir), SQL over the same tables or None
where SQL cannot express the method; those are tested against brute force).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from rowlake.llm import bpe, centroids, ctph, decontaminate, lexical, passages, pii, quality, secrets
from rowlake.llm import simhash, suffixes, tokencount, toxicity
from rowlake.llm.common import table


def op1_passages(spark, sf_dir):
    return passages.shared_passages(table(spark, sf_dir, "documents"))


def op2_simhash(spark, sf_dir):
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op3_secrets(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op5_decontaminate(spark, sf_dir):
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_bpe(spark, sf_dir):
    return bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op7_suffix_dedup(spark, sf_dir):
    return suffixes.remove(table(spark, sf_dir, "documents"), keep_text=False).drop("kept")


def op8_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op9_ctph(spark, sf_dir):
    return ctph.compare_with_next(table(spark, sf_dir, "documents"))


def op10_token_counts(spark, sf_dir):
    edited = tokencount.with_own_edits(table(spark, sf_dir, "documents"))
    return tokencount.counts_after_edits(edited, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


def op11_ranked_search(spark, sf_dir):
    return lexical.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_centroids(spark, sf_dir):
    return centroids.report(table(spark, sf_dir, "embeddings"))


def op13_personal_data(spark, sf_dir):
    return pii.report(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_passages": (op1_passages, None),
    "op2_simhash": (op2_simhash, None),
    "op3_secrets": (op3_secrets, secrets.oracle_sql()),
    "op4_quality": (op4_quality, None),
    "op5_decontaminate": (op5_decontaminate, decontaminate.ORACLE_SQL),
    "op6_bpe": (op6_bpe, None),
    "op7_suffix_dedup": (op7_suffix_dedup, suffixes.ORACLE_SQL),
    "op8_toxicity": (op8_toxicity, None),
    "op9_ctph": (op9_ctph, None),
    "op10_token_counts": (op10_token_counts, None),
    "op11_ranked_search": (op11_ranked_search, lexical.ORACLE_SQL),
    "op12_centroids": (op12_centroids, centroids.oracle_sql()),
    "op13_personal_data": (op13_personal_data, None),
}
