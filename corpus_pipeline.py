"""Training-data pipeline over ``documents``: toxic documents go, one document
of each near-duplicate group stays, secrets are masked, sources are mixed to
target weights, and what is left is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next one's docs. All stages but the
last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fleetlens.llm.bpe_codec import encode_documents
from fleetlens.llm.common import read_table
from fleetlens.llm.jaccard import jaccard_components, keep_one_of_each
from fleetlens.llm.mixing import WEIGHTS, mix_documents, with_domain
from fleetlens.llm.secret_scan import redact_secrets
from fleetlens.llm.toxicity import reject_toxic
from fleetlens.runtime import materialize


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents predicted toxic."""
    return reject_toxic(docs, read_table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by a Jaccard
    similarity of 0.8 or more of their five-word shingles."""
    return keep_one_of_each(docs, jaccard_components(docs, shingle_words=5, percent=80))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with [SECRET] in place of each secret; n_chars follows."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents by domain, language and source weights; four fifths of the
    words, no document more than twice."""
    return mix_documents(with_domain(docs, name="__domain"), ("__domain", "lang", "source"), WEIGHTS).select(*docs.columns)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids, and the hash of the ids decoded back."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_documents(docs, ranks, public_tokenizers.PATTERN, outputs=("ids", "decoded_sha256"), keep=("lang", "source"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secrets),
    ("mixing", mixing),
    ("encoding", encoding),
]

# The first stage learns a classifier, which SQL cannot express; tests compare
# the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}").df
    return docs
