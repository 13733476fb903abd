"""The named queries: each applies its operator, with production parameters,
to its whole table and returns the full result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlens.llm.bpe_codec import encode_documents
from fleetlens.llm.bpe_count import count_tokens
from fleetlens.llm.common import crc_mod, read_table
from fleetlens.llm.divergence import source_divergence
from fleetlens.llm.html_cut import extract_main_text
from fleetlens.llm.jaccard import jaccard_components
from fleetlens.llm.k2treap import ranked_search
from fleetlens.llm.licenses import scan_licenses
from fleetlens.llm.mixing import LEVELS, WEIGHTS, mix_counts, with_domain
from fleetlens.llm.ppm import score_documents
from fleetlens.llm.quality import quality_verdicts
from fleetlens.llm.secret_scan import scan_secrets
from fleetlens.llm.topk import top_k
from fleetlens.llm.toxicity import score_toxicity

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_verdicts(read_table(spark, sf_dir, "documents")).drop("removed_lines")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    return scores.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op3_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return top_k(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_counts(with_domain(read_table(spark, sf_dir, "documents")), LEVELS, WEIGHTS)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op7_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op8_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read_table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(read_table(spark, sf_dir, "documents")).drop("n_entropy", "base_spans")


def op10_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(
        read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, outputs=("ids_sha256", "decoded_sha256")
    )


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(read_table(spark, sf_dir, "pages"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(read_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_toxicity": op2_toxicity,
    "op3_exact_topk": op3_exact_topk,
    "op4_token_counts": op4_token_counts,
    "op5_source_mixing": op5_source_mixing,
    "op6_license_scan": op6_license_scan,
    "op7_ngram_jaccard": op7_ngram_jaccard,
    "op8_lm_scores": op8_lm_scores,
    "op9_secret_scan": op9_secret_scan,
    "op10_bpe_codec": op10_bpe_codec,
    "op11_html_extraction": op11_html_extraction,
    "op12_ranked_search": op12_ranked_search,
    "op13_source_divergence": op13_source_divergence,
}
