"""One query per operator, ``(spark, sf_dir) -> DataFrame``, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tunefold.llm import align, ann, chat, decontam, mainhtml, neardup, packing, quality, spans, surrogates, tokenfile, toxicity, whitening
from tunefold.llm.common import table


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer files lie on this machine and on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bm25_block_max_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return decontam.matches(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_keyed_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replaced(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    rated = table(spark, sf_dir, "labels", "doc_id", "quality", "toxic").withColumn("rating", quality.rating())
    return quality.rate(docs, quality.train(docs, rated))


def op4_max_subsequence_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    return mainhtml.extract(pages, mainhtml.learned(pages))


def op5_nonnegative_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels", "doc_id", "toxic")))


def op6_karmarkar_karp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return packing.pack(docs, tokenizer_path("byte_bpe_50k.json"))


def op7_sentence_span_deduplication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans.deduplicated(table(spark, sf_dir, "documents", "doc_id", "text"))


def op8_arrow_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return tokenfile.token_files(spark, docs, tokenizer_path("word_bpe_49k.json"))


def op9_minhash_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents", "doc_id", "text"), k=3, percent=85)


def op10_kmeans_tree_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def op11_lockstep_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return align.aligned(docs, tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


def op12_offset_aligned_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    return chat.format_chats(rows.unionByName(chat.probe(spark)), tokenizer_path("byte_bpe_50k.json"))


def op13_polarised_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings", "vec_id", "embedding"))


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """The registered queries by name."""
    found = (
        op1_bm25_block_max_decontamination,
        op2_keyed_surrogates,
        op3_ordinal_quality,
        op4_max_subsequence_html,
        op5_nonnegative_pu_toxicity,
        op6_karmarkar_karp_packing,
        op7_sentence_span_deduplication,
        op8_arrow_token_files,
        op9_minhash_near_duplicates,
        op10_kmeans_tree_neighbours,
        op11_lockstep_alignment,
        op12_offset_aligned_chats,
        op13_polarised_whitening,
    )
    return {f.__name__: f for f in found}
