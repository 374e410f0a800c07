"""The operators over their whole tables, one query each, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hazardgrid.llm import best_fit_packing, bpe_codec, chunk_dedup, collocations, embedding_dedup, html_extraction, line_dedup, mixing, quality_knn, ranked_search, simhash_dedup, token_counts, warc
from hazardgrid.llm.common import table


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.best_fit_packing(table(spark, sf_dir, "documents"), tokenizer())


def op4_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.simhash_dedup(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_knn.classify_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.chunk_dedup(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_dedup(table(spark, sf_dir, "documents"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = html_extraction.extract_main_text(table(spark, sf_dir, "pages"))
    return texts.withColumn("n_chars", F.char_length("text").cast("long"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer(), keep=("doc_id",))
    return counts.withColumn("over_limit", F.col("n_tokens") > 2048)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived_pages(table(spark, sf_dir, "pages"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = bpe_codec.bpe_encode(table(spark, sf_dir, "documents"), tokenizer())
    decoded = bpe_codec.bpe_decode(ids, tokenizer())
    return decoded.select("doc_id", bpe_codec.id_count().alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {f.__name__: f for f in (
    op1_embedding_dedup, op2_mixing, op3_best_fit_packing, op4_simhash_dedup, op5_quality, op6_exact_dedup, op7_line_dedup,
    op8_html_extraction, op9_token_counts, op10_warc, op11_ranked_search, op12_collocations, op13_bpe_codec, pipeline,
)}
