"""The registered queries of the operators, one ``opN_<name>`` each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gapwatch.llm import (
    automaton, divergence, fingerprints, fragments, html, kdtree, langid, mixing, neardup, packing, quality, toxicity, trie, twins,
)


def tokenizer_path() -> str:
    """The public tokenizer file, at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.clean_lines(_documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lost_share")


def kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kdtree.kd_shards(_documents(spark, sf_dir), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(_documents(spark, sf_dir))


def packed_sequences(docs: DataFrame) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), tokens=2048, segments=2048, loss_tokens=2048).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset",
        "segment", "loss_tokens")


def vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_sequences(_documents(spark, sf_dir))


def bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = automaton.encode_and_decode(_documents(spark, sf_dir), tokenizer_path())
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


def _remainder(of: int) -> Column:
    """crc32(doc_id as text) mod ``of``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % of


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    model = langid.fit_languages(docs, _remainder(5) != 0)
    return langid.identify_language(docs.select("doc_id", "text"), model).select(
        "doc_id", (_remainder(5) == 0).alias("held_out"), "lang_pred", "score")


def scored_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All columns of ``docs``, with ``score`` and ``predicted``."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    return toxicity.score_toxicity(docs, toxicity.fit_lexicon(docs, labels, _remainder(3) != 1))


def lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = scored_toxicity(spark, _documents(spark, sf_dir), sf_dir)
    return scored.select("doc_id", (_remainder(3) == 1).alias("held_out"), "score", "predicted")


def feature_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare_with_edited(_documents(spark, sf_dir)).select(
        "doc_id", "n_chars", "edited_sha256", F.lower(F.hex("digest")).alias("fingerprint"),
        F.lower(F.hex("edited_digest")).alias("edited_fingerprint"), "near_edited", "near_next")


def context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score_texts(_documents(spark, sf_dir), _remainder(10) == 0)


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.source_divergence(_documents(spark, sf_dir))


def prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


def ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fragments.similar_groups(_documents(spark, sf_dir))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_vector_packing": vector_packing,
        "op2_context_mixing": context_mixing,
        "op3_html_text": html_text,
        "op4_bpe_automaton": bpe_automaton,
        "op5_language_id": language_id,
        "op6_feature_fingerprints": feature_fingerprints,
        "op7_lexicon_toxicity": lexicon_toxicity,
        "op8_near_duplicates": near_duplicates,
        "op9_line_quality": line_quality,
        "op10_kd_sharding": kd_sharding,
        "op11_source_divergence": source_divergence,
        "op12_prefix_trie": prefix_trie,
        "op13_ngram_join": ngram_join,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict[str, str]:
    """SQL twins; the methods of the other operators can't be written in it and are tested against brute force."""
    return {
        "op8_near_duplicates": twins.near_duplicates(),
        "op11_source_divergence": twins.source_divergence(),
        "op12_prefix_trie": twins.prefix_trie(),
        "op13_ngram_join": twins.ngram_join(),
    }
