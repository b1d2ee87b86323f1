"""Registered queries of the text operators: each applies one operator, with production
parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer file (never copied into this repository)."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.quality import quality_verdicts

    return quality_verdicts(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.tokens import count_tokens

    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


def op3_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.neardup import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"), shingle_words=4, threshold=0.8)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.langid import identify_languages

    return identify_languages(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.pii import BASE_KINDS, find_personal_data, span_list

    found = find_personal_data(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(span_list(base), 256).alias("base_sha256"), span_list(F.col("spans")).alias("spans"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.htmltext import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.linededup import dedup_lines

    cleaned = dedup_lines(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_deleted", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))


def op8_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.bpe import encode_documents

    both = encode_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"), decoded=True)
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.decontam import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.brown import score_texts

    return score_texts(table(spark, sf_dir, "documents"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.suffixes import remove_repeats

    cut = remove_repeats(table(spark, sf_dir, "documents"), length=100)
    removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed")
    return cut.select("doc_id", "n_bytes", removed, F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.merkle import verified_rows

    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    text = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.translate("text", upper, lower)).otherwise(F.col("text"))
    checked = verified_rows(table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], "lang", "doc_id", {"text": text})
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", "verified")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from rollmatch.llm.repair import damaged, repair_conversations

    return repair_conversations(damaged(table(spark, sf_dir, "conversations")), there=F.col("there"))


QUERIES = {f.__name__: f for f in (
    op1_quality_rules, op2_token_counts, op3_minhash_neardup, op4_language_id, op5_personal_data, op6_html_extraction,
    op7_line_dedup, op8_bpe_round_trip, op9_decontamination, op10_lm_scores, op11_suffix_dedup, op12_merkle_manifest, op13_conversation_repair)}
