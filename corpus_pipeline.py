"""From raw documents to token ids in five stages, each an operator of ``rollmatch.llm``.

Every stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
in the shared checkpoint folder and read back as the next stage's ``docs``:

1. ``language_id``      documents in no learned language go (no letters, or unlike all samples)
2. ``line_dedup``       later copies of repeated runs of lines are deleted; documents of which nothing is left go
3. ``near_dedup``       of each group of near-duplicates one document stays (shingles of 5 words, similarity 0.8)
4. ``decontamination``  documents that contain a benchmark item go
5. ``bpe``              the texts as token ids, with a digest of what the ids decode to

All but the last return the columns of ``documents``. NULL and empty texts go in stage 1.
Rows with the same id (NULL too) and the same text count as one document: one of them
passes stage 3, which deletes others only as near-duplicates of a document that stays (the
one with the smallest id; NULL ids come last). Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.llm.bpe import encode_documents
from rollmatch.llm.catalog import table, tokenizer_file
from rollmatch.llm.common import written
from rollmatch.llm.decontam import contained_items
from rollmatch.llm.langid import in_learned_language
from rollmatch.llm.linededup import dedup_lines
from rollmatch.llm.neardup import near_duplicates, same_values

#: Names that no input column is expected to have.
_LINES, _GONE, _LEAKS, _KEY = "__lines", "__deleted", "__leaks", "__key"


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return in_learned_language(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cleaned = dedup_lines(docs, counts=(_LINES, _GONE))
    left = cleaned.filter((F.col(_GONE) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.when(F.col(_GONE) > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return left.select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    told = ["__id", "__hash"]
    docs = docs.withColumns({"__id": F.col("doc_id"), "__hash": F.xxhash64("text")})
    # one number for each document (id and text), in the order of the ids, NULL ids last; texts stay where they are
    order = docs.groupBy(told).agg(F.count(F.lit(1)).alias("__rows")).orderBy(F.col("__id").asc_nulls_last(), "__hash")
    keys = written(order.withColumn(_KEY, F.monotonically_increasing_id()), "keys")
    repeated = keys.filter("__rows > 1").select(told)
    if not repeated.isEmpty():
        repeated = written(repeated, "repeated")
        same = same_values(docs, repeated, told)
        docs = written(docs.join(repeated, same, "left_anti").union(docs.join(repeated, same, "left_semi").dropDuplicates(told)), "once")
    keys = keys.drop("__rows")
    found = near_duplicates(docs, id_col=_KEY, shingle_words=5, threshold=0.8, keys=keys)
    gone = written(found.filter("NOT kept").join(keys, _KEY).select(told), "gone")
    return docs.join(gone, same_values(docs, gone, told), "left_anti").drop(*told)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contained_items(docs, table(spark, sf_dir, "benchmark"), as_col=_LEAKS)
    return found.filter(F.size(_LEAKS) == 0).drop(_LEAKS)


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode_documents(docs, tokenizer_file("byte_bpe_50k.json"), decoded=True)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", bpe),
]

#: Near-duplicate components, suffix automata and merges are beyond SQL; the tests hold a brute-force version against run().
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over ``documents``; every stage's result is written and read back."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
