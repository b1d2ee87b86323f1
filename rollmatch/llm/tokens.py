"""Token counts by a two-tier map-side lookup of pre-token lengths.

The model neither merges across the start of a new space run nor rewrites text, so a
text falls into pre-tokens (spaces and what follows up to the next space) whose token
counts add up exactly; ``PreTokens`` checks that property of the vocabulary.

1. One map-only pass keeps, per task, a bounded table of frequent pre-tokens (lossy
   counting: infrequent entries are dropped when the table is full). Only these
   bounded tables are summed, never the pre-tokens themselves.
2. The ``table_size`` most frequent ones form a compact hash table with their exact
   lengths (a few MB at most: ``table_size`` entries of ``max_chars`` characters),
   broadcast to the workers.
3. The counting pass looks each pre-token up there, then in a worker's cache of
   bounded size, and asks the tokenizer only for what neither has.

The tables only save time: every length is what the library returns for that pre-token.
NULL and empty texts have 0 tokens and 0 bytes; a text without a space is one pre-token.
"""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import most_frequent, parts_for, per_text, small_batches, written

SPACE_MARK = "▁"
_PIECE = re.compile(r" *[^ ]+| +$")


class PreTokens:
    """Splits a text into independent pre-tokens; each is given without its first space,
    which the tokenizer adds itself."""

    @staticmethod
    def split(text: str) -> list[str]:
        if SPACE_MARK in text:
            text = text.replace(SPACE_MARK, " ")
        if not text:
            return []
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [m[1:] for m in _PIECE.findall(" " + text)]

    @staticmethod
    def check(processor) -> None:
        """Raises if some piece holds a space after another character (pre-tokens would depend on each other)."""
        for i in range(processor.get_piece_size()):
            if re.search(f"[^{SPACE_MARK}]{SPACE_MARK}", processor.id_to_piece(i)):
                raise ValueError("a piece spans several words; pre-token lengths do not add up for this model")
        if processor.encode("a  b ") != processor.encode("a") + processor.encode(" b") + [processor.piece_to_id(SPACE_MARK)]:
            raise ValueError("the model rewrites spaces; pre-token lengths do not add up for this model")


class Lengths(dict):
    """Pre-token -> number of tokens; what is missing is encoded and kept, up to ``room`` entries."""

    def __init__(self, frequent: dict, processor, room: int):
        super().__init__(frequent)
        self.frequent, self.encode, self.most = frequent, processor.encode, len(frequent) + room

    def __missing__(self, piece: str) -> int:
        if len(self) >= self.most:
            self.clear()
            self.update(self.frequent)
        n = len(self.encode(piece)) if piece else 1  # a single space at the end of a text
        if len(piece) <= 64:
            self[piece] = n
        return n


def frequent_pretokens(docs: DataFrame, text_col: str, table_size: int, per_task: int, max_chars: int) -> list[str]:
    """The ``table_size`` pre-tokens with the largest counts over all texts (counts from bounded per-task tables)."""

    def summarise(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch[text_col]:
                if text:
                    counts.update(PreTokens.split(text))
                    if len(counts) > 16 * per_task:
                        counts = Counter(dict(counts.most_common(8 * per_task)))
        import pandas as pd

        top = [(w, n) for w, n in counts.most_common(per_task) if n > 1 and len(w) <= max_chars]
        yield pd.DataFrame(top, columns=["piece", "n"])

    texts = docs.select(F.col(text_col))
    # a task's table has per_task rows at most; their sum needs no file for each of the session's shuffle partitions
    parts = parts_for(per_task * texts.rdd.getNumPartitions())
    tables = texts.mapInPandas(summarise, "piece string, n long")
    counts = written(tables.groupBy("piece").agg(F.sum("n").alias("n")).coalesce(parts), "pretokens")
    return [w for w, _ in most_frequent(counts, "piece", "n", table_size)]


def count_tokens(docs: DataFrame, model_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 4096,
                 table_size: int = 20_000, per_task: int = 4_096, max_chars: int = 32, cache_size: int = 200_000) -> DataFrame:
    """Per row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit`` (more than ``limit`` tokens)."""
    import sentencepiece

    with open(model_file, "rb") as f:
        model = f.read()
    small_batches(docs.sparkSession)
    processor = sentencepiece.SentencePieceProcessor(model_proto=model)
    PreTokens.check(processor)
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col))
    frequent = frequent_pretokens(docs, text_col, table_size, per_task, max_chars)
    # bounded by the model file and table_size entries of max_chars characters; a worker keeps its
    # cache in the received value, so it lasts from task to task
    shared = docs.sparkSession.sparkContext.broadcast({"model": model, "lengths": {p: len(processor.encode(p)) for p in frequent}})

    def make():
        import sentencepiece

        held = shared.value
        if "cache" not in held:
            held["cache"] = Lengths(held["lengths"], sentencepiece.SentencePieceProcessor(model_proto=held["model"]), cache_size)
        length, split = held["cache"].__getitem__, PreTokens.split
        return lambda text: (sum(map(length, split(text))),)

    counted = docs.select(
        F.col(id_col), F.coalesce(F.octet_length(text_col), F.lit(0)).cast("long").alias("n_bytes"),
        per_text(make, "n_tokens long")(F.col(text_col)).alias("_r"))
    return counted.select(id_col, "n_bytes", F.col("_r.n_tokens").alias("n_tokens"), (F.col("_r.n_tokens") > limit).alias("over_limit"))
