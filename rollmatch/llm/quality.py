"""Quality rules: a threshold table compiled into one projection of built-in functions.

Words are runs of characters other than space and ``\\x09-\\x0D``. Per text the measures
are counts and ratios (length, symbols, stop words, letters in capitals, repeated lines,
repeated three-word windows); ``RULES`` bounds them and becomes one boolean column.
No Python runs on the executors and nothing is shuffled.

NULL and empty texts have no words and fail the base rule. Repeated rows get equal
results; only the id and text columns are read, so other columns may have any name.
A text of n words costs O(n log n) in its own row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The characters that separate words, as a set and as a pattern.
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
SYMBOL = r"[#*$%&|<>]"

#: Frequent function words of English, German, French and Spanish.
STOP_WORDS = (
    "the", "of", "and", "to", "a", "in", "is", "it", "that", "was", "for", "on", "with", "as", "by", "be", "are", "this",
    "der", "die", "das", "und", "zu", "den", "von", "mit", "ist", "ein", "eine", "im", "auf", "für", "nicht", "sich", "dem",
    "le", "la", "les", "de", "des", "du", "et", "un", "une", "est", "que", "qui", "dans", "pour", "par", "pas", "au",
    "el", "los", "las", "del", "y", "se", "una", "con", "no", "su", "lo", "es", "por", "para", "al",
)


@dataclass(frozen=True)
class Rule:
    """Holds if ``low <= measure <= high`` (a bound of None is open), for texts of ``min_words`` words or more."""

    measure: str
    low: float | None = None
    high: float | None = None
    min_words: int = 0


RULES = (
    Rule("symbols_per_word", high=0.10),
    Rule("capital_ratio", high=0.35),
    Rule("mean_word_chars", low=2.0, high=14.0),
    Rule("stop_word_ratio", low=0.01, min_words=100),
    Rule("dup_line_ratio", high=0.40),
    Rule("repeat_ratio", high=0.50),
)


def let(value: Column, body) -> Column:
    """``body(v)`` with ``value`` computed once and bound to ``v``."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE_RUN))


def repeated_window_words(words: Column, width: int = 3) -> Column:
    """How many words stand in a ``width``-word window that occurs twice or more.

    Window hashes decide whether anything can repeat at all (most texts: no); only then
    are the windows themselves sorted and compared, so the count is exact.
    """
    n_windows = F.size(words) - width + 1

    def hashes(h):
        return F.transform(F.sequence(F.lit(0), n_windows - 1), lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(width)]))

    def count(w):
        grams = F.sort_array(F.transform(
            F.sequence(F.lit(0), F.size(w) - width),
            lambda i: F.struct(F.concat_ws(" ", *[F.get(w, i + k) for k in range(width)]).alias("g"), i.alias("i"))))

        def positions(s):
            starts = F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda j: F.when(
                (F.get(s, j)["g"] == F.get(s, j - 1)["g"]) | (F.get(s, j)["g"] == F.get(s, j + 1)["g"]), F.get(s, j)["i"]))
            return F.flatten(F.transform(F.array_compact(starts), lambda i: F.array(*[i + k for k in range(width)])))

        return F.size(F.array_distinct(let(grams, positions)))

    repeats = let(let(F.transform(words, lambda w: F.xxhash64(w)), hashes), lambda x: F.size(F.array_distinct(x)) < F.size(x))
    return F.when(n_windows < 2, F.lit(0)).when(repeats, let(words, count)).otherwise(F.lit(0))


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id column and every measure the rules may name; one row per input row."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    base = docs.select(F.col(id_col), text.alias("_t")).select(
        id_col, "_t", words_of(F.col("_t")).alias("_w"),
        F.filter(F.split("_t", "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("_l"))
    n, t, w, lines = F.col("n_words"), F.col("_t"), F.col("_w"), F.col("_l")
    counted = base.select(
        id_col,
        F.size(w).cast("long").alias("n_words"),
        F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
        F.regexp_count(t, F.lit(SYMBOL)).cast("long").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        repeated_window_words(w).cast("long").alias("n_repeat_words"),
        F.size(lines).cast("long").alias("n_lines"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.length(F.regexp_replace(t, r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
    )
    per_word = lambda c: F.when(n > 0, F.col(c) / n).otherwise(F.lit(0.0))
    return counted.select(
        "*",
        per_word("n_symbols").alias("symbols_per_word"),
        F.when(F.col("word_chars") > 0, F.col("n_capitals") / F.col("word_chars")).otherwise(F.lit(0.0)).alias("capital_ratio"),
        per_word("word_chars").alias("mean_word_chars"),
        per_word("n_stop_words").alias("stop_word_ratio"),
        F.when(F.col("n_lines") > 0, F.col("n_dup_lines") / F.col("n_lines")).otherwise(F.lit(0.0)).alias("dup_line_ratio"),
        per_word("n_repeat_words").alias("repeat_ratio"),
    )


def compile_rules(rules=RULES) -> Column:
    """The threshold table as one boolean column."""
    verdict = F.lit(True)
    for r in rules:
        holds = F.lit(True)
        if r.low is not None:
            holds = holds & (F.col(r.measure) >= r.low)
        if r.high is not None:
            holds = holds & (F.col(r.measure) <= r.high)
        verdict = verdict & (holds | (F.col("n_words") < r.min_words))
    return verdict


def quality_verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES,
                     min_words: int = 50, max_repeat_percent: int = 50) -> DataFrame:
    """Measures plus ``base_failed`` (too few words, or too many in repeated windows) and ``kept``."""
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return (measures(docs, id_col, text_col).withColumn("base_failed", failed)
            .withColumn("kept", ~F.col("base_failed") & compile_rules(rules)))
