"""Language identification by cross-parsing entropy.

From a bounded sample of labelled text per language (``sample_rows`` different texts with
a letter, chosen by their hash; whole if they have ``sample_chars`` characters together,
else the longest ones cut to an equal length that fits, from their first letter on) a
suffix automaton is built. So every language with one labelled text that has a letter is
learned, however long that text is. A text is parsed against each automaton from left to right
into phrases, each the longest match with anything in the sample (a character unknown
to the sample is a phrase of its own); phrases end at word ends. The fewer phrases per
letter, the closer the text is to the language: c phrases over n letters estimate a
cross entropy of c * log2(n) / n bits, so the language with the fewest wins (ties: the
first by name).

Parsing a word gives the same phrases wherever it stands, so workers keep the phrase
counts of words in a cache of bounded size and a text costs one lookup per word.

A text without a letter (NULL and empty texts too) is ``und`` with score 0. The score is
the winner's lead over the second language, as a share of the second's phrases; with
one learned language, or phrases in none but one, it is 1. Without any labelled text
every text is ``und``.
"""

from __future__ import annotations

import re
import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text

UNDETERMINED = "und"
#: Word characters that are numbers but no decimal digits (superscripts, fractions, Roman numerals).
_NUMBERS = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum() and not (c.isalpha() or c.isdecimal()))
_ALPHA = rf"[^\W\d_{_NUMBERS}]"
_WORD = re.compile(rf"{_ALPHA}+")
#: Words together with numbers between or beside them. Much faster than _WORD, which tries every number at every letter;
#: the words of a text are those of its runs.
_RUN = re.compile(r"[^\W\d_]+")
_LAST = re.compile(rf"(?<!{_ALPHA}){_ALPHA}+\Z")
#: The same characters as in _WORD, for Spark.
_LETTER = r"\p{L}"
_BITS = 32


class SuffixAutomaton:
    """All substrings of the added strings; ``phrases`` parses a string into longest matches."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.size, self.last = [-1], [0], 0

    def add(self, text: str) -> None:
        self.last = 0
        for c in text:
            self._extend(c)

    def _new(self, size: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.size.append(size)
        return len(self.size) - 1

    def _split(self, p: int, q: int, c: str) -> int:
        """The state for the longest match of p plus c: q itself, or a shorter copy of it."""
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self._new(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def _extend(self, c: str) -> None:
        p = self.last
        if c in self.next[p]:  # known from an earlier string
            self.last = self._split(p, self.next[p][c], c)
            return
        new = self._new(self.size[p] + 1, 0, {})
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][c], c)
        self.last = new

    def phrases(self, text: str) -> int:
        moves, here, n = self.next, self.next[0], 0
        start = here
        for c in text:
            to = here.get(c)
            if to is None:
                if here is not start:
                    n += 1
                to = start.get(c)
                if to is None:
                    n += 1
                    here = start
                    continue
            here = moves[to]
        return n + (here is not start)


class Parser:
    """Phrase counts of whole texts for every language at once."""

    def __init__(self, samples: dict[str, list[str]], cache_size: int):
        self.languages = sorted(samples)
        self.automata = []
        for name in self.languages:
            a = SuffixAutomaton()
            for word in dict.fromkeys(w for t in samples[name] for run in _RUN.findall(t.lower()) for w in _WORD.findall(run)):
                a.add(f" {word} ")
            self.automata.append(a)
        self.most, self.known = cache_size, _Packed(self.count, cache_size)

    def count(self, run: str) -> int:
        """Letters and phrases of the words of a run: a field of _BITS bits for the letters and one for each language."""
        packed = 0
        for word in _WORD.findall(run):
            padded = f" {word} "
            packed += len(word)
            for k, a in enumerate(self.automata, 1):
                packed += a.phrases(padded) << (_BITS * k)
        return packed

    def letters_and_phrases(self, text: str) -> list[int]:
        # lower case has as many letters: only U+0130 becomes two characters, of which one is a letter
        total = sum(map(self.known.__getitem__, _RUN.findall(text.lower())))
        return [(total >> (_BITS * k)) & ((1 << _BITS) - 1) for k in range(len(self.languages) + 1)]

    def __call__(self, text: str) -> tuple[str, float, int, int]:
        letters, *counts = self.letters_and_phrases(text)
        if not counts or not max(counts):
            return UNDETERMINED, 0.0, 0, letters
        best = min(range(len(counts)), key=counts.__getitem__)
        second = min([c for k, c in enumerate(counts) if k != best], default=None)
        score = 1.0 if not second else (second - counts[best]) / second
        return self.languages[best], score, counts[best], letters


class _Packed(dict):
    def __init__(self, count, most: int):
        super().__init__()
        self.count, self.most = count, most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        n = self.count(word)
        if len(word) <= 64:
            self[word] = n
        return n


def held_out(id_col: str, folds: int = 5) -> Column:
    """True for rows whose crc32 of the id as text is 0 modulo ``folds`` (a NULL id counts as an empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)) == 0


def shares(lengths: list[int], total: int) -> int:
    """The largest length to which texts of these lengths can be cut so that they add up to ``total`` at most (1 at least)."""
    left = total
    for k, n in enumerate(sorted(lengths)):
        if n * (len(lengths) - k) > left:
            return max(1, left // (len(lengths) - k))
        left -= n
    return max(1, total)


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str, folds: int, sample_rows: int,
                    sample_chars: int) -> dict[str, list[str]]:
    """Bounded training text per language, from labelled rows outside the held-out fold."""
    labelled = (docs.filter(F.col(lang_col).isNotNull() & ~held_out(id_col, folds) & F.col(text_col).rlike(_LETTER))
                .select(F.col(lang_col).alias("lang"), F.xxhash64(text_col).alias("h"), F.col(text_col).alias("text")))
    # hashes first (no text in the sort), then the texts of those rows
    chosen = labelled.groupBy("lang", "h").agg(F.max(F.length("text")).alias("n"))
    # ranked within 64 slices of a language before within the language, so no task sees more than its slice
    for keys in (("lang", F.pmod("h", F.lit(64))), ("lang",)):
        rank = F.row_number().over(W.partitionBy(*keys).orderBy("h"))
        chosen = chosen.withColumn("_r", rank).filter(F.col("_r") <= sample_rows).drop("_r")
    ranked: dict[str, dict[int, int]] = {}
    for r in chosen.collect():  # sample_rows for each language at most
        ranked.setdefault(r["lang"], {})[r["h"]] = r["n"]
    if not ranked:
        return {}
    cut = {lang: shares(list(of.values()), sample_chars) for lang, of in ranked.items()}
    wanted = docs.sparkSession.createDataFrame([(lang, h, cut[lang]) for lang, of in ranked.items() for h in of], "lang string, h long, most int")
    # equal texts give equal excerpts: one comes out of each task
    excerpt = F.regexp_replace("text", f"^[^{_LETTER}]++", "").substr(F.lit(1), F.col("most"))
    rows = labelled.join(F.broadcast(wanted), ["lang", "h"]).groupBy("lang", "h").agg(F.max(excerpt).alias("text")).collect()
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r["lang"], r["h"])):
        text = r["text"]
        if ranked[r["lang"]][r["h"]] > len(text) == cut[r["lang"]]:  # the last word may be cut
            whole = _LAST.sub("", text)
            text = whole if _WORD.search(whole) else text
        if _WORD.search(text):
            out.setdefault(r["lang"], []).append(text)
    return out


def language_column(spark, samples: dict[str, list[str]], text: Column, cache_size: int = 150_000) -> Column:
    """Struct of ``lang``, ``score``, ``phrases`` and ``letters`` for a text column."""
    # bounded by sample_chars for each language; workers keep automata and cache with the received value
    shared = spark.sparkContext.broadcast({"samples": samples})

    def make():
        held = shared.value
        if "parser" not in held:
            held["parser"] = Parser(held["samples"], cache_size)
        return held["parser"]

    return per_text(make, "lang string, score double, phrases long, letters long")(text)


def in_learned_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
                        max_phrase_rate: float = 0.9, sample_rows: int = 64, sample_chars: int = 60_000) -> DataFrame:
    """The rows of ``docs`` whose text is in some learned language, unchanged. Rejected are undetermined texts and
    those that fall into more than ``max_phrase_rate`` phrases per letter even in their best language, that is,
    share next to nothing with any sample."""
    samples = labelled_sample(docs, id_col, text_col, lang_col, folds, sample_rows, sample_chars)
    found = language_column(docs.sparkSession, samples, F.col(text_col))
    held = docs.select(F.struct("*").alias("row"), found.alias("found"))
    known = (F.col("found.lang") != UNDETERMINED) & (F.col("found.phrases") <= max_phrase_rate * F.col("found.letters"))
    return held.filter(known).select("row.*")


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5,
                       sample_rows: int = 64, sample_chars: int = 60_000) -> DataFrame:
    """Per row: id, ``held_out``, ``lang_pred``, ``score``."""
    samples = labelled_sample(docs, id_col, text_col, lang_col, folds, sample_rows, sample_chars)
    found = docs.select(F.col(id_col), held_out(id_col, folds).alias("held_out"),
                        language_column(docs.sparkSession, samples, F.col(text_col)).alias("_r"))
    return found.select(id_col, "held_out", F.col("_r.lang").alias("lang_pred"), F.col("_r.score").alias("score"),
                        F.col("_r.phrases").alias("phrases"), F.col("_r.letters").alias("letters"))
