"""Line dedup by winnowing: later copies of repeated runs of lines are deleted.

A *gram* starts at a line and takes as few lines as hold ``gram_words`` words; a
*window* starts at a line and takes as few as hold ``run_words`` words. Each window
selects the smallest gram hash inside it as its fingerprint (ties: the last), so two
documents that share a run of whole lines of ``run_words`` words or more share a window
and select the same fingerprint: none is missed, and few grams are selected.

1. One pass yields the windows of every text with their fingerprint and content hash.
2. Fingerprints that occur once are dropped (counts are summed map-side).
3. Around each repeated fingerprint its windows are the smallest extensions that reach
   ``run_words``; they are joined by content. The first occurrence of a content, by
   (id, text hash, line), stays; every later one is a repeated run. Adjacent and
   overlapping runs unite, which extends a match as far as it goes both ways (windows
   are taken from every line forwards and from every line backwards).
4. Lines of repeated runs are deleted from the text, the others are kept as they are.

So a line goes exactly if it lies in a run of ``run_words`` words or more that occurs
before, in an earlier document or earlier in its own; the first occurrence of any line
content always stays. Shorter repeats (licence lines, headings) stay.

NULL ids come first in the order. Rows with the same id and text are one document: each
gets the same result. NULL and empty texts have no runs; NULL stays NULL. A single very
long line is one window. Only ranges of lines are shuffled, then texts once by id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text, written


def words_per_line(lines: list[str]) -> list[int]:
    return [len(line.encode("utf-8", "surrogatepass").split()) for line in lines]


def reach(words: list[int], target: int) -> list[int]:
    """For each start line the last line of the shortest run with ``target`` words (-1: none)."""
    out, end, total = [], 0, 0
    for start in range(len(words)):
        while end < len(words) and total < target:
            total += words[end]
            end += 1
        out.append(end - 1 if total >= target else -1)
        total -= words[start]
    return out


class Winnower:
    """Text -> windows (start, end, line of the fingerprint, fingerprint, content hash), from every line
    forwards and backwards."""

    def __init__(self, run_words: int, gram_words: int):
        import xxhash

        self.run, self.gram, self.hash = run_words, min(gram_words, run_words), xxhash.xxh3_64_intdigest

    def windows(self, text: str) -> list[tuple[int, int, int, int, int]]:
        lines = text.split("\n")
        words = words_per_line(lines)
        if sum(words) < self.run:
            return []
        ends = reach(words, self.run)
        spans = {(s, e) for s, e in enumerate(ends) if e >= 0 and words[s]}
        back = reach(words[::-1], self.run)
        last = len(lines) - 1
        spans |= {(last - e, last - s) for s, e in enumerate(back) if e >= 0 and words[last - s]}
        raw = [self.hash(line.encode("utf-8", "surrogatepass")).to_bytes(8, "little") for line in lines]
        gram_end = reach(words, self.gram)
        gram = [self.hash(b"".join(raw[s:e + 1])) if e >= 0 and words[s] else None for s, e in enumerate(gram_end)]
        out = []
        for s, e in sorted(spans):
            inside = [(gram[i], -i) for i in range(s, e + 1) if gram[i] is not None and gram_end[i] <= e]
            fingerprint, line = min(inside)
            out.append((s, e, -line, signed(fingerprint), signed(self.hash(b"".join(raw[s:e + 1]), 1))))
        return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def repeated_runs(docs: DataFrame, run_words: int, gram_words: int) -> DataFrame:
    """docs: id, h (text hash), text -> per (id, h) the ranges of repeated lines as ``runs`` (array of s, e)."""

    def make():
        w = Winnower(run_words, gram_words)
        return lambda t: ([{"s": s, "e": e, "p": p, "f": f, "c": c} for s, e, p, f, c in w.windows(t)],)

    found = per_text(make, "w array<struct<s:int,e:int,p:int,f:long,c:long>>")
    windows = written(docs.select("id", "h", F.explode(found(F.col("text"))["w"]).alias("w")).select("id", "h", "w.*"), "windows")
    # overlapping windows share their fingerprint, so a repeated one is one that stands in two places
    place = F.xxhash64("id", "h", "p")
    often = windows.groupBy("f").agg(F.min(place).alias("lo"), F.max(place).alias("hi")).filter("lo <> hi").select("f")
    met = windows.join(often, "f", "left_semi").drop("f", "p")
    at = F.struct("id", "h", "s")
    first = met.groupBy("c").agg(F.min(at).alias("first"), F.count("s").alias("m")).filter("m > 1").drop("m")
    later = met.join(written(first, "first"), "c").filter(at > F.col("first"))
    return later.groupBy("id", "h").agg(F.collect_set(F.shiftleft(F.col("s").cast("long"), 32) + F.col("e")).alias("runs"))


def without_lines(text: str, runs: list[tuple[int, int]]) -> tuple[str, int, int]:
    lines = text.split("\n")
    gone = set()
    for s, e in runs:
        gone.update(range(s, e + 1))
    return "\n".join(line for i, line in enumerate(lines) if i not in gone), len(lines), len(gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", run_words: int = 50, gram_words: int = 20,
                counts: tuple[str, str] = ("n_lines", "n_deleted")) -> DataFrame:
    """All input columns with the text cleaned, plus the numbers of lines and of deleted lines as the columns
    ``counts`` (input columns of these names are replaced)."""
    import pandas as pd

    columns = [c for c in docs.columns if c not in counts]
    others = F.struct(*[F.col(c) for c in columns if c != text_col] or [F.lit(None).alias("none")])
    keyed = docs.select(others.alias("row"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("h"))
    runs = repeated_runs(keyed.select("id", "h", "text"), run_words, gram_words)
    joined = keyed.join(runs.withColumnsRenamed({"id": "rid", "h": "rh"}), (F.col("id").eqNullSafe(F.col("rid"))) & (F.col("h") == F.col("rh")), "left")

    def clean(texts: pd.Series, runs: pd.Series) -> pd.DataFrame:
        rows = []
        for t, r in zip(texts, runs):
            if t is None or r is None:
                rows.append((t, 0 if t is None else t.count("\n") + 1, 0))
            else:
                rows.append(without_lines(t, [(int(x) >> 32, int(x) & 0xFFFFFFFF) for x in r]))
        return pd.DataFrame(rows, columns=["text", "n_lines", "n_deleted"])

    clean.__annotations__ = {"texts": pd.Series, "runs": pd.Series, "return": pd.DataFrame}
    cleaned = joined.select("row", F.pandas_udf(clean, "text string, n_lines long, n_deleted long")("text", "runs").alias("r"))
    return cleaned.select(*[F.col("r.text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in columns],
                          F.col("r.n_lines").alias(counts[0]), F.col("r.n_deleted").alias(counts[1]))
