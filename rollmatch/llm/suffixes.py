"""Removal of repeated byte strings: ranks of positions by prefix doubling over all texts.

Every byte of a text that is covered by a string of ``length`` bytes which also starts earlier
(in a document with a smaller id, or earlier in the same one) is removed. Strings are judged on
the input. As in prefix doubling, positions get a rank for their first ``half`` bytes, positions
of a unique rank leave, and the others are ranked anew by the pair of their rank and the rank
``length - half`` bytes further on, which passes the threshold. Spark sorts the pairs.

Ranks are fingerprints of 64 bits (equal strings, equal ranks), so a position's second rank
comes from its text and not from a join by position; a pair has 128 bits. Doubling from single
bytes would sort all positions several times, some tens of times the input. So:

* Round one ranks the smallest half string of every window only: of the ``length - half + 1`` half
  strings that start in a window of ``length`` bytes, the one with the least hash (the leftmost of equal
  ones). Equal windows have equal ones at equal places, so a window whose half string occurs once is
  unique. Consecutive windows with the same half string form a *run*; its text is a fingerprint of all
  the bytes its windows cover. Spark sorts (rank, run text, document). A unique rank leaves; equal runs
  are settled at once, all but those of the first document are repeats.
* Round two ranks all positions of the remaining runs: the first run of each text whose rank
  also has other run texts. Spark sorts their rank pairs; all but the first document's are repeats.
* A last pass puts both lists to each text, adds the repeats inside the text, and cuts.

Skew: tasks keep what they have seen often. A run or pair that an earlier document of the task has too
is settled there, and a rank known to be repeated goes straight to round two, so what many documents share
reaches the sort a few times a task. Long texts are read in pieces of about a million positions (a run
ends there). Lists of a document are bounded by its text.

Rows: a NULL text is empty; texts shorter than ``length`` stay whole. Rows with one id count as one
place in the order: none of them is earlier than another, each has its own repeats removed and those of
smaller ids; a NULL id counts as the largest. Rows that are equal get equal results. Other columns are
not read. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.llm.common import small_batches, written

#: Positions read at a time; the places of a piece fit into the low bits of a key.
_PLACE_BITS = 20
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
_LARGEST = (1 << 63) - 1
#: What tasks remember of strings seen often.
_REMEMBERED = 1 << 16
COMPARE, SETTLED, OPEN = 0, 1, 2


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


class _Sums:
    """Fingerprints of substrings: sums of byte values times powers of an odd number, modulo 2**64."""

    def __init__(self, base: int, size: int):
        self.values = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(base))
        step = base | 1
        self.powers = np.multiply.accumulate(np.full(size, step, np.uint64))
        self.inverse = np.multiply.accumulate(np.full(size + 1, pow(step, -1, 1 << 64), np.uint64))

    def of(self, data: np.ndarray) -> np.ndarray:
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[:len(data)], out=out[1:])
        return out

    def between(self, sums: np.ndarray, start, end) -> np.ndarray:
        """Fingerprints of data[start:end], for arrays of places or slices."""
        return (sums[end] - sums[start]) * self.inverse[start]


def _least(keys: np.ndarray, width: int) -> np.ndarray:
    """The least key of every ``width`` consecutive ones."""
    n, pad = len(keys) - width + 1, -len(keys) % width
    blocks = np.concatenate([keys, np.full(pad, ~np.uint64(0))]).reshape(-1, width)
    left = np.minimum.accumulate(blocks, axis=1).ravel()
    right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(right[:n], left[width - 1:width - 1 + n])


class Parser:
    """Runs and window fingerprints of texts, for windows of ``length`` bytes."""

    def __init__(self, length: int):
        if length < 2:
            raise ValueError("length must be 2 at least")
        self.length, self.half = length, (length + 1) // 2
        self.piece = (1 << _PLACE_BITS) - length
        self.ranks = _Sums(0x9E3779B97F4A7C15, 1 << _PLACE_BITS)
        self.texts = _Sums(0xD1342543DE82EF95, 1 << _PLACE_BITS)

    def _half_ranks(self, data: np.ndarray) -> np.ndarray:
        n = len(data) - self.half + 1
        return _mix(self.ranks.between(self.ranks.of(data), slice(0, n), slice(self.half, self.half + n)))

    def pieces(self, data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first place, bytes) of the pieces; together they hold every window once."""
        for first in range(0, len(data) - self.length + 1, self.piece):
            yield first, data[first:first + self.piece + self.length - 1]

    def runs(self, data: np.ndarray) -> tuple[np.ndarray, ...]:
        """(first window, windows, rank, text) of the runs of a text."""
        found = []
        for first, part in self.pieces(data):
            ranks = self._half_ranks(part)
            places = np.arange(len(ranks), dtype=np.uint64)
            least = _least((ranks & ~_PLACES) | places, self.length - self.half + 1)
            starts = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
            sizes = np.diff(np.append(starts, len(least)))
            sums = self.texts.of(part)
            texts = self.texts.between(sums, starts, starts + sizes - 1 + self.length)
            found.append((starts + first, sizes, ranks[(least[starts] & _PLACES).astype(np.int64)], _mix(texts + sizes.astype(np.uint64))))
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(c) for c in zip(*found))

    def pairs(self, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, rank, rank further on) of all windows of the given runs."""
        out = []
        for first, part in self.pieces(data):
            here = (starts >= first) & (starts < first + self.piece)
            if here.any():
                ranks = self._half_ranks(part)
                at, n = starts[here] - first, sizes[here]
                places = np.repeat(at - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                out.append((places + first, ranks[places], ranks[places + self.length - self.half]))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        return tuple(np.concatenate(c) for c in zip(*out))


def pair_key(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """One number for a rank pair, to find it again inside one text; ``_KEY`` is the same in SQL."""
    return first ^ ((second << np.uint64(1)) | (second >> np.uint64(63)))


_KEY = "a ^ (shiftleft(b, 1) | shiftrightunsigned(b, 63))"


class _Combiner:
    """Settles what a task can: rows (a, b, doc) of which an earlier document of the task has the same (a, b).

    ``by_rank``: a value of ``a`` that many documents of the task have with different b is marked OPEN."""

    def __init__(self, by_rank: bool):
        self.by_rank, self.first, self.known = by_rank, {}, np.zeros(0, np.uint64)

    def __call__(self, a: np.ndarray, b: np.ndarray, doc: np.ndarray):
        order = np.lexsort((doc, b, a))
        a, b, doc = a[order], b[order], doc[order]
        new_a = np.concatenate([[True], a[1:] != a[:-1]])
        new = new_a | np.concatenate([[True], b[1:] != b[:-1]])
        group = np.cumsum(new) - 1
        least = doc[new]
        kind = np.where(doc > least[group], SETTLED, COMPARE)
        # one row of a document for each (a, b)
        again = ~new & np.concatenate([[False], doc[1:] == doc[:-1]])
        sizes, heads = np.bincount(group), np.flatnonzero(new)
        for g in np.flatnonzero(sizes >= 4):
            at = heads[g]
            key = (int(a[at]), int(b[at]))
            earlier = self.first.get(key)
            if earlier is not None and earlier < least[g]:
                kind[at:at + sizes[g]] = SETTLED
            else:
                if len(self.first) >= _REMEMBERED:
                    self.first.clear()
                self.first[key] = int(least[g])
        if self.by_rank:
            known = np.isin(a, self.known) & (kind == COMPARE)
            kind[known] = OPEN
            many = np.bincount(np.cumsum(new_a) - 1, weights=new)
            fresh = np.setdiff1d(a[new_a][many >= 4], self.known, assume_unique=True)
            if len(fresh):
                self.known = np.union1d(self.known if len(self.known) < _REMEMBERED else fresh[:0], fresh)
        keep = ~again
        return kind[keep].astype(np.int32), a[keep], b[keep], doc[keep]


def _rows(kind, a, b, doc) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(doc)], ["kind", "a", "b", "doc"])


_ROWS = "kind int, a long, b long, doc long"
#: Bytes of text whose rows are combined at a time.
_BYTES = 4 << 20


def _combined(batches, parse, by_rank: bool) -> Iterator[pa.RecordBatch]:
    combine, held, size = _Combiner(by_rank), [], 0

    def flush():
        return _rows(*combine(*(np.concatenate(c) for c in zip(*held))))

    for batch in batches:
        for row in zip(*(batch.column(i) for i in range(batch.num_columns))):
            doc, data = row[0].as_py(), np.frombuffer(row[2].as_buffer(), np.uint8)
            a, b = parse(data, *row[3:])
            if len(a):
                held.append((a, b, np.full(len(a), doc, np.int64)))
            size += len(data) + 100
            if size >= _BYTES and held:
                yield flush()
                held, size = [], 0
    if held:
        yield flush()


def _run_rows(length: int):
    def run(batches):
        parser = Parser(length)
        yield from _combined(batches, lambda data: parser.runs(data)[2:], True)
    return run


def _pair_rows(length: int):
    def run(batches):
        parser = Parser(length)

        def parse(data, open_texts):
            starts, sizes, _, texts = parser.runs(data)
            at = np.isin(texts, _numbers(open_texts))
            return parser.pairs(data, starts[at], sizes[at])[1:]

        yield from _combined(batches, parse, False)
    return run


def _numbers(cell: pa.Scalar) -> np.ndarray:
    return np.zeros(0, np.uint64) if not cell.is_valid else cell.values.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def repeats(parser: Parser, data: np.ndarray, settled: np.ndarray, opened: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Which bytes of a text go: runs with a settled text, windows of open runs with a settled pair,
    and windows that stand earlier in the text."""
    gone = np.zeros(len(data) + 1, np.int64)
    starts, sizes, ranks, texts = parser.runs(data)
    whole = np.isin(texts, settled)
    np.add.at(gone, starts[whole], 1)
    np.add.at(gone, starts[whole] + sizes[whole] - 1 + parser.length, -1)
    _, back, count = np.unique(ranks, return_inverse=True, return_counts=True)
    here, opens = count[back] > 1, np.isin(texts, opened)
    look = here | (opens & ~whole)
    if look.any():
        places, first, second = parser.pairs(data, starts[look], sizes[look])
        keys = pair_key(first, second)
        cut = np.ones(len(keys), bool)
        cut[np.unique(keys, return_index=True)[1]] = False  # places ascend
        cut |= np.isin(keys, pairs)
        np.add.at(gone, places[cut], 1)
        np.add.at(gone, places[cut] + parser.length, -1)
    return np.cumsum(gone[:-1]) > 0


def _cut(length: int) -> Column:
    kind = pa.struct([("kept", pa.binary()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])

    def run(batches):
        parser = Parser(length)
        for batch in batches:
            out = []
            for text, settled, opened, pairs in zip(*batch):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                gone = repeats(parser, data, _numbers(settled), _numbers(opened), _numbers(pairs))
                edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]])))
                out.append({"kept": data[~gone].tobytes(), "spans": [{"start": int(s), "end": int(e)} for s, e in edges.reshape(-1, 2)]})
            yield pa.array(out, kind)

    run.__annotations__ = {"batches": Iterator[tuple[pa.Array, pa.Array, pa.Array, pa.Array]], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, "struct<kept:binary,spans:array<struct<start:long,end:long>>>")


def remove_repeats(docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_bytes, kept, spans): the bytes that stay, and the removed runs as byte offsets, end exclusive."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LARGEST)).alias("doc"), F.col(id_col).alias("id"),
                        F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("data"))

    # compared rows meet by their rank, the others are spread by document
    place = F.when(F.col("kind") == COMPARE, F.col("a")).otherwise(F.col("doc")).alias("place")
    nth = F.rank().over(Window.partitionBy("place", "kind", "b").orderBy("doc"))
    same = Window.partitionBy("place", "kind")
    rows = texts.mapInArrow(_run_rows(length), _ROWS).select("kind", "a", "b", "doc", place).repartition("place")
    ranked = rows.withColumn("nth", nth).withColumn("others", F.min("b").over(same) != F.max("b").over(same))
    compared = F.col("kind") == COMPARE
    settled = (F.col("kind") == SETTLED) | compared & (F.col("nth") > 1)
    opened = (F.col("kind") == OPEN) | compared & (F.col("nth") == 1) & F.col("others")
    runs = ranked.select("doc", F.when(settled, F.col("b")).alias("settled"), F.when(opened, F.col("b")).alias("opened"))
    runs = written(runs.filter("settled IS NOT NULL OR opened IS NOT NULL"), "suffix-runs")
    lists = runs.groupBy("doc").agg(F.collect_list("settled").alias("settled"), F.collect_list("opened").alias("opened"))

    # both joins read the texts dealt by document once
    open_texts = texts.join(lists.filter(F.size("opened") > 0).select("doc", "opened"), "doc").select("doc", "id", "data", "opened")
    pairs = open_texts.mapInArrow(_pair_rows(length), _ROWS).select("kind", "a", "b", "doc", place).repartition("place", "b")
    repeated = pairs.withColumn("nth", nth).filter((F.col("kind") == SETTLED) | (F.col("nth") > 1))
    keys = repeated.select("doc", F.expr(_KEY).alias("key")).groupBy("doc").agg(F.collect_list("key").alias("pairs"))

    marked = texts.join(lists, "doc", "left").join(keys, "doc", "left")
    cut = _cut(length)("data", "settled", "opened", "pairs").alias("cut")
    return marked.select(F.col("id").alias(id_col), F.octet_length("data").cast("long").alias("n_bytes"), cut).select(id_col, "n_bytes", "cut.kept", "cut.spans")
