"""Benchmark decontamination by the q-gram lemma and banded alignment.

A text (lower case, white space runs as one space) contains a benchmark item if some
stretch of it is within the item's edit budget: ``edit_rate`` of its length. An item of
m characters and a stretch with at most k edits share at least m - q + 1 - k q of the
item's q-grams, all of them on diagonals (text position less item position) that differ
by at most 2k. So per text

1. the hashes of its q-grams are looked up in the set of all items' q-grams,
2. shared q-grams are counted per item in diagonal bands of width 2 (2k + 1) that
   overlap by half, so each occurrence lies in one band as a whole,
3. bands that meet the bound are regions to verify: by containment, else by a banded
   edit-distance alignment of the item against the region.

Where the budget would make the bound useless, it is lowered so that at least one
q-gram must be shared; items shorter than q count only where they stand verbatim. Items
without a letter or digit match nothing. The place of an item is its least (edits, start)
over all stretches of the text.

Frequent q-grams (blanks to fill in, rulers, phrases that many items share) would pair each
of their positions in the text with each in the items. Three things bound that, all exactly:

* The lemma holds for any chosen positions of an item: at least as many as were chosen less
  k q are shared. An item looks up its rare q-grams, and of the frequent ones (more than
  ``_COMMON`` places in the block) the rarest, as many as its bound still needs.
* No stretch within the budget is longer than the longest item and its edits. So the middle of a
  long periodic run (periods up to ``_PERIODS``) is cut out before the search: every
  stretch that could match still stands there, and no other appears.
* A text is read in overlapping segments of about ``_PAIRS`` pairs, and neighbouring bands
  of an item are verified by one alignment.

The benchmark is the stated query set, taken in blocks of ``block_chars`` characters. One block
is broadcast to a lazy pass over the documents. Of several, each has a pass of its own that writes
its hits by the digest of their text and releases the broadcast; the hits are then joined
to the documents. So a worker and the driver hold one block however large the benchmark is.
With one block documents are not shuffled. NULL and empty texts contain nothing; repeated rows get equal
results. An item without an id is searched for like any other and comes out with a NULL id.
"""

from __future__ import annotations

from functools import reduce
from itertools import chain

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text, written

Q = 10
#: Places in a block up to which a q-gram is looked up for every item that has it.
_COMMON = 32
#: Pairs of a text position and an item position handled at a time.
_PAIRS = 1 << 20
_PERIODS = 16
_HITS = "array<struct<item_id:long,start:long,edits:int>>"
_BASE = np.uint64(0x9E3779B97F4A7C15)


def normalized(text: str) -> str:
    return " ".join(text.lower().split())


def qgrams(text: str, q: int = Q) -> np.ndarray:
    """Hash of the q-gram at each position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = len(codes) - q + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(q):
        h *= _BASE
        h += codes[k:k + n]
    h ^= h >> np.uint64(32)
    return h * _BASE


def edit_budget(m: int, rate: float, q: int = Q) -> int:
    """Edits allowed for an item of m characters; at least one shared q-gram must remain."""
    return max(0, min(int(rate * m), (m - q) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _sampled_periods(codes: np.ndarray, step: int, periods: int) -> list[int]:
    """The periods that short windows ``step`` characters apart have: those of all runs of ``2 step`` and a period's characters."""
    wide = min(32, step)
    points = np.arange(0, len(codes) - wide, step)
    shifted = np.arange(periods + 1)[:, None] + np.arange(wide)[None, :]
    windows = codes[np.minimum(points[:, None, None] + shifted, len(codes) - 1)]
    same = (windows[:, 1:] == windows[:, :1]).all(axis=2).any(axis=0)
    return [int(p) + 1 for p in np.flatnonzero(same)]


def shortened(text: str, stretch: int, periods: int = _PERIODS) -> tuple[str, np.ndarray, np.ndarray]:
    """The text without the middles of periodic runs, with the places of the cuts in it and the characters
    cut before or at each. Stretches of up to ``stretch`` characters stay the same ones."""
    cuts = []
    keep = 2 * (stretch + periods)
    if len(text) > keep + periods:
        codes = _codes(text)
        free = 0  # cuts ascend and do not overlap
        runs = []
        for period in _sampled_periods(codes, keep // 2, periods):
            edge = np.flatnonzero(codes[period:] != codes[:-period])
            starts = np.concatenate([[0], edge + 1])
            ends = np.concatenate([edge + period, [len(codes)]])
            runs += [(int(a), int(b), period) for a, b in zip(starts[ends - starts > keep + period], ends[ends - starts > keep + period])]
        for a, b, period in sorted(runs):
            a = max(a, free)
            if b - a > keep + period:
                gone = (b - a - keep) // period * period
                cuts.append((a + keep // 2, gone))
                free = a + keep // 2 + gone
    if not cuts:
        return text, np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, gone = np.array(cuts, np.int64).T
    total = np.cumsum(gone)
    edges = [0, *(at + gone).tolist()]
    return "".join(text[e:c] for e, c in zip(edges, [*at.tolist(), len(text)])), at - (total - gone), total


def banded_place(item: str, region: str, most: int, slack: int) -> tuple[int, int]:
    """(edits, start) of the stretch of ``region`` nearest to ``item``, the leftmost of equal ones, among those that start within
    the first ``slack`` + ``most`` characters, on the diagonals those starts and ``most`` edits can reach; (most + 1, 0) if farther."""
    a, b = _codes(item), _codes(region)
    width = slack + 3 * most + 1  # diagonals -most .. slack + 2 most of the region
    edit = 1 << 40  # a cell is edits * edit + start, so the least one is the leftmost of the nearest
    far = (most + 1) * edit
    steps = np.arange(width)
    paid = steps * edit
    row = np.where(steps >= most, steps - most, far)  # cell d of row i stands for region position i + d - most
    padded = np.concatenate([np.full(most, 0xFFFFFFFF, np.uint32), b, np.full(width + len(a), 0xFFFFFFFF, np.uint32)])
    for i in range(len(a)):
        other = padded[i:i + width] != a[i]
        up = np.concatenate([row[1:], [far]]) + edit
        row = np.minimum(row + other * edit, up)
        row = np.minimum(np.minimum.accumulate(row - paid) + paid, far)
        if row.min() >= far:
            return most + 1, 0
    ends = len(b) - len(a) + most
    best = int(row[: ends + 1].min()) if ends >= 0 else far
    return (best >> 40, best & (edit - 1)) if best < far else (most + 1, 0)


class Finder:
    """Occurrences of a block of items in a text."""

    def __init__(self, items: list[tuple[int | str, str]], rate: float, q: int = Q):
        self.q, self.items = q, [(k, t) for k, t in ((k, normalized(t)) for k, t in items) if any(c.isalnum() for c in t)]
        self.short = [(k, t) for k, t in self.items if len(t) < q]
        self.long = [(k, t) for k, t in self.items if len(t) >= q]
        self.budget = np.array([edit_budget(len(t), rate, q) for _, t in self.long], np.int64)
        self.band = 2 * self.budget + 1
        #: Characters of the longest stretch within a budget.
        self.stretch = max([len(t) + int(k) for (_, t), k in zip(self.long, self.budget)], default=0)
        grams = [qgrams(t, q) for _, t in self.long]
        if grams:
            h = np.concatenate(grams)
            item = np.concatenate([np.full(len(g), i, np.int64) for i, g in enumerate(grams)])
            offset = np.concatenate([np.arange(len(g), dtype=np.int64) for g in grams])
            _, back, count = np.unique(h, return_inverse=True, return_counts=True)
            places = count[back]
            # the rarest positions of each item come first
            order = np.lexsort((offset, places, item))
            sizes = np.bincount(item)
            nth = np.arange(len(h)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            lost = self.budget * q
            needed = lost + np.maximum(1, (sizes - lost) // 2)
            chosen = order[(places[order] <= _COMMON) | (nth < needed[item[order]])]
            self.bound = np.maximum(1, np.bincount(item[chosen], minlength=len(sizes)) - lost)
            chosen = chosen[np.argsort(h[chosen], kind="stable")]
            self.hash, self.item, self.offset = h[chosen], item[chosen], offset[chosen]
            bits = max(16, min(26, int(np.ceil(np.log2(len(chosen) * 16)))))
            self.shift = np.uint64(64 - bits)
            self.maybe = np.zeros(1 << bits, bool)
            self.maybe[self.hash >> self.shift] = True

    def regions(self, text: str) -> list[tuple[int, int, int]]:
        """(item, lower end of the first band, of the last) of all neighbouring bands that meet their bound."""
        h = qgrams(text, self.q)
        at = np.flatnonzero(self.maybe[h >> self.shift]) if len(h) else np.empty(0, np.int64)
        if not len(at):
            return []
        lo = np.searchsorted(self.hash, h[at], side="left")
        n = np.searchsorted(self.hash, h[at], side="right") - lo
        at, lo, n = at[n > 0], lo[n > 0], n[n > 0]
        if not len(at):
            return []
        pairs, found, first = np.cumsum(n), [], 0
        while True:
            # segments share a whole stretch with the next one
            last = max(int(np.searchsorted(pairs, pairs[first] - n[first] + _PAIRS)), int(np.searchsorted(at, at[first] + 2 * self.stretch)))
            found.append(self._bands(at[first:last], lo[first:last], n[first:last]))
            if last >= len(at):
                break
            first = int(np.searchsorted(at, at[last] - self.stretch))
        keys = np.unique(np.concatenate(found)) if len(found) > 1 else found[0]
        if not len(keys):
            return []
        heads = np.flatnonzero(np.concatenate([[True], np.diff(keys) > 2]))
        tails = np.append(heads[1:], len(keys)) - 1
        which = keys[heads] >> 40
        low, high = ((keys[k] & ((1 << 40) - 1)) - (1 << 32) for k in (heads, tails))
        return [(int(i), int(a * self.band[i]), int(b * self.band[i])) for i, a, b in zip(which, low, high)]

    def _bands(self, at: np.ndarray, lo: np.ndarray, n: np.ndarray) -> np.ndarray:
        """Keys (item and band) of the bands that meet their bound by the q-grams of a segment."""
        entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item = self.item[entry]
        # a q-gram repeated in the item counts once per diagonal
        key = item * (1 << 40) + np.floor_divide(np.repeat(at, n) - self.offset[entry], self.band[item]) + (1 << 32)
        keys, counts = np.unique(key, return_counts=True)
        # band b holds the diagonals of steps b and b + 1, each band wide
        bands, back = np.unique(np.concatenate([keys, keys - 1]), return_inverse=True)
        totals = np.bincount(back, weights=np.concatenate([counts, counts]))
        return bands[totals >= self.bound[bands >> 40]]

    def __call__(self, raw: str) -> list[tuple[int | None, int, int]]:
        """(item id, start in the normalized text, edits) of each contained item, the best place of each; the id of an
        item that goes by its text is None."""
        text, best = normalized(raw), {}
        for k, t in self.short:
            p = f" {text} ".find(f" {t} ")
            if p >= 0:
                best[k] = (0, p)
        places = {}
        if self.long:
            short, at, gone = shortened(text, self.stretch)
            for i, low, high in self.regions(short):
                k, t = self.long[i]
                if places.get(k, (1, 0))[0] == 0:
                    continue
                budget, slack = int(self.budget[i]), high - low + 2 * int(self.band[i])
                start = max(0, low - budget)
                region = short[start:low + slack + len(t) + 2 * budget]
                p = region.find(t)
                edits, p = (0, p) if p >= 0 else banded_place(t, region, budget, slack) if budget else (1, 0)
                if edits <= budget:
                    places[k] = min(places.get(k, (edits, start + p)), (edits, start + p))
            for k, (edits, p) in places.items():
                cut = int(np.searchsorted(at, p, side="right"))
                best[k] = min(best.get(k, (edits + 1, 0)), (edits, p + int(gone[cut - 1]) if cut else p))
        nameless = sorted((p, e) for k, (e, p) in best.items() if isinstance(k, str))
        return [(None, p, e) for p, e in nameless] + sorted((k, p, e) for k, (e, p) in best.items() if not isinstance(k, str))


def item_blocks(benchmark: DataFrame, item_col: str, text_col: str, block_chars: int):
    """The items in blocks of about ``block_chars`` characters; one block is on the driver at a time."""
    items = benchmark.select(F.col(item_col).cast("long").alias("k"), F.col(text_col).alias("t")).filter("t IS NOT NULL")
    total = items.agg(F.sum(F.length("t"))).first()[0] or 0
    n = -(-total // block_chars)
    for b in range(n):
        part = items if n == 1 else items.filter(F.pmod(F.xxhash64("k", "t"), F.lit(n)) == b)
        # an item without an id is told from others by its text
        yield [(r["t"] if r["k"] is None else r["k"], r["t"]) for r in part.collect()]


def contained_items(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text",
                    edit_rate: float = 0.06, block_chars: int = 4_000_000, as_col: str = "leaks") -> DataFrame:
    """All input columns plus ``as_col``: array of struct(item_id, start, edits) of the items in the text."""
    spark, blocks = docs.sparkSession, item_blocks(benchmark, item_col, item_text, block_chars)
    first, second = next(blocks, None), next(blocks, None)
    empty = F.array().cast(_HITS)
    if first is None:
        return docs.withColumn(as_col, empty)
    if second is None:
        return docs.withColumn(as_col, _found(spark.sparkContext.broadcast({"items": first}), edit_rate)(F.col(text_col))["leaks"])
    texts, hits = docs.select(F.sha2(F.col(text_col), 256).alias("_text"), F.col(text_col).alias("_t")), []
    for block in chain([first, second], blocks):
        shared = spark.sparkContext.broadcast({"items": block})
        # posexplode_outer: a filter on the array itself would run the finder twice
        one = texts.select("_text", F.posexplode_outer(_found(shared, edit_rate)(F.col("_t"))["leaks"]).alias("_nth", "_hit"))
        hits.append(written(one.filter("_hit IS NOT NULL"), "leaks").dropDuplicates(["_text", "_nth"]))
        shared.destroy()
    lists = reduce(DataFrame.unionAll, hits).groupBy("_text").agg(F.array_sort(F.collect_list("_hit")).alias("_hits"))
    lists = written(lists, "leaks")
    joined = docs.join(lists, F.sha2(docs[text_col], 256) == lists["_text"], "left")
    value = F.coalesce(lists["_hits"], empty).alias(as_col)
    names = docs.columns if as_col in docs.columns else [*docs.columns, as_col]
    return joined.select(*(value if c == as_col else docs[c] for c in names))


def _found(shared, edit_rate: float):
    """Column function of a text: the items of a broadcast block in it."""
    def make():
        held = shared.value
        if "finder" not in held:
            held["finder"] = Finder(held["items"], edit_rate)
        return lambda t: ([{"item_id": k, "start": p, "edits": e} for k, p, e in held["finder"](t)],)

    return per_text(make, f"leaks {_HITS}")


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per document and contained item: id, item_id, start, edits."""
    only = docs.select(F.col(id_col), F.col(text_col))
    found = contained_items(only, benchmark, text_col, as_col="_leaks", **options)
    # explode_outer: an inner explode would put a filter on the array before it, and run the finder twice
    return found.select(id_col, F.explode_outer("_leaks").alias("l")).filter("l IS NOT NULL").select(id_col, "l.item_id", "l.start", "l.edits")
