"""Near-duplicate documents by MinHash bands, verified through odd sketches and full sets.

A document's set holds its distinct shingles of ``shingle_words`` words (A-Z in lower
case; with fewer words the whole sequence is one shingle; without words it is empty and
linked with nothing), as 64-bit hashes. Two documents are linked if their sets' Jaccard
similarity reaches ``threshold``, and a component is what links connect.

1. One pass computes, per document, ``bands * rows`` MinHash samples, a key per band,
   and an odd sketch: every sample toggles one bit of a parity bitmap, so the population
   count of the XOR of two bitmaps estimates their similarity. Equal sets collapse to
   their smallest document first.
2. In each band, documents with an equal key meet in a bucket. Its member with the
   smallest hash is compared with all others by odd sketch; pairs estimated at
   ``threshold - margin`` or more form families.
3. Where a bucket still holds several families, members of different families are
   compared by odd sketch inside an equi-join whose condition is the estimate, so only
   pairs that unite families come out. Now any two documents of a bucket with such an
   estimate are in one family, whatever the bucket's centre was.
4. Families are verified on the full sets, in blocks of bounded size (every pair of
   blocks of a large family is a group of its own). A group yields a spanning forest of
   its links, never all pairs.
5. The components of those links are the result.

With the defaults (30 bands of 5 rows) two documents of similarity 0.8 share no bucket
with probability 7e-6, and the estimate of such a pair falls 0.2 short with less.

NULL ids: such rows have a NULL component and are kept. Rows with the same id count as
linked. Tables are written to the shared checkpoint folder between the steps.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text, written
from rollmatch.llm.components import components

SKETCH_LONGS = 8
#: Fixed odd multipliers of the word positions in a shingle and of the bit mixing.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xBF58476D1CE4E5B9,
               0x94D049BB133111EB, 0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53)


class Shingler:
    """Text -> sorted distinct 64-bit shingle hashes; hashes of words are kept in a bounded cache."""

    def __init__(self, width: int, cache_size: int = 200_000):
        import xxhash

        self.width, self.most, self.hash, self.known = width, cache_size, xxhash.xxh3_64_intdigest, {}

    def word_hashes(self, text: str) -> np.ndarray:
        words, known, h = text.encode("utf-8", "surrogatepass").lower().split(), self.known, self.hash
        if len(known) > self.most:
            known.clear()
        out = np.empty(len(words), np.uint64)
        for i, w in enumerate(words):
            v = known.get(w)
            if v is None:
                v = h(w)
                if len(w) <= 64:
                    known[w] = v
            out[i] = v
        return out

    def __call__(self, text: str) -> np.ndarray:
        words = self.word_hashes(text)
        width = min(self.width, len(words))
        if not width:
            return words
        n = len(words) - width + 1
        x = np.full(n, width, np.uint64)
        for k in range(width):
            x += words[k:k + n] * np.uint64(MULTIPLIERS[k % 8] + 2 * (k // 8))
        return np.unique(mix(x))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MULTIPLIERS[4])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MULTIPLIERS[5])
    return x ^ (x >> np.uint64(31))


class Signer:
    """Set of shingle hashes -> (set hashes, band keys, odd sketch)."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, k = bands, rows, bands * rows
        seeds = mix(np.arange(1, 2 * k + 1, dtype=np.uint64) * np.uint64(MULTIPLIERS[0]))
        self.xor = (seeds[:k] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.mul = (seeds[k:] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)
        self.lane = np.arange(k, dtype=np.uint64) * np.uint64(MULTIPLIERS[1])

    def __call__(self, shingles: np.ndarray, block: int = 4096):
        high = (shingles >> np.uint64(32)).astype(np.uint32)
        least = None
        for i in range(0, len(high), block):
            now = ((high[None, i:i + block] ^ self.xor) * self.mul).min(axis=1)
            least = now if least is None else np.minimum(least, now)
        lanes = mix(least.astype(np.uint64) * np.uint64(MULTIPLIERS[2]) + self.lane)
        keys = mix(np.bitwise_xor.reduce(mix(lanes).reshape(self.bands, self.rows), axis=1))
        bits = np.bincount((lanes >> np.uint64(55)).astype(np.int64), minlength=64 * SKETCH_LONGS) & 1
        sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
        return keys.view(np.int64).tolist(), sketch.tolist()


def signatures(docs: DataFrame, ids: list[str], text_col: str, width: int, bands: int, rows: int) -> DataFrame:
    """Per row: the columns ``ids``, n_shingles, h1, h2 (hashes of the set), bands (array), s0.. (odd sketch); NULLs for empty sets."""

    def make():
        shingler, signer = Shingler(width), Signer(bands, rows)

        def sign(text: str):
            x = shingler(text)
            if not len(x):
                return 0, None, None, None, None
            keys, sketch = signer(x)
            h1, h2 = (int(np.bitwise_xor.reduce(mix(x + np.uint64(c))).view(np.int64)) for c in MULTIPLIERS[6:8])
            return len(x), h1, h2, keys, sketch

        return sign

    signed = per_text(make, "n long, h1 long, h2 long, bands array<long>, sketch array<long>")
    out = docs.select(*ids, signed(F.col(text_col)).alias("r")).select(*ids, "r.*")
    return out.select(*ids, F.col("n").alias("n_shingles"), "h1", "h2", "bands", *[F.col("sketch")[k].alias(f"s{k}") for k in range(SKETCH_LONGS)])


def distance_bound(samples: int, similarity: float) -> int:
    """Largest XOR population count of odd sketches with an estimate of ``similarity`` or more."""
    n = 64 * SKETCH_LONGS
    return math.floor(n / 2 * (1 - math.exp(-4 * samples * (1 - similarity) / n)))


def sketch_distance(a: str, b: str):
    return sum((F.bit_count(F.col(f"{a}.s{k}").bitwiseXOR(F.col(f"{b}.s{k}"))) for k in range(SKETCH_LONGS)), F.lit(0))


def near_families(nodes: DataFrame, bands: int, rows: int, threshold: float, margin: float) -> DataFrame:
    """(id, family) of all nodes that have a neighbour by band key and odd sketch (steps 2 and 3)."""
    sketches = nodes.select("id", "n_shingles", *[f"s{k}" for k in range(SKETCH_LONGS)])
    met = nodes.select("id", F.posexplode("bands").alias("band", "key"))
    lead = F.min_by("id", F.xxhash64("band", "id")).alias("lead")
    buckets = met.groupBy("band", "key").agg(F.count("id").alias("m"), lead).filter("m > 1").drop("m")
    members = written(met.join(buckets, ["band", "key"]), "members")
    close = ((sketch_distance("a", "b") <= distance_bound(bands * rows, threshold - margin))
             & (F.least("a.n_shingles", "b.n_shingles") >= threshold * F.greatest("a.n_shingles", "b.n_shingles")))
    pairs = written(members.filter("id <> lead").select("id", "lead").distinct(), "pairs")
    stars = (pairs.join(sketches.alias("a"), pairs["id"] == F.col("a.id")).join(sketches.alias("b"), pairs["lead"] == F.col("b.id"))
             .filter(close).select(F.col("a.id").alias("u"), F.col("b.id").alias("v")))
    first = components(stars)
    # buckets that hold several families: compare members across them
    placed = members.join(first, members["id"] == first["node"], "left").select(
        "band", "key", "id", F.coalesce("component", "id").alias("family"))
    mixed = placed.groupBy("band", "key").agg(F.min("family").alias("lo"), F.max("family").alias("hi")).filter("lo <> hi").select("band", "key")
    open_members = written(placed.join(mixed, ["band", "key"]).join(sketches, "id"), "open")
    across = (open_members.alias("a").join(open_members.alias("b"), (F.col("a.band") == F.col("b.band")) & (F.col("a.key") == F.col("b.key"))
              & (F.col("a.family") < F.col("b.family")) & close)
              .select(F.col("a.family").alias("u"), F.col("b.family").alias("v")).distinct())
    second = components(across)
    found = first.select(F.col("node").alias("id"), F.col("component").alias("family"))
    alone = second.join(first, second["node"] == first["node"], "left_anti").select(F.col("node").alias("id"), F.col("node").alias("family"))
    joined = found.union(alone)
    return joined.join(second, joined["family"] == second["node"], "left").select("id", F.coalesce("component", "family").alias("family"))


def verify_block(ids: np.ndarray, side: np.ndarray, sets: list[np.ndarray], threshold: float) -> list[tuple[int, int]]:
    """A spanning forest of the links between the given non-empty sets (with two sides: of links across them)."""
    if len(sets) < 2:
        return []
    sizes = np.array([len(s) for s in sets], np.int64)
    _, flat = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    order = np.argsort(sizes, kind="stable")
    parent = list(range(len(sets)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    links, mark = [], np.zeros(int(flat.max()) + 1, bool)
    two = len(set(side.tolist())) > 1
    by_size = flat[np.concatenate([np.arange(starts[i], starts[i + 1]) for i in order])]
    ends = np.concatenate([[0], np.cumsum(sizes[order])])
    for p, i in enumerate(order):
        own = flat[starts[i]:starts[i + 1]]
        # larger sets that are small enough to reach the threshold
        last = int(np.searchsorted(sizes[order], sizes[i] / threshold + 1e-9, side="right"))
        if last <= p + 1:
            continue
        mark[own] = True
        shared = np.add.reduceat(mark[by_size[ends[p + 1]:ends[last]]], ends[p + 1:last] - ends[p + 1], dtype=np.int64)
        mark[own] = False
        others = order[p + 1:last]
        linked = 100 * shared >= round(100 * threshold) * (sizes[i] + sizes[others] - shared)
        for j in others[linked]:
            if (not two or side[i] != side[j]) and root(i) != root(j):
                parent[root(i)] = root(j)
                links.append((int(ids[i]), int(ids[j])))
    return links


def verified_links(families: DataFrame, with_texts, width: int, threshold: float, block_docs: int, block_shingles: int) -> DataFrame:
    """Links (u, v) within families; families: id, family, n_shingles; ``with_texts`` adds ``text`` to rows with an ``id``."""
    sizes = families.groupBy("family").agg(
        F.greatest(F.ceil(F.count("id") / block_docs), F.ceil(F.sum("n_shingles") / block_shingles)).cast("int").alias("blocks"))
    placed = families.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("id"), "blocks").cast("int"))
    # a block meets every other block of its family once; the only block of a family meets itself
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = met.select("id", "family", F.least("block", "other").alias("b1"), F.greatest("block", "other").alias("b2"), "block")
    rows = with_texts(met)

    def verify(batch: pd.DataFrame) -> pd.DataFrame:
        shingler = Shingler(width)
        sets = [shingler(t) for t in batch["text"]]
        full = [i for i, x in enumerate(sets) if len(x)]
        links = verify_block(batch["id"].to_numpy()[full], batch["block"].to_numpy()[full], [sets[i] for i in full], threshold)
        return pd.DataFrame(links, columns=["u", "v"], dtype="int64")

    return rows.select("id", "text", "block", "family", "b1", "b2").groupBy("family", "b1", "b2").applyInPandas(verify, "u long, v long")


def same_values(a: DataFrame, b: DataFrame, columns: list[str]):
    """Condition of a join on equal ``columns``, NULLs equal."""
    return reduce(lambda x, y: x & y, [a[c].eqNullSafe(b[c]) for c in columns])


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 5, threshold: float = 0.8,
                    bands: int = 30, rows: int = 5, margin: float = 0.2, block_docs: int = 1024,
                    block_shingles: int = 1_000_000, keys: DataFrame | None = None) -> DataFrame:
    """Per row: id, ``n_shingles``, ``component_id`` (smallest id linked, itself included), ``kept`` (is it that one).

    ``keys`` numbers documents that have no ``id_col`` themselves: one row for each document, with ``id_col`` and the
    columns that tell documents apart (NULLs equal, names unlike those of the result). Numbers are joined to signatures
    and to members of families, so the texts of the others are not shuffled for them.
    """
    text = F.col(text_col).cast("string").alias("text")
    if keys is None:
        docs = docs.select(F.col(id_col).cast("long").alias("id"), text)
        signed = written(signatures(docs, ["id"], "text", shingle_words, bands, rows), "signatures")

        def with_texts(met: DataFrame) -> DataFrame:
            return docs.filter("id IS NOT NULL").join(met, "id")
    else:
        own = [c for c in keys.columns if c != id_col]
        keys = keys.select(F.col(id_col).cast("long").alias("id"), *own)
        docs = docs.select(*own, text)
        bare = written(signatures(docs, own, "text", shingle_words, bands, rows), "bare")
        signed = written(bare.join(keys, same_values(bare, keys, own)).select("id", *[bare[c] for c in bare.columns if c not in own]), "signatures")

        def with_texts(met: DataFrame) -> DataFrame:
            members = written(met.join(keys, "id"), "met")
            return docs.join(members, same_values(docs, members, own)).select("text", *met.columns)
    full = signed.filter("n_shingles > 0 AND id IS NOT NULL")
    sets = written(full.groupBy("h1", "h2", "n_shingles").agg(F.min("id").alias("node")), "sets")
    nodes = full.join(sets.select(F.col("node").alias("id"), "h1", "h2", "n_shingles"), ["id", "h1", "h2", "n_shingles"], "left_semi")
    families = written(near_families(nodes, bands, rows, threshold, margin), "families")
    families = families.join(nodes.select("id", "n_shingles").distinct(), "id")
    links = verified_links(families, with_texts, shingle_words, threshold, block_docs, block_shingles)
    found = components(links)
    labels = sets.join(found, sets["node"] == found["node"], "left").select("h1", "h2", "n_shingles", F.coalesce("component", sets["node"]).alias("component"))
    out = signed.select("id", "n_shingles", "h1", "h2").join(written(labels, "labels"), ["h1", "h2", "n_shingles"], "left")
    component = F.when(F.col("n_shingles") > 0, F.when(F.col("id").isNotNull(), F.col("component"))).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("component_id").isNull() | (F.col(id_col) == F.col("component_id")))
