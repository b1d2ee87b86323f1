"""Merkle manifest of a table: digests of rows, trees of digests, and proofs by a recursive query.

A row is a leaf: SHA-256 of its fields, each as byte count, ``:`` and value (``-`` if NULL).
The leaves of a group (a language) ascend by the order column; every ``fanout`` consecutive
nodes become the SHA-256 of their hex digests until one node is left, the group's subroot;
the subroots, by group (NULL first, then by bytes), become the root in the same way.

* Leaves are numbered inside their group without a window over a group: a range sort gives
  each row its place in its partition, and counts per (partition, group) give the shift.
* Levels are built bottom-up, one aggregation each, over groups of at most ``fanout`` nodes.
* The levels are stored as parent-linked rows, one per run of siblings: its children's digests,
  the run above and the place in it. A row is stored once per *block* of ``fanout ** 4`` leaves
  below it, so that the rows of the upper levels, which every proof passes, are no hot keys
  (that many rows meet one row at most); this adds one row per block and level.
* ``climb`` is a recursive query: a step joins every leaf's row with its run, gives the siblings
  of that level and folds the claimed digest into the run's digest. Its rows hold one level
  each; the proof of a leaf is put together from them afterwards, one array entry a level.

Every table of digests lies in as many partitions as its number of rows needs, however many the
session's shuffles have.

Nothing but the numbers of groups and rows, the largest group's size and the root reaches the driver.

Rows: a NULL in the group column is a group, a NULL in the order column comes first. Rows with
equal order ascend by their digest (repeated rows are leaves of their own with equal proofs' parts
in any order). Other columns are not read, whatever their names. An empty table has no rows and
no root (None).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rollmatch.llm.common import parts_for, written

FANOUT = 8
#: Levels whose rows lie inside one block.
BLOCK_LEVELS = 4
_OFFSET_BITS = 33  # of monotonically_increasing_id()


def row_digest(*fields: Column) -> Column:
    """Binary SHA-256 of the fields, each as ``<bytes>:<value>``, or ``-`` if NULL."""
    parts = [F.coalesce(F.concat(F.octet_length(f.cast("string")).cast("string"), F.lit(":"), f.cast("string")), F.lit("-")) for f in fields]
    return F.unhex(F.sha2(F.concat(*parts), 256))


def hex_of(digests: Column) -> Column:
    return F.lower(F.hex(digests))


def _digest_of(children: Column) -> Column:
    """Binary SHA-256 of the hex text of concatenated binary digests."""
    return F.unhex(F.sha2(hex_of(children), 256))


def _height(n: Column, fanout: int) -> Column:
    """Levels above ``n`` nodes until one is left: how many powers of the fanout are below n."""
    powers = []
    while not powers or powers[-1] < 1 << 62:
        powers.append(fanout ** len(powers))
    return sum(((F.lit(p) < n).cast("int") for p in powers[:-1]), F.lit(0))


def _numbered(rows: DataFrame, group: str | None, order: list[Column], tag: str) -> DataFrame:
    """``rows`` written with ``__at``, their place in the order inside their group, from 0."""
    # rows that are equal in all of the order may fall to either side of a cut
    placed = written(rows.orderBy(*([F.col(group).asc_nulls_first()] if group else []), *order, F.monotonically_increasing_id())
                     .withColumn("__id", F.monotonically_increasing_id()), tag)
    part, offset = F.shiftright("__id", _OFFSET_BITS), F.col("__id").bitwiseAND((1 << _OFFSET_BITS) - 1)
    if group is None:  # as many rows as partitions
        counts = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("n"))
        before = F.sum("n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
        shifts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__shift"))
        joined = placed.withColumn("__part", part).join(shifts, "__part")
    else:  # as many rows as partitions and groups
        counts = placed.groupBy(part.alias("__part"), F.col(group).alias("__g")).agg(F.count(F.lit(1)).alias("n"), F.min(offset).alias("least"))
        before = F.sum("n").over(Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
        shifts = counts.select(F.col("__part").alias("__p"), "__g", (F.coalesce(before, F.lit(0)) - F.col("least")).alias("__shift"))
        joined = placed.withColumn("__part", part).join(shifts, (F.col("__part") == F.col("__p")) & F.col(group).eqNullSafe(F.col("__g"))).drop("__p", "__g")
    return joined.withColumn("__at", offset + F.col("__shift")).drop("__part", "__shift", "__id")


def _levels(nodes: DataFrame, n_nodes: int, n_trees: int, top: int, fanout: int, tag: str) -> tuple[list[DataFrame], DataFrame]:
    """``nodes`` (tree, height, idx, hash) -> its runs level by level, and each tree's last node (tree, hash).

    A run has (tree, height, idx, kids): the digests of its children in order.
    """
    runs, ends = [], nodes.filter("height = 0").select("tree", "hash")
    for level in range(1, top + 1):
        kids = F.sort_array(F.collect_list(F.struct("idx", "hash")))
        run = nodes.filter(F.col("height") >= level).groupBy("tree", "height", F.floor(F.col("idx") / fanout).alias("up")).agg(kids.alias("kids"))
        joined = F.aggregate("kids", F.lit(b""), lambda all_, kid: F.concat(all_, kid["hash"]))
        run = run.select("tree", "height", F.col("up").alias("idx"), joined.alias("kids"))
        run = written(run.coalesce(parts_for(n_nodes // fanout ** level + n_trees)), f"{tag}-{level}")
        runs.append(run)
        nodes = run.select("tree", "height", "idx", _digest_of(F.col("kids")).alias("hash"))
        ends = ends.union(nodes.filter(F.col("height") == level).select("tree", "hash"))
    return runs, ends


@dataclass(frozen=True)
class Manifest:
    """``leaves``: the id, group and extra columns with (tree, idx, height, block, hash);
    ``links``: the stored levels; ``subroots``: (tree, subroot); ``root``: hex text or None."""

    leaves: DataFrame
    links: DataFrame
    subroots: DataFrame
    root: str | None
    fanout: int


def build_manifest(rows: DataFrame, group: str, order: str, digest: str, fanout: int = FANOUT) -> Manifest:
    """The trees over ``rows``, whose binary column ``digest`` holds the leaves' digests. Columns with two leading
    underscores and the names of :class:`Manifest` are the module's own: pass only the columns wanted."""
    placed = _numbered(rows, group, [F.col(order).asc_nulls_first(), F.col(digest)], "merkle-leaves")
    sizes = placed.groupBy(group).agg(F.count(F.lit(1)).alias("size"))
    trees = _numbered(sizes, None, [F.col(group).asc_nulls_first()], "merkle-trees").select(
        F.col(group).alias("__group"), F.col("__at").alias("tree"), _height(F.col("size"), fanout).alias("height"), "size")
    trees = written(trees, "merkle-trees")
    highest, n_trees, n_rows = trees.agg(F.max("height"), F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    block = fanout ** BLOCK_LEVELS
    leaves = placed.join(trees, F.col(group).eqNullSafe(F.col("__group"))).select(
        *rows.columns, "tree", "height", F.col("__at").alias("idx"), F.floor(F.col("__at") / block).alias("block"), F.col(digest).alias("hash"))
    leaves = written(leaves.coalesce(parts_for(n_rows)), "merkle-numbered")

    runs, subroots = _levels(leaves.select("tree", "height", "idx", "hash"), n_rows, n_trees, highest or 0, fanout, "merkle-level")
    subroots = written(subroots.select("tree", F.col("hash").alias("subroot")).coalesce(parts_for(n_trees)), "merkle-subroots")
    upper = 0
    while fanout ** upper < n_trees:
        upper += 1
    top_nodes = subroots.select(F.lit(-1).cast("long").alias("tree"), F.lit(upper).alias("height"), F.col("tree").alias("idx"), F.col("subroot").alias("hash"))
    top_runs, top_ends = _levels(top_nodes, n_trees, 1, upper, fanout, "merkle-top")
    last = top_ends.first()

    blocks = trees.select("tree", "height", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 1) / block))).alias("block"))
    links = None
    for level, run in enumerate(runs, 1):
        if level <= BLOCK_LEVELS:
            row = run.withColumn("block", F.floor(F.col("idx") / fanout ** (BLOCK_LEVELS - level)))
        else:
            over = blocks.withColumn("idx", F.floor(F.col("block") / fanout ** (level - BLOCK_LEVELS)))
            row = run.join(over.drop("height"), ["tree", "idx"])
        inside = F.col("height") > level
        row = row.select("tree", "block", F.lit(level).alias("step"), "idx", "kids",
                         F.when(inside, F.floor(F.col("idx") / fanout)).otherwise(F.floor(F.col("tree") / fanout)).alias("up"),
                         F.when(inside, F.col("idx") % fanout).otherwise(F.col("tree") % fanout).cast("int").alias("place"))
        links = row if links is None else links.union(row)
    for level, run in enumerate(top_runs, 1):
        over = blocks.withColumn("idx", F.floor(F.col("tree") / fanout ** level))
        row = over.join(run.select("idx", "kids"), "idx").select(
            "tree", "block", (F.col("height") + level).cast("int").alias("step"), "idx", "kids",
            F.floor(F.col("idx") / fanout).alias("up"), (F.col("idx") % fanout).cast("int").alias("place"))
        links = row if links is None else links.union(row)
    if links is None:  # at most one row in all
        links = leaves.limit(0).select("tree", "block", F.lit(0).alias("step"), "idx", F.col("hash").alias("kids"), F.col("idx").alias("up"), F.lit(0).alias("place"))
    # a seventh of the rows with the default fanout, and one for each block, tree and upper level
    links = links.coalesce(parts_for((n_rows // fanout + n_trees) * 2))
    return Manifest(leaves, written(links, "merkle-links"), subroots, hex_of_bytes(last["hash"]) if last else None, fanout)


def hex_of_bytes(digest: bytes) -> str:
    return bytes(digest).hex()


#: Each step meets a leaf's row with the run above its node; rows without a run above are done.
_CLIMB = """
WITH RECURSIVE climb(tree, idx, block, step, up, place, folded, siblings) AS (
  SELECT tree, idx, block, 0, first_up, first_place, claimed, X'' FROM {leaves}
  UNION ALL
  SELECT tree, idx, block, step, up, place,
         unhex(sha2(lower(hex(concat(substring(kids, 1, 32 * at), folded, substring(kids, 32 * at + 33)))), 256)),
         concat(substring(kids, 1, 32 * at), substring(kids, 32 * at + 33))
  FROM (SELECT c.tree, c.idx, c.block, l.step, l.up, l.place, l.kids, c.place AS at, c.folded
        FROM climb c JOIN {links} l ON l.tree = c.tree AND l.block = c.block AND l.step = c.step + 1 AND l.idx = c.up))
SELECT tree, idx, step, folded, siblings FROM climb LIMIT ALL"""


def climb(manifest: Manifest, claimed: Column) -> DataFrame:
    """(tree, idx, proof, folded) per leaf: ``proof`` is the siblings' digests (binary, concatenated from leaf to
    root), ``folded`` the root that follows from the digest ``claimed`` of the leaf and these siblings."""
    m, f = manifest, manifest.fanout
    inside = F.col("height") > 0
    start = m.leaves.select("tree", "idx", "block", claimed.alias("claimed"),
                            F.floor(F.when(inside, F.col("idx")).otherwise(F.col("tree")) / f).alias("first_up"),
                            (F.when(inside, F.col("idx")).otherwise(F.col("tree")) % f).cast("int").alias("first_place"))
    steps = m.leaves.sparkSession.sql(_CLIMB, leaves=start, links=m.links)
    path = F.sort_array(F.collect_list(F.struct("step", "siblings")))
    ends = steps.groupBy("tree", "idx").agg(F.max_by("folded", "step").alias("folded"), path.alias("path"))
    return ends.select("tree", "idx", F.aggregate("path", F.lit(b""), lambda all_, s: F.concat(all_, s["siblings"])).alias("proof"), "folded")


def verified_rows(docs: DataFrame, fields: list[str], group: str, order: str, tampered: dict[str, Column]) -> DataFrame:
    """Manifest of ``docs`` over ``fields`` and the check of every row, some of whose fields are replaced by ``tampered``.

    Returns (order, leaf, subroot, root, proof, folded_root, verified); digests as hex text, the proof as the siblings' hex text.
    """
    rows = docs.select(F.col(group).alias("__lang"), F.col(order).alias("__order"), row_digest(*(F.col(f) for f in fields)).alias("__digest"),
                       row_digest(*(tampered.get(f, F.col(f)) for f in fields)).alias("__claimed"))
    m = build_manifest(rows, "__lang", "__order", "__digest")
    proofs = climb(m, F.col("__claimed"))
    leaves = m.leaves.select("tree", "idx", "__order", "hash").join(m.subroots, "tree").join(proofs, ["tree", "idx"])
    root, folded = F.lit(m.root), hex_of(F.col("folded"))
    return leaves.select(F.col("__order").alias(order), hex_of(F.col("hash")).alias("leaf"), hex_of(F.col("subroot")).alias("subroot"),
                         root.alias("root"), hex_of(F.col("proof")).alias("proof"), folded.alias("folded_root"), (folded == root).alias("verified"))
