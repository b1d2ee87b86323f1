"""Shared helpers: Python functions over a text column, tables kept in the shared folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from rollmatch.sources.snapshot import snapshot_root


#: Rows that enter or leave a Python worker at a time.
BATCH_ROWS = 500
#: Bytes at which such a batch is closed, whatever its rows.
BATCH_BYTES = 16 << 20
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark) -> None:
    """Hands texts to Python workers in batches of BATCH_ROWS rows or BATCH_BYTES bytes, unless the application chose a size.

    Spark's default of 10,000 rows or 64 MB suits numbers; with whole documents such a batch takes
    tens of MB several times over (in the JVM's buffers and in the worker, for each task). With the
    bound on bytes a batch holds one very long text at most beyond it.
    """
    chosen = spark.sparkContext.getConf()
    if chosen.get(_BATCH, None) is None and spark.conf.get(_BATCH) == "10000":
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if chosen.get(_BYTES, None) is None and spark.conf.get(_BYTES) == "67108864b":
        spark.conf.set(_BYTES, str(BATCH_BYTES))


def per_text(make, schema: str):
    """A struct-valued column function of one text column.

    ``make()`` runs once per task and returns a function from a text (never None) to a
    tuple in the order of ``schema``. Rows come in small Arrow batches, which bound memory.
    """
    small_batches(SparkSession.active())
    struct = T.StructType.fromDDL(schema)
    names, kind = [f.name for f in struct.fields], to_arrow_type(struct)

    def run(batches):
        f = make()
        for texts in batches:
            values = (t.as_py() if t.is_valid else "" for t in texts)  # an empty binary stays one
            yield pa.array([dict(zip(names, f(t))) for t in values], kind)

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(run, schema)


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as Parquet in the shared checkpoint folder and read back.

    Cuts the lineage: a lost executor reads files again instead of computing anew.
    """
    spark = df.sparkSession
    path = f"{snapshot_root(spark)}/{tag}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def parts_for(rows: int, per_part: int = 50_000) -> int:
    """Partitions that ``rows`` narrow rows need. A table coalesced to them keeps its files and tasks in proportion
    to its rows; a single partition is grouped and joined without any exchange."""
    return max(1, -(-rows // per_part))


def most_frequent(counts: DataFrame, word: str, n: str, most: int) -> list[tuple[str, int]]:
    """About the ``most`` words with the largest counts (never many more), largest first, ties by word.

    A histogram of the counts on a logarithmic scale (a few thousand rows however many words there
    are) gives the cut; of the bucket it falls into, a share by hash is taken. So only the words
    that are asked for travel to the driver, not a list from every task.
    """
    bucket = F.floor(F.log(F.col(n)) * 32).alias("b")
    sizes = {r["b"]: r["k"] for r in counts.groupBy(bucket).agg(F.count(F.lit(1)).alias("k")).collect()}
    taken, cut, share = 0, None, 0.0
    for b in sorted(sizes, reverse=True):
        if taken + sizes[b] > most:
            cut, share = b, (most - taken) / sizes[b]
            break
        taken += sizes[b]
    if cut is not None:
        part = F.pmod(F.xxhash64(word), F.lit(1 << 20)) < int(share * (1 << 20))
        counts = counts.filter((bucket > cut) | ((bucket == cut) & part))
    return sorted(((r[word], r[n]) for r in counts.select(word, n).collect()), key=lambda r: (-r[1], r[0]))
