"""District dimension handling: checked broadcast and enrichment (left join on the id)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.aun import numeric_aun

# A dimension is broadcast only when it has at most this many rows.
DEFAULT_BROADCAST_ROWS = 200_000


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only after checking the row count (``limit`` stops the scan early).

    Beyond the bound the frame is returned unhinted and Spark plans a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def prepare_dimension(dim: DataFrame, key: str = "aun_2",
                      max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Check the id is unique (a repeated id would multiply rows) and size the broadcast."""
    stats = dim.agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_distinct(key) + F.max(F.col(key).isNull().cast("int"))).alias("ids"),
    ).first()
    if stats["n"] and stats["n"] != stats["ids"]:
        raise ValueError(f"district dimension has repeated {key} values ({stats['n']} rows, {stats['ids']} ids)")
    return F.broadcast(dim) if stats["n"] <= max_rows else dim


def enrich(df: DataFrame, dim: DataFrame, on: str = "AUN", key: str = "aun_2",
           numeric: bool = False) -> DataFrame:
    """Left join the dimension on the plain id (NULL matches NULL); optionally id -> number."""
    out = df.join(dim, df[on].eqNullSafe(dim[key]), "left").drop(dim[key])
    if numeric:
        out = out.withColumn(on, numeric_aun(on))
    return out
