"""Batch intake: CSV folder -> prefixed, cleaned rows with both ids -> Parquet snapshot.

One pass over the rows: scan, cleaning and the id filter run as one map-only job that
writes a staging snapshot, in which rows of the wrong width stay even without ids. Strict
mode then checks the width flag there (one column) and the files' headers, raises with
the names of all files at fault, and only after that puts the staging snapshot in the
place of the published one: a failed intake leaves the earlier snapshot untouched.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.aun import valid_aun
from rollmatch.operators.cleaning import prepare_side
from rollmatch.schema import Side
from rollmatch.sources.csv import BAD_WIDTH, SOURCE_BATCH, headers, raise_on_widths, scan_rosters
from rollmatch.sources.snapshot import publish_snapshot, read_snapshot, replace_snapshot, write_snapshot


def intake_batch(spark: SparkSession, folder: str, side: Side, snapshot: str, mode: str = "strict",
                 **scan_options) -> DataFrame:
    """Scan one batch folder, clean, keep rows with both ids, publish ``snapshot``; strict widths raise before."""
    raw = scan_rosters(spark, folder, mode=mode, **scan_options)
    if mode != "strict":
        return replace_snapshot(prepare_side(raw, side), snapshot)
    staging = snapshot.rstrip("/") + "_staging"
    rows = write_snapshot(prepare_side(raw, side, keep_flagged=BAD_WIDTH), staging)
    raise_on_widths(rows, headers(spark, folder, encoding=scan_options.get("encoding", "UTF-8")), side)
    return publish_snapshot(spark, staging, snapshot)


def combine_batches(spark: SparkSession, snapshots: dict[str, str], side: Side, out: str,
                    valid_ids_only: bool = True) -> DataFrame:
    """Stack batch snapshots in the given order (labelled ``batch``, position in ``src_batch``), keep
    well-formed district ids, write ``out``."""
    parts = [read_snapshot(spark, p).withColumns({"batch": F.lit(name), side.col(SOURCE_BATCH): F.lit(i)})
             for i, (name, p) in enumerate(snapshots.items())]
    combined = parts[0]
    for p in parts[1:]:
        combined = combined.unionByName(p, allowMissingColumns=True)
    if valid_ids_only:
        combined = combined.filter(valid_aun(side.col("aun9_3")))
    return replace_snapshot(combined, out)
