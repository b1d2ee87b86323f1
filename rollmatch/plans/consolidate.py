"""Consolidation of the two user groups into one wide roster per roster kind.

* "DC only" rows come from folders of CSV files: rows without a first name drop,
  the file's district id (taken from the file name, then dashed) becomes ``AUN``
  and the id written in the file is kept as ``AUN_original``.
* "Full User" rows come from the intake snapshots: the first 25 columns are
  relabelled to the consolidated names and ``AUN_original`` copies ``AUN``.

Both are stacked in one layout of 27 columns. Pure projection/union: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollmatch.functions.aun import MEAL_FILE_AUN, aun_from_filename, format_aun, plain_aun
from rollmatch.operators.cleaning import relabel, require, with_label
from rollmatch.schema import CONSOLIDATED_NAMES, INTAKE_NAMES

# The user-group labels.
DC_ONLY = "DC only"
FULL_USER = "Full User"


#: The consolidated columns in order: the 25 fields, the id as written in the file before ``AUN``, the user group.
LAYOUT = tuple(x for c in CONSOLIDATED_NAMES for x in (("AUN_original", c) if c == "AUN" else (c,))) + ("usertype",)


def dc_only(df: DataFrame, pattern: str, file_col: str = "source_file") -> DataFrame:
    """25 consolidated columns + ``file_col`` -> DC-only rows in the layout."""
    out = require(df, ["studentfirstname"]).withColumnRenamed("AUN", "AUN_original")
    out = out.withColumn("AUN", format_aun(aun_from_filename(file_col, pattern)))
    return with_label(out, "usertype", DC_ONLY).select(*LAYOUT)


def full_user(df: DataFrame) -> DataFrame:
    """Snapshot rows (first 25 columns by position) -> Full User rows in the layout."""
    out = relabel(df.select(*df.columns[:len(CONSOLIDATED_NAMES)]), CONSOLIDATED_NAMES)
    return with_label(out, "usertype", FULL_USER).withColumn("AUN_original", F.col("AUN")).select(*LAYOUT)


def consolidate(dc: DataFrame, full: DataFrame) -> DataFrame:
    return dc.unionByName(full)


def consolidate_rosters(s_raw: DataFrame, p_raw: DataFrame) -> DataFrame:
    """Consolidation of a roster pair (25 intake fields): P rows as DC-only files
    named ``x<district id>...``, S rows as Full User snapshot rows."""
    files = p_raw.select(
        *[F.col(n).alias(c) for n, c in zip(INTAKE_NAMES, CONSOLIDATED_NAMES)],
        F.concat(F.lit("x"), plain_aun("aun9_3"), F.lit("_meals.csv")).alias("source_file"),
    )
    return consolidate(dc_only(files, MEAL_FILE_AUN), full_user(s_raw.select(*INTAKE_NAMES)))


def consolidate_folder(spark, dc_folder: str, pattern: str, full_user_rows: DataFrame,
                       encoding: str = "UTF-8") -> DataFrame:
    """The whole consolidation for one roster kind: a folder of DC-only CSV files (read
    leniently under the consolidated names; widths reported, not raised) stacked with
    the Full User intake snapshot rows."""
    from rollmatch.sources.csv import SOURCE_FILE, scan_rosters

    files = scan_rosters(spark, dc_folder, names=CONSOLIDATED_NAMES, mode="lenient", encoding=encoding)
    return consolidate(dc_only(files, pattern, SOURCE_FILE), full_user(full_user_rows))
