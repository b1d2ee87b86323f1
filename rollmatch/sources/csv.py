"""Roster CSV folders: one scan per folder into the 25-field positional schema.

* Fields bind by position (explicit all-string schema; header names are ignored).
* Quotes are ``"`` with a doubled quote as escape; a backslash is literal; a newline
  inside quotes is data (``multiline``; files are then read whole, one task each).
* The text ``NA`` is missing. Blank fields read as ``''`` (``blank="empty"``, what a
  text column gets) or NULL (``blank="null"``); fields a short row lacks stay NULL.
* Only ``*.csv`` directly in the folder. Spark skips names starting with ``_``;
  such files raise instead of being lost silently.
* ``mode="strict"``: a file whose header or rows do not have exactly 25 fields is an
  error naming all such files. ``mode="lenient"``: longer rows are cut to 25 fields,
  shorter ones padded with NULL, and ``folder_report`` tells which files had such rows,
  no rows, or could not be read.

Every row keeps its batch position, source file name and position (``src_batch``,
``src_file``, ``src_row``), so "first row in batch and file order" stays defined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rollmatch.functions.nulls import count_where
from rollmatch.schema import INTAKE_NAMES, Side, roster_schema

CORRUPT = "_corrupt_record"
SOURCE_BATCH = "src_batch"
SOURCE_FILE = "src_file"
SOURCE_ROW = "src_row"
BAD_WIDTH = "bad_width"
ORDER = (SOURCE_BATCH, SOURCE_FILE, SOURCE_ROW)

# The text read as a missing value.
NA_STRINGS = ("NA",)
def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of the files directly in ``path`` (driver-side listing, names only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile())


def reject_hidden_csv(spark: SparkSession, path: str) -> None:
    hidden = [n for n in list_folder(spark, path) if n.startswith("_") and n.endswith(".csv")]
    if hidden:
        raise ValueError(f"files starting with '_' would be skipped by the scan; rename them: {hidden}")


def _field_count(raw: Column) -> Column:
    """Commas outside double quotes plus one, in time linear in the record: quoted parts go
    first, then whatever follows a quote that never closes."""
    bare = F.substring_index(F.regexp_replace(raw, r'"[^"]*+"', ""), '"', 1)
    return F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1


def reader_options(names: Sequence[str], mode: str, encoding: str, multiline: bool) -> dict:
    return {
        "header": True,
        "enforceSchema": True,
        "quote": '"',
        "escape": '"',
        "multiLine": multiline,
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "encoding": encoding,
        "pathGlobFilter": "*.csv",
        "recursiveFileLookup": False,
        "ignoreCorruptFiles": mode == "lenient",
    }


def normalize(df: DataFrame, names: Sequence[str] = INTAKE_NAMES, blank: str = "empty") -> DataFrame:
    """Parsed CSV rows -> the 25 fields with NA/blank rules + src_file, src_row, bad_width."""
    if blank not in ("empty", "null"):
        raise ValueError("blank must be 'empty' or 'null'")
    width = F.when(F.col(CORRUPT).isNull(), F.lit(len(names))).otherwise(_field_count(F.col(CORRUPT)))
    cols = []
    for i, n in enumerate(names):
        c = F.col(n)
        c = F.when(c.isin(*NA_STRINGS), F.lit(None).cast("string")).otherwise(c)
        if blank == "empty":
            c = F.when(F.col(n).isNull() & (width > i), F.lit("")).otherwise(c)
        cols.append(c.alias(n))
    file_name = F.col(SOURCE_FILE) if SOURCE_FILE in df.columns else F.col("_metadata.file_name")
    return df.select(
        *cols,
        F.lit(0).alias(SOURCE_BATCH),
        file_name.alias(SOURCE_FILE),
        F.monotonically_increasing_id().alias(SOURCE_ROW),
        F.col(CORRUPT).isNotNull().alias(BAD_WIDTH),
    )


def scan_rosters(spark: SparkSession, path: str | Sequence[str], names: Sequence[str] = INTAKE_NAMES,
                 mode: str = "strict", blank: str = "empty", encoding: str = "UTF-8",
                 multiline: bool = True, check: bool = False) -> DataFrame:
    """All ``*.csv`` in the folder(s) as one frame of ``names`` + src_file, src_row, bad_width.

    Lazy; with ``check=True`` and ``mode="strict"`` it scans once to raise on bad widths.
    """
    if mode not in ("strict", "lenient"):
        raise ValueError("mode must be 'strict' or 'lenient'")
    paths = [path] if isinstance(path, str) else list(path)
    for p in paths:
        reject_hidden_csv(spark, p)
    df = (spark.read.schema(roster_schema(names, CORRUPT))
          .options(**reader_options(names, mode, encoding, multiline)).csv(paths))
    out = normalize(df, names, blank)
    if check and mode == "strict":
        raise_on_widths(out, headers(spark, paths, len(names), encoding))
    return out


def headers(spark: SparkSession, path: str | Sequence[str], width: int = len(INTAKE_NAMES), encoding: str = "UTF-8") -> DataFrame:
    """Per file with a first line: ``src_file``, its number of fields, whether that differs from ``width``."""
    paths = [path] if isinstance(path, str) else list(path)
    lines = (spark.read.option("pathGlobFilter", "*.csv").option("encoding", encoding).option("ignoreCorruptFiles", True).text(paths)
             .select(F.col("_metadata.file_name").alias(SOURCE_FILE), F.col("_metadata.file_block_start").alias("_start"), "value",
                     F.monotonically_increasing_id().alias("_row")))
    first = lines.filter("_start = 0").groupBy(SOURCE_FILE).agg(F.min_by("value", "_row").alias("_line"))
    fields = _field_count(F.col("_line"))
    return first.select(SOURCE_FILE, fields.alias("header_fields"), (fields != width).alias("bad_header"))


def row_report(df: DataFrame, side: Side | None = None, first_name: str = "student_first_name") -> DataFrame:
    """Per source file: rows, rows whose field count was not 25, rows without a first name.

    Works on a raw scan and, with ``side``, on a prefixed snapshot. (Reading a data field also
    keeps the query valid on a raw scan, where Spark refuses queries that touch only the
    corrupt-record column.)
    """
    name = side.col if side else lambda c: c
    first = F.col(name(first_name))
    return df.groupBy(F.col(name(SOURCE_FILE)).alias(SOURCE_FILE)).agg(
        F.count(F.lit(1)).alias("rows"),
        count_where(F.col(name(BAD_WIDTH))).alias("bad_width_rows"),
        count_where(first.isNull() | (first == "")).alias("blank_first_name_rows"),
    )


def folder_report(spark: SparkSession, path: str, rows: DataFrame, side: Side | None = None,
                  names: Sequence[str] = INTAKE_NAMES, encoding: str = "UTF-8", first_name: str = "student_first_name") -> DataFrame:
    """Every CSV file of the folder with its header width, the counts of ``row_report`` and a status.

    ``status``: ``unreadable or empty`` (listed, but not even a first line could be read),
    ``wrong width`` (header or rows), ``no rows`` (a header only), else ``ok``.
    """
    listed = [(n,) for n in list_folder(spark, path) if n.endswith(".csv") and not n.startswith((".", "_"))]
    files = spark.createDataFrame(listed, f"{SOURCE_FILE} string")
    out = (files.join(headers(spark, path, len(names), encoding), SOURCE_FILE, "left")
           .join(row_report(rows, side, first_name), SOURCE_FILE, "left"))
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "bad_width_rows", "blank_first_name_rows")]
    out = out.select(SOURCE_FILE, "header_fields", "bad_header", *counts)
    status = (F.when(F.col("header_fields").isNull(), "unreadable or empty")
              .when(F.col("bad_header") | (F.col("bad_width_rows") > 0), "wrong width")
              .when(F.col("rows") == 0, "no rows").otherwise("ok"))
    return out.select(SOURCE_FILE, "header_fields", "rows", "bad_width_rows", "blank_first_name_rows", status.alias("status"))


def raise_on_widths(flagged: DataFrame, head: DataFrame, side: Side | None = None) -> None:
    """Raise naming every file whose header or any row has the wrong number of fields."""
    name = side.col if side else lambda c: c
    probe = F.col(flagged.columns[0])  # a data field, so the check is valid on a raw scan too
    rows = (flagged.filter(F.col(name(BAD_WIDTH))).groupBy(F.col(name(SOURCE_FILE)).alias(SOURCE_FILE))
            .agg(F.count(probe).alias("_n")))
    bad = {r[0] for r in rows.union(head.filter("bad_header").select(SOURCE_FILE, F.lit(0))).collect()}  # file names only
    if bad:
        raise ValueError(f"Column count mismatch in file(s): {sorted(bad)}")


def scan_batches(spark: SparkSession, batches: dict[str, str], **options) -> DataFrame:
    """Several batch folders in one scan, each row labelled with its batch name and position."""
    parts = []
    for i, (name, p) in enumerate(batches.items()):
        parts.append(scan_rosters(spark, p, **options).withColumns({"batch": F.lit(name), SOURCE_BATCH: F.lit(i)}))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def append_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Stack two frames by column name; a column absent from one side is NULL there."""
    return a.unionByName(b, allowMissingColumns=True)
