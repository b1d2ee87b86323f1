"""District dimension from a sheet export: skip leading rows, snake_case names, keep three columns."""

from __future__ import annotations

import csv
import re
import unicodedata
from collections.abc import Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

# Symbol words used when cleaning names.
_SYMBOLS = (("%", "_percent_"), ("#", "_number_"))
# The dimension columns used downstream (the id is the second "AUN" column).
DIMENSION_COLUMNS = ("aun_2", "sfa_name", "schl_type")
#: Lines read at least to find the header of a sheet.
HEAD_LINES = 200


def snake_case(name: str) -> str:
    s = unicodedata.normalize("NFKD", name).encode("ascii", "ignore").decode()
    for sym, word in _SYMBOLS:
        s = s.replace(sym, word)
    s = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", s)
    s = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", s)
    s = re.sub(r"[^A-Za-z0-9]+", "_", s).strip("_").lower()
    if not s:
        s = "x"
    if s[0].isdigit():
        s = "x" + s
    return s


def clean_names(names: Sequence[str], max_len: int | None = None) -> list[str]:
    """snake_case names; a repeated name gets ``_2``, ``_3``...; optionally cut to ``max_len``."""
    out, seen = [], {}
    for n in names:
        base = snake_case(n or "")
        k = seen.get(base, 0) + 1
        seen[base] = k
        name = base if k == 1 else f"{base}_{k}"
        out.append(name[:max_len] if max_len else name)
    return out


def rename_clean(df: DataFrame, max_len: int | None = None) -> DataFrame:
    """Column-name cleaning on a frame (metadata only)."""
    return df.toDF(*clean_names(df.columns, max_len))


def _sheet_row(lines: Sequence[Row], n: int, path: str) -> tuple[str, int]:
    """Text of the ``n``-th sheet row (line breaks in it as spaces) and the number of its last line."""
    row, rows = [], 0
    for line in lines:
        row.append(line["value"])
        if sum(part.count('"') for part in row) % 2 == 0:
            if rows == n:
                return " ".join(row), line["_line"]
            row, rows = [], rows + 1
    if row:
        raise ValueError(f"{path}: a quoted cell above the data is not closed within {len(lines)} lines")
    raise ValueError(f"{path}: fewer than {n + 1} lines")


def load_districts(spark: SparkSession, path: str, skip_rows: int = 3, fmt: str = "csv",
                   keep: Sequence[str] = DIMENSION_COLUMNS, id_col: str = "aun_2") -> DataFrame:
    """Dimension with the header on line ``skip_rows + 1``; names cleaned; id as text.

    Lines (blank ones included, as sheet rows) are read as text; only the leading
    ones reach the driver, to name the columns: ``skip_rows + 1`` sheet rows, whose quoted
    cells may hold line breaks (``HEAD_LINES`` lines at most). Data lines are parsed on the
    executors with ``from_csv``.
    """
    if fmt == "parquet":
        df = rename_clean(spark.read.parquet(path))
    else:
        lines = spark.read.text(path).withColumn("_line", F.monotonically_increasing_id())
        head = lines.orderBy("_line").limit(max(skip_rows + 1, HEAD_LINES)).collect()
        header, last = _sheet_row(head, skip_rows, path)
        names = clean_names(next(csv.reader([header])))
        schema = ", ".join(f"`_f{i}` STRING" for i in range(len(names)))
        data = lines.filter((F.col("_line") > F.lit(last)) & (F.trim("value") != ""))
        parsed = data.select(F.from_csv("value", schema, {"quote": '"', "escape": '"'}).alias("_r"))
        df = parsed.select("_r.*").toDF(*names)
    return df.select(*keep).withColumn(id_col, F.col(id_col).cast("string"))
