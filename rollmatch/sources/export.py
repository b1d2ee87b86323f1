"""Writers: the wide consolidated CSV and one dataset per measure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_csv(df: DataFrame, path: str) -> None:
    """Wide CSV with a header line; NULL is written empty, the empty string as ``""``."""
    df.write.mode("overwrite").option("header", True).csv(path)


def export_measures(measures: dict[str, DataFrame], path: str, fmt: str = "parquet",
                    sort_by: str | None = "AUN") -> dict[str, str]:
    """One folder per measure under ``path``, rows sorted by district id (NULL last) where
    the report has one; returns name -> folder. Reports are one row per district."""
    out = {}
    for name, df in measures.items():
        target = f"{path.rstrip('/')}/{name}"
        if sort_by and sort_by in df.columns:
            df = df.orderBy(F.col(sort_by).asc_nulls_last())
        w = df.write.mode("overwrite").format(fmt)
        if fmt == "csv":
            w = w.option("header", True)
        w.save(target)
        out[name] = target
    return out


def write_named_csv(df: DataFrame, name_col: str, folder: str, file_name: str) -> None:
    """CSV files named after a column: ``file_name`` with ``{name}`` (the value) and ``{k}`` (a running number).

    Rows stay in the tasks that hold them; the driver only renames the part files, one or
    more for each value. NULL is written as ``NA``, white space as it is.
    """
    spark, parts = df.sparkSession, folder.rstrip("/") + "_parts"
    (df.write.mode("overwrite").partitionBy(name_col).option("header", True).option("nullValue", "NA")
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(parts))
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.delete(path(folder), True)
    fs.mkdirs(path(folder))
    for d in fs.listStatus(path(parts)):
        if d.isDirectory():
            name = d.getPath().getName().split("=", 1)[1]
            files = [f.getPath() for f in fs.listStatus(d.getPath()) if f.getPath().getName().startswith("part-")]
            for k, f in enumerate(files):
                fs.rename(f, path(f"{folder}/{file_name.format(name=name, k=k)}"))
    fs.delete(path(parts), True)
