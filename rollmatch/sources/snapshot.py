"""Parquet snapshots between pipeline steps, kept in the shared checkpoint folder.

The intake writes the cleaned rosters once; every report then reads the snapshot
(column pruning and filter pushdown apply, lineage is cut, and a lost executor
re-reads files instead of recomputing the intake).
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from rollmatch.session import ensure_checkpoint_dir


def snapshot_root(spark: SparkSession) -> str:
    """``<spark checkpoint folder>/snapshots/<application id>``."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/snapshots/{spark.sparkContext.applicationId}"


def snapshot_path(spark: SparkSession, *parts: str) -> str:
    tag = hashlib.sha1("/".join(parts).encode()).hexdigest()[:12]
    return f"{snapshot_root(spark)}/{tag}"


def write_snapshot(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet at ``path`` (in the input's split) and return the frame reading it back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def _previous(path: str) -> str:
    return path.rstrip("/") + "_previous"


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def publish_snapshot(spark: SparkSession, staging: str, path: str) -> DataFrame:
    """Put a complete snapshot written at ``staging`` in the place of ``path`` and read it.

    Only renames, and a complete snapshot stands at every moment: the earlier one is renamed to
    ``<path>_previous``, the new one takes its place, then the earlier one is deleted. A job that
    stops in between leaves the earlier one where ``read_snapshot`` finds it and the next publication keeps
    it until the new one stands. One job publishes a path at a time.
    """
    fs, at = _file_system(spark, path)
    src, dst, old = at(staging), at(path), at(_previous(path))
    if fs.exists(dst):
        if fs.exists(old):
            fs.delete(old, True)
        if not fs.rename(dst, old):
            raise OSError(f"could not move {path} to {_previous(path)}")
    else:
        fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"could not move {staging} to {path}")
    fs.delete(old, True)
    return read_snapshot(spark, path)


def replace_snapshot(df: DataFrame, path: str) -> DataFrame:
    """``df`` written beside ``path`` and published there once it is complete; ``df`` may read the earlier snapshot."""
    staging = path.rstrip("/") + "_staging"
    write_snapshot(df, staging)
    return publish_snapshot(df.sparkSession, staging, path)


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The snapshot published at ``path``; the earlier one where a publication stopped between its renames."""
    fs, at = _file_system(spark, path)
    stopped = not fs.exists(at(path)) and fs.exists(at(_previous(path)))
    return spark.read.parquet(_previous(path) if stopped else path)
