"""Session helpers: a local session for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "rollmatch", extra: dict | None = None) -> SparkSession:
    """A local session configured the way the tests and the bench expect.

    On a cluster, build the session from the cluster's own configuration instead;
    nothing in the library depends on these settings.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        # generated methods above the JIT's size limit would run interpreted; fall back instead
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir`` (or set on the context)."""
    d = spark.sparkContext.getCheckpointDir()
    if d:
        return d
    return spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; set once, from ``spark.checkpoint.dir`` when given.

    A session on one machine that names none (tests, local runs) gets a temporary folder.
    Anywhere else that is an error: other machines would not see such a folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    target = sc.getConf().get("spark.checkpoint.dir", None)
    if target is None:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        target = tempfile.mkdtemp(prefix="rollmatch-ckpt-", dir=os.environ.get("ROLLMATCH_TMP", "/tmp"))
    sc.setCheckpointDir(target)
    return sc.getCheckpointDir() or target


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
