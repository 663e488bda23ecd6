"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def use_utc(spark: SparkSession) -> SparkSession:
    """All instants are UTC wall-clock times, so the session zone must be UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    sc = spark.sparkContext
    root = spark.conf.get(_CHECKPOINT_KEY, None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise ValueError(f"{_CHECKPOINT_KEY} must name a shared folder")
        root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/tidemark-{uuid.uuid4().hex}/{name}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and continue from the written rows."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session(cores: int = 8) -> SparkSession:
    """A session on this machine, as the tests, the checks and the bench use it."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidemark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", "/tmp/tidemark-warehouse")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
