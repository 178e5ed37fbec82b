"""Session settings and the shared work area."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def build_session(app: str = "tillstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the plans are designed for.

    Adaptive execution coalesces small shuffle partitions and splits skewed join
    partitions.  A cluster session starts shuffles with many partitions and lets them be
    coalesced to the advisory size, so that each fits in memory at any input size; scans
    take larger splits to keep the number of shuffle blocks down.  The zone is UTC
    because the timestamps of the model have none.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        **conf,
    }
    if not (master or "").startswith("local"):
        settings = {
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
            "spark.sql.files.maxPartitionBytes": "512MB",
            **settings,
        }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            settings = {
                "spark.ui.enabled": "false",
                "spark.driver.host": "127.0.0.1",
                "spark.driver.bindAddress": "127.0.0.1",
                **settings,
            }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_area(spark: SparkSession, name: str) -> str:
    """A fresh folder path for stream checkpoints and written intermediate tables.

    It lies in the shared folder the cluster names in spark.checkpoint.dir.  Only a
    local session without that setting gets a temporary folder of this machine.
    """
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tillstream-")
    return f"{base.rstrip('/')}/tillstream/{name}-{uuid.uuid4().hex}"
