"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

_local_base: str | None = None
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "assayline") -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config(_METHOD_LIMIT, "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )


def wide_selects(spark: SparkSession) -> None:
    """The JVM does not compile methods above 8000 bytes of code. Wide cleaning selects
    exceed that when fused into one; with the limit set, Spark then generates them
    in pieces, which runs several times faster. Sessions that were given a limit keep it.
    """
    if spark.conf.get(_METHOD_LIMIT, "65535") == "65535":
        spark.conf.set(_METHOD_LIMIT, "8000")


def scratch(spark: SparkSession, name: str) -> str:
    """New path below the folder every executor can reach.

    The folder is `spark.checkpoint.dir` of the session. Only a local session may
    fall back to a folder of this machine.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        global _local_base
        _local_base = _local_base or tempfile.mkdtemp(prefix="assayline-")
        base = _local_base
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def salt_count(spark: SparkSession) -> int:
    """Number of pieces a hot key is split into: one per shuffle partition."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
