"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side whose row count is known not to exceed this may be broadcast.
BROADCAST_ROWS = 100_000


def build_session(app: str = "tallyguard", master: str | None = None, **conf: str) -> SparkSession:
    """Session for tests and benchmarks; on a cluster pass your own."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every expression doubles the time to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that every executor can reach.

    It lies under ``spark.checkpoint.dir``, which a cluster sets to shared
    storage.  Only a local session may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="tallyguard-")
    return join_path(base, f"{name}-{uuid.uuid4().hex}")


def join_path(base: str, *parts: str) -> str:
    return "/".join([base.rstrip("/"), *parts])


def bounded_broadcast(df: DataFrame, max_rows: int | None) -> DataFrame:
    """Broadcast ``df`` if its row bound is known and small.

    Beyond the bound the join stays an ordinary shuffle join, which AQE splits
    where a key is hot.
    """
    if max_rows is not None and max_rows <= BROADCAST_ROWS:
        return F.broadcast(df)
    return df


def one_row(df: DataFrame) -> DataFrame:
    """Marks the result of a global aggregate for a broadcast; it has one row."""
    return F.broadcast(df)


