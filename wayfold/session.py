"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "wayfold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the library expects (UTC clock, ANSI, AQE)."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split a hot key even where the next operator could have reused the join's partitioning
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.ui.enabled": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder: ``spark.checkpoint.dir``.

    Only on a local master, where all tasks share one disk, a fresh local folder stands in for it; elsewhere its
    absence is an error, as each executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured and spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not configured:
        configured = getattr(shared_dir, "_fallback", None)
    if not configured:
        configured = shared_dir._fallback = tempfile.mkdtemp(prefix="wayfold-")
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex}")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike a local one."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def cut_plan(df: DataFrame) -> DataFrame:
    """As :func:`cut_lineage`, and without what the optimizer had inferred of the rows.

    A checkpoint keeps the constraints of its plan.  In loops that join a table with what came of it they multiply from round
    to round, until planning takes all time and memory of the driver; so rounds take this one.
    """
    kept, session = cut_lineage(df), df.sparkSession
    return DataFrame(session._jsparkSession.internalCreateDataFrame(kept._jdf.queryExecution().toRdd(), kept._jdf.schema(), False), session)
