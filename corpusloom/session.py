"""Session defaults and the one place that cuts lineage."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def session(master: str | None = None, app: str = "corpusloom", **conf: object) -> SparkSession:
    """A session with the settings the engine is planned for.

    AQE coalesces and splits shuffle partitions at run time, so the static
    number of shuffle partitions is left to the cluster. Values in ``conf`` win.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.showConsoleProgress": "false",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    for key, value in (defaults | {k: str(v) for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget its lineage.

    The folder is the session's ``spark.checkpoint.dir``. Only a session that
    is one process (``local[...]``: tests, a laptop) gets a temporary folder
    where that is unset; on a cluster each machine would have its own, so an
    unset folder is an error there. The files are reliable storage, so a lost
    executor costs nothing, and later reads see exactly the same partitions in
    the same order. ``session`` has them removed once nothing refers to them.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or os.path.join(tempfile.gettempdir(), "corpusloom-checkpoints"))
    return df.checkpoint(eager=True)
