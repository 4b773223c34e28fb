"""A session with the settings that the engine counts on."""

from __future__ import annotations

import functools
import tempfile

from pyspark.sql import SparkSession


def session(name: str = "tallybrook", **settings: str) -> SparkSession:
    """UTC, adaptive execution, dynamic partition overwrite; dots of a setting as double underscores."""
    builder = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where that is unset, a local session (as in tests) gets a temporary one for its lifetime; a cluster must name one that
    the driver and all executors share."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        path = held.get() if held.isDefined() else _own_dir(spark.sparkContext.applicationId, spark.sparkContext.master)
    return path.rstrip("/")


@functools.cache
def _own_dir(application: str, master: str) -> str:
    if not master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"file://{tempfile.mkdtemp(prefix='shared')}"
