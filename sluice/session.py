"""Session set-up and the shared folder that loops write their state to."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import SparkSession


def build_session(app_name: str = "sluice", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the jobs are tuned for; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # plan-time size guesses do not see rows made by explode, so only sizes
        # measured at run time may turn a join into a broadcast
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "10MB",
        "spark.sql.session.timeZone": "UTC",
        # loop steps leave one checkpoint each; drop a step once nothing refers to it
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    }
    settings.update({name.replace("__", "."): value for name, value in conf.items()})
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use ``spark.checkpoint.dir``; only a local master may fall back to a temporary folder, which goes at the end."""
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current is not None:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="sluice-checkpoint-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
    context.setCheckpointDir(folder)
    return folder


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
