"""Session settings and the shared folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

#: Settings every run relies on; sizes of partitions are left to the cluster.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(app: str = "tessellar", **more: str) -> SparkSession:
    """A session with the settings above; ``more`` overrides them."""
    builder = SparkSession.builder.appName(app)
    for key, value in (SETTINGS | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as ``spark.checkpoint.dir`` names it.

    Only where the setting is absent (single-machine runs and tests) one is made and set.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(named)
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is not set; name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(os.path.join(tempfile.gettempdir(), "tessellar-shared"))
    return spark.sparkContext.getCheckpointDir()
