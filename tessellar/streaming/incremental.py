"""Runs that take up only what is new."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.operators.xmlmeta import article_id, read_articles


def new_articles(spark: SparkSession, folder: str, out: str, state: str, work: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """Metadata of article files not yet seen, added to ``out``; rows added.

    The files seen are kept in ``state``; a run that is repeated after a failure writes a batch once.
    """
    files = spark.readStream.format("binaryFile").schema("path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY").option("pathGlobFilter", "PPR*.xml").load(folder)
    stem = F.regexp_replace(F.substring_index("path", "/", -1), r"\.[^.]*$", "")
    texts = files.select(article_id(stem).alias("ppr_id"), F.decode("content", "UTF-8").alias("xml"))
    done = (work or (lambda df: read_articles(df, "ppr_id", "xml")))(texts)
    run = done.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    run.awaitTermination()
    return sum(p["numInputRows"] for p in run.recentProgress)
