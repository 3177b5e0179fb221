"""Files as tables: article corpora, sidecars, JSON Lines, CSV and Parquet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.functions.text import unix_newlines
from tessellar.operators.split import non_empty
from tessellar.operators.xmlmeta import article_id


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def _documents(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)


def read_xml(spark: SparkSession, folder: str, glob: str = "PPR*.xml", required: bool = True) -> DataFrame:
    """``path``, ``stem``, ``ppr_id``, ``xml`` of each article file in a folder, not of folders in it.

    Texts must be UTF-8; line ends are unified.  A folder without such files raises, unless not ``required``.
    """
    files = _documents(spark, folder, glob)
    if required:
        non_empty(files.select("path"), f"{glob} in {folder}")
    stem = F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "")
    return files.select("path", stem.alias("stem"), article_id(stem).alias("ppr_id"), unix_newlines(F.decode("content", "UTF-8")).alias("xml"))


def read_binary(spark: SparkSession, folder: str, glob: str = "PPR*.pdf", name: str = "pdf") -> DataFrame:
    """``ppr_id`` and the bytes of each file."""
    stem = F.regexp_replace(file_name(F.col("path")), r"\.[^.]*$", "")
    return _documents(spark, folder, glob).select(article_id(stem).alias("ppr_id"), F.col("content").alias(name))


def existing(spark: SparkSession, folder: str) -> DataFrame:
    """``number``, ``has_xml``, ``has_pdf`` of the outputs in a folder, from its listing alone."""
    names = _documents(spark, folder, "PPR*").select(file_name(F.col("path")).alias("name"))
    number = F.regexp_extract("name", r"^PPR(\d+)\.(?:xml|pdf)$", 1).try_cast("bigint")
    kinds = names.select(number.alias("number"), F.col("name").endswith(".xml").alias("x"), F.col("name").endswith(".pdf").alias("p")).where("number IS NOT NULL")
    return kinds.groupBy("number").agg(F.max("x").alias("has_xml"), F.max("p").alias("has_pdf"))


def read_sidecars(spark: SparkSession, folder: str) -> DataFrame:
    """``ppr_id`` and the five provenance fields of each sidecar, null where absent; malformed JSON raises."""
    files = _documents(spark, folder, "PPR*.provenance.json")
    stem = F.regexp_replace(file_name(F.col("path")), r"\.provenance\.json$", "")
    got = F.from_json(F.decode("content", "UTF-8"), schemas.PROVENANCE, {"mode": "FAILFAST"})
    return files.select(article_id(stem).alias("ppr_id"), got.alias("p")).select("ppr_id", "p.*")


def read_jsonl(spark: SparkSession, path: str, ddl: str = schemas.METADATA) -> DataFrame:
    """One row a line; blank lines are skipped, malformed ones raise."""
    return spark.read.schema(ddl).option("mode", "FAILFAST").json(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a CSV file with a header, all text."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def union_all(frames: list[DataFrame]) -> DataFrame:
    """All rows of all frames by column name; columns a frame lacks are null.  No frame raises."""
    if not frames:
        raise ValueError("no tables to unite")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_parquets(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of a folder as one table, columns united by name, and ``file_split``, the name before its first '-'."""
    df = spark.read.option("mergeSchema", True).option("pathGlobFilter", "*.parquet").parquet(folder)
    return df.withColumn("file_split", F.split_part(F.col("_metadata.file_name"), F.lit("-"), F.lit(1)))


def sorted_paths(spark: SparkSession, folder: str, glob: str = "PPR*.xml") -> DataFrame:
    """``path`` of each file in a folder, by code point; contents are not read."""
    return _documents(spark, folder, glob).select("path").orderBy("path")
