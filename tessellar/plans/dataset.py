"""The whole run: article files to assembled splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.functions.text import iso_stamp
from tessellar.operators.assemble import fixed_columns, with_files
from tessellar.operators.keyed import upsert, with_sidecar
from tessellar.operators.retrieve import fetch_list, needs
from tessellar.operators.split import non_empty, stratified_split
from tessellar.operators.xmlmeta import read_articles, repaired, with_subjects
from tessellar.sources.files import read_binary, read_sidecars, read_xml


def metadata_of(texts: DataFrame, sidecars: DataFrame) -> DataFrame:
    """Metadata of articles (``ppr_id``, ``xml``) with their provenance; unreadable ones are left out."""
    return with_sidecar(with_subjects(read_articles(texts, "ppr_id", "xml")), sidecars, "ppr_id").select(*schemas.names(schemas.METADATA))


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The table and an observation ``n`` of its rows, filled when it is written."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def dataset(spark: SparkSession, folder: str, train: float = 0.2, val: float = 0.3, seed: int = 42) -> DataFrame:
    """``split``, the fixed metadata columns, ``xml`` and ``pdf`` of every readable article in a folder."""
    texts = read_xml(spark, folder).select("ppr_id", "xml")
    meta = non_empty(metadata_of(texts, read_sidecars(spark, folder)), f"readable articles in {folder}")
    splits = stratified_split(meta, "ppr_id", "language", train, val, seed).select("ppr_id", "split")
    files = texts.join(read_binary(spark, folder), "ppr_id", "left")
    return with_files(fixed_columns(splits.join(meta, "ppr_id"), "split"), files).select("split", *schemas.names(schemas.DATASET))


def retrieval(articles: DataFrame, existing: DataFrame, batches: DataFrame, limit: int | None = None, skip_existing: bool = True) -> DataFrame:
    """What to fetch: ``number``, ``url`` in order, with need flags and PDF url; nothing needed gives no rows."""
    wanted = needs(articles, existing, skip_existing)
    return fetch_list(wanted.select("number"), batches, limit).join(wanted, "number")


def stored(fetched: DataFrame, wanted: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Texts to write (raw and repaired) and the provenance after it.

    Nothing is overwritten: only articles whose XML is needed give a text; their fields go over the old
    ones, untouched fields stay.
    """
    rows = fetched.join(wanted.where("xml_needed").select(F.col("number").alias("ppr_id")), "ppr_id", "left_semi")
    texts = repaired(rows, "xml")
    new = texts.select(
        "ppr_id",
        F.col("batch_url").alias("xml_source_url"),
        iso_stamp(F.col("downloaded_at")).alias("xml_downloaded_at"),
        F.col("xml_changed").alias("xml_ftfy_applied"),
        F.lit(None).cast("string").alias("pdf_source_url"),
        F.lit(None).cast("string").alias("pdf_downloaded_at"),
    )
    return texts, upsert(old, new, "ppr_id")
