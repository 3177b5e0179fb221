"""Schemas of the tables, as Spark DDL."""

from __future__ import annotations

PROVENANCE_FIELDS = ("xml_source_url", "xml_downloaded_at", "xml_ftfy_applied", "pdf_source_url", "pdf_downloaded_at")

AUTHORS = "ARRAY<STRUCT<name: STRING, orcid: STRING, affiliations: ARRAY<STRING>>>"

#: What is read out of one article's XML.
EXTRACTED = (
    f"doi STRING, version STRING, title STRING, authors {AUTHORS}, pub_date STRING, license STRING, keywords ARRAY<STRING>, "
    "subjects MAP<STRING, STRING>, article_type STRING, language STRING, language_raw STRING"
)

PROVENANCE = "xml_source_url STRING, xml_downloaded_at STRING, xml_ftfy_applied BOOLEAN, pdf_source_url STRING, pdf_downloaded_at STRING"

METADATA = (
    f"ppr_id STRING, doi STRING, version STRING, title STRING, authors {AUTHORS}, pub_date STRING, license STRING, keywords ARRAY<STRING>, "
    f"subject_heading STRING, subject_europepmc_category STRING, article_type STRING, language STRING, language_raw STRING, {PROVENANCE}"
)

#: The assembled table.
DATASET = f"{METADATA}, xml STRING NOT NULL, pdf BINARY NOT NULL"

ARTICLES = "id STRING, title STRING, fullTextUrlList STRUCT<fullTextUrl: ARRAY<STRUCT<documentStyle: STRING, site: STRING, url: STRING>>>"

BATCHES = "url STRING, start_id BIGINT, end_id BIGINT"

RETRIEVED = "ppr_id BIGINT, xml STRING, batch_url STRING, downloaded_at TIMESTAMP"


def names(ddl: str) -> list[str]:
    """Column names of a flat listing above."""
    out, depth, word = [], 0, ""
    for ch in ddl + ",":
        depth += (ch == "<") - (ch == ">")
        if ch == "," and not depth:
            out.append(word.split()[0])
            word = ""
        else:
            word += ch
    return out
