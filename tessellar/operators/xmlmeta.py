"""Metadata out of article XML: each document is parsed once, in Arrow batches."""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.functions.text import LANGUAGE_CODES, fixed_text

_LANG = "{http://www.w3.org/XML/1998/namespace}lang"
_LICENSE = "permissions/license/{http://www.niso.org/schemas/ali/1.0/}license_ref"
#: Documents per Arrow slice, so that a batch of long texts is not held twice.
SLICE = 500

_TEXTS = pa.list_(pa.string())
_ROW = pa.struct(
    {name: pa.string() for name in ("doi", "version", "title")}
    | {"authors": pa.list_(pa.struct({"name": pa.string(), "orcid": pa.string(), "affiliations": _TEXTS}))}
    | {"pub_date": pa.string(), "license": pa.string(), "keywords": _TEXTS, "subjects": pa.map_(pa.string(), pa.string())}
    | {name: pa.string() for name in ("article_type", "language", "language_raw")}
)


def _lead(element: ET.Element | None) -> str:
    """Text before the first child element."""
    return (element.text or "") if element is not None else ""


def _leads(parent: ET.Element, path: str, **attributes: str) -> list[str]:
    """Stripped lead texts of the elements at a path, those with the given attributes."""
    wanted = {k.replace("_", "-"): v for k, v in attributes.items()}
    return [_lead(e).strip() for e in parent.iterfind(path) if all(e.get(k) == v for k, v in wanted.items())]


def plain_affiliation(aff: ET.Element) -> str:
    """Lead text, then of every child its lead text (labels excepted) and tail; deeper text is left out."""
    pieces = [_lead(aff)]
    for child in aff:
        pieces += ["" if child.tag == "label" else _lead(child), child.tail or ""]
    return "".join(pieces).strip()


def _author(contrib: ET.Element, shared: dict[str, str]) -> dict | None:
    person = contrib.find("name")
    if person is None:
        return None
    name = " ".join(_lead(person.find(part)).strip() for part in ("given-names", "surname")).strip()
    if not name:
        return None
    pointers = [x.get("rid", "") for x in contrib.iterfind("xref") if x.get("ref-type") == "aff"]
    named = [shared[rid] for rid in pointers if rid in shared]
    own = (plain_affiliation(a) for a in contrib.iterfind("aff"))
    ids = _leads(contrib, "contrib-id", contrib_id_type="orcid")
    return {"name": name, "orcid": ids[0] if ids else "", "affiliations": named or [a for a in own if a]}


def _date(meta: ET.Element) -> str:
    for found in meta.iterfind("pub-date"):
        if found.get("pub-type") == "preprint":
            year, month, day = (found.findtext(part) or "" for part in ("year", "month", "day"))
            return "-".join([year] * bool(year) + [month.zfill(2), day.zfill(2)])
    return ""


def read_article(text: str | None) -> dict | None:
    """The metadata of one XML text; None where it is not well formed.

    The last DOI and version count, the first ORCID, date and licence; titles keep the text
    before their first inline element only.
    """
    try:
        root = ET.fromstring(text or "")
    except (ET.ParseError, ValueError):
        return None
    meta = root.find("front/article-meta")
    if meta is None:
        meta = ET.Element("article-meta")
    raw = root.get(_LANG) or ""
    shared = {key: plain_affiliation(a) for a in meta.iterfind("aff") if (key := a.get("id"))}
    subjects = {}
    for group in meta.iterfind("article-categories/subj-group"):
        kind, subject = group.get("subj-group-type", "").replace("-", "_"), _lead(group.find("subject")).strip()
        if kind and subject:
            subjects[kind] = subject
    return {
        "doi": (_leads(meta, "article-id", pub_id_type="doi") or [""])[-1],
        "version": (_leads(meta, "article-version-alternatives/article-version", article_version_type="number") or [""])[-1],
        "title": _lead(meta.find("title-group/article-title")).strip(),
        "authors": [a for c in meta.iterfind("contrib-group/contrib") if (a := _author(c, shared))],
        "pub_date": _date(meta),
        "license": (_leads(meta, _LICENSE) or [""])[0],
        "keywords": [k for k in _leads(meta, "kwd-group/kwd") if k],
        "subjects": list(subjects.items()),
        "article_type": root.get("article-type", ""),
        "language": LANGUAGE_CODES.get(raw, raw.lower()),
        "language_raw": raw,
    }


def read_articles(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the metadata columns of every well-formed text; others give no row (see ``unreadable``)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                read = [(n, row) for n, t in enumerate(part.column(1).to_pylist()) if (row := read_article(t))]
                keys = part.column(0).take(pa.array([n for n, _ in read], pa.int32()))
                rows = pa.array([row for _, row in read], _ROW)
                yield pa.RecordBatch.from_arrays([keys, *rows.flatten()], ["__key", *(f.name for f in _ROW)])

    picked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(run, f"__key {kind}, {schemas.EXTRACTED}").withColumnRenamed("__key", key)


def with_subjects(df: DataFrame) -> DataFrame:
    """The two subject columns of the fixed layout out of the open map."""
    return df.withColumns({"subject_heading": F.col("subjects")["heading"], "subject_europepmc_category": F.col("subjects")["europepmc_category"]}).drop("subjects")


def unreadable(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` of every row whose text is missing or not well formed."""
    return df.select(key).join(read_articles(df, key, text).select(key), key, "left_anti")


def article_id(stem: Column) -> Column:
    """Identifier of a document by its file's stem: the first 'PPR_' counts as 'PPR'."""
    return F.regexp_replace(stem, "^(.*?)PPR_", "$1PPR")


def repaired(df: DataFrame, text: str) -> DataFrame:
    """``text`` repaired, ``<text>_original`` as it was, and ``<text>_changed``."""
    fixed = df.withColumns({f"{text}_original": F.col(text), text: fixed_text(F.col(text))})
    return fixed.withColumn(f"{text}_changed", F.coalesce(F.col(text) != F.col(f"{text}_original"), F.lit(False)))
