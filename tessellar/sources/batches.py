"""Batch files: their index, and the articles in them."""

from __future__ import annotations

import gzip
import time
import xml.etree.ElementTree as ET
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar import schemas

#: Name of a batch file; seconds before each retry.
BATCH_NAME = r"PPR(\d+)_PPR(\d+)\.xml\.gz"
RETRY_AFTER = (5, 30, 120)


def batch_links(pages: DataFrame, html: str, base: str) -> DataFrame:
    """``url``, ``start_id``, ``end_id`` of every batch file named in index pages; names listed twice come twice."""
    names = pages.select(F.explode(F.regexp_extract_all(F.col(html), F.lit(BATCH_NAME), 0)).alias("name"))
    ids = [F.regexp_extract("name", BATCH_NAME, n).cast("bigint") for n in (1, 2)]
    return names.select(F.concat(F.lit(base.rstrip("/") + "/"), "name").alias("url"), ids[0].alias("start_id"), ids[1].alias("end_id"))


def archive_number(article: ET.Element) -> int | None:
    """Number of the first archive id at any depth, if it is 'PPR' + number."""
    first = next((e for e in article.iter("article-id") if e.get("pub-id-type") == "archive"), None)
    said = (first.text or "") if first is not None else ""
    try:
        return int(said[3:]) if said.startswith("PPR") else None
    except ValueError:
        return None


def articles_in(stream: BinaryIO, wanted: set[int]) -> Iterator[tuple[int, str]]:
    """(number, XML text) of the first article of each wanted number; ends as soon as all are found."""
    left, depth, root = set(wanted), 0, None
    for event, element in ET.iterparse(stream, events=("start", "end")):
        if event == "start":
            root = element if root is None else root
            depth += 1
            continue
        depth -= 1
        if depth != 1:
            continue
        if element.tag == "article" and (number := archive_number(element)) in left:
            left.discard(number)
            element.tail = None
            yield number, '<?xml version="1.0" encoding="UTF-8"?>\n' + ET.tostring(element, encoding="unicode")
            if not left:
                return
        root.clear()


def fetched(url: str, wanted: set[int], open_url: Callable[[str], BinaryIO], sleep: Callable[[float], None] = time.sleep) -> Iterator[tuple[int, str]]:
    """Articles of one gzipped batch; after a failure the batch is opened anew for what is still missing."""
    left = set(wanted)
    for delay in (*RETRY_AFTER, None):
        try:
            with open_url(url) as raw, gzip.open(raw, "rb") as stream:
                for number, text in articles_in(stream, left):
                    left.discard(number)
                    yield number, text
            return
        except Exception:
            if delay is None:
                raise
            sleep(delay)


def read_batches(wanted: DataFrame, open_url: Callable[[str], BinaryIO], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """``ppr_id``, ``xml``, ``batch_url``, ``downloaded_at`` of wanted articles (``number``, ``url``), one task a batch.

    The ids of a batch are grouped by url; a batch of N articles holds at most N of them, 8 bytes each.
    """
    lists = wanted.groupBy("url").agg(F.collect_set("number").alias("numbers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for number, text in fetched(row["url"], set(row["numbers"]), open_url, sleep):
                    yield pa.RecordBatch.from_pylist([{"ppr_id": number, "xml": text, "batch_url": row["url"]}], pa.schema([("ppr_id", pa.int64()), ("xml", pa.string()), ("batch_url", pa.string())]))

    found = lists.repartition("url").mapInArrow(run, "ppr_id bigint, xml string, batch_url string")
    return found.withColumn("downloaded_at", F.current_timestamp()).to(found.sparkSession.createDataFrame([], schemas.RETRIEVED).schema)


def fetch_files(wanted: DataFrame, key: str, url: str, fetch: Callable[[str], bytes]) -> DataFrame:
    """``key``, ``content``, ``error``: each url's bytes, or why there are none; a failure does not end the run."""
    kind = wanted.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, address in enumerate(batch.column(1).to_pylist()):
                content, error = None, None
                try:
                    content = fetch(address)
                except OSError as e:
                    error = f"{type(e).__name__}: {e}"
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(n, 1), pa.array([content], pa.binary()), pa.array([error], pa.string())], ["__key", "content", "error"])

    picked = wanted.select(F.col(key).alias("__key"), F.col(url).alias("__url")).where(F.col("__url").isNotNull())
    return picked.mapInArrow(run, f"__key {kind}, content binary, error string").withColumnRenamed("__key", key)
