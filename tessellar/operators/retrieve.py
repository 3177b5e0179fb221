"""Planning of downloads: which articles are needed, and which batch files hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Width of the id ranges by which ids and batches meet in an equi-join.
RANGE = 4096
#: The source's own predicate, and the one for full text.
PUBLISHER, FULL_TEXT = 'PUBLISHER:"SciELO Preprints"', "IN_EPMC:Y"


def source_query(extra: str = "", full_text: bool = True) -> str:
    """Predicate handed to the source: its own, AND the full-text one, AND the user's."""
    more = " AND ".join([FULL_TEXT] * full_text + [f"({extra})" if full_text else extra] * bool(extra))
    return f"{PUBLISHER} AND ({more})" if more else PUBLISHER


def article_number(identifier: Column) -> Column:
    """Number of an id 'PPR' + number, null for all others; leading zeros are lost."""
    return F.when(F.coalesce(identifier, F.lit("")).startswith("PPR"), F.substring(identifier, 4, 1 << 30).try_cast("bigint"))


def pdf_url(links: Column) -> Column:
    """Url of the first PDF entry of the home site; null if that entry has none, or there is no such entry."""
    fitting = F.filter(links, lambda x: (x["documentStyle"] == "pdf") & (x["site"] == "Europe_PMC"))
    return F.try_element_at(fitting, F.lit(1))["url"]


def numbered(articles: DataFrame) -> DataFrame:
    """Articles with a usable id: ``number`` and all columns; repeated numbers stay."""
    return articles.withColumn("number", article_number(F.col("id"))).where("number IS NOT NULL")


def needs(articles: DataFrame, existing: DataFrame, skip_existing: bool = True) -> DataFrame:
    """``number``, ``title``, ``pdf_url``, ``xml_needed``, ``pdf_needed`` of every article to fetch.

    ``existing`` tells ``number``, ``has_xml``, ``has_pdf`` of what is there.  A PDF is needed only where
    there is a url.  With ``skip_existing`` articles that need nothing are left out; without, they stay
    but nothing that is there counts as needed.  Of repeated records one is kept, the one greatest in title and url.
    """
    rows = numbered(articles).select("number", F.col("title"), pdf_url(F.col("fullTextUrlList.fullTextUrl")).alias("pdf_url"))
    one = rows.groupBy("number").agg(F.max(F.struct("title", "pdf_url")).alias("r")).select("number", "r.title", "r.pdf_url")
    held = existing.groupBy("number").agg(F.max("has_xml").alias("x"), F.max("has_pdf").alias("p"))
    flagged = one.join(held, "number", "left").select(
        "number", "title", "pdf_url", (~F.coalesce("x", F.lit(False))).alias("xml_needed"), (F.col("pdf_url").isNotNull() & ~F.coalesce("p", F.lit(False))).alias("pdf_needed")
    )
    return flagged.where("xml_needed OR pdf_needed") if skip_existing else flagged


def batches_of(ids: DataFrame, batches: DataFrame, width: int = RANGE) -> DataFrame:
    """``number``, ``url``, ``start_id``: every batch whose range holds the id; repeated batches count once.

    Both sides meet on the id's range of ``width`` numbers.  A batch is listed in each range it touches,
    but one that covers more than a thousand ranges is cut on a coarser scale of its own, so the
    number of listings stays below two thousand a batch.
    """
    distinct = batches.select("url", "start_id", "end_id").where("start_id <= end_id").distinct()
    span = (F.col("end_id") - F.col("start_id")) / F.lit(width)
    scale = F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(span, F.lit(1)) / 1000))).cast("int")
    cut = distinct.withColumn("scale", scale).withColumn("step", F.lit(width) * F.pow(F.lit(2.0), "scale").cast("bigint"))
    listed = cut.withColumn("cell", F.explode(F.sequence(F.floor(F.col("start_id") / F.col("step")), F.floor(F.col("end_id") / F.col("step")))))
    # there are at most 51 scales, since ranges of 64-bit numbers have so many powers of two
    steps = F.array(*[F.struct(F.lit(r.scale).alias("scale"), F.lit(r.step).alias("step")) for r in cut.select("scale", "step").distinct().collect()] or [F.struct(F.lit(0).alias("scale"), F.lit(width).cast("bigint").alias("step"))])
    placed = ids.select("number", F.explode(steps).alias("s")).select("number", F.col("s.scale").alias("scale"), F.floor(F.col("number") / F.col("s.step")).alias("cell"))
    met = placed.join(listed, ["scale", "cell"])
    return met.where("number BETWEEN start_id AND end_id").select("number", "url", "start_id", "end_id")


def needed_batches(ids: DataFrame, batches: DataFrame) -> DataFrame:
    """Batches that hold at least one id, by url; the others need not be opened."""
    return batches_of(ids, batches).select("url", "start_id", "end_id").distinct()


def first_in_batch(found: DataFrame, order: list[str]) -> DataFrame:
    """Of the occurrences of an id in a batch the first by ``order``."""
    rest = [c for c in found.columns if c not in ("number", "url")]
    one = found.groupBy("url", "number").agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r"))
    return one.select("url", "number", *[F.col("r")[c].alias(c) for c in rest])


def fetch_list(ids: DataFrame, batches: DataFrame, limit: int | None = None) -> DataFrame:
    """``number``, ``url``, ``start_id`` in the order in which they are fetched: by batch, then number; at most ``limit``."""
    rows = batches_of(ids.distinct(), batches).select("number", "url", "start_id")
    order = [F.col("start_id"), F.col("url"), F.col("number")]
    return rows.orderBy(*order) if limit is None else rows.orderBy(*order).limit(limit)


def position(df: DataFrame, by: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """Position from 1 within a small group."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
