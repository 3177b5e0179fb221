"""Overlap and duplicates between datasets and splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def leading_number(doi: Column, prefix: str) -> Column:
    """Digits that follow ``prefix`` (a regular expression) at the start; null if they don't."""
    return F.nullif(F.regexp_extract(doi, rf"^{prefix}(\d+)", 1), F.lit(""))


def versioned(entry: Column) -> tuple[Column, Column]:
    """Number and version ('v' + digits, as written) of an archive's top folder; null if it isn't named so."""
    top = F.split_part(entry, F.lit("/"), F.lit(1))
    return F.nullif(F.regexp_extract(top, r"(?i)^(\d+)v\d+", 1), F.lit("")), F.nullif(F.regexp_extract(top, r"(?i)^\d+(v\d+)$", 1), F.lit(""))


def distinct_ids(df: DataFrame, split: str = "split", key: str = "id") -> DataFrame:
    """``split``, ``id``: the ids of each split once, nulls left out."""
    return df.select(F.col(split).alias("split"), F.col(key).alias("id")).where("id IS NOT NULL").distinct()


def overlap_counts(local: DataFrame, foreign: DataFrame) -> DataFrame:
    """``split``, ``n``: local ids found in each foreign split; split '*' counts those found in any."""
    ids = local.select("id").where("id IS NOT NULL").distinct()
    met = foreign.join(ids, "id", "left_semi")
    each = met.groupBy("split").agg(F.count_distinct("id").alias("n"))
    return each.unionByName(met.agg(F.count_distinct("id").alias("n")).select(F.lit("*").alias("split"), "n"))


def overlap_detail(local: DataFrame, foreign: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``id``, ``local_split``, ``splits``: for each local id found elsewhere all foreign splits, in the given order.

    A group holds at most one entry for each split, so it is bounded by the number of splits.
    """
    place = F.array_position(F.array(*map(F.lit, order)), F.col("split"))
    met = foreign.distinct().join(local.select("id", F.col("split").alias("local_split")).distinct(), "id")
    lists = met.groupBy("id", "local_split").agg(F.array_sort(F.collect_set(F.struct(place.alias("at"), "split"))).alias("s"))
    return lists.select("id", "local_split", F.concat_ws(",", F.transform("s", lambda x: x["split"])).alias("splits"))


def several_versions(entries: DataFrame) -> DataFrame:
    """``split``, ``id``, ``versions``, ``n`` of every id with more than one version in a split, by first occurrence.

    Versions are reduced to one row each before a list is made; 'v1' and 'V1' differ.
    """
    first = entries.where("id IS NOT NULL AND version IS NOT NULL").groupBy("split", "id", "version").agg(F.min("pos").alias("pos"))
    lists = first.groupBy("split", "id").agg(F.array_sort(F.collect_list(F.struct("pos", "version"))).alias("v")).where("size(v) > 1")
    return lists.select("split", "id", F.concat_ws(",", F.transform("v", lambda x: x["version"])).alias("versions"), F.size("v").cast("bigint").alias("n"))


def cross_split_pairs(ids: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``a``, ``b``, ``n``: ids that two splits share, of every two splits, 0 included.

    Each id carries its few splits as a set, so no join of the rows with themselves is needed.
    """
    sets = ids.groupBy("id").agg(F.collect_set("split").alias("s")).where("size(s) > 1")
    pairs = [(a, b) for n, a in enumerate(order) for b in order[n + 1 :]]
    counts = sets.agg(*[F.count(F.when(F.array_contains("s", a) & F.array_contains("s", b), 1)).alias(f"{a}|{b}") for a, b in pairs])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("n")) for a, b in pairs])).alias("r")).select("r.*")


def unrecognised(entries: DataFrame) -> DataFrame:
    """Top-level entries that are no versioned folder."""
    number, _ = versioned(F.col("entry"))
    return entries.where(number.isNull() & ~F.col("entry").contains("/"))


def ends(items: Column, n: int = 5) -> tuple[Column, Column]:
    """First and last n elements; shorter arrays are given whole."""
    return F.slice(items, 1, n), F.slice(items, F.greatest(F.size(items) - n + 1, F.lit(1)), n)
