"""Splits that keep related records together.

Records are related if they list one person or are records of one preprint.  Relations are edges to
an anchor each, so a person with many records costs one edge a record; components come from local
union-find forests merged hierarchically.  Groups go largest first to the split furthest below its
target; groups of one size are alike, so only the sizes and how many groups have each go to the driver
(there are at most sqrt(2 x records) different sizes), and which group goes where is decided by ranks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.forest import components, cut
from tessellar.operators.ranks import hashed_rank

#: The shares of the dataset's own splits.
SHARES = {"train": 0.2, "val": 0.3, "test": 0.5}


def relations(people: DataFrame, preprints: DataFrame, key: str) -> DataFrame:
    """``k``, ``anchor``: each record's persons (``key``, ``person``) and preprint (``id``, ``group``)."""
    return people.select(F.col(key).alias("k"), F.concat(F.lit("person\x1f"), "person").alias("anchor")).union(preprints.select(F.col("id").alias("k"), F.concat(F.lit("preprint\x1f"), F.col("group").cast("string")))).distinct()


def related_pairs(related: DataFrame) -> DataFrame:
    """``a`` < ``b``: every two records with a common anchor."""
    several = related.groupBy("anchor").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("anchor")
    held = cut(related.join(several, "anchor"))
    one, two = held.select("anchor", F.col("k").alias("a")), held.select("anchor", F.col("k").alias("b"))
    return one.join(two, "anchor").where("a < b").select("a", "b").distinct()


def placement(sizes: list[tuple[int, int]], shares: dict[str, float]) -> dict[int, list[tuple[str, int]]]:
    """For every size how many of its groups go to each split, by (size, number of groups), largest first.

    Each group goes to the split furthest below its target; runs of equal groups are placed at once
    until what is left is small, then one by one.
    """
    total = sum(s * n for s, n in sizes)
    room = {name: share * total for name, share in shares.items()}
    out: dict[int, list[tuple[str, int]]] = {}
    for size, n in sorted(sizes, reverse=True):
        given = dict.fromkeys(shares, 0)
        if n > 1000:
            # the level to which the rooms would sink if groups were divisible
            names = sorted(room, key=room.get, reverse=True)
            for m in range(len(names), 0, -1):
                level = (sum(room[x] for x in names[:m]) - n * size) / m
                if room[names[m - 1]] >= level:
                    break
            for x in names[:m]:
                given[x] = max(0, int((room[x] - level) / size) - 1)
                room[x] -= given[x] * size
        for _ in range(n - sum(given.values())):
            x = max(room, key=lambda s: (room[s], s))
            given[x] += 1
            room[x] -= size
        out[size] = list(given.items())
    return out


def grouped_split(keys: DataFrame, related: DataFrame, shares: dict[str, float] = SHARES, seed: int = 42) -> DataFrame:
    """``k``, ``group``, ``split`` of every key (one column ``k``); related keys share a split.

    Shares must be positive and are scaled to one.  A group larger than a split's target makes that split
    larger than its share, as groups are never cut.  Null and repeated keys count once.
    """
    if not shares or min(shares.values()) <= 0:
        raise ValueError("shares must be positive")
    whole = sum(shares.values())
    anchors = related.groupBy("anchor").agg(F.min("k").alias("a"))
    edges = related.join(anchors, "anchor").where("k <> a").select("a", F.col("k").alias("b"))
    group = components(edges)
    member = cut(keys.select("k").distinct().join(group, keys.k == group.id, "left").select("k", F.coalesce("group", "k").alias("group")))
    sized = member.groupBy("group").agg(F.count(F.lit(1)).alias("size"))
    ranked = cut(hashed_rank(sized.withColumn("order", F.md5(F.concat_ws(":", F.lit(seed), "group"))), ["size"], [F.col("order"), F.col("group")]))
    counts = [(r["size"], r["n"]) for r in ranked.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()]
    bounds = []
    for size, parts in placement(counts, {s: v / whole for s, v in shares.items()}).items():
        low = 0
        for name, n in parts:
            if n:
                bounds.append((size, low, low + n, name))
            low += n
    spark = keys.sparkSession
    table = spark.createDataFrame(bounds, "size bigint, low bigint, high bigint, split string")
    placed = ranked.join(table, "size").where("rank > low AND rank <= high").select("group", "split")
    return member.join(placed, "group").select("k", "group", "split")
