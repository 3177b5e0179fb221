"""Sources mixed to target weights, by weighted fair queueing.

Every source's documents are shuffled; a document's virtual finish time is the source's tokens up to and
including it, divided by the source's weight.  All documents are range-sorted by that time and cut off at
the budget, so at any point of the mix each source has its share.  A source too small for its share starts
again, at most ``max_repeats`` times in all.

Running sums are taken in two steps, sums of ranges first, so neither a hot source nor the whole mix is
ever in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessellar.llm.forest import cut

#: Ranges of a source's shuffled documents and of the mix, for running sums.
RANGES = 1024


def _running(df: DataFrame, group: list[str], slot: str, order: list, value: str, name: str) -> DataFrame:
    """``name``: running sum of ``value`` within a group, by ``slot`` (an integer), then ``order``."""
    sums = df.groupBy(*group, slot).agg(F.sum(value).alias("__s"))
    before = F.coalesce(F.sum("__s").over(Window.partitionBy(*group).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(*group, slot, before.alias("__before"))
    within = F.sum(value).over(Window.partitionBy(*group, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return df.withColumn("__within", within).join(offsets, [*group, slot]).withColumn(name, F.col("__before") + F.col("__within")).drop("__before", "__within")


def plan(sized: DataFrame, targets: DataFrame, budget: int | None = None) -> DataFrame:
    """``source``, ``weight`` (of the sources that are there, summing to 1), ``held`` (tokens), ``max_repeats``, ``budget``.

    Without a given budget it is the greatest one at which every source that is there can give its share.
    Targets of the same source must not repeat; those that are null, not positive, or of a source without
    tokens count as absent.
    """
    held = sized.groupBy("source").agg(F.sum("tokens").alias("held"))
    wanted = targets.where("target_share > 0 AND max_repeats > 0").select("source", "target_share", "max_repeats")
    there = held.join(wanted, "source").where("held > 0")
    total = there.agg(F.sum("target_share").alias("all"), F.min(F.col("held") * F.col("max_repeats") / F.col("target_share")).alias("least"))
    most = F.lit(budget).cast("double") if budget is not None else F.floor(F.col("least") * F.col("all"))
    # one row; targets are a table of sources
    return there.join(F.broadcast(total), F.lit(True)).select("source", "held", "max_repeats", "target_share", (F.col("target_share") / F.col("all")).alias("weight"), most.cast("bigint").alias("budget"))


def mix(sized: DataFrame, targets: DataFrame, key: str, budget: int | None = None, seed: int = 42, ranges: int = RANGES) -> DataFrame:
    """``position`` (tokens of the mix up to and including the row), ``key``, ``source``, ``repeat`` (from 1), ``tokens``, ``finish``.

    ``sized`` holds ``key``, ``source``, ``tokens``.  Rows without tokens or of a source without a target are
    in no mix.  The last row is the last that ends within the budget.
    """
    planned = cut(plan(sized, targets, budget))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")))
    docs = sized.where("tokens > 0").select(key, "source", "tokens").join(planned, "source").withColumn("order", order)
    docs = docs.withColumn("slot", (F.conv(F.substring("order", 1, 6), 16, 10).cast("bigint") * ranges / F.lit(1 << 24)).cast("int"))
    summed = _running(docs, ["source"], "slot", [F.col("order"), F.col(key)], "tokens", "upto")
    # copies are made only as far as the budget reaches
    turns = F.least(F.col("max_repeats"), F.ceil(F.col("weight") * F.col("budget") / F.col("held")) + 1).cast("int")
    copies = summed.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), turns))))
    timed = copies.withColumn("finish", (F.col("upto") + (F.col("repeat") - 1) * F.col("held")) / F.col("weight"))
    # all sources move at the rate of their weights, so time is about evenly filled with tokens
    slot = F.least(F.lit(ranges), F.floor(F.col("finish") * ranges / F.greatest(F.col("budget"), F.lit(1)))).cast("int")
    lined = cut(timed.select(key, "source", "repeat", "tokens", "finish", "budget", slot.alias("slot")).withColumn("all", F.lit(0)))
    placed = _running(lined, ["all"], "slot", [F.col("finish"), F.col("source"), F.col(key), F.col("repeat")], "tokens", "position")
    return placed.where("position <= budget").select("position", key, "source", "repeat", "tokens", "finish").orderBy("position")


def shares(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """``source``, ``target_share``, ``actual_share``, ``tokens``, ``documents``, ``most_repeats`` of every target."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeat").alias("most_repeats"))
    total = got.agg(F.sum("tokens").alias("all"))
    both = targets.select("source", "target_share").join(got, "source", "left").join(F.broadcast(total), F.lit(True), "left")
    return both.select("source", "target_share", F.coalesce(F.col("tokens") / F.col("all"), F.lit(0.0)).alias("actual_share"), *[F.coalesce(c, F.lit(0)).alias(c) for c in ("tokens", "documents", "most_repeats")])
