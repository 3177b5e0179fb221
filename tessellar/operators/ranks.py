"""Exact global positions without one task holding a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges a group is cut into by the first bits of its order key; their counts are small enough to sum in one task.
RANGES = 4096


def hashed_rank(df: DataFrame, group: list[str], order: list[Column], total: str | None = None, ranges: int = RANGES) -> DataFrame:
    """``rank`` from 1 within each group (the whole table if none), by ``order``; ``total`` names a column for the group's size.

    The first order column must be a hexadecimal digest: its leading digits cut each group into even
    ranges, which are counted first, so a window never holds more than one range of a group.  Rows equal
    in all order columns get neighbouring ranks.  Null groups are groups.
    """
    cut = df.withColumn("__range", (F.conv(F.substring(order[0], 1, 6), 16, 10).cast("bigint") * ranges / F.lit(1 << 24)).cast("int"))
    counts = cut.groupBy(*group, "__range").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    if total:
        offsets = offsets.withColumn("__total", F.sum("__n").over(Window.partitionBy(*group)))
    names = [f"__g{n}" for n in range(len(group))]
    offsets = offsets.select(*[F.col(g).alias(n) for g, n in zip(group, names, strict=True)], F.col("__range").alias("__r"), "__before", *["__total"] * bool(total))
    same = F.col("__range") == F.col("__r")
    for g, n in zip(group, names, strict=True):
        same = same & F.col(g).eqNullSafe(F.col(n))
    within = F.row_number().over(Window.partitionBy(*group, "__range").orderBy(*order))
    out = cut.withColumn("__within", within).join(offsets, same).withColumn("rank", F.col("__before") + F.col("__within"))
    if total:
        out = out.withColumn(total, F.col("__total"))
    return out.drop("__range", "__r", "__before", "__within", "__total", *names)
