"""Exact, reproducible splits: stratified, and plain in two steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.operators.ranks import hashed_rank

SPLITS = ("train", "val", "test")
#: Languages with a stratum of their own.
MAIN_LANGUAGES = ("pt", "es")


def stratum(language: Column, main: tuple[str, ...] = MAIN_LANGUAGES) -> Column:
    """The language itself if it is a main one, else 'other'; null and '' are 'other'."""
    return F.when(language.isin(*main), language).otherwise("other")


def seeded(key: Column, seed: int) -> Column:
    """Digest that orders rows anew for every seed."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))


def checked_shares(train: float, val: float) -> None:
    if min(train, val) < 0 or train + val >= 1:
        raise ValueError("train and val shares must not be negative and must add up to less than 1")


def non_empty(df: DataFrame, what: str) -> DataFrame:
    """The table itself; an empty one raises."""
    if df.isEmpty():
        raise ValueError(f"no rows: {what}")
    return df


def stratified_split(df: DataFrame, key: str, language: str, train: float = 0.2, val: float = 0.3, seed: int = 42, main: tuple[str, ...] = MAIN_LANGUAGES) -> DataFrame:
    """``key``, ``stratum``, ``split`` of every row, repeated rows included.

    Of a stratum's n rows, in seeded order, the first n x train rounded half to even are train, as
    many for val follow, the rest is test.  An empty table gives no rows.
    """
    checked_shares(train, val)
    rows = df.select(F.col(key).alias("__key"), stratum(F.col(language), main).alias("stratum")).withColumn("__order", seeded(F.col("__key"), seed))
    ranked = hashed_rank(rows, ["stratum"], [F.col("__order"), F.col("__key")], total="__size")
    first, second = F.rint(F.col("__size") * F.lit(train)), F.rint(F.col("__size") * F.lit(val))
    split = F.when(F.col("rank") <= first, "train").when(F.col("rank") <= first + second, "val").otherwise("test")
    return ranked.select(F.col("__key").alias(key), "stratum", split.alias("split"))


def two_step_split(df: DataFrame, key: str, seed: int = 42, held_out: float = 0.8, test: float = 0.625) -> DataFrame:
    """``key``, ``split`` without strata: the held-out share, rounded up, is cut again into test, rounded up, and validation."""
    rows = df.select(F.col(key).alias("__key")).withColumn("__order", seeded(F.col("__key"), seed))
    ranked = hashed_rank(rows, [], [F.col("__order"), F.col("__key")], total="__size")
    rest = F.ceil(F.col("__size") * F.lit(held_out))
    tests = F.ceil(rest * F.lit(test))
    train, val = F.col("__size") - rest, rest - tests
    split = F.when(F.col("rank") <= train, "train").when(F.col("rank") <= train + val, "validation").otherwise("test")
    return ranked.select(F.col("__key").alias(key), split.alias("split"))


def split_table(split: Column) -> Column:
    """Name of a split in the assembled dataset; unknown names stay."""
    return F.when(split == "val", "validation").otherwise(split)


def split_counts(assigned: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """``split``, ``n`` of each named split, 0 where it has no row."""
    fixed = assigned.sparkSession.createDataFrame([(s,) for s in splits], "split string")
    found = assigned.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    return F.broadcast(fixed).join(found, "split", "left").select("split", F.coalesce("n", F.lit(0)).alias("n"))


def stratum_counts(assigned: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """``stratum`` and one count column for each split."""
    wide = assigned.groupBy("stratum").pivot("split", list(splits)).agg(F.count(F.lit(1)))
    return wide.select("stratum", *[F.coalesce(s, F.lit(0)).alias(s) for s in splits])
