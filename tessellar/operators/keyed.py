"""One row per key: last wins, and field-wise upserts of a change log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar import schemas


def last_wins(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Of the rows of each key the last by ``order``.

    An aggregate, so that rows are reduced before the shuffle and a hot key costs one row per task.
    Null keys are one key; rows equal in the whole order must be equal in all columns or carry a
    last order column that tells them apart.
    """
    rest = [c for c in df.columns if c != key]
    if not rest:
        return df.distinct()
    picked = df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__row"))
    return picked.select(*[F.col(key) if c == key else F.col("__row")[c].alias(c) for c in df.columns])


def merged_log(log: DataFrame, key: str, order: list[str], fields: tuple[str, ...] = schemas.PROVENANCE_FIELDS) -> DataFrame:
    """State of each key after all of a log's writes: of each field the last value that is not null.

    Writes apply by ``order``; of writes equal in it the greater value counts.  A field never written is null.
    """
    last = [F.max_by(F.when(F.col(f).isNotNull(), F.col(f)), F.when(F.col(f).isNotNull(), F.struct(*order, f))).alias(f) for f in fields]
    return log.groupBy(key).agg(*last)


def upsert(old: DataFrame, new: DataFrame, key: str, fields: tuple[str, ...] = schemas.PROVENANCE_FIELDS) -> DataFrame:
    """Keys of either side; each field of ``new`` where it has a value, else of ``old``.  Both sides hold a key once."""
    a, b = (side.select(F.col(key).alias("__key"), F.struct(*fields).alias(name)) for side, name in ((old, "old"), (new, "new")))
    both = a.join(b, "__key", "full")
    return both.select(F.col("__key").alias(key), *[F.coalesce(F.col(f"new.{f}"), F.col(f"old.{f}")).alias(f) for f in fields])


def with_sidecar(df: DataFrame, sidecars: DataFrame, key: str, fields: tuple[str, ...] = schemas.PROVENANCE_FIELDS) -> DataFrame:
    """Every row with the sidecar fields of its key, null where there is none; columns of the same name are replaced."""
    return df.drop(*fields).join(sidecars.select(key, *fields), key, "left")
