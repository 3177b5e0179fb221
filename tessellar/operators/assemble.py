"""Assembly of the dataset: split rows with their metadata and files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessellar import schemas
from tessellar.functions.text import unix_newlines
from tessellar.operators.keyed import last_wins


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def _texts(c: Column) -> Column:
    return F.transform(F.coalesce(c, F.array().cast("array<string>")), _text)


def _default(c: Column, kind: T.DataType) -> Column:
    """Nulls to the empty value of the type."""
    if isinstance(kind, T.BooleanType):
        return F.coalesce(c, F.lit(False))
    if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StringType):
        return _texts(c)
    if isinstance(kind, T.ArrayType):
        person = lambda a: F.struct(_text(a["name"]).alias("name"), _text(a["orcid"]).alias("orcid"), _texts(a["affiliations"]).alias("affiliations"))
        return F.transform(F.coalesce(c, F.array().cast(schemas.AUTHORS)), person)
    return _text(c)


def fixed_columns(df: DataFrame, *kept: str) -> DataFrame:
    """The metadata columns of the fixed layout without nulls, after the ``kept`` ones.

    Columns that are missing are empty, unknown ones are dropped.
    """
    have = set(df.columns)
    wanted = T._parse_datatype_string(schemas.METADATA)
    filled = [_default(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType), f.dataType).alias(f.name) for f in wanted]
    return df.select(*kept, *filled)


def with_metadata(splits: DataFrame, lines: DataFrame, order: str = "line_no") -> DataFrame:
    """``split`` and the fixed columns of every split row, repeated ones included.

    Of several metadata lines of a key the last counts; keys without one get empty values.
    The join side is left to adaptive execution, since metadata grows with the data.
    """
    meta = last_wins(lines, "ppr_id", [F.col(order)]).drop(order, "split")
    return fixed_columns(splits.select("ppr_id", "split").join(meta, "ppr_id", "left"), "split")


def missing_files(splits: DataFrame, files: DataFrame) -> DataFrame:
    """``ppr_id`` of split rows without a document row, or without its XML or PDF."""
    whole = files.where(F.col("xml").isNotNull() & F.col("pdf").isNotNull()).select("ppr_id")
    return splits.select("ppr_id").distinct().join(whole, "ppr_id", "left_anti")


def with_files(splits: DataFrame, files: DataFrame, strict: bool = True) -> DataFrame:
    """Split rows with ``xml`` (line ends unified) and ``pdf``, which take the place of columns so named.

    ``strict`` looks for missing documents before anything is written and raises naming some of them;
    otherwise rows without a document are left out.
    """
    if strict and (lost := missing_files(splits, files).orderBy("ppr_id").limit(5).collect()):
        raise FileNotFoundError("documents not found: " + ", ".join(str(r.ppr_id) for r in lost))
    held = files.select("ppr_id", unix_newlines(F.col("xml")).alias("xml"), "pdf").where(F.col("xml").isNotNull() & F.col("pdf").isNotNull())
    return splits.drop("xml", "pdf").join(held, "ppr_id")
