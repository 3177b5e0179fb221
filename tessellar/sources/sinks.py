"""Writers with the file layouts of the dataset."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.operators.split import split_table


def write_jsonl(df: DataFrame, path: str, files: int | None = None) -> None:
    """JSON Lines with nulls written out; ``files`` bounds the number of files."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV with a header and the line ends of RFC 4180."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("header", True).option("lineSep", "\r\n").csv(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """Parquet, one folder a split under its table name ('val' and 'validation' become one)."""
    df.withColumn(split, split_table(F.col(split))).write.mode("overwrite").partitionBy(split).option("compression", "snappy").parquet(path)


def name_split_files(df: DataFrame, path: str, split: str = "split") -> list[str]:
    """Parquet files '<split>-<n>-of-<m>.parquet' in one folder: written as ``write_splits`` does, then renamed in place."""
    write_splits(df, path, split)
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    named = []
    for folder in sorted((s.getPath() for s in fs.listStatus(at) if s.isDirectory()), key=lambda p: p.getName()):
        parts = sorted((s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".parquet")), key=lambda p: p.getName())
        for n, part in enumerate(parts):
            name = f"{folder.getName().partition('=')[2]}-{n:05d}-of-{len(parts):05d}.parquet"
            fs.rename(part, jvm.org.apache.hadoop.fs.Path(at, name))
            named.append(name)
        fs.delete(folder, True)
    return named


def write_sidecars(df: DataFrame, path: str) -> None:
    """Provenance rows as one JSON object a line; rows without any value are not written."""
    fields = [F.col(f) for f in schemas.PROVENANCE_FIELDS]
    df.where(F.coalesce(*[c.isNotNull() & F.lit(True) for c in fields]) & F.greatest(*[c.isNotNull().cast("int") for c in fields]).cast("boolean")).write.mode("overwrite").json(path)


def write_documents(df: DataFrame, folder: str) -> None:
    """Files of articles in a folder all tasks can write to: 'PPR<number>' and '.xml', '.xml.original', '.pdf', '.provenance.json'.

    ``df`` holds ``ppr_id`` (a number) and any of ``xml``, ``xml_original``, ``pdf`` and the provenance fields; nulls
    write nothing.  A file is written under another name and renamed, so a repeated task leaves no half of one.
    """
    held = set(df.columns)
    kinds = [(c, s) for c, s in (("xml_original", ".xml.original"), ("xml", ".xml"), ("pdf", ".pdf")) if c in held]
    fields = [f for f in schemas.PROVENANCE_FIELDS if f in held]

    def put(rows) -> None:
        os.makedirs(folder, exist_ok=True)
        for r in rows:
            known = {f: r[f] for f in fields if r[f] is not None}
            texts = [(s, r[c]) for c, s in kinds if r[c] is not None] + [(".provenance.json", json.dumps(known, indent=2))] * bool(known)
            for suffix, value in texts:
                path = os.path.join(folder, f"PPR{r['ppr_id']}{suffix}")
                part = f"{path}.{uuid.uuid4().hex}"
                with open(part, "wb") as f:
                    f.write(value.encode("utf-8") if isinstance(value, str) else bytes(value))
                os.replace(part, path)

    df.foreachPartition(put)
