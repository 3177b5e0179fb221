"""Sizes of texts in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import importlib.util
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def default_ranks() -> str:
    """Path of the byte-level vocabulary of the installed package of public tokenizers."""
    spec = importlib.util.find_spec("public_tokenizers")
    if spec is None or not spec.submodule_search_locations:
        raise FileNotFoundError("no public tokenizers are installed: give the path of a vocabulary of ranks")
    return os.path.join(list(spec.submodule_search_locations)[0], "byte_bpe_50k.tiktoken")


@lru_cache(1)
def _encoding(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("sizes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(df: DataFrame, key: str, text: str, ranks: str | None = None) -> DataFrame:
    """``key``, ``tokens`` of every row; null and empty texts have 0.  ``ranks`` must be readable by all tasks."""
    kind, path = df.schema[key].dataType.simpleString(), ranks or default_ranks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoding(path).encode_ordinary
        for batch in batches:
            counts = [len(encode(t)) if t else 0 for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["__key", "tokens"])

    return df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, f"__key {kind}, tokens bigint").withColumnRenamed("__key", key)
