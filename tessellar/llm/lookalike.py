"""Texts that look the same but are made of different characters: one consistent form.

The form is made by DuckDB inside Arrow partitions, in embedded SQL: ``regexp_replace`` drops invisible
characters, ``translate`` writes full-width forms, odd spaces and letters of the same shape plainly,
``replace`` opens ligatures, and ``nfc_normalize`` composes accents before and after.  Case, accents,
digits and visible punctuation stay as they are, so texts that differ visibly keep different forms.

Letters of one shape get the Latin letter in every word, also in words of another script: two readers'
views of a word are equal if and only if their forms are.  Null texts have no form and are in no pair.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import duckdb
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts and the Latin letters of the same shape.
SHAPES = (
    ("АВЕКМНОРСТУХЅІЈԚԜҮӀԌ", "ABEKMHOPCTYXSIJQWYIG"),
    ("аеорсухѕіјԛԝһԁүѵӏ", "aeopcyxsijqwhdyvl"),
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "ABEZHIKMNOPTYXCJ"),
    ("νορϲϳ", "vopcj"),
    ("ՕօՏսհցո", "OoSuhgn"),
    ("ɑɡ", "ag"),
)
#: Signs of the same look, and spaces of any width.
SIGNS = {0x2010: "-", 0x2011: "-", 0xB5: "μ", 0x2206: "Δ", 0x2126: "Ω", 0x2BC: "’", 0x37E: ";", 0x387: "·", 0x2215: "/", 0x2044: "/"}
SPACES = (0xA0, 0x1680, *range(0x2000, 0x200B), 0x202F, 0x205F, 0x3000)
#: Ranges of compatibility forms that look like what they are made of (full and half width, ligatures, Roman numerals, digraphs).
FORMS = ((0xFF01, 0xFFEF), (0xFB00, 0xFB07), (0x2160, 0x2180), (0x1C4, 0x1CD), (0x1F1, 0x1F4))
#: Invisible characters beside those of category Cf.
INVISIBLE = (0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x180F), *range(0xFE00, 0xFE10), *range(0xE0000, 0xE01F0))


def _invisible(c: int) -> bool:
    return unicodedata.category(chr(c)) == "Cf" or c in INVISIBLE


@lru_cache(1)
def tables() -> tuple[dict[str, str], dict[str, str]]:
    """(single characters to single ones, characters to several): by rule from the fixed values and the Unicode tables."""
    one = {a: b for left, right in SHAPES for a, b in zip(left, right, strict=True)}
    one |= {chr(c): s for c, s in SIGNS.items()} | {chr(c): " " for c in SPACES}
    several: dict[str, str] = {}
    for low, high in FORMS:
        for c in range(low, high):
            plain = unicodedata.normalize("NFKC", chr(c))
            if plain != chr(c) and not _invisible(c):
                (one if len(plain) == 1 else several)[chr(c)] = plain
    # accented letters follow their bare letter
    for c in range(0xC0, 0x2000):
        bare = unicodedata.normalize("NFD", chr(c))
        if len(bare) > 1 and bare[0] in one and chr(c) not in one:
            plain = unicodedata.normalize("NFC", one[bare[0]] + bare[1:])
            (one if len(plain) == 1 else several)[chr(c)] = plain
    return one, several


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@lru_cache(1)
def form_sql(text: str = "t") -> str:
    """The SQL expression of the consistent form of a column."""
    one, several = tables()
    hidden = [c for c in range(0x110000) if _invisible(c)]
    ranges: list[list[int]] = []
    for c in hidden:
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    unseen = "[" + "".join(f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges) + "]"
    bare = f"regexp_replace(nfc_normalize({text}), {_quoted(unseen)}, '', 'g')"
    opened = "x"
    for a, b in several.items():
        opened = f"replace({opened}, {_quoted(a)}, {_quoted(b)})"
    wide = "[" + "".join(several) + "]"
    expanded = f"list_transform([{bare}], lambda x: CASE WHEN regexp_matches(x, {_quoted(wide)}) THEN {opened} ELSE x END)[1]"
    shaped = f"nfc_normalize(translate({expanded}, {_quoted(''.join(one))}, {_quoted(''.join(one.values()))}))"
    # texts of plain characters are their own form
    return f"CASE WHEN regexp_full_match({text}, '[\\x00-\\x7E¡-¬®-´¶-ÿ–—‘’“”„•…€™]*') THEN {text} ELSE {shaped} END"


def _run_sql(kind: str, columns: str, names: str):
    """A mapInArrow function: one SQL statement over each batch (``k``, ``t``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = duckdb.connect(config={"threads": "1"})
        con.execute("SET enable_progress_bar = false")
        statement = f"SELECT k, {columns} FROM (SELECT k, t, {form_sql()} AS form FROM batch)"
        for batch in batches:
            con.register("batch", pa.Table.from_batches([batch.rename_columns(["k", "t"])]))
            found = con.sql(statement).to_arrow_table()
            con.unregister("batch")
            yield from found.rename_columns(["__key", *names.split()]).cast(pa.schema([("__key", batch.schema.field(0).type), *((n, pa.string()) for n in names.split())])).to_batches()

    return run


def forms(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``form`` of every row with a text."""
    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(_run_sql(kind, "form", "form"), f"__key {kind}, form string").withColumnRenamed("__key", key)


def form_digests(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key`` and the digests of form and text, so that texts are not moved."""
    kind = df.schema[key].dataType.simpleString()
    picked = df.select(F.col(key).alias("__key"), F.col(text).cast("string").alias("__text")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(_run_sql(kind, "md5(form) AS f, md5(t) AS t", "form_md5 text_md5"), f"__key {kind}, form_md5 string, text_md5 string").withColumnRenamed("__key", key)


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``_a < ``key``_b: every two rows whose texts differ but have one form.

    Forms of a single text are left out before anything is joined, however many copies it has; nothing
    is collected for a form.
    """
    told = form_digests(df, key, text).select(F.col(key).alias("k"), "form_md5", "text_md5").persist()
    several = told.groupBy("form_md5").agg(F.min("text_md5").alias("low"), F.max("text_md5").alias("high")).where("low < high").select("form_md5")
    held = told.join(several, "form_md5")
    a, b = (held.select("form_md5", F.col("k").alias(f"{key}_{n}"), F.col("text_md5").alias(f"t{n}")) for n in "ab")
    return a.join(b, "form_md5").where(F.col(f"{key}_a") < F.col(f"{key}_b")).where("ta <> tb").select(f"{key}_a", f"{key}_b")
