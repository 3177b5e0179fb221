"""String functions whose results differ from Spark's built-ins of the same name, and text repair."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Language codes as they occur and the ISO 639-1 code each stands for.
LANGUAGE_CODES = {"pt": "pt", "PT": "pt", "po": "pt", "es": "es", "sp": "es", "en": "en", "fr": "fr", "de": "de"}


def language_code(raw: Column) -> Column:
    """ISO code of a raw language tag: the table above, case-sensitive, else the tag in lower case; null gives ''."""
    table = F.create_map(*[F.lit(x) for pair in LANGUAGE_CODES.items() for x in pair])
    return F.coalesce(table[raw], F.lower(raw), F.lit(""))


def strip(text: Column) -> Column:
    """White space of any script removed from both ends (``trim`` takes blanks only)."""
    return F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")


def zero_fill(text: Column, width: int = 2) -> Column:
    """Zeros before texts shorter than ``width``; longer ones stay whole; '' becomes zeros."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def joined_date(year: Column, month: Column, day: Column) -> Column:
    """``year-month-day``; an empty year is left out, an empty month or day is '00'.  Nulls count as ''."""
    parts = [F.coalesce(c, F.lit("")) for c in (year, month, day)]
    return F.concat_ws("-", F.nullif(parts[0], F.lit("")), zero_fill(parts[1]), zero_fill(parts[2]))


def unix_newlines(text: Column) -> Column:
    """Carriage returns, alone or before a line feed, as line feeds."""
    return F.regexp_replace(text, "\r\n?", "\n")


def iso_stamp(at: Column) -> Column:
    """UTC timestamp as ISO text; a fraction of zero is left out.  The session's time zone must be UTC."""
    return F.regexp_replace(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"), r"\.000000", "")


def non_blank(texts: Column) -> Column:
    """Elements stripped, blank and null ones dropped, order and repeats kept."""
    return F.filter(F.transform(texts, strip), lambda x: x != "")


def _mapped() -> dict[int, int]:
    """Code point to byte of Windows-1252, its five free bytes standing for themselves."""
    table = {b: b for b in range(0x80, 0x100)}
    for b in range(0x80, 0xA0):
        try:
            table[ord(bytes([b]).decode("cp1252"))] = b
        except UnicodeDecodeError:
            continue
    return table


_BYTES = {chr(c): b for c, b in _mapped().items()}


def _class(low: int, high: int) -> str:
    return "[" + "".join(re.escape(c) for c, b in _BYTES.items() if low <= b <= high) + "]"


#: Two, three or four characters that read as one UTF-8 sequence.
_SEQUENCE = re.compile(f"{_class(0xC2, 0xDF)}{_class(0x80, 0xBF)}|{_class(0xE0, 0xEF)}{_class(0x80, 0xBF)}{{2}}|{_class(0xF0, 0xF4)}{_class(0x80, 0xBF)}{{3}}")
#: What makes a text worth handing to Python.
_MARK = "[Â-ô][^\u0000-\u007f]"


def _read_again(found: re.Match[str]) -> str:
    try:
        return bytes(_BYTES[c] for c in found.group()).decode()
    except UnicodeDecodeError:
        return found.group()


def fix_text(text: str) -> str:
    """UTF-8 that was read as Windows-1252 or Latin-1, once or several times over, read rightly."""
    while not text.isascii() and (better := _SEQUENCE.sub(_read_again, text)) != text:
        text = better
    return text


@F.pandas_udf(StringType())
def _fixed(texts: pd.Series) -> pd.Series:
    return texts.map(fix_text, na_action="ignore")


def fixed_text(text: Column) -> Column:
    """``fix_text`` of a column.  Texts without two neighbouring characters beyond ASCII never leave the JVM; null stays null."""
    return F.when(text.rlike(_MARK), _fixed(F.when(text.rlike(_MARK), text))).otherwise(text)
