"""Language of records and of their paragraphs, by compression.

For each language a raw-content zstandard dictionary holds sample text; a text is encoded with each of
them and belongs to the language whose encoding is smallest.  The confidence is the lead of the smallest
over the second, as a part of the second; below ``MARGIN`` the language is rejected (null).

Labels are often wrong, so a committee of small dictionaries first votes on the labelled sample, and only
paragraphs that keep their label make up the dictionaries.  The sample is the one bounded thing:
``SAMPLE`` records a language, the least by hash.  Everything else covers all rows and whole texts.
"""

from __future__ import annotations

import hashlib
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: The languages told apart.
LANGUAGES = ("pt", "es", "en", "fr", "de")
#: Labelled records a language the dictionaries are fitted on, and bytes of a dictionary.
SAMPLE, DICTIONARY = 200, 48 * 1024
#: Small dictionaries a language that vote on the sample's labels, and paragraphs in one of them.
COMMITTEE, MEMBER = 12, 6
#: Compression level; lead of the best language below which a text is rejected.
LEVEL, MARGIN = 3, 0.02
#: Records per Arrow slice.
SLICE = 500

_SPACE = re.compile(r"\s+")
_LETTER = re.compile(r"[^\W\d_]")


class Classifier:
    """One compressor for each dictionary; they are made on first use, so the object can be sent to tasks."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.dictionaries = dictionaries
        self._encoders: list[tuple[str, zstandard.ZstdCompressor]] | None = None

    def __getstate__(self) -> dict:
        return {"dictionaries": self.dictionaries, "_encoders": None}

    def sizes(self, text: str) -> list[tuple[int, str]]:
        if self._encoders is None:
            self._encoders = []
            for lang, content in self.dictionaries.items():
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=LEVEL)
                self._encoders.append((lang, zstandard.ZstdCompressor(level=LEVEL, dict_data=d, write_content_size=False, write_dict_id=False)))
        data = text.encode("utf-8", "replace")
        return sorted((len(encoder.compress(data)), lang) for lang, encoder in self._encoders)

    def language(self, text: str, margin: float = MARGIN) -> tuple[str | None, float]:
        """(language or None, confidence from 0 to 1).  Texts without letters have no language."""
        text = _SPACE.sub(" ", text).strip()
        if not self.dictionaries or not _LETTER.search(text):
            return None, 0.0
        ranked = self.sizes(text)
        if len(ranked) == 1:
            return ranked[0][1], 1.0
        lead = (ranked[1][0] - ranked[0][0]) / ranked[1][0]
        return (ranked[0][1] if lead >= margin else None), lead


def _local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def parts(text: str | None) -> tuple[list[str], str] | None:
    """(texts of the p elements of body in document order, text of the abstract); None if not well formed."""
    try:
        root = ET.fromstring(text or "")
    except (ET.ParseError, ValueError):
        return None
    body = next((e for e in root.iter() if _local(e.tag) == "body"), None)
    paragraphs = ["".join(e.itertext()) for e in body.iter() if _local(e.tag) == "p"] if body is not None else []
    abstract = next((e for e in root.iter() if _local(e.tag) == "abstract"), None)
    return paragraphs, "".join(abstract.itertext()) if abstract is not None else ""


def fitted(df: DataFrame, key: str, text: str, label: str, sample: int = SAMPLE) -> Classifier:
    """A classifier from a bounded sample of labelled records; languages without any have no dictionary."""
    labelled = df.where(F.col(label).isin(*LANGUAGES)).select(F.col(key).alias("k"), F.col(label).alias("lang"))
    order = Window.partitionBy("lang").orderBy(F.xxhash64("k"), "k")
    chosen = labelled.withColumn("n", F.row_number().over(order)).where(F.col("n") <= sample).select("k", "lang")
    # at most len(LANGUAGES) x sample ids
    rows = df.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(chosen), "k").select("lang", "t", "k").collect()
    said: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: str(r.k)):
        found = parts(r.t)
        for p in (*found[0], found[1]) if found else ():
            if len(p) > 80:
                said.setdefault(r.lang, []).append(_SPACE.sub(" ", p).strip())

    return trained(said)


def trained(said: dict[str, list[str]]) -> Classifier:
    """A classifier from labelled paragraphs of which some are in another language.

    A dictionary holds what it holds however rarely, so a few wrong labels would spoil it.  A committee of
    small dictionaries a language, each of a few paragraphs, first votes on every paragraph by the sum of
    its encodings; only paragraphs that keep their label make up the dictionaries.
    """
    shuffled = {lang: sorted(set(texts), key=hash_of) for lang, texts in said.items()}
    committee = [
        Classifier({lang: "\n".join(texts[n::COMMITTEE][:MEMBER]).encode() for lang, texts in shuffled.items() if texts[n::COMMITTEE]}) for n in range(COMMITTEE)
    ]
    seats = {(lang, p): n % COMMITTEE for lang, texts in shuffled.items() for n, p in enumerate(texts) if n // COMMITTEE < MEMBER}
    clean: dict[str, list[str]] = {}
    for lang, texts in shuffled.items():
        for p in texts:
            total = dict.fromkeys(shuffled, 0)
            for n, one in enumerate(committee):
                if seats.get((lang, p)) != n:  # no dictionary judges its own text
                    for size, code in one.sizes(p):
                        total[code] += size
            first, second = (*sorted(total, key=lambda c: (total[c], c)), None)[:2]
            if first == lang and (second is None or total[second] >= total[first] * (1 + MARGIN)):
                clean.setdefault(lang, []).append(p)
    out = {}
    for lang, texts in sorted(clean.items()):
        content, size = [], 0
        for p in texts:
            data = (p + "\n").encode()
            if size + len(data) > DICTIONARY:
                break
            content.append(data)
            size += len(data)
        if content:
            out[lang] = b"".join(content)
    return Classifier(out)


def hash_of(text: str) -> bytes:
    return hashlib.md5(text.encode("utf-8", "replace"), usedforsecurity=False).digest()


def languages(df: DataFrame, key: str, text: str, classifier: Classifier, label: str | None = None) -> DataFrame:
    """``key``, ``para_no``, ``lang``, ``confidence``, ``main``, ``label`` of every record (0) and paragraph (1, ...).

    A record's language is that of the greatest number of characters of its paragraphs, or that of its
    abstract if it has none; its confidence is the mean of theirs, weighed by length.  A rejected paragraph
    has a null language and counts for none.  Texts that are null or not well formed give no rows, records
    without paragraphs and abstract a null language.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                where, number, lang, sure, main = [], [], [], [], []
                for n, t in enumerate(part.column(1).to_pylist()):
                    if (found := parts(t)) is None:
                        continue
                    paragraphs, abstract = found
                    told = [classifier.language(p) for p in paragraphs]
                    weight: dict[str, list[float]] = {}
                    for (code, lead), p in zip(told, paragraphs, strict=True) if told else [(classifier.language(abstract), abstract)]:
                        if code:
                            got = weight.setdefault(code, [0, 0.0])
                            got[0] += len(p)
                            got[1] += lead * len(p)
                    most = max(weight, key=lambda c: (weight[c][0], c)) if weight else None
                    own = [(most, weight[most][1] / weight[most][0] if most else 0.0), *told]
                    where.extend([n] * len(own))
                    number.extend(range(len(own)))
                    lang.extend(c for c, _ in own)
                    sure.extend(s for _, s in own)
                    main.extend([most] * len(own))
                took = pa.array(where, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(took), pa.array(number, pa.int32()), pa.array(lang, pa.string()), pa.array(sure, pa.float64()), pa.array(main, pa.string()), part.column(2).take(took)],
                    ["__key", "para_no", "lang", "confidence", "main", "label"],
                )

    picked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text"), (F.col(label) if label else F.lit(None).cast("string")).alias("__label")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(run, f"__key {kind}, para_no int, lang string, confidence double, main string, label string").withColumnRenamed("__key", key)


def mislabelled(told: DataFrame) -> DataFrame:
    """Of ``languages``' rows the records whose label is not their language, and the paragraphs in another language than their record."""
    record = (F.col("para_no") == 0) & ~F.col("lang").eqNullSafe(F.col("label"))
    paragraph = (F.col("para_no") > 0) & (F.col("lang") != F.col("main"))
    return told.where(F.col("lang").isNotNull() & (record | paragraph))


_SENTENCE = re.compile(r"(?<=[.!?])\s+")


def segments(df: DataFrame, key: str, text: str, classifier: Classifier) -> DataFrame:
    """``key``, ``seg_no``, ``lang``, ``confidence``, ``chars``: runs of sentences of one language in each text.

    A rejected sentence goes with the run before it.  Null and empty texts give no rows.
    """
    kind = df.schema[key].dataType.simpleString()

    def runs(t: str) -> list[list]:
        out: list[list] = []
        for s in _SENTENCE.split(t.strip()):
            if not s:
                continue
            code, lead = classifier.language(s)
            if out and (code is None or code == out[-1][0] or out[-1][0] is None):
                out[-1][0] = out[-1][0] or code
                out[-1][1] += lead * len(s)
                out[-1][2] += len(s)
            else:
                out.append([code, lead * len(s), len(s)])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(n, k, *r) for n, t in enumerate(batch.column(1).to_pylist()) for k, r in enumerate(runs(t), 1)]
            keys = batch.column(0).take(pa.array([f[0] for f in found], pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [keys, pa.array([f[1] for f in found], pa.int32()), pa.array([f[2] for f in found], pa.string()), pa.array([f[3] / f[4] for f in found], pa.float64()), pa.array([f[4] for f in found], pa.int64())],
                ["__key", "seg_no", "lang", "confidence", "chars"],
            )

    picked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(run, f"__key {kind}, seg_no int, lang string, confidence double, chars bigint").withColumnRenamed("__key", key)
