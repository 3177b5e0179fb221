"""Records as sequences of sentences, and records that share passages.

A record is the sequence of the sentences of its paragraphs, each reduced to its ASCII letters and
digits, so that spoilt, re-accented and re-cased copies stay equal; a sentence is its 64-bit hash.
A passage is a pair of neighbouring sentences; short records also count their beginning.

``similar`` joins records by shared passages without expanding what is common: copies are one class,
and of a passage borne by many records only those search by it that need it (prefix filter: two records
that share 0.4 of the shorter one's passages share one of its 0.6 rarest).  ``covered`` scans training
records with Aho-Corasick automata over the evaluation records' passages, one automaton a shard.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.forest import components, cut, sent

#: Share of the passages of the shorter record from which two records are of one text.
SHARED = 0.4
#: Records of fewer sentences also count their beginning, as one changed sentence takes two passages.
SHORT = 8
#: Shortest reduced sentence that counts.
LETTERS = 12
#: Records bearing a passage from which the prefix filter applies to it.
COMMON = 20
#: Passages in one automaton (about 60 MB).
SHARD = 100_000
#: Records per Arrow slice.
SLICE = 500

_OPEN = re.compile(r"<p(?:\s[^>]*)?>")
_END = re.compile(rb"[.!?]\s+")
_TAG = re.compile(r"<[^>]*>|&[#\w]+;")
_SPACES = "\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
_KEPT = b"abcdefghijklmnopqrstuvwxyz0123456789"
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_DROPPED = bytes(c for c in range(256) if _LOWER[c] not in _KEPT)


def _paragraphs(text: str) -> Iterator[str]:
    """What is between each ``<p>`` and the next ``</p>``."""
    at = 0
    while (m := _OPEN.search(text, at)) and (end := text.find("</p>", m.end())) >= 0:
        yield text[m.end() : end]
        at = end + 4


def sentence_hashes(text: str | None) -> list[int]:
    """Hashes (signed 64 bits) of the reduced sentences of all paragraphs, in order."""
    if not text:
        return []
    if not text.isascii():
        for c in _SPACES:
            if c in text:
                text = text.replace(c, " ")
    parts = [_TAG.sub("", p) if "<" in p or "&" in p else p for p in _paragraphs(text)]
    out = []
    for s in _END.split(".\n".join(parts).encode("ascii", "ignore")):
        kept = s.translate(_LOWER, _DROPPED)
        if len(kept) > LETTERS:
            h = xxhash.xxh3_64_intdigest(kept)
            out.append(h - (1 << 64) if h >> 63 else h)
    return out


def sequences(df: DataFrame, key: str, text: str) -> DataFrame:
    """``k``, ``said``: every record's sentences; records without any, or with a null text, have an empty list."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([sentence_hashes(t) for t in part.column(1).to_pylist()], pa.list_(pa.int64()))], ["k", "said"])

    return df.select(F.col(key).alias("k"), F.col(text).alias("t")).mapInArrow(run, f"k {kind}, said array<bigint>")


def classes(said: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``k``, ``rep`` of every record with sentences; ``rep``, ``marks`` of every class of equal sequences).

    ``marks`` are the distinct passages of a class, as 64-bit hashes.
    """
    full = said.where("size(said) > 0").withColumn("copy", F.xxhash64("said"))
    least = full.groupBy("copy").agg(F.min_by("said", "k").alias("said"), F.min("k").alias("rep"))
    member = full.select("k", "copy").join(least.select("copy", "rep"), "copy").select("k", "rep")
    begun = F.when(F.size("said") < SHORT, F.concat(F.array(F.lit(0).cast("bigint")), "said")).otherwise(F.col("said"))
    pairs = F.transform(F.sequence(F.lit(1), F.size("b") - 1), lambda n: F.xxhash64(F.get("b", n - 1), F.get("b", n)))
    return member, least.select("rep", begun.alias("b")).where("size(b) > 1").select("rep", F.array_distinct(pairs).alias("marks"))


def _postings(marks: DataFrame) -> DataFrame:
    """``mark``, ``rep``, ``n`` (passages of the record), ``df``, ``lead`` (among those the record searches by) of passages borne by several."""
    one = marks.select("rep", F.size("marks").alias("n"), F.explode("marks").alias("mark"))
    counts = sent(one.groupBy("mark").agg(F.count(F.lit(1)).alias("df")).where("df > 1"))
    held = cut(one.join(counts, "mark"))
    # how many rarer passages the record has: those borne by it alone, and the held ones before this one
    hot = held.where(F.col("df") > COMMON)
    rarer = held.groupBy("rep").agg(F.count_if(F.col("df") <= COMMON).alias("cool"), F.count_if(F.col("df") > COMMON).alias("warm"))
    ranked = hot.groupBy("rep", "n").agg(F.array_sort(F.collect_list(F.struct("df", "mark"))).alias("w")).join(rarer, "rep")
    first = F.greatest(F.lit(0), F.col("n") - F.ceil(F.col("n") * SHARED) + 1 - (F.col("n") - F.col("warm")))
    warm = ranked.select("rep", "n", F.posexplode("w").alias("at", "x"), first.cast("int").alias("first")).select(F.col("x.mark").alias("mark"), "rep", "n", F.col("x.df").alias("df"), (F.col("at") < F.col("first")).alias("lead"))
    return held.where(F.col("df") <= COMMON).select("mark", "rep", "n", "df", F.lit(True).alias("lead")).unionByName(warm)


def candidates(marks: DataFrame) -> DataFrame:
    """``a`` < ``b``: classes that share a passage one of them searches by."""
    posted = cut(_postings(marks))
    # passages of few records: their lists are bounded by COMMON, so pairs are made in place
    lists = posted.where(F.col("df") <= COMMON).groupBy("mark").agg(F.array_sort(F.collect_list("rep")).alias("m"))
    some = lists.select(F.explode("m").alias("a"), "m").select("a", F.explode("m").alias("b")).where("a < b")
    hot = posted.where(F.col("df") > COMMON)
    met = hot.where("lead").select("mark", F.col("rep").alias("x")).join(hot.select("mark", F.col("rep").alias("y")), "mark").where("x <> y")
    return some.union(met.select(F.least("x", "y"), F.greatest("x", "y"))).distinct()


def shared_part(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """``pairs`` with ``part``: shared passages as a part of those of the shorter record; 0 where one has none."""
    a, b = (marks.select(F.col("rep").alias(x), F.col("marks").alias(f"m{x}")) for x in ("a", "b"))
    both = pairs.join(a, "a", "left").join(b, "b", "left")
    part = F.size(F.array_intersect("ma", "mb")) / F.least(F.size("ma"), F.size("mb"))
    return both.withColumn("part", F.coalesce(part, F.lit(0.0))).drop("ma", "mb")


def similar(marks: DataFrame) -> DataFrame:
    """``a`` < ``b``: every two classes that share enough passages."""
    return shared_part(candidates(marks), marks).where(F.col("part") >= SHARED).select("a", "b")


def _begun() -> F.Column:
    return F.when(F.size("said") < SHORT, F.concat(F.array(F.lit(0).cast("bigint")), "said")).otherwise(F.col("said"))


def matches(evaluation: DataFrame, training: DataFrame, shard_size: int = SHARD) -> DataFrame:
    """``rep`` of a training class, ``mark`` of each evaluation passage found in it, by Aho-Corasick automata.

    A passage belongs to the shard of its first sentence; a text goes to the shards of its own sentences
    only, so the work grows with the text, not with shards times texts.  In a shard the distinct passages
    become one automaton, past which the texts stream; both sides hold classes (``rep``, ``said``).
    """
    symbol = lambda c: F.pmod(c, F.lit((1 << 31) - 1)).cast("int")
    pairs = F.transform(F.sequence(F.lit(1), F.size("b") - 1), lambda n: F.struct(F.get("b", n - 1).alias("x"), F.get("b", n).alias("y")))
    said = cut(evaluation.select(_begun().alias("b")).where("size(b) > 1").select(F.explode(pairs).alias("p")).select("p.x", "p.y").distinct())
    shards = max(1, -(-said.count() // shard_size))
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards)).cast("int")
    kind = training.schema["rep"].dataType.simpleString()
    patterns = said.select(shard(F.col("x")).alias("shard"), F.lit(False).alias("text"), F.lit(None).cast(kind).alias("rep"), F.array(symbol(F.col("x")), symbol(F.col("y"))).alias("symbols"), F.xxhash64("x", "y").alias("mark"))
    texts = training.select("rep", _begun().alias("b")).where("size(b) > 1")
    sent = texts.select("rep", F.explode(F.array_distinct(F.transform("b", shard))).alias("shard"), F.transform("b", symbol).alias("symbols")).select("shard", F.lit(True).alias("text"), "rep", "symbols", F.lit(None).cast("bigint").alias("mark"))
    both = patterns.unionByName(sent).repartition("shard").sortWithinPartitions("shard", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a symbol is written as four characters below 256, so that no node of an automaton has more branches
        at, automaton, waiting = None, None, {}
        for batch in batches:
            rows, marks = [], []
            lists = batch.column(3)
            starts = lists.offsets.to_numpy()
            written = lists.values.to_numpy(zero_copy_only=False).astype(">u4").tobytes().decode("latin-1")
            for n, (shard_no, is_text, mark) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(4).to_pylist(), strict=True)):
                if shard_no != at:
                    at, automaton, waiting = shard_no, None, {}
                symbols = written[4 * starts[n] : 4 * starts[n + 1]]
                if not is_text:
                    waiting[symbols] = mark
                    continue
                if waiting:
                    automaton = ahocorasick.Automaton()
                    for passage, value in waiting.items():
                        automaton.add_word(passage, value)
                    automaton.make_automaton()
                    waiting = {}
                if automaton is not None:
                    found = {value for end, value in automaton.iter(symbols) if end % 4 == 3}
                    rows.extend([n] * len(found))
                    marks.extend(found)
            yield pa.RecordBatch.from_arrays([batch.column(2).take(pa.array(rows, pa.int32())), pa.array(marks, pa.int64())], ["rep", "mark"])

    return both.mapInArrow(run, f"rep {kind}, mark bigint").distinct()


def overlaps(evaluation: DataFrame, training: DataFrame, marks: DataFrame) -> DataFrame:
    """``a`` (training class), ``b`` (evaluation class), ``part``, ``covered``, ``sentences`` of every overlap of SHARED or more.

    Matched intervals are merged: ``covered`` of the ``sentences`` of the evaluation record lie in a matched
    passage.  A passage common to many records brings two together only if one of them searches by it.
    """
    posted = cut(_postings(marks))
    found = cut(matches(evaluation, training))
    warm = posted.where(F.col("df") > COMMON).select("mark", "rep", "lead")
    held = posted.join(evaluation.select("rep"), "rep", "left_semi")
    cool = found.join(held.where(F.col("df") <= COMMON).select("mark", F.col("rep").alias("b")), "mark").select(F.col("rep").alias("a"), "b")
    hot = found.join(warm.withColumnRenamed("lead", "first"), ["mark", "rep"]).select("mark", F.col("rep").alias("a"), "first")
    there = held.where(F.col("df") > COMMON).select("mark", F.col("rep").alias("b"), "lead")
    led = hot.where("first").join(there, "mark").select("a", "b").union(hot.join(there.where("lead"), "mark").select("a", "b"))
    pairs = cool.union(led).where("a <> b").distinct()
    at = F.transform(F.sequence(F.lit(1), F.size("b") - 1), lambda n: F.struct(F.xxhash64(F.get("b", n - 1), F.get("b", n)).alias("mark"), n.alias("at")))
    placed = evaluation.select(F.col("rep").alias("id"), _begun().alias("b")).where("size(b) > 1").select("id", F.size("b").alias("sentences"), F.explode(at).alias("p")).select(F.col("id").alias("b"), "sentences", "p.mark", "p.at")
    hits = pairs.join(placed, "b").join(found.withColumnRenamed("rep", "a"), ["a", "mark"])
    merged = hits.groupBy("a", "b", "sentences").agg(F.count_distinct("mark").alias("shared"), F.size(F.array_distinct(F.flatten(F.collect_list(F.array(F.col("at") - 1, "at"))))).cast("bigint").alias("covered"))
    sizes = marks.select("rep", F.size("marks").alias("n"))
    sized = merged.join(sizes.select(F.col("rep").alias("a"), F.col("n").alias("na")), "a").join(sizes.select(F.col("rep").alias("b"), F.col("n").alias("nb")), "b")
    return sized.withColumn("part", F.col("shared") / F.least("na", "nb")).where(F.col("part") >= SHARED).select("a", "b", "part", "covered", "sentences")


def cross_split(df: DataFrame, key: str, text: str, splits: DataFrame) -> DataFrame:
    """``id``, ``train``, ``group``: records in a group that has train and evaluation records of one text.

    ``splits`` tells ``k`` and ``train`` of each record.  Groups are the components of the overlaps
    between training and evaluation records; equal texts in both are overlaps without a search.
    """
    said = cut(sequences(df, key, text))
    member, marks = classes(said)
    member, marks = cut(member), cut(marks)
    placed = cut(member.join(splits, "k"))
    full = said.where("size(said) > 0").select(F.col("k").alias("rep"), "said")
    sides = {t: full.join(placed.where(F.col("train") == t).select("rep").distinct(), "rep", "left_semi") for t in (True, False)}
    links = overlaps(sides[False], sides[True], marks).select("a", "b")
    group = components(links)
    all_members = placed.join(group, placed.rep == group.id, "left").select(F.col("k").alias("id"), "train", F.coalesce("group", "rep").alias("group"))
    both = all_members.groupBy("group").agg(F.count_if("train").alias("t"), F.count_if(~F.col("train")).alias("e")).where("t > 0 AND e > 0").select("group")
    return all_members.join(both, "group").select("id", "train", "group").distinct()
