"""Records of one preprint, and one surviving record for each.

Both questions are answered by a latent two-sided quality model: a claim is true or not, sources
assert it or not, and each source's sensitivity (asserted | true) and specificity (not asserted |
false) are inferred together with the truth by expectation-maximisation.

``same_preprint``: claims are pairs of records, sources are the kinds of evidence: shared passages,
equal DOI, equal title, common authors.
``survivors``: claims are the values of a field within a group, sources are the places the records
come from.  Of a single-valued field the value most surely true is kept; of a multi-valued one every
value judged true.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.llm.forest import components, cut
from tessellar.llm.passages import SHARED, candidates, classes, sequences, shared_part

#: Rounds of expectation-maximisation; both models settle in fewer.
ROUNDS = 12
#: Kinds of evidence, in the order of their votes.
EVIDENCE = ("text", "doi", "title", "authors")
#: Part of the shorter list of authors that two records of one preprint share.
SAME_PEOPLE = 0.5


def plain_doi(doi: Column) -> Column:
    """DOI without its way of writing: resolver, case, final dots and version; null where it is none or a placeholder."""
    bare = F.regexp_replace(F.regexp_extract(F.lower(doi), r"(10\.\d{4,}/\S+)", 1), r"(?:[./]?v\d+)?[./]*$", "")
    bare = F.regexp_replace(bare, r"(?:[./]?v\d+)$", "")
    return F.when((bare != "") & ~bare.rlike(r"[./](?:0+|x+|n/?a|none|tba)$"), bare)


_LONG = re.compile(r"[a-z]{5,}")
_NOT_KEPT = re.compile(r"[^a-z0-9]+")


def _plain(text: str | None) -> str:
    """Lower-case text without accents."""
    if not text or text.isascii():
        return (text or "").lower()
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c)).lower()


def _fold(text: str | None) -> str:
    return _NOT_KEPT.sub("", _plain(text))


def _fronts(df: DataFrame, key: str) -> DataFrame:
    """``k``, ``doi``, ``title`` (folded), ``people`` (words of five letters or more of the authors' names), ``first`` (the least of the first author's)."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            titles = [_fold(t) for t in batch.column(2).to_pylist()]
            found = [[_LONG.findall(_plain(n)) for n in names or ()] for names in batch.column(3).to_pylist()]
            people = [sorted({w for ws in f for w in ws}) for f in found]
            first = [max(f[0], key=lambda w: (len(w), w), default=None) if f else None for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(titles, pa.string()), pa.array(people, pa.list_(pa.string())), pa.array(first, pa.string())], ["k", "doi", "title", "people", "first"])

    picked = df.select(F.col(key).alias("k"), plain_doi(F.col("doi")).alias("doi"), "title", F.transform("authors", lambda a: a["name"]).alias("names"))
    return picked.mapInArrow(run, f"k {kind}, doi string, title string, people array<string>, first string")


def two_sided(patterns: list[tuple[tuple[bool | None, ...], int]], rounds: int = ROUNDS) -> dict[tuple[bool | None, ...], float]:
    """Probability of truth of every pattern of votes, by expectation-maximisation over pattern counts.

    A vote of None is a source that knows nothing of the claim: it neither weighs nor is weighed.
    """
    if not patterns:
        return {}
    width = len(patterns[0][0])
    truth = {v: (sum(x is True for x in v) + 0.5) / (sum(x is not None for x in v) + 1) for v, _ in patterns}
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        share = (sum(truth[v] * n for v, n in patterns) + 1) / (total + 2)
        sens, spec = [], []
        for s in range(width):
            asked = [(v[s], truth[v] * n, (1 - truth[v]) * n) for v, n in patterns if v[s] is not None]
            sens.append((sum(t for said, t, _ in asked if said) + 1) / (sum(t for _, t, _ in asked) + 2))
            spec.append((sum(f for said, _, f in asked if not said) + 1) / (sum(f for _, _, f in asked) + 2))
        for v, _ in patterns:
            odds = math.log(share / (1 - share))
            for s, said in enumerate(v):
                if said is not None:
                    odds += math.log(sens[s] / (1 - spec[s])) if said else math.log((1 - sens[s]) / spec[s])
            truth[v] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
    return truth


def evidence(df: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(members of text classes; ``a``, ``b`` and the four votes of all pairs worth a judgement).

    Pairs are classes that share a passage, and records linked to the least record with their DOI, or with
    their title and first author; so no group is expanded into all its pairs.
    """
    said = cut(sequences(df, key, text))
    member, marks = classes(said)
    member, marks = cut(member), cut(marks)
    front = cut(_fronts(df, key))
    by_doi = front.where("doi IS NOT NULL").select("k", F.col("doi").alias("g"))
    by_title = front.where("length(title) > 12 AND first IS NOT NULL").select("k", F.concat_ws("|", "title", "first").alias("g"))
    stars = []
    for rows in (by_doi, by_title):
        least = rows.groupBy("g").agg(F.min("k").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1").select("g", "a")
        stars.append(rows.join(least, "g").where("k <> a").select("a", F.col("k").alias("b")))
    reps = candidates(marks)
    pairs = cut(reps.union(stars[0]).union(stars[1]).distinct())
    rep = member.select(F.col("k"), "rep")
    textual = pairs.join(rep.select(F.col("k").alias("a"), F.col("rep").alias("ra")), "a", "left").join(rep.select(F.col("k").alias("b"), F.col("rep").alias("rb")), "b", "left")
    unlike = shared_part(textual.where("ra <> rb").select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), marks)
    scored = textual.join(unlike.select(F.col("a").alias("x"), F.col("b").alias("y"), "part"), (F.least("ra", "rb") == F.col("x")) & (F.greatest("ra", "rb") == F.col("y")), "left")
    part = F.when(F.col("ra") == F.col("rb"), F.lit(1.0)).when(F.col("ra").isNotNull() & F.col("rb").isNotNull(), F.coalesce("part", F.lit(0.0)))
    one, two = (front.select(*[F.col(c).alias(f"{c}_{n}") for c in ("k", "doi", "title", "people")]) for n in ("a", "b"))
    joined = scored.select("a", "b", part.alias("part")).join(one, F.col("a") == F.col("k_a")).join(two, F.col("b") == F.col("k_b"))
    people = F.size(F.array_intersect("people_a", "people_b")) >= F.greatest(F.lit(1), F.least(F.size("people_a"), F.size("people_b")) * SAME_PEOPLE)
    votes = {
        "text": F.col("part") >= SHARED,
        "doi": F.col("doi_a") == F.col("doi_b"),
        "title": F.when((F.col("title_a") != "") & (F.col("title_b") != ""), (F.length("title_a") > 12) & (F.col("title_a") == F.col("title_b"))),
        "authors": F.when((F.size("people_a") > 0) & (F.size("people_b") > 0), people),
    }
    return member, joined.select("a", "b", *[votes[v].alias(v) for v in EVIDENCE])


def same_preprint(df: DataFrame, key: str, text: str) -> DataFrame:
    """``id``, ``group``: every record of a preprint that has several, and the least record of its group.

    A record without text, DOI, title and authors in common with others joins no group.
    """
    member, pairs = evidence(df, key, text)
    pairs = cut(pairs)
    # at most three to the number of kinds of evidence rows
    counts = [(tuple(r[v] for v in EVIDENCE), r["count"]) for r in pairs.groupBy(*EVIDENCE).count().collect()]
    truth = two_sided(counts)
    held = [v for v, p in truth.items() if p >= 0.5]
    pattern = F.concat(*[F.coalesce(F.col(v).cast("int").cast("string"), F.lit("-")) for v in EVIDENCE])
    true = pairs.where(pattern.isin(["".join("-" if x is None else str(int(x)) for x in v) for v in held] or [""])).select("a", "b")
    copies = member.where("k <> rep").select(F.col("rep").alias("a"), F.col("k").alias("b"))
    return components(true.union(copies))


#: Fields of a surviving record; those of SEVERAL keep all values judged true.
SINGLE = ("doi", "version", "title", "pub_date", "license", "subject_heading", "subject_europepmc_category", "article_type", "language")
SEVERAL = ("keywords", "author_names")


def _claims(df: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """``group``, ``field``, ``value``, ``source``, ``k`` of every value a grouped record states."""
    rows = df.select(key, *SINGLE, "keywords", "xml_source_url", F.transform("authors", lambda a: a["name"]).alias("author_names")).join(groups.select(F.col("id").alias(key), "group"), key)
    source = F.coalesce(F.nullif(F.regexp_extract("doi", r"(10\.\d{4,})", 1), F.lit("")), F.lit("none"))
    source = F.concat_ws("|", source, F.coalesce(F.nullif(F.col("xml_source_url"), F.lit("")), F.lit("none")))
    single = F.array(*[F.struct(F.lit(c).alias("field"), F.array(F.col(c)).alias("values")) for c in SINGLE])
    several = F.array(*[F.struct(F.lit(c).alias("field"), F.array_distinct(F.coalesce(c, F.array().cast("array<string>"))).alias("values")) for c in SEVERAL])
    exploded = rows.select("group", F.col(key).alias("k"), source.alias("source"), F.explode(F.concat(single, several)).alias("f")).select("group", "k", "source", "f.field", F.explode("f.values").alias("value"))
    said = exploded.where("value IS NOT NULL AND trim(value) <> ''")
    # ways of writing one value are one claim
    same = F.when(F.col("field") == "doi", F.coalesce(plain_doi(F.col("value")), F.col("value"))).when(F.col("field") == "version", F.regexp_replace(F.lower("value"), r"^v?0*|\.0$", "")).otherwise(F.regexp_replace(F.lower("value"), r"[^\p{L}\p{N}]+", ""))
    return said.withColumn("claim", F.xxhash64("group", "field", same))


def judged(df: DataFrame, key: str, groups: DataFrame, rounds: int = 5) -> DataFrame:
    """``group``, ``field``, ``value``, ``truth``, ``said`` (records that state it), ``claim`` of every value in a group.

    A source is silent on a claim if it has a record in the group that states another value of the field.
    Records of one source are counted before anything is joined, so a hot group is as wide as its sources.
    """
    said = cut(_claims(df, key, groups))
    asserts = said.groupBy("group", "field", "claim", "source").agg(F.count_distinct("k").cast("double").alias("yes"))
    spoke = said.groupBy("group", "field", "source").agg(F.count_distinct("k").cast("double").alias("n"))
    claims = asserts.select("group", "field", "claim").distinct()
    seen = claims.join(spoke, ["group", "field"]).join(asserts, ["group", "field", "claim", "source"], "left").withColumn("yes", F.coalesce("yes", F.lit(0.0)))
    votes = cut(seen.select("claim", F.xxhash64("source", "field").alias("s"), "yes", (F.col("n") - F.col("yes")).alias("no")))
    # at first the share of the records that state it
    truth = votes.groupBy("claim").agg((F.sum("yes") / F.sum(F.col("yes") + F.col("no"))).alias("p"))
    for turn in range(rounds):
        weighed = votes.join(truth, "claim")
        quality = weighed.groupBy("s").agg(
            ((F.sum(F.col("p") * F.col("yes")) + 4) / (F.sum(F.col("p") * (F.col("yes") + F.col("no"))) + 5)).alias("sens"),
            ((F.sum((1 - F.col("p")) * F.col("no")) + 4) / (F.sum((1 - F.col("p")) * (F.col("yes") + F.col("no"))) + 5)).alias("spec"),
        )
        gain = F.col("yes") * F.ln(F.col("sens") / (1 - F.col("spec"))) + F.col("no") * F.ln((1 - F.col("sens")) / F.col("spec"))
        truth = votes.join(quality, "s").groupBy("claim").agg((1 / (1 + F.exp(-F.sum(gain)))).alias("p"))
        if turn % 2:
            truth = cut(truth)
    stated = said.groupBy("claim", "group", "field", "value").agg(F.count_distinct("k").alias("said"))
    return stated.join(truth, "claim").select("group", "field", "value", F.col("p").alias("truth"), "said", "claim")


def survivors(df: DataFrame, key: str, groups: DataFrame) -> DataFrame:
    """One row a group: ``group`` and every field, built value by value.

    Of equally sure values one without lost characters counts, then one not all in capitals, then the one
    stated by more records, then the longer, then the greater one.
    Fields nobody states are null or empty.
    """
    values = judged(df, key, groups)
    form = F.struct(F.round("truth", 6), (~F.col("value").contains("\ufffd")).alias("whole"), (F.col("value") != F.upper("value")).alias("mixed"), F.coalesce(F.col("value") == plain_doi(F.col("value")), F.lit(False)).alias("plain"), "said", F.length("value").alias("length"), "value")
    best = values.where(F.col("field").isin(*SINGLE)).groupBy("group", "field").agg(F.max_by("value", form).alias("value"))
    single = best.groupBy("group").pivot("field", list(SINGLE)).agg(F.first("value"))
    sure = values.where(F.col("field").isin(*SEVERAL)).where("truth >= 0.5").groupBy("group", "field", "claim").agg(F.max_by("value", form).alias("value"))
    several = sure.groupBy("group").pivot("field", list(SEVERAL)).agg(F.array_join(F.sort_array(F.collect_set("value")), "|"))
    base = groups.select("group").distinct()
    return base.join(single, "group", "left").join(several, "group", "left")
