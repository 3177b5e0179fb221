"""Registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessellar.llm.language import fitted, languages, mislabelled, segments
from tessellar.llm.lookalike import form_sql, forms, lookalike_pairs
from tessellar.llm.mixing import mix, shares
from tessellar.llm.mojibake import repair_texts
from tessellar.llm.forest import cut
from tessellar.llm.grouped import grouped_split, related_pairs, relations
from tessellar.llm.names import author_persons, mentions, name_pairs, organisations
from tessellar.llm.packing import filling, packed
from tessellar.llm.passages import cross_split
from tessellar.llm.preprints import same_preprint, survivors
from tessellar.llm.sizes import token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _told(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "hf_dataset")
    return languages(df, "ppr_id", "xml", fitted(df, "ppr_id", "xml", "language"), "language")


@query()
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose label is not their language, and paragraphs in another language than their record."""
    return mislabelled(_told(spark, sf_dir)).select("ppr_id", "para_no", "lang")


@query()
def p1_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every record (0) and body paragraph."""
    return _told(spark, sf_dir).select("ppr_id", "para_no", "lang", "confidence")


@query()
def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every run of sentences of one language in every document."""
    df = read(spark, sf_dir, "hf_dataset")
    return segments(read(spark, sf_dir, "documents"), "doc_id", "text", fitted(df, "ppr_id", "xml", "language"))


@query()
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spellings of one person or one organisation, in pairs."""
    return name_pairs(read(spark, sf_dir, "hf_dataset"), "ppr_id", "authors")


@query()
def p2_organisations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spelling of an affiliation and the least spelling of its organisation."""
    return organisations(mentions(read(spark, sf_dir, "hf_dataset"), "ppr_id", "authors"))


@query()
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose XML holds spoilt text."""
    return repair_texts(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml").select("ppr_id")


@query()
def p3_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every spoilt record's text as far as it can be restored, and the kinds of damage."""
    return repair_texts(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml")


def _related(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = read(spark, sf_dir, "hf_dataset")
    return cut(relations(author_persons(df, "ppr_id", "authors"), same_preprint(df, "ppr_id", "xml"), "ppr_id"))


@query()
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that list one person or are of one preprint, in pairs."""
    return related_pairs(_related(spark, sf_dir)).select(F.col("a").alias("ppr_id_a"), F.col("b").alias("ppr_id_b"))


@query()
def p4_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A split for every record, related records together."""
    keys = read(spark, sf_dir, "hf_dataset").select(F.col("ppr_id").alias("k"))
    return grouped_split(keys, _related(spark, sf_dir)).select(F.col("k").alias("ppr_id"), F.col("group").alias("group_ppr_id"), "split")


def _overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    splits = read(spark, sf_dir, "split_assignments").select(F.col("ppr_id").alias("k"), (F.col("split") == "train").alias("train")).distinct()
    return cut(cross_split(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml", splits))


@query()
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two records of one preprint, one of them in train, the other in val or test."""
    rows = _overlapping(spark, sf_dir)
    train, held = (rows.where(F.col("train") == t).select("group", F.col("id").alias(n)) for t, n in ((True, "t"), (False, "e")))
    return train.join(held, "group").where("t <> e").select(F.least("t", "e").alias("ppr_id_a"), F.greatest("t", "e").alias("ppr_id_b")).distinct()


@query()
def p5_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that overlap with the other side, by split and by batch file they come from."""
    rows = _overlapping(spark, sf_dir).select(F.col("id").alias("ppr_id")).distinct()
    named = read(spark, sf_dir, "split_assignments").distinct().join(rows, "ppr_id").join(read(spark, sf_dir, "hf_dataset").select("ppr_id", "xml_source_url"), "ppr_id")
    return named.groupBy("split", F.col("xml_source_url").alias("source")).agg(F.count(F.lit(1)).alias("n"))


@query()
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record that shares its preprint with another, and the smallest record of its group."""
    return same_preprint(read(spark, sf_dir, "hf_dataset"), "ppr_id", "xml").select(F.col("id").alias("ppr_id"), F.col("group").alias("group_ppr_id"))


@query()
def p6_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The surviving record of every preprint with several records, built field by field."""
    df = read(spark, sf_dir, "hf_dataset")
    return survivors(df, "ppr_id", same_preprint(df, "ppr_id", "xml")).withColumnRenamed("group", "group_ppr_id")


def _packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = token_counts(read(spark, sf_dir, "documents"), "doc_id", "text")
    kinds = read(spark, sf_dir, "container_kinds").select(F.col("container_kind").alias("kind"), F.col("capacity_tokens").alias("capacity"))
    return packed(sized, kinds, "doc_id", "tokens")


@query()
def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The container of every document, or piece of a document longer than the capacity, for every kind."""
    return _packed(spark, sf_dir).select(F.col("kind").alias("container_kind"), "container", "doc_id", "piece", "tokens")


@query()
def p8_filling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers of every kind, and how full they are."""
    return filling(_packed(spark, sf_dir)).withColumnRenamed("kind", "container_kind")


def _mixed(spark: SparkSession, sf_dir: str, whole: bool = False) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    targets = read(spark, sf_dir, "source_targets")
    listed = docs.join(targets.select("source"), "source", "left_semi")
    sized = token_counts(listed, "doc_id", "text").join(listed.select("doc_id", "source"), "doc_id")
    sized = cut(sized)
    return mix(sized, targets, "doc_id", sized.agg(F.sum("tokens")).first()[0] or 0 if whole else None)


@query()
def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix in order: every use of a document, up to the budget."""
    return _mixed(spark, sf_dir)


@query()
def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual share of every source."""
    return shares(_mixed(spark, sf_dir), read(spark, sf_dir, "source_targets"))


@query()
def p9_whole_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix as large as all listed sources together; small sources repeat as often as they may, then run out."""
    return _mixed(spark, sf_dir, whole=True)


@query()
def p9_whole_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and actual shares of ``p9_whole_mix``."""
    return shares(_mixed(spark, sf_dir, whole=True), read(spark, sf_dir, "source_targets"))


@query(
    f"""WITH f AS (SELECT doc_id, text, {form_sql('text')} AS form FROM documents WHERE text IS NOT NULL)
SELECT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM f a JOIN f b ON a.form = b.form AND a.doc_id < b.doc_id AND a.text <> b.text"""
)
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that look the same but differ in characters."""
    return lookalike_pairs(read(spark, sf_dir, "documents"), "doc_id", "text")


@query(f"SELECT doc_id, {form_sql('text')} AS form FROM documents WHERE text IS NOT NULL")
def p10_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text in one consistent form."""
    return forms(read(spark, sf_dir, "documents"), "doc_id", "text")
