import pytest
from pyspark.sql import functions as F

from tessellar import schemas
from tessellar.functions import text as tx
from tessellar.operators import assemble, audit, keyed, retrieve


def test_strip_and_fill(spark):
    df = spark.createDataFrame([(" \t a b \n",), ("",), (None,), ("3",), ("123",)], "t string")
    assert [tuple(r) for r in df.select(tx.strip(F.col("t")), tx.zero_fill(F.col("t"))).collect()] == [("a b", " \t a b \n"), ("", "00"), (None, None), ("3", "03"), ("123", "123")]


def test_fix_text_needs_every_layer():
    once = "educação – São".encode().decode("cp1252", "replace")
    assert tx.fix_text(once) == "educação – São"
    assert tx.fix_text("ação".encode().decode("latin-1").encode().decode("latin-1")) == "ação"
    assert tx.fix_text("Ã é") == "Ã é"


def test_last_wins(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), (None, 1, "n"), ("b", 1, None)], "k string, n int, v string")
    assert {tuple(r) for r in keyed.last_wins(df, "k", [F.col("n")]).collect()} == {("a", 3, "z"), (None, 1, "n"), ("b", 1, None)}
    assert keyed.last_wins(df.limit(0), "k", [F.col("n")]).count() == 0


def test_upsert_keeps_untouched_fields(spark):
    old = spark.createDataFrame([("a", "u", "t", True, None, None), ("b", "u", None, None, None, None)], f"ppr_id string, {schemas.PROVENANCE}")
    new = spark.createDataFrame([("a", None, None, None, "p", "q"), ("c", None, None, False, None, None)], f"ppr_id string, {schemas.PROVENANCE}")
    assert {tuple(r) for r in keyed.upsert(old, new, "ppr_id").collect()} == {("a", "u", "t", True, "p", "q"), ("b", "u", None, None, None, None), ("c", None, None, False, None, None)}


def test_merged_log_takes_the_last_value_of_each_field(spark):
    log = spark.createDataFrame([("a", "u1", None, True, 1), ("a", None, None, None, 3), ("a", "u2", "d", None, 2)], "k string, x string, y string, z boolean, at int")
    assert [tuple(r) for r in keyed.merged_log(log, "k", ["at"], ("x", "y", "z")).collect()] == [("a", "u2", "d", True)]


def test_metadata_defaults(spark):
    splits = spark.createDataFrame([("a", "train"), ("a", "train"), ("b", "val")], "ppr_id string, split string")
    lines = spark.createDataFrame([("a", 1, "old", [("n", None, [None, "x"])], None), ("a", 2, "new", [("n", None, [None, "x"])], None)], f"ppr_id string, line_no bigint, doi string, authors {schemas.AUTHORS}, keywords array<string>")
    got = assemble.with_metadata(splits, lines).collect()
    assert len(got) == 3 and got[0].asDict().keys() == {"split", *schemas.names(schemas.METADATA)}
    a = next(r for r in got if r.ppr_id == "a")
    b = next(r for r in got if r.ppr_id == "b")
    assert (a.doi, a.authors[0].orcid, a.authors[0].affiliations, a.keywords, a.xml_ftfy_applied) == ("new", "", ["", "x"], [], False)
    assert (b.doi, b.authors, b.split) == ("", [], "val")


def test_missing_files_raise_before_anything_is_written(spark):
    splits = spark.createDataFrame([("a", "train"), ("b", "val")], "ppr_id string, split string")
    files = spark.createDataFrame([("a", "1\r\n2\r3", bytearray(b"p")), ("b", "x", None)], "ppr_id string, xml string, pdf binary")
    with pytest.raises(FileNotFoundError, match="b"):
        assemble.with_files(splits, files)
    assert [(r.ppr_id, r.xml) for r in assemble.with_files(splits, files, strict=False).collect()] == [("a", "1\n2\n3")]


def articles(spark):
    links = lambda *x: (list(x),)
    return spark.createDataFrame(
        [
            ("PPR007", "t", links(("html", "Europe_PMC", "h"), ("pdf", "Other", "o"), ("pdf", "Europe_PMC", "p"))),
            ("PPR8", None, links(("pdf", "Europe_PMC", None), ("pdf", "Europe_PMC", "late"))),
            ("PPR9", "t", None),
            ("PPR10", "t", (None,)),
            ("PPR11", "t", links()),
            ("PMC12", "t", None),
            ("PPRX", "t", None),
            (None, "t", None),
            ("PPR9", "t", None),
        ],
        schemas.ARTICLES,
    )


def test_first_fitting_link_counts(spark):
    got = retrieve.numbered(articles(spark)).select("number", retrieve.pdf_url(F.col("fullTextUrlList.fullTextUrl")).alias("u"))
    assert sorted(got.distinct().collect()) == [(7, "p"), (8, None), (9, None), (10, None), (11, None)]


def test_needs(spark):
    held = spark.createDataFrame([(7, True, False), (9, True, True), (8, False, False)], "number bigint, has_xml boolean, has_pdf boolean")
    got = {r.number: (r.xml_needed, r.pdf_needed) for r in retrieve.needs(articles(spark), held).collect()}
    assert got == {7: (False, True), 8: (True, False), 10: (True, False), 11: (True, False)}
    # asked for again, nothing that is there counts as needed
    assert {r.number: (r.xml_needed, r.pdf_needed) for r in retrieve.needs(articles(spark), held, False).collect()}[9] == (False, False)


def test_query_text():
    assert retrieve.source_query() == 'PUBLISHER:"SciELO Preprints" AND (IN_EPMC:Y)'
    assert retrieve.source_query("X:1") == 'PUBLISHER:"SciELO Preprints" AND (IN_EPMC:Y AND (X:1))'
    assert retrieve.source_query(full_text=False) == 'PUBLISHER:"SciELO Preprints"'


def test_ranges(spark):
    batches = spark.createDataFrame([("a", 1, 500), ("a", 1, 500), ("b", 501, 1000), ("all", 0, 1 << 40), ("none", 5000, 4000)], schemas.BATCHES)
    ids = spark.createDataFrame([(1,), (500,), (501,), (4096,), (99999,)], "number bigint")
    got = {(r.number, r.url) for r in retrieve.batches_of(ids, batches).collect()}
    assert got == {(1, "a"), (500, "a"), (501, "b"), (1, "all"), (500, "all"), (501, "all"), (4096, "all"), (99999, "all")}
    assert {r.url for r in retrieve.needed_batches(ids.where("number = 4096"), batches).collect()} == {"all"}
    assert retrieve.batches_of(ids, batches.limit(0)).count() == 0 == retrieve.batches_of(ids.limit(0), batches).count()
    assert [r.number for r in retrieve.fetch_list(ids, batches, 2).collect()] == [1, 500]
    assert retrieve.fetch_list(ids, batches, 0).count() == 0


def test_audit(spark):
    entries = spark.createDataFrame([("t", 1, "153551v1/"), ("t", 2, "153551v1/153551v1.xml"), ("t", 3, "153551V1/"), ("t", 4, "153551v2/"), ("t", 5, "index.tsv"), ("t", 6, "x/y"), ("u", 7, "9v1/")], "split string, pos bigint, entry string")
    number, version = audit.versioned(F.col("entry"))
    got = audit.several_versions(entries.select("split", "pos", number.alias("id"), version.alias("version"))).collect()
    assert [tuple(r) for r in got] == [("t", "153551", "v1,V1,v2", 3)]
    assert [r.entry for r in audit.unrecognised(entries).collect()] == ["index.tsv"]
    ids = spark.createDataFrame([("a", "1"), ("b", "1"), ("b", "2"), ("c", None)], "split string, id string")
    assert {tuple(r) for r in audit.cross_split_pairs(audit.distinct_ids(ids), ("a", "b", "c")).collect()} == {("a", "b", 1), ("a", "c", 0), ("b", "c", 0)}
    local = spark.createDataFrame([("1", "train"), ("3", "val")], "id string, split string")
    assert {tuple(r) for r in audit.overlap_counts(local, audit.distinct_ids(ids)).collect()} == {("a", 1), ("b", 1), ("*", 1)}
    assert [tuple(r) for r in audit.overlap_detail(local, audit.distinct_ids(ids), ("b", "a")).collect()] == [("1", "train", "b,a")]
