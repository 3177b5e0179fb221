import gzip
import io
import json
import zipfile

import pytest

from tessellar import schemas
from tessellar.plans import dataset as plan
from tessellar.sources import batches, files, remote, sinks
from tessellar.streaming.incremental import new_articles


def article(n, body="x"):
    return f'<article xml:lang="pt" article-type="preprint"><front><article-meta><article-id pub-id-type="archive">PPR{n}</article-id></article-meta></front><body><p>{body}</p></body></article>'


@pytest.fixture
def folder(tmp_path):
    for n in range(1, 21):
        (tmp_path / f"PPR{n}.xml").write_bytes(article(n, "a\r\nb").encode())
        (tmp_path / f"PPR{n}.pdf").write_bytes(b"%PDF")
    (tmp_path / "PPR1.xml.original").write_text("old")
    (tmp_path / "PPR1.provenance.json").write_text(json.dumps({"xml_source_url": "u", "xml_ftfy_applied": True}))
    (tmp_path / "PPR_77.xml").write_text(article(77))
    (tmp_path / "PPR_77.pdf").write_bytes(b"%PDF")
    (tmp_path / "PPR99.xml").write_text("not xml")
    return str(tmp_path)


def test_corpus_listing(spark, folder):
    got = files.read_xml(spark, folder).collect()
    assert len(got) == 22 and {r.ppr_id for r in got} >= {"PPR1", "PPR77", "PPR99"} and not any("\r" in r.xml for r in got)
    held = {r.number: (r.has_xml, r.has_pdf) for r in files.existing(spark, folder).collect()}
    assert held[1] == (True, True) and held[99] == (True, False) and 77 not in held
    with pytest.raises(ValueError):
        files.read_xml(spark, folder, "NONE*.xml")


def test_whole_run(spark, folder, tmp_path):
    df = plan.dataset(spark, folder)
    rows = df.collect()
    assert len(rows) == 21 and df.columns == ["split", *schemas.names(schemas.DATASET)]
    one = next(r for r in rows if r.ppr_id == "PPR1")
    assert (one.xml_source_url, one.xml_ftfy_applied, one.pdf_source_url, bytes(one.pdf)) == ("u", True, "", b"%PDF")
    names = sinks.name_split_files(df.coalesce(1), str(tmp_path / "out"))
    assert names == ["test-00000-of-00001.parquet", "train-00000-of-00001.parquet", "validation-00000-of-00001.parquet"]
    back = files.read_parquets(spark, str(tmp_path / "out"))
    assert {r.file_split: r["count"] for r in back.groupBy("file_split").count().collect()} == {"train": 4, "validation": 6, "test": 11}
    seen_df, seen = plan.counted(df)
    seen_df.write.format("noop").mode("overwrite").save()
    assert seen.get["n"] == 21


def test_jsonl_and_csv(spark, tmp_path):
    p = tmp_path / "in.jsonl"
    p.write_text('{"ppr_id": "a", "title": "ã"}\n\n{"ppr_id": "b", "authors": [{"name": "n", "orcid": null, "affiliations": []}]}\n')
    df = files.read_jsonl(spark, str(p))
    assert df.count() == 2
    sinks.write_jsonl(df, str(tmp_path / "o"), 1)
    text = "".join(f.read_text() for f in (tmp_path / "o").glob("part*"))
    assert '"doi":null' in text and "ã" in text
    (tmp_path / "bad.jsonl").write_text("{bad\n")
    with pytest.raises(Exception):
        files.read_jsonl(spark, str(tmp_path / "bad.jsonl")).collect()
    sinks.write_csv(spark.createDataFrame([("a", "train")], "ppr_id string, split string"), str(tmp_path / "c"), 1)
    assert next((tmp_path / "c").glob("part*")).read_bytes() == b"ppr_id,split\r\na,train\r\n"
    assert files.read_csv(spark, str(tmp_path / "c")).collect() == [("a", "train")]
    with pytest.raises(ValueError):
        files.union_all([])
    sinks.write_sidecars(spark.createDataFrame([("u", None, None, None, None), (None,) * 5], schemas.PROVENANCE), str(tmp_path / "s"))
    assert sum(len(f.read_text().splitlines()) for f in (tmp_path / "s").glob("part*")) == 1


def packed(*numbers):
    return gzip.compress(("<articles>" + "".join(article(n) for n in numbers) + "</articles>").encode())


def test_batch_stream_stops_early_and_resumes():
    assert [n for n, _ in batches.articles_in(io.BytesIO(gzip.decompress(packed(1, 2, 2, 3))), {2, 3})] == [2, 3]
    broken = b"<articles>" + article(1).encode() + b"<article><oops"
    assert next(batches.articles_in(io.BytesIO(broken), {1}))[0] == 1
    tries, naps = [], []

    def flaky(url):
        tries.append(url)
        return io.BytesIO(gzip.compress(broken) if len(tries) == 1 else packed(1, 2))

    assert [n for n, _ in batches.fetched("u", {1, 2}, flaky, naps.append)] == [1, 2] and naps == [5]
    with pytest.raises(OSError):
        list(batches.fetched("u", {1}, lambda u: (_ for _ in ()).throw(OSError("down")), naps.append))
    assert naps == [5, 5, 30, 120]


def test_batches_on_spark(spark):
    wanted = spark.createDataFrame([(1, "a"), (2, "a"), (9, "b")], "number bigint, url string")
    data = {"a": packed(1, 2, 3), "b": packed(8)}
    got = batches.read_batches(wanted, lambda u: io.BytesIO(data[u]))
    assert {(r.ppr_id, r.batch_url) for r in got.collect()} == {(1, "a"), (2, "a")}
    page = spark.createDataFrame([('<a href="PPR501_PPR1000.xml.gz">PPR501_PPR1000.xml.gz</a><a href="PPR1_PPR500.xml.gz">',), ("",), (None,)], "html string")
    rows = batches.batch_links(page, "html", "http://x/").orderBy("start_id").collect()
    assert [r.start_id for r in rows] == [1, 501, 501] and rows[0].url == "http://x/PPR1_PPR500.xml.gz"


def test_failed_files_are_reported(spark):
    def fetch(url):
        if url == "bad":
            raise OSError("gone")
        return b"ok"

    df = spark.createDataFrame([(1, "good"), (2, "bad"), (3, None)], "k int, url string")
    got = {r.k: (r.content, r.error) for r in batches.fetch_files(df, "k", "url", fetch).collect()}
    assert got[1][0] == b"ok" and "gone" in got[2][1] and 3 not in got


def pages(url, params):
    if params["resultType"] == "idlist":
        return {"hitCount": 3}
    first = {"resultList": {"result": [{"id": "PPR1", "title": "t"}, {"id": "PPR2", "fullTextUrlList": {"fullTextUrl": [{"documentStyle": "pdf", "site": "Europe_PMC", "url": "u"}]}}]}, "nextCursorMark": "n"}
    return first if params["cursorMark"] == "*" else {"resultList": {"result": [{"id": "PPR3"}]}, "nextCursorMark": "n"}


def test_remote_sources(spark):
    assert [r["id"] for r in remote.cursor_pages(pages, "u", "q")] == ["PPR1", "PPR2", "PPR3"]
    assert remote.hit_count(pages, "u", "q") == 3 and remote.hit_count(lambda u, p: {}, "u", "q") == 0
    spark.dataSource.register(remote.article_source(pages, "u"))
    got = {r.id: r for r in spark.read.format("articles").load().collect()}
    assert got["PPR2"].fullTextUrlList.fullTextUrl[0].url == "u" and got["PPR1"].fullTextUrlList is None
    blob = io.BytesIO()
    with zipfile.ZipFile(blob, "w") as z:
        for n in ("1v1/", "1v1/1v1.xml"):
            z.writestr(n, "x")
    data = blob.getvalue()
    spark.dataSource.register(remote.archive_source(lambda url: remote.RangeFile(len(data), lambda a, b: data[a : b + 1])))
    rows = spark.read.format("archives").option("archives", json.dumps({"train": "u", "test": "v"})).load().collect()
    assert {tuple(r) for r in rows} == {(s, n, e) for s in ("train", "test") for n, e in enumerate(("1v1/", "1v1/1v1.xml"))}
    f = remote.RangeFile(3, lambda a, b: b"abc"[a : b + 1])
    assert f.seek(5) == 5 and f.read() == b"" and f.seek(-2, 2) == 1 and f.read(-1) == b"bc"


def test_incremental_run_adds_only_new_files(spark, folder, tmp_path):
    out, state = str(tmp_path / "o"), str(tmp_path / "st")
    assert new_articles(spark, folder, out, state) == 22
    assert new_articles(spark, folder, out, state) == 0
    assert spark.read.parquet(out).count() == 21


def test_stored_never_overwrites(spark):
    fetched = spark.createDataFrame([(1, "<p>LuxÃºria</p>", "u"), (2, "<p>b</p>", "u")], "ppr_id bigint, xml string, batch_url string").selectExpr("*", "timestamp'2024-01-15 10:30:00' AS downloaded_at")
    wanted = spark.createDataFrame([(1, True), (2, False)], "number bigint, xml_needed boolean")
    old = spark.createDataFrame([(1, None, None, None, "p", "q")], f"ppr_id bigint, {schemas.PROVENANCE}")
    texts, log = plan.stored(fetched, wanted, old)
    assert [(r.ppr_id, r.xml, r.xml_original) for r in texts.collect()] == [(1, "<p>Luxúria</p>", "<p>LuxÃºria</p>")]
    assert [tuple(r) for r in log.collect()] == [(1, "u", "2024-01-15T10:30:00+00:00", True, "p", "q")]
