import argparse
import gzip
import io
import json
import types

import pyarrow.parquet as pq
import pytest
from test_sources import article

from tessellar import __main__ as cli
from tessellar.operators.retrieve import source_query


@pytest.fixture
def folder(tmp_path):
    docs = tmp_path / "docs"
    docs.mkdir()
    for n in range(1, 21):
        (docs / f"PPR{n}.xml").write_text(article(n))
        (docs / f"PPR{n}.pdf").write_bytes(b"%PDF")
    return tmp_path


def test_metadata_split_assemble(spark, folder, capsys):
    run = lambda *a: cli.main([str(x) for x in a], spark)
    assert run("metadata", folder / "docs", folder / "m") == 0
    assert run("split", folder / "m", folder / "s") == 0
    assert "train=4 val=6 test=10 (total=20)" in capsys.readouterr().out
    assert run("assemble", folder / "docs", folder / "s", folder / "m", folder / "out") == 0
    assert run("split", folder / "m", folder / "x", "--train", "0.7", "--val", "0.3") == 1
    got = {p.name.split("-")[0]: sum(pq.read_table(q).num_rows for q in (folder / "out").glob(p.name.split("-")[0] + "*")) for p in (folder / "out").glob("*.parquet")}
    assert got == {"train": 4, "validation": 6, "test": 10}
    assert run("split-parquet", "--input-dir", folder / "out", "--output-dir", folder / "again") == 0
    assert sum(pq.read_table(q).num_rows for q in (folder / "again").glob("*.parquet")) == 20
    (folder / "docs" / "PPR3.pdf").unlink()
    assert run("assemble", folder / "docs", folder / "s", folder / "m", folder / "out2") == 1 and not (folder / "out2").exists()


def transport():
    links = lambda n: {"fullTextUrl": [{"documentStyle": "pdf", "site": "Europe_PMC", "url": f"http://x/{n}.pdf"}]}

    def get_json(url, params):
        assert params["query"] == source_query("")
        return {"resultList": {"result": [{"id": f"PPR{n}", "title": "t", "fullTextUrlList": links(n)} for n in (1, 2, 3)] + [{"id": "PMC9"}]}}

    def fetch(url):
        if url.endswith("2.pdf"):
            raise OSError("gone")
        return b"%PDF"

    batch = gzip.compress(("<articles>" + "".join(article(n, "LuxÃºria") for n in (1, 2)) + "</articles>").encode())
    return types.SimpleNamespace(get_json=get_json, fetch=fetch, get_text=lambda url: '<a href="PPR1_PPR500.xml.gz">x</a>', open_batch=lambda url: io.BytesIO(batch))


def test_retrieve_writes_once(spark, tmp_path, capsys):
    out = tmp_path / "o"
    out.mkdir()
    (out / "PPR1.provenance.json").write_text(json.dumps({"pdf_source_url": "old"}))
    a = argparse.Namespace(output_dir=str(out), api="http://api", batches="http://b", limit=None, query="", page_size=100, skip_existing=True)
    assert cli._retrieve(spark, a, transport()) == "Finished. Downloaded: 2"
    assert "Luxúria" in (out / "PPR1.xml").read_text() and "LuxÃºria" in (out / "PPR1.xml.original").read_text() and not (out / "PPR3.xml").exists()
    one, two = (json.loads((out / f"PPR{n}.provenance.json").read_text()) for n in (1, 2))
    assert one["pdf_source_url"] == "http://x/1.pdf" and one["xml_ftfy_applied"] is True and "pdf_source_url" not in two
    assert (out / "PPR1.pdf").exists() and not (out / "PPR2.pdf").exists() and "PPR2" in capsys.readouterr().err
    (out / "PPR1.xml").write_text("kept")
    a.limit = 1
    cli._retrieve(spark, a, transport())
    assert (out / "PPR1.xml").read_text() == "kept"
