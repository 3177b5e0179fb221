import pytest

from tessellar.operators import xmlmeta
from tessellar.operators.xmlmeta import read_article

HEAD = '<article xmlns:ali="http://www.niso.org/schemas/ali/1.0/" xml:lang="{lang}" article-type="preprint"><front><article-meta>{meta}</article-meta></front></article>'


def read(meta="", lang="pt"):
    return read_article(HEAD.format(lang=lang, meta=meta))


@pytest.mark.parametrize(("raw", "code"), [("pt", "pt"), ("PT", "pt"), ("po", "pt"), ("PO", "po"), ("sp", "es"), ("SP", "sp"), ("ES", "es"), ("FR", "fr"), ("", "")])
def test_language(raw, code):
    got = read(lang=raw)
    assert (got["language"], got["language_raw"]) == (code, raw)


def test_last_doi_and_version_count():
    got = read('<article-id pub-id-type="doi"> 10.1/a </article-id><article-id pub-id-type="doi">10.1/b</article-id><article-id pub-id-type="archive">PPR1</article-id>')
    assert got["doi"] == "10.1/b"
    got = read('<article-version-alternatives><article-version article-version-type="number">1</article-version><article-version article-version-type="number">2</article-version></article-version-alternatives>')
    assert got["version"] == "2"


def test_title_is_the_lead_text_only():
    assert read("<title-group><article-title>Foo <italic>bar</italic> baz</article-title></title-group>")["title"] == "Foo"
    assert read("<title-group><article-title><italic>bar</italic> baz</article-title></title-group>")["title"] == ""


def contrib(inner):
    return read(f"<contrib-group><contrib>{inner}</contrib></contrib-group>"
                '<aff id="a1"><label>1</label> Uni <institution>X <b>deep</b></institution>, Y</aff><aff id="a2"/><aff id="a1b">old</aff><aff id="a1b">new</aff>')["authors"]


NAME = "<name><given-names> Ana </given-names><surname>Silva\xa0</surname></name>"


def test_authors():
    assert contrib(NAME) == [{"name": "Ana Silva", "orcid": "", "affiliations": []}]
    assert contrib("<collab>Group</collab>") == [] == contrib("<name><surname> </surname></name>")
    assert contrib(NAME + '<contrib-id contrib-id-type="orcid">1</contrib-id><contrib-id contrib-id-type="orcid">2</contrib-id>')[0]["orcid"] == "1"


def test_affiliations():
    got = lambda x: contrib(NAME + x)[0]["affiliations"]
    assert got('<xref ref-type="aff" rid="a1b"/><xref ref-type="aff" rid="a1"/>') == ["new", "Uni X , Y"]
    assert got('<xref ref-type="corresp" rid="a1"/><aff>Own</aff><aff> </aff>') == ["Own"]
    assert got('<xref ref-type="aff" rid="none"/><aff>Own</aff>') == ["Own"]
    assert got('<xref ref-type="aff" rid="a2"/><aff>Own</aff>') == [""]


@pytest.mark.parametrize(
    ("parts", "want"),
    [("<year>2022</year><month>3</month><day>5</day>", "2022-03-05"), ("<year>2022</year>", "2022-00-00"), ("<month>3</month><day>5</day>", "03-05"), ("", "00-00"), ("<year>2022</year><month>123</month><day>1</day>", "2022-123-01")],
)
def test_dates(parts, want):
    assert read(f'<pub-date pub-type="epub"><year>1</year></pub-date><pub-date pub-type="preprint">{parts}</pub-date>')["pub_date"] == want


def test_license_keywords_subjects():
    got = read(
        "<permissions><license><ali:license_ref> </ali:license_ref><ali:license_ref>u</ali:license_ref></license></permissions>"
        "<kwd-group><kwd> a </kwd><kwd> </kwd></kwd-group><kwd-group><kwd>a</kwd><kwd><i>x</i></kwd></kwd-group>"
        '<article-categories><subj-group subj-group-type="europepmc-category"><subject>A</subject></subj-group><subj-group subj-group-type="europepmc-category"><subject>B</subject></subj-group><subj-group><subject>C</subject></subj-group></article-categories>'
    )
    assert got["license"] == "" and got["keywords"] == ["a", "a"] and dict(got["subjects"]) == {"europepmc_category": "B"}


def test_bare_and_broken():
    assert read_article("<article/>")["authors"] == [] and read_article("<article/>")["pub_date"] == ""
    assert read_article("not xml") is read_article("") is read_article(None) is None


def test_rows(spark):
    rows = [("PPR1", HEAD.format(lang="pt", meta=""), 1), ("PPR2", "not xml", 2), ("PPR3", None, 3), (None, "<article/>", 4)]
    df = spark.createDataFrame(rows, "ppr_id string, xml string, doi int")
    assert {r.ppr_id for r in xmlmeta.read_articles(df, "ppr_id", "xml").collect()} == {"PPR1", None}
    assert {r.ppr_id for r in xmlmeta.unreadable(df.where("ppr_id is not null"), "ppr_id", "xml").collect()} == {"PPR2", "PPR3"}
    assert xmlmeta.read_articles(df.limit(0), "ppr_id", "xml").count() == 0


def test_repair_and_its_flag(spark):
    df = spark.createDataFrame([("<p>LuxÃºria</p>",), ("<p>plain</p>",), (None,), ("",), ("São Ãº" * 3000,)], "xml string")
    got = [(r.xml, r.xml_changed) for r in xmlmeta.repaired(df, "xml").collect()]
    assert got[:4] == [("<p>Luxúria</p>", True), ("<p>plain</p>", False), (None, False), ("", False)]
    assert got[4] == ("São ú" * 3000, True)
