import pytest

from tessellar.operators import nested

TEXT = """<article><front><contrib-group>
<contrib><aff id="a1"/><xref ref-type="aff" rid="a2"/><xref ref-type="corresp" rid="a1"/></contrib>
<contrib><xref ref-type="aff" rid="a2"/><xref ref-type="aff" rid="a2"/></contrib></contrib-group>
<aff id="a2"/><aff id="a2"/><abstract><p>no</p></abstract></front>
<body><p>1</p><sec><p>2</p><sec><list><list-item><p>3</p></list-item></list></sec><p>4</p></sec></body>
<back><ref-list><ref/><ref><name/><name/></ref></ref-list></back></article>"""
LINKS = {
    ("contrib", 0, 1), ("contrib", 0, 2), ("contrib_aff", 1, 1), ("contrib_aff", 1, 2), ("contrib_aff", 1, 3), ("contrib_aff", 2, 2), ("contrib_aff", 2, 3),
    ("sec", 0, 1), ("sec", 1, 2), ("p", 0, 1), ("p", 1, 2), ("p", 2, 3), ("p", 1, 4), ("ref", 0, 1), ("ref", 0, 2), ("ref_name", 2, 1), ("ref_name", 2, 2),
}


def test_links(spark):
    df = spark.createDataFrame([("b", TEXT, 1), ("c", "<a><p>", 2), ("d", None, 3), ("e", "", 4), (None, TEXT, 5)], "k string, xml string, no int")
    got = nested.article_links(df, "k", "xml").collect()
    assert len(got) == len(set(got)) == 2 * len(LINKS)
    assert {tuple(r)[1:] for r in got if r.k == "b"} == LINKS == {tuple(r)[1:] for r in got if r.k is None}
    assert nested.article_links(df.limit(0), "k", "xml").count() == 0


def test_inlining_of_repeated_shared_and_recursive_elements():
    plan = nested.inlining([("", "a", 1), ("a", "b", 1), ("b", "c", 1), ("a", "d", 2), ("d", "e", 1), ("b", "s", 1), ("d", "s", 1), ("b", "r", 1), ("r", "q", 1), ("q", "r", 1)])
    assert plan.tables == {"a", "d", "s", "r"}
    assert plan.columns == {"b": "b", "c": "b/c", "e": "e", "q": "q"}


def test_shredded_rows_can_be_put_together_again(spark):
    df = spark.createDataFrame([("k", '<a x="1"><b>t<c y="2">u</c></b><d id="i">v</d><d>w<e>z</e></d><f rid="i"/></a>')], "k string, xml string")
    plan = nested.derived_inlining(df, "xml")
    rows = {(r.table, r.no): r for r in nested.shred(df, "k", "xml", nested.Inlining(plan.tables | {"f"}, {k: v for k, v in plan.columns.items() if k != "f"})).collect()}
    assert rows["a", 1].fields == {"@x": "1", "b": "t", "b/c": "u", "b/c@y": "2"}
    assert (rows["d", 2].text, rows["d", 2].fields, rows["d", 2].parent_table, rows["d", 2].parent_no) == ("w", {"e": "z"}, "a", 1)
    assert [tuple(t) for t in rows["f", 1].to] == [("d", 1)]
    assert nested.table_of(nested.shred(df, "k", "xml", plan), "k", plan, "a").select("b_c").collect() == [("u",)]


@pytest.mark.parametrize("depth", [50, 3000])
def test_deep_recursion_is_a_table(spark, depth):
    df = spark.createDataFrame([("k", "<a>" + "<s>" * depth + "</s>" * depth + "</a>")], "k string, xml string")
    rows = nested.shred(df, "k", "xml", nested.derived_inlining(df, "xml"), within=("s",))
    assert rows.where("table = 's' AND s_no = no - 1").count() == depth


def test_flatten(spark):
    df = spark.createDataFrame([("k", [("n", ["x", None]), None, ("m", None)]), ("l", None)], "k string, a array<struct<name: string, at: array<string>>>")
    got = nested.flatten(df, "k", "a")
    assert [tuple(r) for r in got["a"].collect()] == [("k", 1, "n"), ("k", 2, None), ("k", 3, "m")]
    assert [tuple(r) for r in got["a.at"].collect()] == [("k", 1, 1, "x"), ("k", 1, 2, None)]
