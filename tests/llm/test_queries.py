import __spark_entry__ as entry
import pytest

from tessellar.llm import queries

SF = "/root/testdata/sf0.001"
FOUND = {
    "p1_found": ["ppr_id", "para_no", "lang"], "p2_found": ["kind", "name_a", "name_b"], "p3_found": ["ppr_id"], "p4_found": ["ppr_id_a", "ppr_id_b"], "p5_found": ["ppr_id_a", "ppr_id_b"],
    "p6_found": ["ppr_id", "group_ppr_id"], "p10_found": ["doc_id_a", "doc_id_b"],
}


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs(spark, shared, name):
    rows = entry.queries()[name](spark, SF)
    got = rows.collect()
    if name in FOUND:
        assert rows.columns == FOUND[name] and len(got) == len(set(got)) and all(v is not None for r in got for v in r)
        pair = [c for c in rows.columns if c.endswith(("_a", "_b"))]
        assert not pair or all(r[pair[0]] < r[pair[1]] for r in got)
    assert got or name in ("p5_found", "p5_report")


def test_related_records_are_never_separated(spark, shared):
    split = {r.ppr_id: r.split for r in entry.queries()["p4_splits"](spark, SF).collect()}
    assert all(split[a] == split[b] for a, b in entry.queries()["p4_found"](spark, SF).collect())


def test_text_damage_at_sf0001_is_gone_after_restoring(spark):
    from tessellar.llm.mojibake import repair

    for r in entry.queries()["p3_restored"](spark, SF).collect():
        if r.damage == "span":
            assert repair(r.restored)[1] in ("", "swap", "loss", "swap,loss")
