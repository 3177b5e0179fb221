import __spark_entry__ as entry

from tessellar import queries as core

SF = "/root/testdata/sf0.001"


def test_entry(spark):
    assert entry.entry(spark).count() == 3


def test_every_core_query_runs(spark):
    for name, f in core.QUERIES.items():
        assert f(spark, SF).count() > 0 or name in ("unreadable_xml", "missing_files", "multi_version", "pending_anti", "unrecognised_entries"), name


def test_sql_is_for_registered_queries_only():
    assert set(entry.oracle_sql()) <= set(entry.queries())
