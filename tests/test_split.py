import pytest

from tessellar.operators import split


def records(spark, *groups):
    rows, n = [], 0
    for language, size in groups:
        rows += [(f"PPR{n + i}", language, "x") for i in range(size)]
        n += size
    return spark.createDataFrame(rows, "ppr_id string, language string, split string")


def counts(df):
    return {r["split"]: r["n"] for r in split.split_counts(df).collect()}


def test_two_hundred_are_cut_exactly(spark):
    assert counts(split.stratified_split(records(spark, ("pt", 200)), "ppr_id", "language")) == {"train": 40, "val": 60, "test": 100}


def test_every_language_is_in_every_split(spark):
    got = split.stratified_split(records(spark, ("pt", 100), ("es", 100)), "ppr_id", "language")
    assert {(r.stratum, r.split) for r in got.collect()} == {(a, b) for a in ("pt", "es") for b in ("train", "val", "test")}


def test_other_languages_share_a_stratum(spark):
    got = split.stratified_split(records(spark, ("en", 10), ("", 5), (None, 5)), "ppr_id", "language").collect()
    assert {r.stratum for r in got} == {"other"} and len(got) == 20


def test_seed_decides(spark):
    df = records(spark, ("pt", 200))
    run = lambda s: {r.ppr_id: r.split for r in split.stratified_split(df, "ppr_id", "language", seed=s).collect()}
    assert run(1) == run(1) != run(2)


def test_halves_round_to_even(spark):
    # 15 x 0.3 = 4.5 goes to 4, 5 x 0.5 = 2.5 to 2
    assert counts(split.stratified_split(records(spark, ("pt", 15)), "ppr_id", "language")) == {"train": 3, "val": 4, "test": 8}
    assert counts(split.stratified_split(records(spark, ("pt", 5)), "ppr_id", "language", 0.5, 0.1)) == {"train": 2, "val": 0, "test": 3}


def test_repeated_rows_and_null_keys_are_rows(spark):
    df = spark.createDataFrame([("a", "pt")] * 6 + [(None, "pt")] * 4, "ppr_id string, language string")
    assert sum(counts(split.stratified_split(df, "ppr_id", "language")).values()) == 10


def test_guards(spark):
    df = records(spark, ("pt", 3))
    with pytest.raises(ValueError):
        split.stratified_split(df, "ppr_id", "language", 0.5, 0.5)
    with pytest.raises(ValueError):
        split.non_empty(df.limit(0), "nothing")
    assert split.stratified_split(df.limit(0), "ppr_id", "language").count() == 0


@pytest.mark.parametrize(("n", "want"), [(1000, (200, 300, 500)), (7, (1, 2, 4)), (1, (0, 0, 1)), (0, (0, 0, 0))])
def test_two_steps(spark, n, want):
    got = split.two_step_split(spark.range(n), "id").collect()
    assert tuple(sum(r["split"] == s for r in got) for s in ("train", "validation", "test")) == want


def test_a_hot_stratum_is_ranked_in_ranges(spark):
    got = split.stratified_split(records(spark, ("pt", 5000), ("es", 10)), "ppr_id", "language")
    assert counts(got) == {"train": 1002, "val": 1503, "test": 2505}
