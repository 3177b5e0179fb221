import random

import pytest

from tessellar.llm import forest
from tessellar.llm.grouped import SHARES, grouped_split, placement, related_pairs


def brute(edges):
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("cap", [forest.CAP, 1])
def test_components_equal_union_find(spark, shared, cap):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + n, 1001 + n) for n in range(60)] + [(5000, 6000 + n) for n in range(80)]
    edges = [(a, b) for a, b in edges if a != b]
    df = spark.createDataFrame([*edges, *edges[:20], (7, 7), (None, 3)], "a bigint, b bigint").repartition(7)
    assert {r.id: r.group for r in forest.components(df, cap=cap).collect()} == brute(edges)


def test_no_edges(spark, shared):
    df = spark.createDataFrame([], "a string, b string")
    assert forest.components(df).count() == 0


def test_placement_meets_the_shares():
    got = placement([(1, 50_000), (3, 2_000), (70, 2)], SHARES)
    total = {s: sum(size * dict(parts)[s] for size, parts in got.items()) for s in SHARES}
    whole = sum(total.values())
    assert whole == 56_140 and all(abs(total[s] / whole - SHARES[s]) < 0.001 for s in SHARES)
    assert placement([], SHARES) == {} and sum(n for _, n in placement([(5, 1)], SHARES)[5]) == 1


def test_related_records_share_a_split(spark, shared):
    keys = spark.createDataFrame([(f"k{n:03}",) for n in range(300)] + [("k000",)], "k string")
    related = spark.createDataFrame([(f"k{n:03}", f"p{n // 3}") for n in range(150)] + [("k000", "hub"), ("k299", "hub")], "k string, anchor string")
    got = {r.k: (r.group, r.split) for r in grouped_split(keys, related).collect()}
    assert len(got) == 300 and all(len({got[f"k{n + i:03}"] for i in range(3)}) == 1 for n in range(0, 150, 3)) and got["k000"] == got["k299"]
    sizes = [sum(s == x for _, s in got.values()) for x in SHARES]
    assert sizes == [60, 90, 150]
    pairs = {tuple(r) for r in related_pairs(related).collect()}
    assert len(pairs) == 50 * 3 + 1 and ("k000", "k299") in pairs
    with pytest.raises(ValueError):
        grouped_split(keys, related, {"a": 0.0})
    assert grouped_split(keys.limit(0), related.limit(0)).count() == 0
