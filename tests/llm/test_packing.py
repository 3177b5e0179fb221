import random

from pyspark.sql import functions as F

from tessellar.llm import mixing as M
from tessellar.llm import packing as G
from tessellar.llm.sizes import token_counts


def test_algorithm_keeps_items_and_capacity():
    rng = random.Random(1)
    size = [rng.randrange(0, 61) for _ in range(300)]
    bins = G.evolved(size, 100, 7)
    assert sorted(i for _, items in bins for i in items) == list(range(300))
    assert all(f == sum(size[i] for i in items) <= 100 for f, items in bins)
    plain = G.best_fit([], list(range(300)), size, 100)
    assert len(bins) <= len(plain) and len(bins) - -(-sum(size) // 100) <= 3
    assert G.evolved([], 10, 1) == [] and len(G.evolved([10], 10, 1)) == 1 and G.evolved(size, 100, 7) == bins


def test_crossover_places_each_item_once():
    rng = random.Random(2)
    size = [rng.randrange(1, 60) for _ in range(80)]
    a, b = (G.best_fit([], rng.sample(range(80), 80), size, 100) for _ in range(2))
    for child in (G.crossover(a, b, size, 100, rng), G.mutated(a, size, 100, rng)):
        assert sorted(i for _, items in child for i in items) == list(range(80)) and max(f for f, _ in child) <= 100


def test_every_piece_is_in_one_container(spark, shared):
    rng = random.Random(3)
    items = [(n, rng.randrange(1, 60)) for n in range(200)] + [(500, 250), (501, None), (502, 0), (503, 100), (3, 7)]
    df = spark.createDataFrame(items, "k bigint, size bigint")
    kinds = spark.createDataFrame([("s", 100), ("l", 1000), ("bad", 0)], "kind string, capacity int")
    got = G.packed(df, kinds, "k", "size", island=60).collect()
    for kind, capacity in (("s", 100), ("l", 1000)):
        rows = [r for r in got if r.kind == kind]
        assert sum(r.tokens for r in rows) == sum(s or 0 for _, s in items) and {r.k for r in rows} == {k for k, _ in items}
        fill = {}
        for r in rows:
            fill[r.container] = fill.get(r.container, 0) + r.tokens
        assert max(fill.values()) <= capacity
        assert all(sum(r.k == k for r in rows) == 1 for k in range(200) if k != 3)  # nothing is split below the capacity
    assert sorted(r.tokens for r in got if r.kind == "s" and r.k == 500) == [50, 100, 100]
    report = {r.kind: r for r in G.filling(G.packed(df, kinds, "k", "size")).collect()}
    assert report["s"].fill > 0.97 and report["s"].containers <= report["s"].least + 2
    assert G.packed(df.limit(0), kinds, "k", "size").count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([(1, "hello world"), (2, ""), (3, None), (4, "x " * 20000)], "k int, t string")
    got = {r.k: r.tokens for r in token_counts(df, "k", "t").collect()}
    assert got[1] == 2 and got[2] == got[3] == 0 and got[4] >= 20000


def sources(spark):
    rng = random.Random(5)
    rows = [(n, "big" if n % 3 else "mid", rng.randrange(50, 150)) for n in range(600)] + [(1000 + n, "small", 100) for n in range(10)] + [(2000, "other", 5), (2001, "big", 0), (2002, None, 9)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("absent", 0.1, 3)], "source string, target_share double, max_repeats int")
    return spark.createDataFrame(rows, "k bigint, source string, tokens bigint"), targets


def test_shares_and_repeats(spark, shared):
    sized, targets = sources(spark)
    got = M.mix(sized, targets, "k", ranges=16).collect()
    used = {}
    for r in got:
        used.setdefault((r.k, r.repeat), 0)
        used[r.k, r.repeat] += 1
    assert max(used.values()) == 1 and max(r.repeat for r in got if r.source == "small") <= 4 and max(r.repeat for r in got if r.source == "big") == 1
    budget = int(1000 * 4 / 0.2)
    assert [r.position for r in got] == sorted(r.position for r in got) and budget - 200 <= got[-1].position <= budget and sum(r.tokens for r in got) == got[-1].position
    shares = {r.source: r for r in M.shares(M.mix(sized, targets, "k"), targets).collect()}
    assert shares["absent"].actual_share == 0 and all(abs(shares[s].actual_share - w) < 0.01 for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)))


def test_any_beginning_of_the_mix_has_the_shares(spark, shared):
    sized, targets = sources(spark)
    got = M.mix(sized, targets, "k").collect()
    half = got[: len(got) // 2]
    total = sum(r.tokens for r in half)
    assert abs(sum(r.tokens for r in half if r.source == "big") / total - 0.5) < 0.03


def test_budget_beyond_what_sources_hold(spark, shared):
    sized, targets = sources(spark)
    got = M.mix(sized, targets, "k", budget=10**9)
    once = {r.source: r.n for r in got.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert once == {"big": 400, "mid": 400, "small": 40}
    assert M.mix(sized.limit(0), targets, "k").count() == 0 and M.mix(sized, targets, "k", budget=0).count() == 0


def test_no_token_running_sum_differs_by_ranges(spark, shared):
    sized, targets = sources(spark)
    one, many = ([tuple(r) for r in M.mix(sized, targets, "k", ranges=n).collect()] for n in (1, 64))
    assert one == many
