"""Items of varying length in containers of fixed capacity, by a grouping genetic algorithm.

A solution is a set of filled containers.  Crossover injects whole well-filled containers of one parent
into the other, removes the containers that hold an item twice, and best-fits the displaced items.

Items are spread over islands by hash, each small enough for one task and evolving alone.  Within an
island two populations evolve apart and exchange their best solutions.  Between epochs the elite, the
containers that are full enough, stay; all other items migrate to new islands, where they meet others.
In the last epoch all containers stay.

No item is split unless it exceeds the capacity; such an item gives full pieces and one rest.  Items of
size 0 (null or empty texts) are placed like others.  Repeated keys are items of their own.
"""

from __future__ import annotations

import random
from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.llm.forest import cut

#: Items of one island; epochs; filling from which a container is of the elite.
ISLAND, EPOCHS, ELITE = 1500, 3, 0.995
#: Solutions in each of an island's populations, generations of an epoch, and generations between exchanges.
POPULATION, GENERATIONS, EXCHANGE = 4, 24, 6

Bin = tuple[int, tuple[int, ...]]  # filling, items


def best_fit(bins: list[Bin], items: list[int], size: list[int], capacity: int) -> list[Bin]:
    """The containers after every item, largest first, went to the fullest one that has room for it."""
    filled = [b[0] for b in bins]
    held = [list(b[1]) for b in bins]
    rooms = sorted((capacity - f, n) for n, f in enumerate(filled))
    for item in sorted(items, key=lambda i: (-size[i], i)):
        at = bisect_left(rooms, (size[item], -1))
        if at == len(rooms):
            n = len(held)
            filled.append(0)
            held.append([])
        else:
            _, n = rooms.pop(at)
        filled[n] += size[item]
        held[n].append(item)
        insort(rooms, (capacity - filled[n], n))
    return [(f, tuple(h)) for f, h in zip(filled, held, strict=True)]


def fitness(bins: list[Bin], capacity: int) -> float:
    """Mean of the squared fillings: few full containers and some empty ones are better than many half full."""
    return sum((f / capacity) ** 2 for f, _ in bins) / max(1, len(bins))


def crossover(a: list[Bin], b: list[Bin], size: list[int], capacity: int, rng: random.Random) -> list[Bin]:
    """``a`` with whole well-filled containers of ``b`` put in."""
    best = sorted(b, key=lambda x: -x[0])
    good = best[: max(1, len(best) // 2)]
    gift = rng.sample(good, max(1, int(len(good) * rng.uniform(0.2, 0.8))))
    given = {i for _, items in gift for i in items}
    kept, displaced = [], []
    for bin_ in a:
        if given.isdisjoint(bin_[1]):
            kept.append(bin_)
        else:
            displaced.extend(i for i in bin_[1] if i not in given)
    return best_fit(gift + kept, displaced, size, capacity)


def mutated(a: list[Bin], size: list[int], capacity: int, rng: random.Random) -> list[Bin]:
    """``a`` with its emptiest containers and a few others dissolved and refilled."""
    order = sorted(a)
    n = max(1, len(order) // 10)
    gone = set(range(n)) | set(rng.sample(range(len(order)), min(n, len(order))))
    loose = [i for k, x in enumerate(order) if k in gone for i in x[1]]
    rng.shuffle(loose)
    half = len(loose) // 2
    rest = best_fit([x for k, x in enumerate(order) if k not in gone], loose[:half], size, capacity)
    return best_fit(rest, loose[half:], size, capacity)


def evolved(size: list[int], capacity: int, seed: int, population: int = POPULATION, generations: int = GENERATIONS, exchange: int = EXCHANGE) -> list[Bin]:
    """The best packing found of items of the given sizes, none above the capacity."""
    if not size:
        return []
    rng = random.Random(seed)
    items = list(range(len(size)))
    least = max(1, -(-sum(size) // capacity))

    def start() -> list[Bin]:
        shuffled = items[:]
        rng.shuffle(shuffled)
        part = rng.randrange(len(items) + 1)
        return best_fit(best_fit([], shuffled[:part], size, capacity), shuffled[part:], size, capacity)

    score = lambda s: (fitness(s, capacity), -len(s))
    first = best_fit([], items, size, capacity)
    islands = [sorted([first, *(start() for _ in range(population - 1))], key=score, reverse=True) for _ in range(2)]
    for generation in range(1, generations + 1):
        if min(len(i[0]) for i in islands) <= least:
            break
        for people in islands:
            a, b = people[0], people[rng.randrange(1, len(people))] if len(people) > 1 else people[0]
            children = [crossover(a, b, size, capacity, rng), crossover(b, a, size, capacity, rng), mutated(a, size, capacity, rng)]
            people[:] = sorted([*people, *children], key=score, reverse=True)[:population]
        if generation % exchange == 0:
            islands[0][-1], islands[1][-1] = islands[1][0], islands[0][0]
            for people in islands:
                people.sort(key=score, reverse=True)
    return max((i[0] for i in islands), key=lambda s: (-len(s), fitness(s, capacity)))


def pieces(items: DataFrame, kinds: DataFrame, key: str, size: str) -> DataFrame:
    """``kind``, ``capacity``, ``key``, ``piece``, ``tokens`` of every item in every kind of container.

    Kinds (``kind``, ``capacity`` > 0) are few: a table of containers, not of data.
    """
    fixed = [(r.kind, r.capacity) for r in kinds.where("capacity > 0").select("kind", "capacity").distinct().limit(1001).collect()]
    if len(fixed) > 1000:
        raise ValueError("more than 1000 kinds of containers")
    each = F.array(*[F.struct(F.lit(k).alias("kind"), F.lit(c).cast("bigint").alias("capacity")) for k, c in fixed])
    rows = items.select(key, F.coalesce(size, F.lit(0)).cast("bigint").alias("size"), F.explode(each).alias("c")).select("c.kind", "c.capacity", key, "size")
    full = F.greatest(F.lit(1), F.ceil(F.col("size") / F.col("capacity"))).cast("int")
    cut_up = rows.withColumn("piece", F.explode(F.sequence(F.lit(1), full)))
    return cut_up.select("kind", "capacity", key, "piece", F.least(F.col("capacity"), F.col("size") - F.col("capacity") * (F.col("piece") - 1)).alias("tokens"))


def _island(epoch: int, last: bool, elite: float):
    """An epoch of one island, as a function of its items."""

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("tokens", "descending"), ("__key", "ascending"), ("piece", "ascending")])
        size, capacity = group["tokens"].to_pylist(), group["capacity"][0].as_py()
        kind, island_no = group["kind"][0].as_py(), group["island"][0].as_py()
        bins = evolved(size, capacity, hash_seed(kind, island_no, epoch))
        where, name, kept = [], [], []
        for n, (filled, members) in enumerate(sorted(bins, key=lambda b: b[1])):
            where.extend(members)
            name.extend([f"{kind}-{epoch}-{island_no}-{n}"] * len(members))
            kept.extend([last or filled >= elite * capacity] * len(members))
        rows = group.take(pa.array(where, pa.int32()))
        return pa.table({"kind": rows["kind"], "capacity": rows["capacity"], "__key": rows["__key"], "piece": rows["piece"], "tokens": rows["tokens"], "container": pa.array(name, pa.string()), "kept": pa.array(kept, pa.bool_())})

    return run


def packed(items: DataFrame, kinds: DataFrame, key: str, size: str, island: int = ISLAND, epochs: int = EPOCHS, elite: float = ELITE) -> DataFrame:
    """``kind``, ``container``, ``key``, ``piece``, ``tokens``: one row for every piece of every item in every kind.

    An empty table gives no rows.
    """
    left = cut(pieces(items, kinds, key, size))
    key_type = items.schema[key].dataType.simpleString()
    done = None
    for epoch in range(1, epochs + 1):
        counts = left.groupBy("kind").agg(F.ceil(F.count(F.lit(1)) / island).alias("islands"))
        placed = left.join(F.broadcast(counts), "kind").withColumn("island", F.pmod(F.xxhash64(key, "piece", F.lit(epoch)), F.col("islands")).cast("int")).drop("islands")
        last = epoch == epochs

        run = _island(epoch, last, elite)
        found = placed.withColumnRenamed(key, "__key").groupBy("kind", "island").applyInArrow(run, f"kind string, capacity bigint, __key {key_type}, piece int, tokens bigint, container string, kept boolean")
        found = cut(found.withColumnRenamed("__key", key))
        kept = found.where("kept").select("kind", "container", "capacity", key, "piece", "tokens")
        done = kept if done is None else done.unionByName(kept)
        left = found.where("NOT kept").select("kind", "capacity", key, "piece", "tokens")
    return done


def hash_seed(*parts: object) -> int:
    """The same number in every process."""
    out = 0
    for c in "|".join(map(str, parts)).encode():
        out = (out * 1_000_003 + c) % (1 << 61)
    return out


def filling(rows: DataFrame) -> DataFrame:
    """``kind``, ``containers``, ``tokens``, ``fill`` (part of the capacity used), ``least`` (containers below which none can be)."""
    bins = rows.groupBy("kind", "capacity", "container").agg(F.sum("tokens").alias("tokens"))
    all_bins = bins.groupBy("kind", "capacity").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"))
    return all_bins.select("kind", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity"))).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity")).alias("least"))
