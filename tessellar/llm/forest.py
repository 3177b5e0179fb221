"""Connected components by union-find: local forests, merged hierarchically.

Every task builds the forest of its own edges and hands on one edge for each node that is no root.
Forests of neighbouring tasks are then merged level by level, as long as a merged task stays below
``CAP`` edges.  If the forests of all tasks cannot be merged below it, the rest is done by exchange:
nodes take the least root any task knows for them, roots that meet in a node are joined, and
pointers are shortened, until nothing changes.  No task ever holds more than ``CAP`` edges of a
merge, and nothing but counts goes to the driver.  Lineage is cut by checkpoints in the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessellar.session import shared_folder

#: Edges that one task may hold in a merge, about 400 MB of Python objects for ids of a dozen characters.
CAP = 1_000_000
#: Forests merged into one at each level.
FAN_IN = 8


def cut(df: DataFrame) -> DataFrame:
    """The table written to the shared folder: plans stay short, and a lost executor loses nothing."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


#: Rows of a few numbers that may be sent to every task, about 15 MB.
SENT = 300_000


def sent(df: DataFrame, most: int = SENT) -> DataFrame:
    """The table written, and marked for broadcast if its rows were counted and are few enough; else joined by exchange."""
    written = cut(df)
    return F.broadcast(written) if written.count() <= most else written


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (a, b) to the edges (node, root) of each task's forest; roots are least members."""
    kind = edges.schema["a"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        up: dict = {}

        def root(x):
            top = x
            while (above := up.get(top, top)) != top:
                top = above
            while x != top:
                up[x], x = top, up[x]
            return top

        schema = None
        for batch in batches:
            schema = schema or batch.schema
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                if a != b:
                    up[max(a, b)] = min(a, b)
        nodes = list(up)
        for at in range(0, len(nodes), 50_000):
            part = nodes[at : at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part, schema.field(0).type), pa.array([root(x) for x in part], schema.field(0).type)], ["a", "b"])

    return edges.select("a", "b").mapInArrow(run, f"a {kind}, b {kind}")


def components(edges: DataFrame, cap: int = CAP, fan_in: int = FAN_IN) -> DataFrame:
    """``id``, ``group`` (least id of its component) of every id in edges (``a``, ``b``).

    Edges may repeat and run both ways; loops are ignored, so an id that occurs in loops only gives no row.
    Rows with a null end are left out.  No edges give no rows.
    """
    shared_folder(edges.sparkSession)
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL")
    forest = _forest(edges).checkpoint()
    total, tasks = forest.count(), forest.rdd.getNumPartitions()
    while tasks > 1 and total * min(fan_in, tasks) / tasks <= cap:
        tasks = -(-tasks // fan_in)
        forest = _forest(forest.coalesce(tasks))
        if tasks > 1:
            forest = forest.checkpoint()
            total = forest.count()
    done = _exchanged(forest) if tasks > 1 else forest
    stars = done.select(F.col("a").alias("id"), F.col("b").alias("group")).union(done.select("b", "b"))
    return stars.groupBy("id").agg(F.min("group").alias("group"))


def _exchanged(forest: DataFrame) -> DataFrame:
    """Forests of many tasks to stars of whole components, by rounds of exchange."""
    now = forest.where("a <> b")
    while True:
        least = now.groupBy("a").agg(F.min("b").alias("low"))
        # roots that meet in a node are joined, nodes keep the least one
        met = now.join(least, "a")
        links = met.select("a", F.col("low").alias("b")).union(met.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))).distinct().checkpoint()
        one = links.groupBy("a").agg(F.min("b").alias("b"))
        # pointers are shortened
        above = one.select(F.col("a").alias("b"), F.col("b").alias("top"))
        short = one.join(above, "b", "left").select("a", F.coalesce("top", "b").alias("b"), F.col("top").isNotNull().alias("moved"))
        rest = links.join(one.withColumnRenamed("b", "low"), "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"), F.lit(True).alias("moved"))
        then = short.union(rest).checkpoint()
        if not then.where("moved").limit(1).count():
            return then.select("a", "b")
        now = then.select("a", "b").where("a <> b")
