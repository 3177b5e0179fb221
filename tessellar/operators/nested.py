"""Deeply nested records to flat tables by shared inlining.

``schema_graph`` reads which elements occur in which, and how often in one.  ``inlining`` derives the
tables from it: elements that repeat, that have several kinds of parents or that contain themselves get
a table, all others become columns of the table above them.  ``shred`` then walks every record once
and gives the rows of all tables with their own number, that of their parent row, and the numbers of
rows they point to by an identifier.  Numbers count from 1 in document order within the record, so keys
need no exchange between tasks.

``flatten`` does the same for typed nested columns: structs are inlined, arrays get tables.

Texts that are null, empty or not well formed give no rows.
"""

from __future__ import annotations

import xml.etree.ElementTree as ET
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Records per Arrow slice.
SLICE = 500
#: A schema graph of more edges than this is refused; it is the one thing that goes to the driver.
MOST_EDGES = 50_000


def _local(tag: object) -> str:
    return tag.rsplit("}", 1)[-1] if isinstance(tag, str) else ""


def _root(text: str | None) -> ET.Element | None:
    try:
        return ET.fromstring(text or "")
    except (ET.ParseError, ValueError):
        return None


def schema_graph(df: DataFrame, text: str) -> DataFrame:
    """``parent``, ``child``, ``most``: every edge and the most such children in one parent; roots have parent ''.

    Each task reduces its records to their distinct edges before the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most: dict[tuple[str, str], int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                for t in batch.column(0).slice(at, SLICE).to_pylist():
                    if (root := _root(t)) is None:
                        continue
                    most.setdefault(("", _local(root.tag)), 1)
                    for e in root.iter():
                        if not len(e):
                            continue
                        tag, seen = e.tag, {}
                        for x in e:
                            seen[x.tag] = seen.get(x.tag, 0) + 1
                        for child, n in seen.items():
                            if n > most.get((tag, child), 0):
                                most[tag, child] = n
        plain: dict[tuple[str, str], int] = {}
        for (parent, child), n in most.items():
            edge = (_local(parent), _local(child))
            plain[edge] = max(n, plain.get(edge, 0))
        edges = [(*k, n) for k, n in plain.items() if k[1]]
        yield pa.RecordBatch.from_pylist([{"parent": a, "child": b, "most": n} for a, b, n in edges], pa.schema([("parent", pa.string()), ("child", pa.string()), ("most", pa.int64())]))

    found = df.select(F.col(text).alias("__text")).where(F.col("__text").isNotNull()).mapInArrow(run, "parent string, child string, most bigint")
    return found.groupBy("parent", "child").agg(F.max("most").alias("most"))


@dataclass(frozen=True)
class Inlining:
    """``tables``: elements with a table.  ``columns``: of each inlined element the path of tags below its table's row."""

    tables: frozenset[str]
    columns: dict[str, str] = field(default_factory=dict)


def inlining(edges: list[tuple[str, str, int]]) -> Inlining:
    """Tables and inlined elements of a schema graph."""
    parents: dict[str, set[str]] = {}
    children: dict[str, set[str]] = {}
    tables: set[str] = set()
    for parent, child, most in edges:
        parents.setdefault(child, set()).add(parent)
        children.setdefault(parent, set()).add(child)
        if parent == "" or most > 1:
            tables.add(child)
    tables |= {c for c, p in parents.items() if len(p) > 1}
    # what is left has one parent each; a chain of such elements that returns to itself is recursive
    for start in parents:
        path, at = [], start
        while at and at not in tables and at not in path:
            path.append(at)
            at = next(iter(parents[at]))
        if at in path:
            tables.add(at)
    columns: dict[str, str] = {}
    for tag in parents:
        if tag not in tables:
            path, at = [tag], next(iter(parents[tag]))
            while at and at not in tables:
                path.append(at)
                at = next(iter(parents[at]))
            columns[tag] = "/".join(reversed(path))
    return Inlining(frozenset(tables), columns)


def derived_inlining(df: DataFrame, text: str) -> Inlining:
    """The inlining of a table's own records; its schema graph must be of bounded size."""
    edges = schema_graph(df, text).limit(MOST_EDGES + 1).collect()
    if len(edges) > MOST_EDGES:
        raise ValueError(f"the records have more than {MOST_EDGES} kinds of edges: no common schema")
    return inlining([tuple(e) for e in edges])


def _walk(root: ET.Element, plan: Inlining, keep: frozenset[str] | None, within: tuple[str, ...], inside: tuple[str, ...], fields: bool | frozenset[str]) -> list[dict]:
    rows: list[dict] = []
    count: dict[str, int] = {}
    nth: dict[tuple, int] = {}
    by_id: dict[str, list[dict]] = {}
    pointing: list[tuple[dict, str]] = []
    around = dict.fromkeys(within, 0)
    # element, row above, path of inlined elements since that row, nearest enclosing numbers, enclosing tags of ``inside``
    stack: list[tuple] = [(root, None, "", around, frozenset())]
    while stack:
        e, above, path, around, holds = stack.pop()
        tag = _local(e.tag)
        if not tag:
            continue
        if tag in plan.tables:
            count[tag] = number = count.get(tag, 0) + 1
            row = {
                "table": tag, "no": number, "parent_table": above["table"] if above else "", "parent_no": above["no"] if above else 0, "path": path,
                "text": (e.text or "").strip() or None, "fields": {}, "to": [],
            }
            if keep is None or tag in keep:
                for a in within:
                    near = around[a]
                    row[f"{a}_no"] = near
                    nth[tag, a, near] = row[f"{a}_nth"] = nth.get((tag, a, near), 0) + 1
                for a in inside:
                    row[f"{a}_nth"] = 0
                    if a in holds:
                        nth[tag, a] = row[f"{a}_nth"] = nth.get((tag, a), 0) + 1
                rows.append(row)
            above, path, prefix = row, "", ""
        else:
            count[tag] = number = count.get(tag, 0) + 1
            path = f"{path}/{tag}" if path else tag
            prefix = path
            if above is not None and fields is True and (said := (e.text or "").strip()):
                above["fields"].setdefault(path, said)
        for name, value in e.items():
            plain = _local(name)
            if plain == "id" and tag in plan.tables:
                by_id.setdefault(value, []).append(row)
            elif plain == "rid" and tag in plan.tables:
                pointing.append((row, value))
            if above is not None and (fields is True or (fields and plain in fields)):
                above["fields"].setdefault(f"{prefix}@{plain}", value)
        if tag in around:
            around = around | {tag: number}
        if tag in inside:
            holds = holds | {tag}
        stack.extend([(x, above, path, around, holds) for x in reversed(e)])
    for row, value in pointing:
        row["to"] = [(r["table"], r["no"]) for r in by_id.get(value, ())]
    return rows


def shred(
    df: DataFrame, key: str, text: str, plan: Inlining, keep: tuple[str, ...] | None = None, within: tuple[str, ...] = (), inside: tuple[str, ...] = (), fields: bool | tuple[str, ...] = True
) -> DataFrame:
    """Rows of the flat tables of every record.

    ``key``, ``table``, ``no`` (the row's own number), ``parent_table``, ``parent_no`` (0: none),
    ``path`` (inlined elements between parent row and element), ``text`` (lead text), ``fields``
    (inlined elements by path, attributes by path@name), ``to`` (rows whose id is the row's rid).
    ``keep`` limits the tables, ``fields`` the attributes.  For every tag in ``within`` there are the
    number of the nearest enclosing element (``<tag>_no``, 0: none) and the row's place in it
    (``<tag>_nth``); for every tag in ``inside`` its place among all rows inside any such element (0: none).
    """
    kind = df.schema[key].dataType.simpleString()
    numbers = [f"{a}_{k}" for a in within for k in ("no", "nth")] + [f"{a}_nth" for a in inside]
    layout = pa.schema(
        [("table", pa.string()), ("no", pa.int32()), ("parent_table", pa.string()), ("parent_no", pa.int32()), ("path", pa.string()), ("text", pa.string())]
        + [("fields", pa.map_(pa.string(), pa.string())), ("to", pa.list_(pa.struct([("table", pa.string()), ("no", pa.int32())])))]
        + [(n, pa.int32()) for n in numbers]
    )
    kept = None if keep is None else frozenset(keep)
    asked = fields if isinstance(fields, bool) else frozenset(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                where: list[int] = []
                columns: dict[str, list] = {f.name: [] for f in layout}
                for n, t in enumerate(part.column(1).to_pylist()):
                    if (root := _root(t)) is None:
                        continue
                    rows = _walk(root, plan, kept, within, inside, asked)
                    where.extend([n] * len(rows))
                    for name, values in columns.items():
                        if name == "fields":
                            values.extend([list(r["fields"].items()) for r in rows])
                        elif name == "to":
                            values.extend([[{"table": a, "no": b} for a, b in r["to"]] for r in rows])
                        else:
                            values.extend([r[name] for r in rows])
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(where, pa.int32())), *(pa.array(columns[f.name], f.type) for f in layout)], ["__key", *layout.names])

    ddl = "table string, no int, parent_table string, parent_no int, path string, text string, fields map<string,string>, to array<struct<table: string, no: int>>" + "".join(f", {n} int" for n in numbers)
    picked = df.select(F.col(key).alias("__key"), F.col(text).alias("__text")).where(F.col("__text").isNotNull())
    return picked.mapInArrow(run, f"__key {kind}, {ddl}").withColumnRenamed("__key", key)


def table_of(rows: DataFrame, key: str, plan: Inlining, table: str) -> DataFrame:
    """One flat table: keys, lead text, and a column for every inlined element that may stand below it."""
    inlined = sorted({p for p in plan.columns.values()})
    return rows.where(F.col("table") == table).select(key, "no", "parent_table", "parent_no", "path", "text", *[F.col("fields")[p].alias(p.replace("/", "_").replace("-", "_")) for p in inlined])


#: What the links of articles are made of.
LINKED = ("contrib", "aff", "xref", "sec", "p", "ref", "name")


def article_links(df: DataFrame, key: str, text: str) -> DataFrame:
    """``key``, ``child_kind``, ``parent_no``, ``child_no``: the parent-child links of articles, out of their flat tables.

    contrib and ref hang on the record; aff on the contrib it stands in or that points to it by an
    xref of type aff; sec on the enclosing sec; p (in the body) on the nearest sec; name on its ref.
    """
    derived = derived_inlining(df, text)
    plan = Inlining(derived.tables | set(LINKED), {k: v for k, v in derived.columns.items() if k not in LINKED})
    rows = shred(df, key, text, plan, keep=LINKED, within=("contrib", "sec", "ref"), inside=("body",), fields=("ref-type",))

    def link(kind: str, parent: str, child: str, when: str = "true") -> F.Column:
        return F.when(F.expr(when), F.array(F.struct(F.lit(kind).alias("child_kind"), F.expr(parent).cast("int").alias("parent_no"), F.expr(child).cast("int").alias("child_no"))))

    pointed = F.transform(F.filter("to", lambda x: x["table"] == "aff"), lambda x: F.struct(F.lit("contrib_aff").alias("child_kind"), F.col("contrib_no").alias("parent_no"), x["no"].alias("child_no")))
    table = F.col("table")
    found = (
        F.when(table == "contrib", link("contrib", "0", "no"))
        .when(table == "aff", link("contrib_aff", "contrib_no", "no", "contrib_no > 0"))
        .when((table == "xref") & (F.col("parent_table") == "contrib") & (F.col("path") == "") & (F.col("fields")["@ref-type"] == "aff"), pointed)
        .when(table == "sec", link("sec", "sec_no", "no"))
        .when(table == "p", link("p", "sec_no", "body_nth", "body_nth > 0"))
        .when(table == "ref", link("ref", "0", "no"))
        .when(table == "name", link("ref_name", "ref_no", "ref_nth", "ref_no > 0"))
    )
    return rows.select(key, F.explode(found).alias("l")).select(key, "l.child_kind", "l.parent_no", "l.child_no").distinct()


def flatten(df: DataFrame, key: str, column: str) -> dict[str, DataFrame]:
    """Flat tables of a typed nested column, by path: structs inlined, every array a table.

    Each has ``key``, the numbers of the rows above it (``no_1``, ...), its own ``no`` and its plain
    columns.  Null and empty arrays give no rows; null elements keep their number.
    """
    out: dict[str, DataFrame] = {}

    def inline(kind: T.DataType, c: F.Column, name: str) -> tuple[list[F.Column], list[tuple[str, F.Column, T.DataType]]]:
        if isinstance(kind, T.StructType):
            plain, below = [], []
            for f in kind.fields:
                p, b = inline(f.dataType, c[f.name], f"{name}_{f.name}" if name else f.name)
                plain, below = plain + p, below + b
            return plain, below
        if isinstance(kind, T.ArrayType):
            return [], [(name, c, kind.elementType)]
        return [c.alias(name or "value")], []

    def down(rows: DataFrame, above: list[str], path: str, c: F.Column, kind: T.DataType) -> None:
        held = rows.select(key, *above, F.posexplode(c).alias("__at", "__item"))
        numbered = held.select(key, *above, (F.col("__at") + 1).alias("no"), "__item")
        plain, below = inline(kind, F.col("__item"), "")
        out[path] = numbered.select(key, *above, "no", *plain)
        for name, inner, inner_kind in below:
            own = f"no_{len(above) + 1}"
            down(numbered.withColumnRenamed("no", own), [*above, own], f"{path}.{name}", inner, inner_kind)

    for name, c, kind in inline(df.schema[column].dataType, F.col(column), column)[1]:
        down(df, [], name, c, kind)
    return out
