"""Deeply nested semi-structured records to flat child tables.

1. infer_shapes: every payload is read once and the kinds found at every path are counted, per partition first, then summed:
   the merged schema. What comes to the driver is one row for each distinct path of an object or a list, the size of the schema, not of
   the data.
2. plan: from the merged schema, which paths are lists of objects (child tables), which keys merely wrap such a list, and which
   values are JSON written as a string.
3. explode_children: native variant expressions built from the plan take every array level apart at once and carry
   the parent's surrogate key and the ordinal: one pass, no shuffle, no Python.

Defined cases: a null or unreadable payload gives no rows; null elements and elements that are no objects, or empty ones, give
no row but keep their ordinal; an object where a list is usual counts as the list's only element; an empty table gives an empty
table; a merged schema beyond MAX_KEYS is an error; other columns of the input are ignored, so their names may clash with ours.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows (path, kind) of objects and lists the merged schema may have. Values never count, however many keys they have; more objects and
#: lists than that come of dictionaries with data in their keys that hold objects, and are an error: no part is left out.
MAX_KEYS = 10_000


def _kind(x: dict) -> str:
    return "object" if x else "empty"


def _inner(x: object) -> object:
    """What a string holds, if it is itself JSON of an object or a list."""
    if isinstance(x, str) and x[:1] in "{[" and x:
        try:
            return json.loads(x)
        except ValueError:
            return x
    return x


def _walk(path: str, x: object, seen: Counter) -> None:
    """Counts the objects and lists below a path; what holds neither decides no table."""
    inner = _inner(x)
    if inner is not x:
        seen[path, "json"] += 1
        x = inner
    if isinstance(x, dict):
        seen[path, _kind(x)] += 1
        for k, v in x.items():
            _walk(f"{path}.{k}", v, seen)
    elif isinstance(x, list):
        seen[path, "array"] += 1
        for v in x:
            _walk(f"{path}[]", v, seen)


def infer_shapes(df: DataFrame, payload: str) -> dict[str, dict[str, int]]:
    """The merged schema: path → kind → count, over all rows."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if text is None:
                    continue
                try:
                    x = json.loads(text)
                    _walk("$", json.loads(x) if isinstance(x, str) else x, seen)
                except (ValueError, RecursionError):
                    seen["$", "unreadable"] += 1
            if len(seen) > MAX_KEYS:
                break  # an error already: the rest need not be read
        if seen:
            keys = list(seen)
            yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in keys]), pa.array([k for _, k in keys]), pa.array([seen[k] for k in keys], pa.int64())], ["path", "kind", "n"])

    rows = df.select(F.col(payload).cast("string").alias("p")).mapInArrow(count, "path string, kind string, n long").groupBy("path", "kind").agg(F.sum("n").alias("n")).limit(MAX_KEYS + 1).collect()
    if len(rows) > MAX_KEYS:
        raise ValueError(f"the merged schema of {payload} has more than {MAX_KEYS} paths and kinds: a payload has data in its keys")
    out: dict[str, dict[str, int]] = {}
    for r in rows:
        out.setdefault(r["path"], {})[r["kind"]] = r["n"]
    return out


@dataclass
class Node:
    """A path of the merged schema: `lists` are its child tables, `fields` the objects that are no tables but may hold some."""

    name: str
    wrapper: str | None = None
    decode: bool = False
    children: list[Node] = field(default_factory=list)
    is_list: bool = False


def _merge(shapes: dict[str, dict[str, int]], paths: list[str]) -> tuple[Counter, dict[str, list[str]]]:
    """Kinds at the paths, and the keys below them with all places where they occur."""
    kinds: Counter = Counter()
    keys: dict[str, list[str]] = {}
    for p in paths:
        kinds.update(shapes.get(p, {}))
    for q in shapes:
        for p in paths:
            if q.startswith(p + ".") and "." not in q[len(p) + 1 :] and "[" not in q[len(p) + 1 :]:
                keys.setdefault(q[len(p) + 1 :], []).append(q)
    return kinds, keys


def plan(shapes: dict[str, dict[str, int]], paths: list[str] | None = None, name: str = "$") -> Node:
    """The tree of child tables. A path is a table if a list of objects ever stands there."""
    paths = paths or ["$"]
    kinds, keys = _merge(shapes, paths)
    element_paths = [f"{p}[]" for p in paths if f"{p}[]" in shapes]
    node = Node(name, decode=bool(kinds["json"]), is_list=any("object" in shapes[p] for p in element_paths))
    if node.is_list:
        _, element_keys = _merge(shapes, element_paths)
        for key, places in keys.items():  # a key that no element has, holding a list or an object: it only wraps the list
            if key not in element_keys and any(f"{q}[]" in shapes for q in places):
                node.wrapper = key
        alone = [p for p in paths if "object" in shapes.get(p, {})]
        wrapped = [f"{p}.{node.wrapper}" for p in alone] if node.wrapper else []
        paths = [*element_paths, *alone, *wrapped, *(f"{p}[]" for p in wrapped)]
        _, keys = _merge(shapes, paths)
    for key, places in sorted(keys.items()):
        if key == node.wrapper:
            continue
        child = plan(shapes, places, key)
        if child.is_list or child.children:
            node.children.append(child)
    return node


def _path(key: str) -> str:
    """One key as a JSON path, quoted so that any name is taken as it is."""
    return '$["' + key.replace("\\", "\\\\").replace('"', '\\"') + '"]'


def _get(v: Column, path: str, kind: str = "variant") -> Column:
    return F.try_variant_get(v, path, kind)


def _let(v: Column, f: Callable[[Column], Column]) -> Column:
    """f(v) with v evaluated once."""
    return F.get(F.transform(F.array(v), f), F.lit(0))


def _as_array(v: Column) -> Column:
    return _get(v, "$", "array<variant>")


def _as_object(v: Column) -> Column:
    return _get(v, "$", "map<string,variant>")


def _decoded(v: Column, decode: bool) -> Column:
    """What a string holds; an object or a list is left as it is, not written out and read again."""
    return _let(v, lambda x: F.when(_as_object(x).isNull() & _as_array(x).isNull(), F.try_parse_json(_get(x, "$", "string"))).otherwise(x)) if decode else v


def _elements(v: Column, node: Node) -> Column:
    """The list at a table's path: as it is, out of its wrapper, or an object standing alone."""
    if node.wrapper:
        v = _let(v, lambda x: _let(_get(x, _path(node.wrapper)), lambda w: F.when(_as_array(w).isNotNull() | _as_object(w).isNotNull(), w).otherwise(x)))
    return _let(v, lambda x: F.coalesce(_as_array(x), F.when(_as_object(x).isNotNull(), F.array(x)), F.array().cast("array<variant>")))


def _rows(v: Column, node: Node, table: str, parent: Column, parent_pos: Column) -> Column:
    """array<struct<child, row_key, parent_key, parent_pos, child_pos, node>> of a table and all tables below it."""
    v = _decoded(v, node.decode)
    if not node.is_list:
        return _below(v, node, table, parent, parent_pos)

    def one(e: Column, i: Column) -> Column:
        key = F.concat(parent, F.lit(f"/{node.name}:"), i.cast("string"))
        row = F.struct(F.lit(table).alias("child"), key.alias("row_key"), parent.alias("parent_key"), parent_pos.alias("parent_pos"), i.alias("child_pos"), e.alias("node"))
        filled = F.coalesce(F.cardinality(_as_object(e)) > 0, F.lit(False))
        own = F.when(filled, F.array(row)).otherwise(F.array().cast(ROWS))
        return F.concat(own, _below(e, node, table, key, i)) if node.children else own

    return F.flatten(F.transform(_elements(v, node), one))


ROWS = "array<struct<child:string,row_key:string,parent_key:string,parent_pos:int,child_pos:int,node:variant>>"


def _below(v: Column, node: Node, table: str, parent: Column, parent_pos: Column) -> Column:
    parts = [_rows(_get(v, _path(c.name)), c, f"{table}.{c.name}", parent, parent_pos) for c in node.children]
    return F.concat(*parts) if parts else F.array().cast(ROWS)


def explode_children(df: DataFrame, key: str, payload: str, root: Node) -> DataFrame:
    """(key, child, row_key, parent_key, parent_pos, child_pos, node): the rows of all child tables; `child` is the table's path.

    row_key is made of the record's key and the ordinals on the way down, so it is the same in every run.
    """
    text = F.col(payload).cast("string")
    v = F.try_parse_json(text)
    v = F.when(F.startswith(F.ltrim(text), F.lit('"')), F.try_parse_json(_get(v, "$", "string"))).otherwise(v)
    # a record delivered as a list is a list of records; each is a parent of its own
    records = F.coalesce(_as_array(F.col("__v")), F.array(F.col("__v")))
    base = df.select(F.col(key).alias("__key"), v.alias("__v")).filter(F.col("__v").isNotNull())
    base = base.select("__key", F.posexplode(records).alias("__i", "__r"))
    top = Node("$", children=root.children)
    parent = F.concat(F.coalesce(F.col("__key").cast("string"), F.lit("")), F.lit("#"), F.col("__i").cast("string"))
    return base.select(F.col("__key").alias(key), F.inline(_below(F.col("__r"), top, "$", parent, F.lit(0))))


def shred(df: DataFrame, key: str, payload: str) -> DataFrame:
    """infer_shapes, plan and explode_children in turn."""
    return explode_children(df, key, payload, plan(infer_shapes(df, payload)))


def child_table(rows: DataFrame, key: str, child: str, fields: dict[str, str]) -> DataFrame:
    """One child table with its fields as columns: name → key of the object; absent and null fields are null."""
    return rows.filter(F.col("child") == child).select(key, "row_key", "parent_key", "parent_pos", "child_pos", *(_get(F.col("node"), _path(k), "string").alias(n) for n, k in fields.items()))
