"""Deeply nested documents to flat parent-child tables.

The JVM's JSON reader brings every body into one nested Arrow shape (list<struct<pos, text,
inner lists>>), however the body writes it.  Flattening then works on
whole Arrow buffers: list offsets give the child arrays, parent-index kernels the owner of every
child, and keys and paths are propagated by vectorised ``take``.  No row is visited in Python.

Defined results: null, damaged or non-object bodies give no rows; a list that is null, blank or
empty gives none; a single object or a bare text stands for a list of one; an object whose keys
are all digits is a list keyed by position; JSON text inside a string is decoded first; null
elements keep their position but give no row.  Repeated rows are flattened each; extra columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: What is nested in what: list name -> lists within its elements.  ``verification`` and ``fix``
#: are single values, the others lists.
TREE = {
    "commodities": {"products": {}},
    "sources": {"evidence": {}},
    "verification": {"issues": {"fix": {}}, "history": {}},
}
SINGLE = {"verification", "fix"}


def _let(value: Column, body) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)


def _elements(text: Column) -> Column:
    """array<struct<pos, text>> of the non-null elements of a list in any notation.

    ``text`` is the JSON text of the value; a JSON string comes without its quotes, so a list
    written as text inside a string looks like the list itself.
    """
    one = F.array(F.struct(F.lit(0).alias("pos"), text.alias("text")))
    none = F.slice(one, 1, 0)
    listed = F.transform(F.from_json(text, "array<string>"), lambda e, i: F.struct(i.alias("pos"), e.alias("text")))
    keyed = _let(
        F.map_entries(F.from_json(text, "map<string,string>")),
        lambda m: F.when(
            F.forall(m, lambda e: e["key"].rlike(r"^\d{1,9}$")),
            F.transform(m, lambda e: F.struct(e["key"].try_cast("int").alias("pos"), e["value"].alias("text"))),
        ),
    )
    found = (
        F.when(text.startswith("["), F.coalesce(listed, one))
        .when(text.startswith("{"), F.coalesce(keyed, one))
        .when(F.length(F.trim(text)) > 0, one)
        .otherwise(none)
    )
    return F.filter(found, lambda e: e["text"].isNotNull())


def branch(tree: dict, kind: str) -> dict:
    """The part of ``tree`` that leads to ``kind``, without what is nested below it."""
    return {name: {} if name == kind else branch(inner, kind) for name, inner in tree.items() if name == kind or branch(inner, kind)}


def _nested(text: Column, name: str, inner: dict, payload: bool, kind: str | None = None) -> Column:
    """The list in ``text`` in the one Arrow shape: array<struct<pos, text, inner...>>; the texts of
    other kinds than ``kind`` are not kept."""
    found = _let(F.trim(text), _elements)
    if name in SINGLE:
        found = F.slice(found, 1, 1)

    def element(e: Column) -> Column:
        kept = (e["text"] if payload and kind in (None, name) else F.lit(None).cast("string")).alias("text")
        if not inner:
            return F.struct(e["pos"].alias("pos"), kept)
        parts = F.from_json(e["text"], ", ".join(f"{k} string" for k in inner))
        return F.struct(
            e["pos"].alias("pos"),
            kept,
            _let(parts, lambda p: F.struct(*(_nested(p[k], k, sub, payload, kind).alias(k) for k, sub in inner.items()))).alias("inner"),
        )

    return F.transform(found, element)


def _flatten(tree: dict, payload: bool, kind: str | None = None):
    def emit(key, path, lists, name, inner, out) -> None:
        owner = pc.list_parent_indices(lists)
        child = pc.list_flatten(lists)
        if not len(child):
            return
        keys, parents = key.take(owner), path.take(owner)
        dotted = pc.if_else(pc.equal(parents, ""), name, pc.binary_join_element_wise(parents, pa.scalar(name), "."))
        if name not in SINGLE:
            pos = pc.cast(pc.struct_field(child, "pos"), pa.string())
            dotted = pc.binary_join_element_wise(dotted, pa.scalar("["), pos, pa.scalar("]"), "")
        cols = [keys, parents, dotted]
        if payload:
            cols += [pa.array([name] * len(child), pa.string()), pc.struct_field(child, "text")]
        if kind in (None, name):
            out.append(pa.RecordBatch.from_arrays(cols, names=["key", "parent_node", "node", "kind", "text"][: len(cols)]))
        if inner:
            within = pc.struct_field(child, "inner")
            for sub, deeper in inner.items():
                emit(keys, dotted, pc.struct_field(within, sub), sub, deeper, out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key")
            root = pa.array([""], pa.string()).take(pa.array([0] * len(key), pa.int32()))
            out: list[pa.RecordBatch] = []
            for name, inner in tree.items():
                emit(key, root, batch.column(name), name, inner, out)
            yield from out

    return run


def flatten_documents(df: DataFrame, key: str, body: str, payload: bool = False, tree: dict = TREE, kind: str | None = None) -> DataFrame:
    """One row per non-null nested element: ``key``, ``parent_node``, ``node`` (and, with
    ``payload``, its ``kind`` and its own JSON ``text``).  With ``kind`` only elements of that kind
    come out, and only the lists that lead to them are read.

    ``parent_node`` is '' for elements of the document itself.  Nodes are paths with positions
    counted from 0, nulls included.
    """
    tree = tree if kind is None else branch(tree, kind)
    clean = F.regexp_replace(F.col(body), "^[\\s\ufeff]+", "")
    names = [*tree, "facility_id"]
    top = ", ".join(f"{k} string" for k in (*names, "facility", "payload"))
    outer = df.select(F.col(key).alias("key"), F.from_json(clean, top + ", _damaged string", {"columnNameOfCorruptRecord": "_damaged"}).alias("d"))
    outer = outer.where(F.col("d._damaged").isNull())
    deeper = F.coalesce(F.col("d.facility"), F.get_json_object("d.payload", "$.facility"), F.col("d.payload"))
    wrapped = F.col("d.facility_id").isNull() & deeper.startswith("{")
    inside = F.from_json(F.when(wrapped, deeper), ", ".join(f"{k} string" for k in names))
    docs = outer.select("key", "d", inside.alias("w"))
    docs = docs.select("key", *(F.coalesce(F.col(f"w.{k}"), F.when(F.col("w").isNull(), F.col(f"d.{k}"))).alias(k) for k in tree))
    shaped = docs.select("key", *(_nested(F.col(k), k, sub, payload, kind).alias(k) for k, sub in tree.items()))
    schema = f"key {dict(df.dtypes)[key]}, parent_node string, node string" + (", kind string, text string" if payload else "")
    flat = shaped.mapInArrow(_flatten(tree, payload, kind), schema)
    return flat.withColumnRenamed("key", key)


def child_table(nodes: DataFrame, key: str, kind: str, fields: dict[str, str]) -> DataFrame:
    """The flat table of one kind of element with its parent link; ``fields`` maps column names
    to ``json_name type``.  A bare text fills the first field; a number written as text counts."""
    schema = ", ".join(f"`{spec.split()[0]}` string" for spec in fields.values())
    obj = F.col("text").startswith("{")
    parsed = F.from_json(F.when(obj, F.col("text")), schema)
    bare = F.when(~obj, F.col("text"))
    cols = []
    for i, (name, spec) in enumerate(fields.items()):
        value = parsed[spec.split()[0]]
        cols.append((F.coalesce(value, bare) if i == 0 else value).try_cast(spec.split()[1]).alias(name))
    return nodes.where(F.col("kind") == kind).select(key, "parent_node", "node", *cols)
