"""Deeply nested records as flat node tables with interval labels (problem 2).

Every node of a record (the record itself, elements of arrays of structs, and
optional structs in them) gets its number in pre-order and in post-order of a
depth-first traversal. Node a contains node b if and only if a.pre < b.pre and
a.post > b.post within the record, so that tables of different node types join
again without having kept each other's keys.

The traversal runs over whole Arrow columns at once: sizes of subtrees are
summed upwards and numbers handed downwards by cumulative sums, so that the
work is linear in the nodes, no record is a Python object, and the scan is a
map without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gramsmith.session import free_name, spread


@dataclass(frozen=True)
class NodeType:
    """A kind of node: where it is within its parent, its label and its number.

    path: name of the column or field that holds the node. many: an array of
    structs, else one optional struct. label, number: fields of the struct to
    emit, or None.
    """

    name: str
    path: str
    many: bool
    label: str | None = None
    number: str | None = None
    children: tuple[NodeType, ...] = field(default=())


NODE_SCHEMA = "record_id bigint, node string, pre bigint, post bigint, level int, pos int, label string, number double"
_OUT = pa.schema(
    [("record_id", pa.int64()), ("node", pa.string()), ("pre", pa.int64()), ("post", pa.int64()), ("level", pa.int32()), ("pos", pa.int32()), ("label", pa.string()), ("number", pa.float64())]
)


class _Nodes:
    """The nodes of one type in a batch, in document order, with their children."""

    def __init__(self, kind: NodeType | None, parent: np.ndarray, pos: np.ndarray, values: pa.Array | None):
        self.kind, self.parent, self.pos, self.values = kind, parent, pos, values
        self.children: list[_Nodes] = []
        self.size = np.ones(len(parent), dtype=np.int64)


def _expand(kind: NodeType, column: pa.Array, parent_pos: np.ndarray) -> _Nodes:
    """The non-null nodes of one type below the rows of ``column``."""
    if kind.many:
        owner = pc.list_parent_indices(column).to_numpy()
        flat = pc.list_flatten(column)
        starts = np.searchsorted(owner, np.arange(len(column)))
        pos = np.arange(len(owner)) - starts[owner] if len(owner) else np.zeros(0, dtype=np.int64)
    else:
        owner, flat, pos = np.arange(len(column)), column, parent_pos
    keep = flat.is_valid().to_numpy(zero_copy_only=False)
    nodes = _Nodes(kind, owner[keep], pos[keep], flat.filter(pa.array(keep)))
    for child in kind.children:
        nodes.children.append(_expand(child, pc.struct_field(nodes.values, child.path), nodes.pos))
    return nodes


def _sizes(nodes: _Nodes) -> None:
    for c in nodes.children:
        _sizes(c)
        nodes.size += np.bincount(c.parent, weights=c.size, minlength=len(nodes.size)).astype(np.int64)


def _number(nodes: _Nodes, pre: np.ndarray, level: int, out: list) -> None:
    """Pre-order numbers downwards; post = pre + size - 1 - level counts the nodes closed before."""
    out.append((nodes, pre, pre + nodes.size - 1 - level, level))
    at = pre + 1
    for c in nodes.children:
        before = np.cumsum(c.size) - c.size
        first = np.searchsorted(c.parent, np.arange(len(nodes.size)))
        base = np.append(before, before[-1] + c.size[-1] if len(before) else 0)[first]
        _number(c, at[c.parent] + before - base[c.parent], level + 1, out)
        at = at + np.bincount(c.parent, weights=c.size, minlength=len(nodes.size)).astype(np.int64)


def shred(df: DataFrame, id_col: str, types: tuple[NodeType, ...]) -> DataFrame:
    """All nodes of all records: record_id, node, pre, post, level, pos, label, number.

    The record is the root (node ``record``, pre 0, level 0, pos 0). pos is the
    place in the array, from 0 and counting null elements; a single struct has
    the pos of its parent. Null elements and null structs are no nodes; null and
    empty arrays have none. label and number stay null where the field is null.
    Repeated records give repeated nodes. Other columns are never read.
    """
    columns = list(dict.fromkeys(t.path for t in types))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n = b.num_rows
            zero = np.zeros(n, dtype=np.int64)
            root = _Nodes(None, np.arange(n), zero, None)
            for t in types:
                root.children.append(_expand(t, b.column(1 + columns.index(t.path)), zero))
            _sizes(root)
            out: list = []
            _number(root, zero, 0, out)
            record = {id(root): np.arange(n)}
            for nodes, *_ in out:
                for c in nodes.children:
                    record[id(c)] = record[id(nodes)][c.parent]
            for nodes, pre, post, level in out:
                m, k = len(pre), nodes.kind
                of = lambda f, t: pc.struct_field(nodes.values, f).cast(t) if f else pa.nulls(m, t)  # noqa: B023, E731
                label, number = (of(k.label, pa.string()), of(k.number, pa.float64())) if k else (pa.nulls(m, pa.string()), pa.nulls(m, pa.float64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        b.column(0).take(pa.array(record[id(nodes)])).cast(pa.int64()),
                        pa.array([k.name if k else "record"] * m, pa.string()),
                        pa.array(pre, pa.int64()),
                        pa.array(post, pa.int64()),
                        pa.array(np.full(m, level), pa.int32()),
                        pa.array(nodes.pos, pa.int32()),
                        label,
                        number,
                    ],
                    schema=_OUT,
                )

    return spread(df.select(id_col, *columns)).mapInArrow(run, NODE_SCHEMA)


def node_table(nodes: DataFrame, name: str) -> DataFrame:
    return nodes.filter(F.col("node") == name)


def contains(outer: str, inner: str) -> Column:
    """The join condition by which a node of alias ``outer`` is an ancestor of one of alias ``inner``."""
    o, i = (lambda c: F.col(f"{outer}.{c}")), (lambda c: F.col(f"{inner}.{c}"))
    return (o("record_id") == i("record_id")) & (o("pre") < i("pre")) & (o("post") > i("post"))


def link(parents: DataFrame, children: DataFrame, parent_level: int) -> DataFrame:
    """Children with parent_pre, the pre-order number of their ancestor on a level.

    An equi-join on the record and a range condition within it; records are
    small groups, so no key is hot.
    """
    name = free_name(children.columns, "parent_pre")
    p = parents.filter(F.col("level") == parent_level).select("record_id", "pre", "post").alias("p")
    return children.alias("c").join(p, contains("p", "c")).select("c.*", F.col("p.pre").alias(name))


#: The nodes of a curated recipe.
RECIPE_TYPES = (
    NodeType("ingredient", "ingredients", True, label="name", children=(NodeType("whole_unit", "whole_unit", False, label="name", number="grams"),)),
    NodeType("source", "sources", True, label="title"),
)


def recipe_nodes(recipes: DataFrame) -> DataFrame:
    """record_id, node, pos, label, milligrams of every node below a curated recipe.

    label is '' for null; milligrams is grams × 1000, rounded half up, and 0 for
    null, NaN and other nodes.
    """
    nodes = shred(recipes, "record_id", RECIPE_TYPES)
    mg = F.floor(F.nanvl("number", F.lit(0.0)) * 1000 + 0.5).cast("bigint")
    return nodes.filter("level > 0").select("record_id", "node", "pos", F.coalesce("label", F.lit("")).alias("label"), F.coalesce(mg, F.lit(0)).cast("bigint").alias("milligrams"))
