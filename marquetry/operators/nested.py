"""Deeply nested records as related flat tables (problem 6).

JSON of drifting shape is first brought to one declared Arrow shape by JVM expressions (`canonical_list`);
flattening then runs on Arrow buffers: list lengths and parent indices give the child arrays, keys follow by
`take`, and no row is looked at in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Level:
    """A list of objects: `column` holds it, `child` names its rows, `name` is the field reported of each object."""

    child: str
    column: str
    name: str
    below: tuple["Level", ...] = field(default=())


def child_rows(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Elements of a list array, the index of each one's parent, and its 1-based place in the list."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    parents = np.repeat(np.arange(len(lengths)), lengths)
    starts = np.cumsum(lengths) - lengths
    places = np.arange(len(parents)) - starts[parents] + 1
    return pc.list_flatten(lists), parents, places


def _emit(level: Level, lists: pa.ListArray, keys: pa.Array, parent_pos: np.ndarray) -> Iterator[pa.RecordBatch]:
    values, parents, places = child_rows(lists)
    if not len(values):
        return
    keys, above = keys.take(pa.array(parents)), parent_pos[parents]
    here = values.is_valid()
    yield pa.RecordBatch.from_arrays(
        [
            keys.filter(here),
            pa.array([level.child] * int(pc.sum(here).as_py() or 0), pa.string()),
            pa.array(above.astype(np.int32)).filter(here),
            pa.array(places.astype(np.int32)).filter(here),
            pc.struct_field(values, level.name).filter(here).cast(pa.string()),
        ],
        names=["row_key", "child", "parent_pos", "pos", "name"],
    )
    for below in level.below:
        yield from _emit(below, pc.struct_field(values, below.column), keys, places)


def flatten_tree(df: DataFrame, key: str, levels: list[Level]) -> DataFrame:
    """One row per nested object of all `levels`, in one pass and without a shuffle.

    Result: row_key (type of `key`), child, parent_pos (0 at the top), pos, name. A null element takes a place
    but gives no row; a null or empty list gives none; an object without the named field gives a row with a null
    name; a null key stays null and repeated rows each give their rows. Other columns are pruned at the scan,
    so clashing names in them do no harm.
    """
    kind = df.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField("row_key", kind),
            T.StructField("child", T.StringType()),
            T.StructField("parent_pos", T.IntegerType()),
            T.StructField("pos", T.IntegerType()),
            T.StructField("name", T.StringType()),
        ]
    )
    columns = list(dict.fromkeys([key, *(v.column for v in levels)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            top = np.zeros(batch.num_rows, np.int64)
            for level in levels:
                yield from _emit(level, batch.column(columns.index(level.column)), keys, top)

    return df.select(*columns).mapInArrow(run, schema)


def flatten_list(df: DataFrame, key: str, column: str, below: str | None = None) -> DataFrame:
    """The objects of the list `column` (or of their own list `below`) with all fields, as one flat table.

    Result: row_key, parent_pos (with `below`), pos, then the object's fields; lists inside stay as they are.
    Nulls are treated as by `flatten_tree`.
    """
    item = df.schema[column].dataType.elementType
    if below:
        item = item[below].dataType.elementType
    places = [T.StructField(n, T.IntegerType()) for n in (["parent_pos", "pos"] if below else ["pos"])]
    schema = T.StructType([T.StructField("row_key", df.schema[key].dataType), *places, *item.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            values, parents, pos = child_rows(batch.column(1))
            trail = [pos]
            if below:
                keys = keys.take(pa.array(parents))
                values, inner, deep = child_rows(pc.struct_field(values, below))
                trail, parents = [pos[inner], deep], inner
            here = values.is_valid()
            yield pa.RecordBatch.from_arrays(
                [
                    keys.take(pa.array(parents)).filter(here),
                    *(pa.array(x.astype(np.int32)).filter(here) for x in trail),
                    *(pc.struct_field(values, f.name).filter(here) for f in item.fields),
                ],
                names=[f.name for f in schema.fields],
            )

    return df.select(key, column).mapInArrow(run, schema)


def unwrap_json(text: Column) -> Column:
    """JSON text; a JSON string that itself holds JSON is unwrapped. Null if it is no JSON."""
    return F.when(F.ltrim(text).startswith('"'), F.get_json_object(text, "$")).otherwise(text)


def canonical_list(text: Column, wrapper: str = "items") -> Column:
    """The elements of a JSON list as array<string>, whatever manner the list is written in.

    A list gives its elements; an object with the `wrapper` key gives the list under it; another object is a list
    of one; a bare text is a list of one; a text that holds a JSON list is read as that list. Null stays null, and
    a text that opens a list but is no JSON gives null.
    """
    t = F.ltrim(text)
    inner = F.get_json_object(t, f"$.{wrapper}")
    listed = F.when(t.startswith("{") & F.ltrim(inner).startswith("["), inner).otherwise(t)
    return F.when(listed.startswith("["), F.from_json(listed, "array<string>")).when(
        listed.isNotNull(), F.array(t)
    )


def canonical_objects(text: Column, name: str, below: str | None = None, below_name: str | None = None) -> Column:
    """A JSON list as array<struct<name[, below: array<struct<below_name>>]>>; null elements stay null.

    An element that is a bare text is an object with that name.
    """
    fields = f"`{name}` string" + (f", `{below}` string" if below else "")

    def build(e: Column) -> Column:
        is_object = F.ltrim(e).startswith("{")
        parsed = F.from_json(e, f"struct<{fields}>")
        named = F.when(is_object, parsed[name]).otherwise(e).alias(name)
        if not below:
            return F.when(e.isNotNull(), F.struct(named))
        inner = F.when(is_object, canonical_objects(parsed[below], below_name)).alias(below)
        return F.when(e.isNotNull(), F.struct(named, inner))

    return F.transform(canonical_list(text), build)
