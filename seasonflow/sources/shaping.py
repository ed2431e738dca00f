"""Nested-payload shaping.

Landed feeds arrive as JSON text or nested structs; staging expects flat,
typed columns.  Everything here is a per-row projection / generator: no
shuffle, no collection of records into one task.
"""

from __future__ import annotations

import fnmatch
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parse_json(col, schema: T.DataType) -> Column:
    """JSON text -> typed value; malformed text becomes NULL (PERMISSIVE)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.from_json(c, schema, {"mode": "PERMISSIVE"})


def nested_to_json(df: DataFrame) -> DataFrame:
    """Every struct / array / map column serialised to JSON text."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
            out.append(F.to_json(F.col(f"`{f.name}`")).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)


def _flat_cols(dt: T.StructType, prefix: list[str], sep: str, upper: bool,
               root: str | None = None) -> list[Column]:
    cols = []
    for f in dt.fields:
        path = prefix + [f.name]
        ref = F.col(".".join(f"`{p}`" for p in ([root] if root else []) + path))
        name = sep.join(path)
        name = name.upper() if upper else name
        if isinstance(f.dataType, T.StructType):
            cols += _flat_cols(f.dataType, path, sep, upper, root)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
            cols.append(F.to_json(ref).alias(name))      # arrays stay JSON text
        else:
            cols.append(ref.alias(name))
    return cols


def flatten_structs(df: DataFrame, sep: str = "_", upper: bool = False) -> DataFrame:
    """Nested objects -> joined column names (``awayTeam.abbrev`` ->
    ``AWAYTEAM_ABBREV`` with ``upper=True``); arrays are kept as JSON text."""
    return df.select(*_flat_cols(df.schema, [], sep, upper))


def explode_events(df: DataFrame, array_json: str, element: T.StructType, keep: Sequence[str],
                   sep: str = "_", upper: bool = False) -> DataFrame:
    """One row per element of a JSON array column (``plays: [...]``), flattened.
    Rows whose array is NULL or empty produce no rows (inner explode)."""
    exploded = df.select(*keep, F.explode(parse_json(array_json, T.ArrayType(element))).alias("__e"))
    return exploded.select(*keep, *_flat_cols(element, [], sep, upper, root="__e"))


def extract_records(df: DataFrame, payload: str, schema: T.StructType, path: Sequence[str],
                    keep: Sequence[str] = ()) -> DataFrame:
    """Walk ``path`` inside a JSON payload.  Empty path = the whole payload
    as one record; a list at the end = many records; missing = none."""
    parsed = df.select(*keep, parse_json(payload, schema).alias("__p"))
    target = F.col("__p")
    dt: T.DataType = schema
    for step in path:
        target = target.getField(step)
        dt = dt[step].dataType if isinstance(dt, T.StructType) else dt
    if isinstance(dt, T.ArrayType):
        return parsed.select(*keep, F.explode(target).alias("record"))
    return parsed.select(*keep, target.alias("record")).filter(F.col("record").isNotNull())


def carry_parent_key(parent: DataFrame, key: str, children: str, child_name: str = "child") -> DataFrame:
    """Child records stamped with the parent key; parents with a NULL key skipped."""
    return (parent.filter(F.col(key).isNotNull())
                  .select(key, F.explode(children).alias(child_name)))


def _without(dt: T.DataType, pattern: str) -> T.DataType | None:
    """The type without fields that match, at any depth; None where nothing is left."""
    if isinstance(dt, T.StructType):
        kept = [(f, _without(f.dataType, pattern)) for f in dt.fields if not fnmatch.fnmatchcase(f.name, pattern)]
        kept = [T.StructField(f.name, t, f.nullable) for f, t in kept if t is not None]
        return T.StructType(kept) if kept else None
    if isinstance(dt, T.ArrayType):
        inner = _without(dt.elementType, pattern)
        return None if inner is None else T.ArrayType(inner, dt.containsNull)
    if isinstance(dt, T.MapType):
        inner = _without(dt.valueType, pattern)
        return None if inner is None else T.MapType(dt.keyType, inner, dt.valueContainsNull)
    return dt


def _rewrite(col: Column, old: T.DataType, new: T.DataType) -> Column:
    """``col`` with only the fields that ``new`` has; NULL structs stay NULL."""
    if old == new:
        return col
    if isinstance(old, T.StructType):
        fields = [_rewrite(col.getField(f.name), old[f.name].dataType, f.dataType).alias(f.name) for f in new.fields]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(old, T.ArrayType):
        return F.transform(col, lambda x: _rewrite(x, old.elementType, new.elementType))
    return F.transform_values(col, lambda k, v: _rewrite(v, old.valueType, new.valueType))


def drop_fields(df: DataFrame, pattern: str) -> DataFrame:
    """Remove columns whose name matches a glob; ``**.name`` also fields at any
    depth, through structs, arrays of structs and map values.  A struct, array or map
    of which nothing is left goes as a whole."""
    deep = pattern.startswith("**.")
    pat = pattern[3:] if deep else pattern
    cols = []
    for f in df.schema.fields:
        left = None if fnmatch.fnmatchcase(f.name, pat) else _without(f.dataType, pat) if deep else f.dataType
        if left is not None:
            cols.append(_rewrite(F.col(f"`{f.name}`"), f.dataType, left).alias(f.name))
    return df.select(*cols)
