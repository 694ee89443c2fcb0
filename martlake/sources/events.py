"""Event records: nested payloads flattened to dotted-path columns.

JSON text is parsed with a declared schema (``from_json``), or with the schema of
all its payloads: ``payload_schema`` merges the types of every row's VARIANT in one
aggregate, so a key that occurs once in the whole table has its column. Single keys
can be read through a VARIANT without any schema (``variant_fields``).
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martlake.functions.scalar import parse_timestamp


def flatten_struct(col: Column, dtype: T.StructType, prefix: str) -> list[Column]:
    """Every leaf of a struct as its own column named ``prefix_a_b``."""
    out = []
    for f in dtype.fields:
        child = col.getField(f.name)
        name = f"{prefix}_{f.name}"
        if isinstance(f.dataType, T.StructType):
            out += flatten_struct(child, f.dataType, name)
        else:
            out.append(child.alias(name))
    return out


def flatten_events(df: DataFrame, nested: dict[str, T.StructType | str],
                   timestamp_col: str | None = None) -> DataFrame:
    """Parse JSON text columns (or take struct columns) and flatten them.

    ``nested`` maps a column to its schema. A text column is parsed with
    ``from_json``; a struct column is used as is. The timestamp column, when
    text, is parsed to a naive UTC timestamp.
    """
    keep = [F.col(c) for c in df.columns if c not in nested and c != timestamp_col]
    cols = list(keep)
    if timestamp_col:
        ts_type = dict(df.dtypes)[timestamp_col]
        ts = F.col(timestamp_col) if ts_type.startswith("timestamp") else parse_timestamp(timestamp_col)
        cols.append(ts.alias(timestamp_col))
    for name, schema in nested.items():
        st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        src = F.col(name)
        if dict(df.dtypes)[name] == "string":
            src = F.from_json(src, st)
        cols += flatten_struct(src, st, name)
    return df.select(*cols)


def variant_fields(df: DataFrame, column: str, paths: dict[str, str]) -> DataFrame:
    """Read arbitrary keys from JSON text without a full schema:
    ``paths`` maps output column -> ``"$.path::type"``."""
    v = F.parse_json(F.col(column))
    extra = []
    for out, spec in paths.items():
        path, typ = spec.split("::")
        extra.append(F.try_variant_get(v, path, typ).alias(out))
    return df.select("*", *extra)


def payload_schema(df: DataFrame, column: str) -> T.StructType:
    """Schema of all payloads in a JSON text column: the union of their keys, each with
    the type that holds all its values (text, if they have none in common). Rows
    that aren't JSON objects don't count. One aggregate; one text reaches the driver."""
    v = F.try_parse_json(F.col(f"`{column}`"))
    found = df.where(F.schema_of_variant(v).startswith("OBJECT<")).agg(F.schema_of_variant_agg(v)).first()[0]
    if found is None or not found.startswith("OBJECT<"):
        return T.StructType([])
    return _readable(T._parse_datatype_string(found.replace("OBJECT<", "STRUCT<")))


def _readable(t: T.DataType) -> T.DataType:
    """The type with text where a key has nulls only or values of no common type."""
    if isinstance(t, T.StructType):
        return T.StructType([T.StructField(f.name, _readable(f.dataType)) for f in t.fields])
    if isinstance(t, T.ArrayType):
        return T.ArrayType(_readable(t.elementType))
    return T.StringType() if isinstance(t, (T.NullType, T.VariantType)) else t


def flatten_discovered(df: DataFrame, column: str, schema: T.StructType | None = None) -> DataFrame:
    """``df`` with every key of its JSON text column as a column of its own
    (``column_key``, nested keys ``column_key_inner``), whatever keys the rows have.
    A payload that isn't JSON has nulls; the text itself is kept as ``column``."""
    schema = payload_schema(df, column) if schema is None else schema
    v = F.try_parse_json(F.col(f"`{column}`"))

    def leaves(t: T.StructType, path: str, name: str) -> list[Column]:
        out = []
        for f in t.fields:
            here, label = f"{path}[{json.dumps(f.name)}]", f"{name}_{f.name}"
            if isinstance(f.dataType, T.StructType) and f.dataType.fields:
                out += leaves(f.dataType, here, label)
            elif isinstance(f.dataType, (T.StructType, T.ArrayType)):
                out.append(F.to_json(F.try_variant_get(v, here, "variant")).alias(label))
            else:
                out.append(F.try_variant_get(v, here, f.dataType.simpleString()).alias(label))
        return out
    return df.select("*", *leaves(schema, "$", column))
