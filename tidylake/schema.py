"""Schema construction (explicit schemas instead of inference)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

_SIMPLE_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "integer": T.IntegerType(),
    "bigint": T.LongType(), "long": T.LongType(), "double": T.DoubleType(),
    "float": T.FloatType(), "boolean": T.BooleanType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "timestamp_ntz": T.TimestampNTZType(),
}


def data_type(spec: str | T.DataType) -> T.DataType:
    """A ``DataType`` from a type name (``"int"``) or the type itself."""
    if isinstance(spec, T.DataType):
        return spec
    simple = _SIMPLE_TYPES.get(spec.strip().lower())
    if simple is not None:
        return simple
    return T.StructType.fromDDL(f"x {spec}").fields[0].dataType  # needs a session


def make_schema(fields: Iterable[tuple] | str | T.StructType) -> T.StructType:
    """Build a ``StructType``.

    ``fields`` is a list of ``(name, type)`` or ``(name, type, nullable)``
    tuples (``type`` a ``DataType`` or a type name such as ``"int"``), a DDL
    string (``"a int, b string"``) or a ready ``StructType``.  Fields are
    nullable unless stated otherwise.
    """
    if isinstance(fields, T.StructType):
        return fields
    if isinstance(fields, str):
        return T.StructType.fromDDL(fields)
    out = []
    for spec in fields:
        nullable = spec[2] if len(spec) > 2 else True
        out.append(T.StructField(spec[0], data_type(spec[1]), nullable))
    return T.StructType(out)


def reorder(schema: T.StructType, names: list[str]) -> T.StructType:
    """The fields of ``schema`` in the column order ``names`` (a file layout)."""
    by_name = {f.name: f for f in schema.fields}
    missing = [n for n in names if n not in by_name]
    if missing:
        raise ValueError(f"columns not in schema: {missing}")
    return T.StructType([by_name[n] for n in names])
