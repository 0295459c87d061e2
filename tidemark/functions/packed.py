"""Whole rows as one text column, for steps in Python that carry rows without looking into them.

Values travel as text, each in a form that reads back as the same value, so neither nulls nor types
depend on what Python makes of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def as_text(c: Column, kind: T.DataType) -> Column:
    """A value as text, the same for equal values only; null stays null."""
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(c.isNotNull(), F.to_json(F.struct(_to_wire(c, kind).alias("f"))))
    if isinstance(kind, T.BinaryType):
        return F.base64(c)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("string")
    return c.cast("string")


def _from_text(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BinaryType):
        return F.unbase64(c)
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c.cast("long"))
    if isinstance(kind, T.DateType):
        return F.date_from_unix_date(c.cast("int"))
    return c if isinstance(kind, T.StringType) else c.cast(kind)


def _wire(kind: T.DataType) -> T.DataType:
    """The type of a value on its way: nested as it was, with text at the leaves."""
    if isinstance(kind, T.StructType):
        return T.StructType([T.StructField(f"f{i}", _wire(f.dataType)) for i, f in enumerate(kind.fields)])
    if isinstance(kind, T.ArrayType):
        return T.ArrayType(_wire(kind.elementType))
    if isinstance(kind, T.MapType):
        return T.ArrayType(T.StructType([T.StructField("k", _wire(kind.keyType)), T.StructField("v", _wire(kind.valueType))]))
    return T.StringType()


def _to_wire(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_to_wire(c.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind.fields)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _to_wire(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform(F.map_entries(c), lambda e: F.struct(_to_wire(e["key"], kind.keyType).alias("k"),
                                                                _to_wire(e["value"], kind.valueType).alias("v")))
    return as_text(c, kind)


def _from_wire(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.StructType):
        fields = [_from_wire(c.getField(f"f{i}"), f.dataType).alias(f.name) for i, f in enumerate(kind.fields)]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(c, lambda x: _from_wire(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.map_from_entries(F.transform(c, lambda e: F.struct(_from_wire(e["k"], kind.keyType), _from_wire(e["v"], kind.valueType))))
    return _from_text(c, kind)


def pack(schema: T.StructType) -> Column:
    """The columns of ``schema`` as one text, never null."""
    fields = [_to_wire(F.col(f"`{f.name}`"), f.dataType).alias(f"f{i}") for i, f in enumerate(schema.fields)]
    return F.to_json(F.struct(*fields))


def unpack(rows: DataFrame, packed: str, schema: T.StructType) -> DataFrame:
    """The rows that ``pack`` has put into the column ``packed``; every text is parsed once."""
    parsed = rows.select(F.from_json(F.col(packed), _wire(schema)).alias("r"))
    return parsed.select([_from_wire(F.col(f"r.f{i}"), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
