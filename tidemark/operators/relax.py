"""One type for a column that two frames hold under different types."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MOST_DIGITS = 38
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Equal types stay, numbers take the wider type, nested types meet part by part, all else meets as text.

    A struct has the fields of both; maps must have keys of one type.
    """
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if isinstance(a, _WHOLE) and isinstance(b, _WHOLE):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        exact = [T.DecimalType(19, 0) if isinstance(t, _WHOLE) else t for t in (a, b)]
        if all(isinstance(t, T.DecimalType) for t in exact):
            scale = max(t.scale for t in exact)
            digits = max(t.precision - t.scale for t in exact) + scale
            if digits <= MOST_DIGITS:
                return T.DecimalType(digits, scale)
        return T.DoubleType()
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(common_type(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType) and a.keyType == b.keyType:
        return T.MapType(a.keyType, common_type(a.valueType, b.valueType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return _common_fields(a, b)
    return T.StringType()


def _common_fields(*schemas: T.StructType) -> T.StructType:
    """The fields of all, by name, in the order they are met."""
    types: dict[str, T.DataType] = {}
    for field in (f for schema in schemas for f in schema.fields):
        types[field.name] = common_type(types[field.name], field.dataType) if field.name in types else field.dataType
    return T.StructType([T.StructField(name, dtype) for name, dtype in types.items()])


def as_type(c: Column, have: T.DataType, want: T.DataType) -> Column:
    if have == want:
        return c
    if isinstance(have, T.ArrayType) and isinstance(want, T.ArrayType):
        return F.transform(c, lambda x: as_type(x, have.elementType, want.elementType))
    if isinstance(have, T.MapType) and isinstance(want, T.MapType):
        return F.transform_values(c, lambda _, x: as_type(x, have.valueType, want.valueType))
    if isinstance(have, T.StructType) and isinstance(want, T.StructType):
        own = {f.name: f.dataType for f in have.fields}
        fields = [_field(c.getField(f.name), own.get(f.name), f).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*fields))
    nested = isinstance(have, (T.ArrayType, T.MapType, T.StructType))
    return F.to_json(c) if nested and isinstance(want, T.StringType) else c.cast(want)


def _field(c: Column, have: T.DataType | None, want: T.StructField) -> Column:
    return F.lit(None).cast(want.dataType) if have is None else as_type(c, have, want.dataType)


def shaped(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The frame in the columns and types of the schema; columns that it lacks are null."""
    own = {f.name: f.dataType for f in df.schema.fields}
    return df.select(
        [
            _field(F.col(f"`{f.name}`"), own.get(f.name), f).alias(f.name)
            for f in schema.fields
        ]
    )


def relaxed_union(*frames: DataFrame) -> DataFrame:
    """All rows of the frames, matched by column name, each column in a type that holds all its values."""
    schema = _common_fields(*[df.schema for df in frames])
    return reduce(DataFrame.union, [shaped(df, schema) for df in frames])
