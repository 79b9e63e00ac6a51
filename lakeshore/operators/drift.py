"""Schema drift between sources (U1): one type per column over all of them.

The types form a lattice, so the result does not depend on the order of the sources:

* null is below every type;
* numbers widen: byte < short < int < bigint < double, float < double, decimals to a decimal
  that holds both, and with a float or double to double;
* date < timestamp_ntz < timestamp;
* any two other types meet in string (binary and string in binary): numbers and times in
  their plain text, nested values as JSON;
* arrays, maps and structs are resolved element by element; struct fields go by name, and
  absent ones are null.  Map keys of different types are text, as doubles might coincide.

Names are compared as Spark does, without case; the first spelling seen stays.  All of it is
casts in a projection per source, before the union: nothing is read or shuffled for it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INTEGER_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_FRACTIONS = (T.FloatType, T.DoubleType)
_TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
_NESTED = (T.ArrayType, T.MapType, T.StructType)
_MOST_DIGITS = 38


def quoted(name: str) -> Column:
    """A column by its name as it is, dots and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def _as_decimal(kind: T.DataType) -> T.DecimalType:
    return kind if isinstance(kind, T.DecimalType) else T.DecimalType(_INTEGER_DIGITS[type(kind)], 0)


def _wider_number(a: T.DataType, b: T.DataType) -> T.DataType:
    if isinstance(a, _INTEGERS) and isinstance(b, _INTEGERS):
        return max(a, b, key=lambda k: _INTEGERS.index(type(k)))
    if isinstance(a, _FRACTIONS) or isinstance(b, _FRACTIONS):
        return T.DoubleType()
    a, b = _as_decimal(a), _as_decimal(b)
    scale = max(a.scale, b.scale)
    digits = max(a.precision - a.scale, b.precision - b.scale) + scale
    return T.DecimalType(digits, scale) if digits <= _MOST_DIGITS else T.StringType()


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type of the lattice that holds the values of both."""
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        return merged([a, b])
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(wider(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        key = a.keyType if a.keyType == b.keyType else T.StringType()
        return T.MapType(key, wider(a.valueType, b.valueType))
    if type(a) is type(b) and not isinstance(a, T.DecimalType):
        return a if a == b else T.StringType()
    numbers = (*_INTEGERS, *_FRACTIONS, T.DecimalType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        return _wider_number(a, b)
    if isinstance(a, _TIMES) and isinstance(b, _TIMES):
        return max(a, b, key=lambda k: _TIMES.index(type(k)))
    if {type(a), type(b)} == {T.BinaryType, T.StringType}:
        return T.BinaryType()
    return T.StringType()


def merged(schemas: Sequence[T.StructType]) -> T.StructType:
    """The columns of all schemas, in the order in which they are first seen."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.get(field.name.lower())
            kind = field.dataType if known is None else wider(known.dataType, field.dataType)
            fields[field.name.lower()] = T.StructField(field.name if known is None else known.name, kind)
    return T.StructType(list(fields.values()))


def converted(value: Column, kind: T.DataType, to: T.DataType) -> Column:
    """A value of one type as a wider one."""
    if kind == to:
        return value
    if isinstance(kind, T.StructType) and isinstance(to, T.StructType):
        return F.when(value.isNotNull(), F.struct(*_fields(kind, to, value.getField)))
    if isinstance(kind, T.ArrayType) and isinstance(to, T.ArrayType):
        return F.transform(value, lambda x: converted(x, kind.elementType, to.elementType)).cast(to)
    if isinstance(kind, T.MapType) and isinstance(to, T.MapType):
        values = F.transform_values(value, lambda _, v: converted(v, kind.valueType, to.valueType))
        return (values if kind.keyType == to.keyType else F.transform_keys(values, lambda k, _: converted(k, kind.keyType, to.keyType))).cast(to)
    if isinstance(kind, _NESTED):
        text = F.to_json(value)
        return text if isinstance(to, T.StringType) else text.cast(to)
    return value.cast(to)


def _fields(kind: T.StructType, to: T.StructType, get) -> list[Column]:
    """The columns of ``to``, from those of ``kind`` that ``get`` gives by name."""
    have = {f.name.lower(): f for f in kind}
    return [(converted(get(have[f.name.lower()].name), have[f.name.lower()].dataType, f.dataType)
             if f.name.lower() in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in to]


def resolved(frames: Sequence[DataFrame]) -> list[DataFrame]:
    """The frames with the same columns and types, absent columns as nulls."""
    schema = merged([df.schema for df in frames])
    return [df.select(*_fields(df.schema, schema, quoted)) for df in frames]


def union_resolved(frames: Sequence[DataFrame]) -> DataFrame:
    """Bag union of sources whose columns and types differ."""
    return reduce(DataFrame.union, resolved(frames))
