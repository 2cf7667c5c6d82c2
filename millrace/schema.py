"""Declared schemas and column checks; driver-side only, no data is read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, types as T

from millrace.defaults import REQUIRED_COLUMNS, REVIEW_DDL
from millrace.errors import MissingColumnsError, SchemaError


def build_schema(fields: Iterable[Mapping]) -> T.StructType:
    """``[{name, type, nullable}]`` to a StructType.

    Any Spark DDL type name is accepted. An unknown type or a repeated name
    raises instead of dropping the field.
    """
    built: list[T.StructField] = []
    seen: set[str] = set()
    for field in fields:
        name = field["name"]
        if name.lower() in seen:
            raise SchemaError(f"field {name!r} is declared twice")
        seen.add(name.lower())
        try:
            data_type = T.DataType.fromDDL(field["type"])
        except PySparkException as exc:
            raise SchemaError(f"field {name!r} has unknown type {field['type']!r}") from exc
        built.append(T.StructField(name, data_type, field.get("nullable", True)))
    return T.StructType(built)


def review_schema() -> T.StructType:
    """The record of the review stream."""
    return T.StructType.fromDDL(REVIEW_DDL)


def as_schema(schema: T.StructType | str) -> T.StructType:
    """A StructType as given, or parsed from a DDL string."""
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def missing_columns(columns: Iterable[str], required: Iterable[str]) -> list[str]:
    present = set(columns)
    return [name for name in required if name not in present]


def require_columns(df: DataFrame, required: Iterable[str] = REQUIRED_COLUMNS) -> DataFrame:
    """``df`` itself, or MissingColumnsError naming what is absent."""
    missing = missing_columns(df.columns, required)
    if missing:
        raise MissingColumnsError(missing)
    return df


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def widened(one: T.DataType, two: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both without loss, or null.

    Whole numbers widen among each other, the three shorter ones to double, float to double, decimals to the digits of
    both on each side of the point, a date to a timestamp without zone. Fields that one struct lacks are null there.
    """
    if one == two:
        return one
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        return _merged(one, two)[0]
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        element = widened(one.elementType, two.elementType)
        return None if element is None else T.ArrayType(element, one.containsNull or two.containsNull)
    if isinstance(one, T.MapType) and isinstance(two, T.MapType):
        value = widened(one.valueType, two.valueType)
        if one.keyType != two.keyType or value is None:
            return None
        return T.MapType(one.keyType, value, one.valueContainsNull or two.valueContainsNull)
    if isinstance(one, T.DecimalType) and isinstance(two, T.DecimalType):
        scale = max(one.scale, two.scale)
        digits = max(one.precision - one.scale, two.precision - two.scale) + scale
        return T.DecimalType(digits, scale) if digits <= 38 else None
    kinds = {type(one), type(two)}
    if kinds <= set(_WHOLE):
        return max(one, two, key=lambda t: _WHOLE.index(type(t)))
    if T.DoubleType in kinds and kinds <= {T.DoubleType, T.FloatType, *_WHOLE[:3]}:
        return T.DoubleType()
    if kinds == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    return None


def _merged(one: T.StructType, two: T.StructType) -> tuple[T.StructType | None, str | None]:
    """Both structs in one, or the name of the first field that cannot be."""
    held = {f.name.lower(): f for f in two.fields}
    fields = []
    for field in one.fields:
        other = held.pop(field.name.lower(), None)
        kind = field.dataType if other is None else widened(field.dataType, other.dataType)
        if kind is None:
            return None, field.name
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType([*fields, *[T.StructField(f.name, f.dataType, True) for f in held.values()]]), None


def merge_schemas(one: T.StructType, two: T.StructType) -> T.StructType:
    """The schema that reads rows of both; raises SchemaError naming a field that fits neither way."""
    merged, bad = _merged(one, two)
    if merged is None:
        kinds = [s[[f.lower() for f in s.fieldNames()].index(bad.lower())].dataType.simpleString() for s in (one, two)]
        raise SchemaError(f"field {bad!r} is {kinds[0]} here and {kinds[1]} there")
    return merged
