"""JSON lines to typed records, with everything that does not fit kept aside.

A line becomes one record (object) or several (array of objects). Blank lines
are dropped. Every other line is rejected with a reason: ``invalid_json``,
``not_object`` or ``type_mismatch``. So for any input

    lines = lines with records + rejected lines + blank lines.

Works the same on batch and streaming text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from millrace.errors import SchemaError
from millrace.functions.barrier import evaluated_once
from millrace.functions.json_text import (
    BLANK,
    END,
    INVALID,
    NOT_OBJECT,
    PARSE_OPTIONS,
    PROBLEM,
    TYPE_MISMATCH,
    end_mark,
    is_json,
    is_json_object,
    is_json_object_array,
    line_problem,
    opens_array,
    opens_object,
    strip_space,
)
from millrace.schema import as_schema

_RAW = "_raw"

# Types whose JSON text survives a detour through string; others parse natively.
_VIA_TEXT = (
    T.ByteType,
    T.ShortType,
    T.IntegerType,
    T.LongType,
    T.FloatType,
    T.DoubleType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def _reading_schema(schema: T.StructType, strict: bool) -> T.StructType:
    fields = []
    for field in schema.fields:
        loose = not strict and isinstance(field.dataType, _VIA_TEXT)
        fields.append(T.StructField(field.name, T.StringType() if loose else field.dataType))
    return T.StructType(fields)


def _typed(record: Column, field: T.StructField, strict: bool) -> Column:
    value = record[field.name]
    if not strict and isinstance(field.dataType, _VIA_TEXT):
        value = value.try_cast(field.dataType)
    return value


def records_with_problems(
    lines: DataFrame,
    schema: T.StructType | str,
    text: str = "value",
    keep: Sequence[str] = (),
    strict_types: bool = False,
    reject_mismatch: bool | Sequence[str] = False,
    problem_column: str = PROBLEM,
    line_column: str = "line",
    coerced_column: str | None = None,
) -> DataFrame:
    """Parse every line once: one row per record and one per rejected line.

    Output: the schema's columns, then ``keep``, then ``problem`` (null for a
    record) and ``line`` (the raw text of a rejected line, null for a record).
    Other names for the last two can be given when a field already uses them.

    ``strict_types=False`` reads scalars loosely (``"89"`` is 89 for a bigint)
    and nulls what does not convert; ``reject_mismatch=True`` rejects the line
    instead, and a list of fields rejects it for those only. ``strict_types=True`` rejects every wrongly typed value. ``coerced_column`` adds
    the names of the fields whose value was nulled in that way.
    """
    schema = as_schema(schema)
    added = [] if coerced_column is None else [coerced_column]
    names = [*schema.fieldNames(), *keep, problem_column, line_column, *added]
    if len({n.lower() for n in names}) < len(names):
        raise SchemaError(f"column names repeat in {names}")
    opened = _open_lines(lines, schema, text, keep, strict_types, reject_mismatch)
    why = F.col("_out")[PROBLEM]
    return opened.select(
        *_fields(schema, strict_types),
        *_columns(keep),
        why.alias(problem_column),
        F.when(why.isNotNull(), F.col("_line")).alias(line_column),
        *[_coerced(schema, strict_types).alias(name) for name in added],
    )


def _coerced(schema: T.StructType, strict: bool) -> Column:
    """Names of the fields that hold a value which does not convert."""
    record = F.col("_out")["record"]
    lost = [
        F.when(record[f.name].isNotNull() & _typed(record, f, strict).isNull(), F.lit(f.name))
        for f in schema.fields
        if isinstance(f.dataType, _VIA_TEXT)
    ]
    none = F.array().cast("array<string>")
    return none if strict or not lost else F.array_compact(F.array(*lost))


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def _fields(schema: T.StructType, strict: bool) -> list[Column]:
    record = F.col("_out")["record"]
    return [_typed(record, f, strict).alias(f.name) for f in schema.fields]


def _open_lines(
    lines: DataFrame,
    schema: T.StructType,
    text: str,
    keep: Sequence[str],
    strict_types: bool,
    reject_mismatch: bool | Sequence[str],
) -> DataFrame:
    """``_line``, ``keep`` and ``_out``: (record, problem), one row per outcome."""
    if END.lower() in {name.lower() for name in schema.fieldNames()}:
        raise SchemaError(f"the field name {END!r} is reserved")
    reading = _reading_schema(schema, strict_types)
    element = T.StructType([*reading.fields, T.StructField(END, T.LongType())])
    # Text accepts any JSON value, so only native types can fail to fit.
    may_misfit = any(not isinstance(f.dataType, T.StringType) for f in reading.fields)

    line = F.col("_line")
    mark = end_mark(line)
    carried = _columns(keep)
    parsed = lines.select(strip_space(F.col(f"`{text}`")).alias("_line"), *carried).select(
        "_line",
        *carried,
        _parse_object(line, element, may_misfit).alias("_one"),
        _parse_array(line, element).alias("_many"),
    )

    refuses = _refuses(schema, reject_mismatch) if reject_mismatch and not strict_types else None
    no_record, no_problem = F.lit(None).cast(element), F.lit(None).cast("string")

    def outcome(record: Column, why: Column) -> Column:
        return F.struct(record.alias("record"), why.alias(PROBLEM))

    one = F.col("_one")["r"] if may_misfit else F.col("_one")
    first = F.get(one, F.lit(0))
    misfit = F.col("_one")[_RAW].isNotNull() if may_misfit else F.lit(False)
    if refuses is not None:
        misfit = misfit | refuses(first)
    from_object = F.array(
        F.when(misfit, outcome(no_record, F.lit(TYPE_MISMATCH))).otherwise(
            outcome(first, no_problem)
        )
    )
    many = F.col("_many")["r"]
    several = F.get(many, F.lit(0))
    any_misfit = F.col("_many")[_RAW].isNotNull()
    if refuses is not None:
        any_misfit = any_misfit | F.exists(several, refuses)
    from_array = F.when(
        any_misfit, F.array(outcome(no_record, F.lit(TYPE_MISMATCH)))
    ).otherwise(F.transform(several, lambda r: outcome(r, no_problem)))
    many_closed = (F.get(F.get(many, F.lit(1)), F.lit(0))[END] == mark) & ~F.exists(
        several, lambda r: r.isNull()
    )

    # Records and rejects leave through one generator. Filters on what it gives
    # stay above it, so the optimizer cannot copy the parse into a filter; the
    # outer form keeps it from adding a filter of its own.
    outcomes = (
        F.when(line == "", F.lit(None))
        .when(F.get(one, F.lit(1))[END] == mark, from_object)
        .when(many_closed, from_array)
        .otherwise(F.array(outcome(no_record, _failed(line, may_misfit))))
    )
    opened = parsed.select("_line", *carried, outcomes.alias("_outcomes")).select(
        "_line", *carried, F.explode_outer("_outcomes").alias("_out")
    )
    return opened.where(F.col("_out").isNotNull())


def _parse_object(line: Column, element: T.StructType, with_raw: bool) -> Column:
    """``[record, end mark]`` for lines that open an object; null for others."""
    tail = F.concat(F.lit(f',{{"{END}":'), end_mark(line).cast("string"), F.lit("}]"))
    pair = T.ArrayType(element)
    if not with_raw:
        wrapped = F.concat(F.lit("["), line, tail)
        return F.when(opens_object(line), F.from_json(wrapped, pair, PARSE_OPTIONS))
    wrapped = F.concat(F.lit('{"r":['), line, tail, F.lit("}"))
    return F.when(opens_object(line), _with_raw(wrapped, pair))


def _parse_array(line: Column, element: T.StructType) -> Column:
    """``[[record, …], [end mark]]`` for lines that open an array; null for others."""
    tail = F.concat(F.lit(f',[{{"{END}":'), end_mark(line).cast("string"), F.lit("}]]}"))
    wrapped = F.concat(F.lit('{"r":['), line, tail)
    groups = T.ArrayType(T.ArrayType(element))
    return F.when(opens_array(line), _with_raw(wrapped, groups))


def _with_raw(wrapped: Column, data_type: T.DataType) -> Column:
    """Parse ``{"r": …}``; the raw column is filled when a value does not fit its type."""
    schema = T.StructType([T.StructField("r", data_type), T.StructField(_RAW, T.StringType())])
    return F.from_json(wrapped, schema, {**PARSE_OPTIONS, "columnNameOfCorruptRecord": _RAW})


def _refuses(schema: T.StructType, wanted: bool | Sequence[str]):
    """Test of a loosely read record: does any scalar, or any of those wanted, fail to convert?"""
    names = schema.fieldNames() if wanted is True else [wanted] if isinstance(wanted, str) else list(wanted)
    loose = [f for f in schema.fields if f.name in names and isinstance(f.dataType, _VIA_TEXT)]

    def test(record: Column) -> Column:
        found = F.lit(False)
        for f in loose:
            found = found | (record[f.name].isNotNull() & _typed(record, f, False).isNull())
        return found

    return test if loose else None


def _failed(line: Column, may_misfit: bool) -> Column:
    """Reason for a line whose records could not be read.

    A failed parse is dear, so text is looked at again only where the first
    parse may have failed for its types rather than for its form.
    """
    fits_form = is_json_object(line) if may_misfit else F.lit(False)
    return (
        F.when(
            line.startswith("{"), F.when(fits_form, F.lit(TYPE_MISMATCH)).otherwise(F.lit(INVALID))
        )
        .when(is_json_object_array(line), F.lit(TYPE_MISMATCH))
        .when(is_json(line), F.lit(NOT_OBJECT))
        .otherwise(F.lit(INVALID))
    )


def parse_lines(
    lines: DataFrame,
    schema: T.StructType | str,
    text: str = "value",
    keep: Sequence[str] = (),
    strict_types: bool = False,
    reject_mismatch: bool | Sequence[str] = False,
) -> DataFrame:
    """The records alone. See :func:`records_with_problems`."""
    schema = as_schema(schema)
    opened = _open_lines(lines, schema, text, keep, strict_types, reject_mismatch)
    good = opened.where(F.col("_out")[PROBLEM].isNull())
    return good.select(*_fields(schema, strict_types), *_columns(keep))


def rejected_lines(
    lines: DataFrame,
    text: str = "value",
    keep: Sequence[str] = (),
    schema: T.StructType | str | None = None,
    strict_types: bool = False,
    reject_mismatch: bool | Sequence[str] = False,
) -> DataFrame:
    """The rejected lines alone: ``keep``, ``problem`` and the raw ``line``.

    Without a schema only the JSON form is judged, which builds no field values.
    """
    carried = _columns(keep)
    if schema is not None:
        opened = _open_lines(
            lines, as_schema(schema), text, keep, strict_types, reject_mismatch
        )
        why = F.col("_out")[PROBLEM]
        return opened.where(why.isNotNull()).select(
            *carried, why.alias(PROBLEM), F.col("_line").alias("line")
        )
    stripped = lines.select(strip_space(F.col(f"`{text}`")).alias("line"), *carried)
    judged = stripped.select(*carried, line_problem(F.col("line")).alias(PROBLEM), "line")
    return evaluated_once(judged).where(F.col(PROBLEM) != BLANK)


def drop_corrupt(df: DataFrame, column: str = "_corrupt_record") -> DataFrame:
    """Rows the JSON reader could parse, without its corrupt-text column.

    Spark refuses a query that needs the corrupt column alone from a JSON scan
    (a plain count, for one). Stage or persist the scan first in that case, or
    use :func:`parse_lines`, which has no such limit.
    """
    if column not in df.columns:
        return df
    return df.where(F.col(column).isNull()).drop(column)
