"""Strict JSON checks as plain column expressions.

Spark's JSON functions stop at the end of the first value and ignore whatever
follows, so ``{"a":1} x`` parses. Every check here appends an end mark after the
text and parses both together: the mark is found in the second place only if the
text is exactly one complete value. The mark is a hash of the text itself, so no
text contains its own mark. One parse, no Python, no session setting.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters a Python string strips by default.
SPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0      "
    "          　"
)

# NaN and Infinity stay accepted: the usual Python reader takes them as numbers.
PARSE_OPTIONS = {"allowSingleQuotes": "false"}

END = "__end__"

PROBLEM = "problem"

BLANK = "blank"
INVALID = "invalid_json"
NOT_OBJECT = "not_object"
TYPE_MISMATCH = "type_mismatch"


def opens_object(text: Column) -> Column:
    """Braces at both ends of stripped text. A line cut short fails here, unparsed."""
    return text.startswith("{") & text.endswith("}")


def opens_array(text: Column) -> Column:
    return text.startswith("[") & text.endswith("]")


def strip_space(text: Column) -> Column:
    """``text`` without surrounding white space; lines that have none are not scanned."""
    tight = opens_object(text) | opens_array(text)
    return F.when(tight, text).otherwise(F.btrim(text, F.lit(SPACE)))


def first_char(text: Column) -> Column:
    """First character that is not white space; empty for blank text."""
    return F.substring(strip_space(text), 1, 1)


def end_mark(text: Column) -> Column:
    return F.xxhash64(text)


def is_json(text: Column) -> Column:
    """True iff stripped ``text`` is one complete JSON value of any kind."""
    mark = end_mark(text).cast("string")
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit(',"'), mark, F.lit('"]')), "array<string>", PARSE_OPTIONS
    )
    cut_short = text.startswith("[") & ~text.endswith("]")
    other = F.when(~cut_short, F.array_position(parsed, mark) == 2)
    return F.when(text.startswith("{"), is_json_object(text)).otherwise(
        F.coalesce(other, F.lit(False))
    )


def is_json_object(text: Column) -> Column:
    """True iff stripped ``text`` is one complete JSON object; its values are skipped, not built."""
    mark = end_mark(text)
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',{{"{END}":'), mark.cast("string"), F.lit("}]")),
        f"array<struct<{END}: bigint>>",
        PARSE_OPTIONS,
    )
    found = F.when(opens_object(text), F.get(parsed, F.lit(1))[END] == mark)
    return F.coalesce(found, F.lit(False))


def is_json_object_array(text: Column) -> Column:
    """True iff stripped ``text`` is one complete JSON array holding objects only."""
    mark = end_mark(text)
    parsed = F.from_json(
        F.concat(F.lit("["), text, F.lit(f',[{{"{END}":'), mark.cast("string"), F.lit("}]]")),
        f"array<array<struct<{END}: bigint>>>",
        PARSE_OPTIONS,
    )
    closed = F.get(F.get(parsed, F.lit(1)), F.lit(0))[END] == mark
    only_objects = ~F.exists(F.get(parsed, F.lit(0)), lambda e: e.isNull())
    return F.coalesce(F.when(opens_array(text), closed & only_objects), F.lit(False))


def line_kind(text: Column) -> Column:
    """``object``, ``array``, ``blank`` or ``other``, from the first character alone."""
    head = first_char(text)
    return (
        F.when(head == "{", "object")
        .when(head == "[", "array")
        .when(head == "", BLANK)
        .otherwise("other")
    )


def line_problem(text: Column) -> Column:
    """Why a line cannot become records, or null when it can.

    ``text`` must already be stripped. A record line is an object, or an array
    of objects that stands for several records. A failed parse is far dearer
    than a good one, so a broken object line is parsed once and no more.
    """
    return (
        F.when(text == "", F.lit(BLANK))
        .when(text.startswith("{"), F.when(~is_json_object(text), F.lit(INVALID)))
        .when(is_json_object_array(text), F.lit(None))
        .when(is_json(text), F.lit(NOT_OBJECT))
        .otherwise(F.lit(INVALID))
    )
