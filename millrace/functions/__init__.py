from millrace.functions.columns import add_constants, drop_columns, free_prefix, stamp
from millrace.functions.json_text import (
    first_char,
    is_json,
    is_json_object,
    line_kind,
    line_problem,
    strip_space,
)
from millrace.functions.keys import add_key_hash, choose_key_column, content_hash, salted_hash

__all__ = [
    "add_constants",
    "add_key_hash",
    "choose_key_column",
    "content_hash",
    "drop_columns",
    "first_char",
    "free_prefix",
    "is_json",
    "is_json_object",
    "line_kind",
    "line_problem",
    "salted_hash",
    "stamp",
    "strip_space",
]
