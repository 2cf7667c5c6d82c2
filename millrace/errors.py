"""Errors raised by the toolkit. Nothing here is ever logged and swallowed."""


class MillraceError(Exception):
    """Base class."""


class SchemaError(MillraceError, ValueError):
    """A declared schema cannot be built or does not fit."""


class MissingColumnsError(SchemaError):
    """Required columns are absent."""

    def __init__(self, missing):
        self.missing = list(missing)
        super().__init__(f"missing required columns: {', '.join(self.missing)}")


class EmptyInputError(MillraceError):
    """The input holds no rows."""


class LoadError(MillraceError):
    """A table load did not end with the expected rows."""
