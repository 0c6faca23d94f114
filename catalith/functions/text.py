"""Small text predicates shared by the checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space plus the four separator controls.
_BLANK = r"(?U)\A[\s\x1c-\x1f]*\z"


def blank(col: Column) -> Column:
    """NULL, empty or only white space."""
    return col.isNull() | col.rlike(_BLANK)


def blank_text(col: Column) -> Column:
    """There is a value, but only white space in it."""
    return col.isNotNull() & col.rlike(_BLANK)


def sha256_bytes(col: Column) -> Column:
    return F.sha2(col, 256)


def sha256_text(col: Column) -> Column:
    """Hash that does not depend on the line-ending style of the text."""
    return F.sha2(F.regexp_replace(col, r"\r\n?", "\n"), 256)
