"""Does the text of a CSV cell parse as a declared column type?"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The type vocabulary of a contract, and the boolean spellings.
INTEGER_TYPES = ("integer", "bigint", "smallint")
NUMBER_TYPES = ("numeric", "real", "double precision")
TIMESTAMP_TYPES = ("timestamp with time zone", "timestamp without time zone")
TYPE_VOCABULARY = (*INTEGER_TYPES, *NUMBER_TYPES, "date", *TIMESTAMP_TYPES, "boolean", "text")
BOOLEAN_WORDS = ("true", "false", "t", "f", "1", "0")

SPARK_TYPES = {
    "integer": "int",
    "bigint": "bigint",
    "smallint": "smallint",
    "numeric": "decimal(38,9)",
    "real": "float",
    "double precision": "double",
    "date": "date",
    "timestamp with time zone": "timestamp",
    "timestamp without time zone": "timestamp_ntz",
    "boolean": "boolean",
    "text": "string",
}

_INTEGER = r"\A\s*[+-]?[0-9]+\s*\z"
_NUMBER = r"(?i)\A\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|nan|inf|infinity)\s*\z"
_DATE_DASHED = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
_DATE_PLAIN = r"\A[0-9]{8}\z"
_CLOCK = (
    r"(?:[T ](?:[01][0-9]|2[0-3])(?::[0-5][0-9](?::[0-5][0-9](?:[.,][0-9]+)?)?)?"
    r"(?:Z|[+-](?:[01][0-9]|2[0-3])(?::?[0-5][0-9])?)?)?"
)
_TIMESTAMP = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}" + _CLOCK + r"\z"


def _real_date(text: Column) -> Column:
    dashed = text.rlike(_DATE_DASHED) & text.try_cast("date").isNotNull()
    plain = text.rlike(_DATE_PLAIN) & F.try_to_date(text, "yyyyMMdd").isNotNull()
    return dashed | plain


def cell_problem(value: Column, data_type: Column) -> Column:
    """NULL if the cell is fine, else `parse` or `range`.

    An empty cell has no type problem, and an unknown type takes any text.
    """
    trimmed = F.trim(value)
    out_of_range = F.lit(False)
    for name in INTEGER_TYPES:
        out_of_range = out_of_range | (
            (data_type == name) & trimmed.try_cast(SPARK_TYPES[name]).isNull()
        )
    parses = (
        F.when(data_type.isin(*INTEGER_TYPES), value.rlike(_INTEGER))
        .when(data_type.isin(*NUMBER_TYPES), value.rlike(_NUMBER))
        .when(data_type == "date", _real_date(value))
        .when(
            data_type.isin(*TIMESTAMP_TYPES),
            _real_date(value) | (value.rlike(_TIMESTAMP) & _real_date(F.substring(value, 1, 10))),
        )
        .when(data_type == "boolean", F.lower(value).isin(*BOOLEAN_WORDS))
        .otherwise(F.lit(True))
    )
    return (
        F.when(value.isNull() | (value == ""), F.lit(None).cast("string"))
        .when(~parses, F.lit("parse"))
        .when(data_type.isin(*INTEGER_TYPES) & out_of_range, F.lit("range"))
    )


def typed_cell(value: Column, data_type: str) -> Column:
    """The cell as its declared type; an empty cell is NULL."""
    text = F.when(value != "", value)
    if data_type == "text" or data_type not in SPARK_TYPES:
        return text
    if data_type == "boolean":
        word = F.lower(text)
        return F.when(word.isin("true", "t", "1"), F.lit(True)).when(word.isin("false", "f", "0"), F.lit(False))
    if data_type == "date":
        return F.coalesce(
            F.when(text.rlike(_DATE_DASHED), text.try_cast("date")),
            F.when(text.rlike(_DATE_PLAIN), F.try_to_date(text, "yyyyMMdd")),
        )
    return F.trim(text).try_cast(SPARK_TYPES[data_type])
