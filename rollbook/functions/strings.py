"""String checks and null replacement."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from rollbook.names import exactly

# Digits only; optional sign, digits, a point and at least one digit.
# \A and \z hold the whole text, where $ would let a final line break pass.
INT_PATTERN = r"\A\d+\z"
DOUBLE_PATTERN = r"\A[-+]?\d*[.]\d+\z"

# The JSON grammar's numbers and words, and what other JSON values begin with.
JSON_SCALAR = (
    r"\A[ \t\r\n]*(?:-?(?:0|[1-9]\d*)(?:[.]\d+)?(?:[eE][-+]?\d+)?|true|false|null)[ \t\r\n]*\z"
)
JSON_OPENING = r'\A[ \t\r\n]*[\[{"]'
STRICT_JSON = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}


def is_empty(text: Column) -> Column:
    """Null or of length 0; blanks count as text."""
    return text.isNull() | (F.length(text) == 0)


def is_int(text: Column) -> Column:
    return F.coalesce(text.rlike(INT_PATTERN), F.lit(False))


def is_double(text: Column) -> Column:
    return F.coalesce(text.rlike(DOUBLE_PATTERN), F.lit(False))


def is_json(text: Column) -> Column:
    """Strict JSON of any kind, and nothing after it.

    Numbers and words are matched. For the rest, Spark's parsers stop at the end
    of the first value and ignore what follows. So the text is parsed inside
    ``[ ]`` and inside ``{"v": }``: text that closes the one wrapper early cannot
    close the other, and only a single complete value passes both.

    Spark's parsers end at 1,000 levels of nesting, and at numbers of over 1,000 digits
    and strings of over 20 million characters inside; such text counts as no JSON.
    """
    # Each test is dearer than the one before and only sees what needs it: plain
    # words and prose fail on their first character, broken text in the list.
    scalar = F.coalesce(text.rlike(JSON_SCALAR), F.lit(False))
    opens = F.coalesce(text.rlike(JSON_OPENING), F.lit(False))
    in_list = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    # The variant parser is the fastest strict one, but refuses repeated keys.
    in_object = F.concat(F.lit('{"v":'), text, F.lit("}"))
    strict = (
        F.try_parse_json(in_object).isNotNull()
        | F.from_json(in_object, "map<string,string>", STRICT_JSON).isNotNull()
    )
    return scalar | (opens & F.coalesce(in_list, F.lit(False)) & strict)


CHECKS = {"is_empty": is_empty, "is_int": is_int, "is_double": is_double, "is_json": is_json}


def classify_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add ``<c>_is_empty``, ``_is_int``, ``_is_double`` and ``_is_json`` per column."""
    return df.withColumns(
        {f"{c}_{name}": check(exactly(c)) for c in columns for name, check in CHECKS.items()}
    )


def profile_strings(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count the same four checks: one row ``column, rows, empties, ints, doubles, jsons`` per column.

    All columns are counted in one pass over the data.
    """
    if not columns:
        raise ValueError("no columns to profile")
    counted = df.agg(
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"),
                    F.count("*").alias("rows"),
                    F.count_if(is_empty(exactly(c))).alias("empties"),
                    F.count_if(is_int(exactly(c))).alias("ints"),
                    F.count_if(is_double(exactly(c))).alias("doubles"),
                    F.count_if(is_json(exactly(c))).alias("jsons"),
                )
                for c in columns
            ]
        ).alias("profiles")
    )
    return counted.select(F.inline("profiles"))


def replace_nulls(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Put ``""`` for null in the given string columns, or in all of them."""
    if columns is None:
        return df.na.fill("")
    for c in columns:
        if not isinstance(df.select(exactly(c)).schema[0].dataType, StringType):
            raise TypeError(f"column {c} is not a string column")
    return df.withColumns({c: F.coalesce(exactly(c), F.lit("")) for c in columns})
