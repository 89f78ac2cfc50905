"""Line-protocol text: escapes, typed values and the grammar to read them back."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters escaped by a backslash, by place.
MEASUREMENT_SPECIAL = ", "
KEY_SPECIAL = ",= "
STRING_SPECIAL = '\\"'

# The grammar. Every repeat is possessive: the Java matcher then loops instead of recursing, so a string field of
# any length is matched whole, and no line can make it backtrack.
NAME = r"(?:[^,\s\\]++|\\.)++"
KEY = r"(?:[^,=\s\\]++|\\.)++"
STRING = r'"(?:[^"\\]++|\\.)*+"'
NUMBER = r"[-+]?(?:[0-9]++(?:\.[0-9]*+)?|\.[0-9]++)(?:[eE][-+]?[0-9]++)?i?|[-+]?inf|nan"
VALUE = rf"(?:{STRING}|true|false|{NUMBER})(?=[,\s]|$)"
HEAD = rf"(?s)^{NAME}(?:,{KEY}={KEY})*+(?= )"
FIELDS = rf"(?s)^{KEY}={VALUE}(?:,{KEY}={VALUE})*+"
TAG_PAIR = rf"(?s),({KEY})=({KEY})"
FIELD_PAIR = rf"(?s)({KEY})=({VALUE})"


def escape(text: Column | str, special: str) -> Column | str:
    """Put a backslash before each special character, of a column or of a name known at plan time.

    Plain replacement works on the bytes and hands text without the character through; a regex would decode it first.
    A backslash, where it is special, comes first in ``special``.
    """
    for character in special:
        if isinstance(text, str):
            text = text.replace(character, "\\" + character)
        else:
            text = F.replace(text, F.lit(character), F.lit("\\" + character))
    return text


def unescape(text: Column, special: str) -> Column:
    """Undo ``escape``; text without a backslash takes no regex."""
    escaped = rf"\\([{re.escape(special)}])"
    return F.when(text.contains("\\"), F.regexp_replace(text, escaped, "$1")).otherwise(text)


def float_text(value: Column) -> Column:
    """Shortest decimal text of a double: plain from 1e-4 up to 1e16, with an exponent beyond.

    Spark's own cast turns to exponents at 1e-3 and 1e7. Only values beyond those take the longer way.
    """
    size = F.abs(value)
    text = value.cast("double").cast("string")
    return (
        F.when(((size >= 1e-3) & (size < 1e7)) | (size == 0), text)
        .when((size >= 1e-4) & (size < 1e-3), _plain(value, "decimal(38,30)"))
        .when((size >= 1e7) & (size < 1e16), _plain(value, "decimal(38,18)"))
        .otherwise(_exponent(text))
    )


def _plain(value: Column, kind: str) -> Column:
    # A double becomes a decimal by its shortest digits; one digit stays after the point.
    return F.regexp_replace(value.cast("double").cast(kind).cast("string"), r"(\.[0-9]+?)0+$", "$1")


def _exponent(text: Column) -> Column:
    # 1.0E16 to 1e+16, 1.5E-5 to 1.5e-05; Infinity and NaN pass through here too.
    lower = F.replace(F.lower(text), F.lit("infinity"), F.lit("inf"))
    signed = F.regexp_replace(F.replace(lower, F.lit(".0e"), F.lit("e")), "e([0-9])", "e+$1")
    return F.regexp_replace(signed, "e([+-])([0-9])$", "e$10$2")


def plain_text(value: Column, kind: T.DataType) -> Column:
    """Text of a value as a tag or inside quotes."""
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True")).when(~value, F.lit("False"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float_text(value)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        # Six fraction digits, or none on whole seconds.
        return F.regexp_replace(F.date_format(value, "yyyy-MM-dd HH:mm:ss.SSSSSS"), r"\.000000$", "")
    return value.cast("string")


def field_text(value: Column, kind: T.DataType) -> Column:
    """Text of a field value by its type; null stays null."""
    if isinstance(kind, T.BooleanType):
        return value.cast("string")
    if isinstance(kind, T.IntegralType):
        return F.concat(value.cast("string"), F.lit("i"))
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float_text(value)
    return F.concat(F.lit('"'), escape(plain_text(value, kind), STRING_SPECIAL), F.lit('"'))


def field_value(text: Column, kind: T.DataType) -> Column:
    """Inverse of ``field_text``; text of another kind is an error, not a null."""
    if isinstance(kind, T.StringType):
        inner = F.substring(text, F.lit(2), F.length(text) - F.lit(2))
        return (
            F.when(text.startswith('"'), unescape(inner, STRING_SPECIAL))
            .when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a string field: "), text)))
        )
    if isinstance(kind, (T.IntegralType, T.FloatType, T.DoubleType)):
        return F.rtrim(text, F.lit("i")).cast(kind)
    if isinstance(kind, T.BooleanType):
        return text.cast(kind)
    raise ValueError(f"a field is a number, a boolean or a string, not {kind.simpleString()}")


def field_kind(text: Column) -> Column:
    """Type name of a field value, by its form."""
    return (
        F.when(text.startswith('"'), F.lit("string"))
        .when(text.isin("true", "false"), F.lit("boolean"))
        .when(text.endswith("i"), F.lit("bigint"))
        .otherwise(F.lit("double"))
    )
