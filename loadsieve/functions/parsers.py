"""Typed parsers as native column expressions.

Each parser maps text to a typed value or null for "cannot parse" and never raises under ANSI
mode: the shape is checked with a pattern first, then converted with try_cast. The set of
accepted shapes is closed and judged per value, so a result never depends on other rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadsieve.functions.text import strip, text_array

# Month abbreviations in calendar order.
MONTHS = ("ene", "feb", "mar", "abr", "may", "jun", "jul", "ago", "sep", "oct", "nov", "dic")

# Day 0 of spreadsheet serial dates and the last serial of each mode.
SERIAL_ORIGIN = "1899-12-30"
SERIAL_MAX = 73050
SERIAL_MAX_UNBOUNDED = 2958465

# Words read as booleans and words read as "no value".
TRUE_WORDS = ("true", "1", "si", "sí")
FALSE_WORDS = ("false", "0", "no")
BOOL_NULL_WORDS = ("<na>", "nan", "")

_TIME = "(?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]"
# year 0 is no calendar year, although Spark would accept it
DAY_FIRST = rf"^([0-9]{{1,2}})[/-]([0-9]{{1,2}})[/-]((?!0000)[0-9]{{4}})( {_TIME})?$"
YEAR_FIRST = rf"^(?!0000)[0-9]{{4}}-[0-9]{{1,2}}-[0-9]{{1,2}}( {_TIME})?$"
YEAR_FIRST_ANY_TIME = r"^(?!0000)[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}(\s+[0-9]{2}:[0-9]{2}:[0-9]{2})?$"
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
NUMBER_OR_INFINITE = rf"{NUMBER}|^[+-]?(?i:inf|infinity)$"
MONTH_TEXT = rf"^({'|'.join(MONTHS)})[/-]?([0-9]{{2}}|[0-9]{{4}})$"

_DIGITS = "[0-9](?:_?[0-9])*"
_GROUPED_NUMBER = rf"^[+-]?({_DIGITS}[.]?({_DIGITS})?|[.]{_DIGITS})([eE][+-]?{_DIGITS})?$"

# The functions named *_of take trimmed text, best a plain column: an expression that is repeated
# is planned and generated as often. The pattern comes first because a cast that fails is dear: it
# costs an exception inside try_cast, several times the price of the pattern.


def _year_first(t: Column) -> Column:
    return F.regexp_replace(t, DAY_FIRST, "$3-$2-$1$4")


def _digit(c: Column) -> Column:
    """Whether a text begins with a digit. A comparison of bytes, which costs next to nothing."""
    return (c >= "0") & (c < ":")


def _at(t: Column, at: int, n: int = 1) -> Column:
    return F.substring(t, at, n)


def full_day_first(t: Column) -> Column:
    """Whether a text has the shape of dd/mm/yyyy or dd-mm-yyyy by its length, its signs and its outer digits.

    Most dates do, and then their parts are where they are: measured, telling this and casting the parts in order costs a seventh of two patterns and a
    replacement. Inner characters that are no digits make the cast null, as the pattern would. Every other shape goes the long way.
    """
    sign = lambda at: _at(t, at).isin("/", "-")
    return (F.octet_length(t) == 10) & sign(3) & sign(6) & _digit(t) & _digit(_at(t, 2)) & _digit(_at(t, 4)) & _digit(_at(t, 5)) & _digit(_at(t, 7)) & (_at(t, 7, 4) != "0000")


def _calendar(t: Column, kind: str) -> Column:
    parts = F.concat(_at(t, 7, 4), F.lit("-"), _at(t, 4, 2), F.lit("-"), _at(t, 1, 2))
    ordered = F.when(full_day_first(t), parts).when(t.rlike(DAY_FIRST), _year_first(t)).when(t.rlike(YEAR_FIRST), t)
    return ordered.try_cast(kind)


def calendar_date_of(t: Column) -> Column:
    return _calendar(t, "date")


def calendar_stamp_of(t: Column) -> Column:
    return _calendar(t, "timestamp_ntz")


def _plainly_numeric(t: Column) -> Column:
    """Whether a text that casts to a number surely is one by the pattern, so that the pattern can be spared.

    A first character among +,-./ and the digits and a digit or dot at the end keep out words, spaces and the letters that casts allow at the end; without an x it is no
    hexadecimal number, and casts to decimals take digits of other scripts. What the cast refuses is no number either way.
    """
    last = F.right(t, F.lit(1))
    ascii_only = F.octet_length(t) == F.char_length(t)
    return (t >= "+") & (t < ":") & (_digit(last) | (last == ".")) & ~t.contains("x") & ~t.contains("X") & ~t.contains("/") & ascii_only


def serial_of(t: Column) -> Column:
    return F.when(_plainly_numeric(t) | t.rlike(NUMBER), t.try_cast("double"))


def _serial_day(n: Column, last: int) -> Column:
    return F.when(n.between(1, last), F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(n).cast("int")))


def serial_date_of(t: Column, last: int = SERIAL_MAX) -> Column:
    return _serial_day(serial_of(t), last)


def serial_stamp_of(t: Column) -> Column:
    n = serial_of(t)
    day = F.date_add(F.lit(SERIAL_ORIGIN).cast("date"), F.floor(n).cast("int")).cast("timestamp_ntz")
    seconds = F.round((n - F.floor(n)) * 86400).cast("int")
    return F.when(n.between(1, SERIAL_MAX), F.timestamp_add("SECOND", seconds, day))


def month_date_of(t: Column) -> Column:
    # lower() is left for texts that start with a letter
    low = F.when(t.rlike("^[a-zA-Z]"), F.lower(t))
    month = F.array_position(text_array(MONTHS), F.regexp_extract(low, MONTH_TEXT, 1))
    year = F.regexp_extract(low, MONTH_TEXT, 2)
    # two digits, or four of which the first two are zeros, mean 2000 and later
    year = F.when(year.startswith("00") | (F.length(year) == 2), F.concat(F.lit("20"), F.right(year, F.lit(2)))).otherwise(year)
    return F.when(low.rlike(MONTH_TEXT), F.concat_ws("-", year, month.cast("string"), F.lit("1")).try_cast("date"))


def date_of(t: Column) -> Column:
    return F.coalesce(calendar_date_of(t), serial_date_of(t))


def period_of(t: Column) -> Column:
    return F.coalesce(calendar_date_of(t), month_date_of(t), serial_date_of(t))


def timestamp_of(t: Column) -> Column:
    return F.coalesce(calendar_stamp_of(t), serial_stamp_of(t))


def unbounded_date_of(t: Column) -> Column:
    number = F.replace(t, F.lit(","), F.lit("."))
    serial = F.when(number.rlike(_GROUPED_NUMBER), F.replace(number, F.lit("_"), F.lit("")).try_cast("double"))
    day_first = t.rlike(DAY_FIRST) & ~t.contains(":")
    ordered = F.when(day_first, _year_first(t)).when(
        t.rlike(YEAR_FIRST_ANY_TIME), F.regexp_replace(t, r"\s.*$", "")
    )
    return F.coalesce(_serial_day(serial, SERIAL_MAX_UNBOUNDED), ordered.try_cast("date"))


def number_text_of(t: Column) -> Column:
    """European or plain number text brought to the plain form; not yet checked."""
    # a comma is always the decimal sign, and then every dot is a thousands sign
    plain = F.when(t.contains(","), F.translate(t, ",.", ".")).otherwise(t)
    bare = F.regexp_replace(plain, "^np[.]float64[(](.+)[)]$", "$1")
    bare = F.regexp_replace(bare, "^np[.]int64[(](.+)[)]$", "$1")
    return F.when(t.startswith("np."), bare).otherwise(plain)


def _checked(t: Column, pattern: str, kind: str) -> Column:
    return F.when(_plainly_numeric(t) | t.rlike(pattern), t.try_cast(kind))


def number_of(t: Column) -> Column:
    return _checked(number_text_of(t), NUMBER_OR_INFINITE, "double")


def plain_number_of(t: Column) -> Column:
    return _checked(t, NUMBER_OR_INFINITE, "double")


def decimal_of(t: Column, precision: int, scale: int) -> Column:
    return _checked(number_text_of(t), NUMBER, f"decimal({precision},{scale})")


WHOLE = "decimal(38,0)"


def whole_of(t: Column, plain: bool = False) -> Column:
    """A number rounded to a whole one (halves away from zero), exact for up to 38 digits; null
    beyond. Text with an exponent goes through a decimal of 10 places, which holds every integer type."""
    text = t if plain else number_text_of(t)
    return F.coalesce(
        F.when(text.rlike("^[-+]?[0-9]+$"), text.try_cast(WHOLE)),
        F.round(_checked(text, NUMBER, "decimal(38,10)"), 0).try_cast(WHOLE),
    )


def bool_of(t: Column) -> Column:
    low = F.lower(t)
    return F.when(low.isin(*TRUE_WORDS), F.lit(True)).when(low.isin(*FALSE_WORDS), F.lit(False))


def parse_date_dayfirst(c: Column) -> Column:
    """d/M/yyyy, d-M-yyyy or yyyy-M-d, each with an optional time that is dropped."""
    return calendar_date_of(strip(c))


def parse_serial_date(c: Column) -> Column:
    """Spreadsheet serial day number; a fraction is time of day and is dropped."""
    return serial_date_of(strip(c))


def parse_date(c: Column) -> Column:
    """Calendar text, else serial number."""
    return date_of(strip(c))


def parse_period(c: Column) -> Column:
    """Calendar text, else month text such as ene-24, else serial number."""
    return period_of(strip(c))


def parse_date_unbounded(c: Column) -> Column:
    """Serial number first (any year to 9999, decimal comma allowed), else calendar text."""
    return unbounded_date_of(strip(c))


def parse_timestamp(c: Column) -> Column:
    """Calendar text with its time of day, else serial number with its fraction of a day."""
    return timestamp_of(strip(c))


def parse_number(c: Column) -> Column:
    """European or plain number; infinity is read, and stored as null later."""
    return number_of(strip(c))


def parse_number_v1(c: Column) -> Column:
    """Plain numbers only: the fixed-schema loader leaves text with a comma unparsed."""
    return plain_number_of(strip(c))


def parse_decimal(c: Column, precision: int, scale: int) -> Column:
    """Exact number for targets that ask for it."""
    return decimal_of(strip(c), precision, scale)


def parse_bool(c: Column) -> Column:
    return bool_of(strip(c))


def bool_text_of(t: Column) -> Column:
    """True when the text says something that ought to be a boolean."""
    return F.coalesce(~F.lower(t).isin(*BOOL_NULL_WORDS), F.lit(False))


# Shapes of literal column defaults and of the cast that may follow.
_CAST_SUFFIX = r'::[a-zA-Z0-9_\s\[\].\"]+$'
_INTEGER_LITERAL = "^[-+]?[0-9]+$"
_DECIMAL_LITERAL = "^[-+]?[0-9]*[.][0-9]+$"
_TEXT_LITERAL = "^'((?:''|[^'])*)'$"


def parse_default_literal(c: Column) -> Column:
    """struct(kind, value): kind is boolean, integer, decimal or text; null when not a literal."""
    t = strip(F.regexp_replace(strip(c), _CAST_SUFFIX, ""))
    low = F.lower(t)
    kind = (
        F.when(low.isin("true", "false"), F.lit("boolean"))
        .when(t.rlike(_INTEGER_LITERAL), F.lit("integer"))
        .when(t.rlike(_DECIMAL_LITERAL), F.lit("decimal"))
        .when(t.rlike(_TEXT_LITERAL), F.lit("text"))
    )
    value = (
        F.when(kind == "boolean", low)
        .when(kind == "text", F.replace(F.regexp_extract(t, _TEXT_LITERAL, 1), F.lit("''"), F.lit("'")))
        .when(kind.isNotNull(), t)
    )
    return F.struct(kind.alias("kind"), value.alias("value"))


def storage_number(c: Column) -> Column:
    """Doubles as stored: no NaN and no infinity."""
    return F.when(~(F.isnan(c) | (F.abs(c) == F.lit(float("inf")))), c)


_WRAPPED_FLOAT = r"^np[.]float64[(]([-+]?[0-9]+(?:[.][0-9]+)?(?:[eE][-+]?[0-9]+)?)[)]$"
_WRAPPED_INT = r"^np[.]int64[(]([-+]?[0-9]+)[)]$"


def storage_text_of(t: Column) -> Column:
    bare = F.when(t.rlike(_WRAPPED_FLOAT), F.regexp_extract(t, _WRAPPED_FLOAT, 1)).when(
        t.rlike(_WRAPPED_INT), F.regexp_extract(t, _WRAPPED_INT, 1)
    )
    return F.when(t.startswith("np."), F.coalesce(bare, t)).otherwise(t)


def storage_text(c: Column) -> Column:
    """Text as stored: trimmed, and a wrapped number shown as the number."""
    return storage_text_of(strip(c))
