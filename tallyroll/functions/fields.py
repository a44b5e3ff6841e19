"""Parsing and checking of the three text fields of a timesheet row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyroll.schemas import HOURS

# The characters a trim removes (U+0000 to U+0020), the accepted
# number and date shapes, and the range of hours.
BLANKS = "".join(chr(code) for code in range(0x21))
NUMBER_SHAPE = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
DATE_SHAPE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
CANONICAL_SHAPE = r"^(-?[1-9][0-9]*|0)(\.[0-9]{1,6})?$"
MAX_HOURS = 24


def clean_text(text: Column) -> Column:
    """Trimmed text; a missing field is the empty string. Most fields have
    nothing to trim, which their first and last characters tell cheaply."""
    clean = (F.substring(text, 1, 1) > " ") & (F.substring(text, -1, 1) > " ")
    return F.coalesce(F.when(clean, text).otherwise(F.btrim(text, F.lit(BLANKS))), F.lit(""))


def _exponent(text: Column) -> Column:
    digits = F.regexp_extract(text, r"[eE]([+-]?[0-9]+)$", 1)
    return F.when(digits == "", F.lit(0)).otherwise(digits.try_cast("int"))


def _mantissa(text: Column) -> Column:
    return F.regexp_extract(text, r"^[+-]?([0-9.]+)", 1)


def is_number(text: Column) -> Column:
    """Decimal number syntax with an optional exponent that fits an int."""
    no_exponent = ~(text.contains("e") | text.contains("E"))
    return text.rlike(NUMBER_SHAPE) & (no_exponent | _exponent(text).isNotNull())


def stored_hours(text: Column) -> Column:
    """Hours as stored: two decimals, halves up. Null when the text is not a
    number or its value does not fit the column."""
    return text.try_cast(HOURS)


def hours_in_range(text: Column, stored: Column) -> Column:
    """``0 < hours <= 24`` of the written value, null when it is no number.

    The stored value decides unless it is one of the two bounds, which the
    written value may have been rounded to; there the text is looked at. The
    number syntax matters only where there is no stored value.
    """
    mantissa = _mantissa(text)
    digits = F.ltrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
    value = text.try_cast("decimal(38,18)")
    # The cast of the value may round to 24 as well; its digits do not.
    above = (value > MAX_HOURS) | (
        (value == MAX_HOURS) & digits.startswith("24") & ~digits.rlike("^240*$")
    )
    return (
        F.when((stored > 0) & (stored < MAX_HOURS), F.lit(True))
        .when(stored == 0, ~text.startswith("-") & mantissa.rlike("[1-9]"))
        .when(stored == MAX_HOURS, ~above)
        .when(stored.isNotNull(), F.lit(False))
        .when(is_number(text), F.lit(False))
    )


def _bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def decimal_text(text: Column) -> Column:
    """Canonical text of a decimal number: no plus sign, no leading zeros, the
    written scale kept, and an exponent only where the scale is negative or
    the leading digit lies more than six places behind the point.

    Nearly every number is written that way already, which one pattern tells.
    The others are taken apart with bound values: that keeps the generated
    code of a query small enough for the JVM to compile.
    """
    return F.when(text.rlike(CANONICAL_SHAPE), text).otherwise(
        _bind(
            F.struct(
                _mantissa(text).alias("mantissa"),
                _exponent(text).alias("exponent"),
                text.startswith("-").alias("negative"),
            ),
            _from_parts,
        )
    )


def _from_parts(parts: Column) -> Column:
    mantissa = parts["mantissa"]
    places = F.when(mantissa.contains("."), F.length(F.substring_index(mantissa, ".", -1))).otherwise(0)
    digits = F.ltrim(F.replace(mantissa, F.lit("."), F.lit("")), F.lit("0"))
    bound = F.struct(
        F.when(digits == "", "0").otherwise(digits).alias("digits"),
        (places - parts["exponent"]).alias("scale"),
        F.when(parts["negative"] & (digits != ""), "-").otherwise("").alias("sign"),
    )
    return _bind(bound, lambda n: F.concat(n["sign"], _unsigned(n["digits"], n["scale"])))


def _unsigned(digits: Column, scale: Column) -> Column:
    size = F.length(digits)
    power = size - 1 - scale

    def pointed(padded: Column) -> Column:
        whole = F.length(padded) - scale
        fraction = F.concat(F.lit("."), F.substring(padded, whole + 1, scale))
        return F.concat(F.substring(padded, F.lit(1), whole), F.when(scale > 0, fraction).otherwise(""))

    rest = F.concat(F.lit("."), F.substring(digits, F.lit(2), size - 1))
    exponent = F.concat(F.when(power > 0, "E+").otherwise("E"), power.cast("string"))
    scientific = F.concat(
        F.substring(digits, 1, 1),
        F.when(size > 1, rest).otherwise(""),
        F.when(power != 0, exponent).otherwise(""),
    )
    return F.when(
        (scale >= 0) & (power >= -6), _bind(F.lpad(digits, F.greatest(size, scale + 1), "0"), pointed)
    ).otherwise(scientific)


def work_date_value(text: Column) -> Column:
    """Strict ``yyyy-MM-dd`` date, null otherwise.

    The shape is checked first because a plain cast also takes ``2026-8-3``
    or a date followed by a time.
    """
    return F.when(text.rlike(DATE_SHAPE), text.try_cast("date"))


def truncated(text: Column, length: int) -> Column:
    """Text cut to ``length`` characters; null becomes the empty string."""
    return F.coalesce(F.substring(text, 1, length), F.lit(""))
