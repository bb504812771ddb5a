"""Literal forms of the program text and the characters a string may not carry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters a string literal may not carry.
FORBIDDEN_CHARACTERS = "\"'<>&"


def fixed_real(value: Column, places: int) -> Column:
    """``places`` decimals, trailing zeros dropped, one decimal kept: 2.0, 0.25."""
    text = F.rtrim(F.format_string(f"%.{places}f", value.cast("double")), F.lit("0"))
    return F.when(F.endswith(text, F.lit(".")), F.concat(text, F.lit("0"))).otherwise(text)


def plain_real(value: Column) -> Column:
    """The shortest decimals that read back as the same double: 12345678.5, 0.0005, 2.0.

    Without an exponent from 0.0001 to below 10^16, with one beyond, as ``1e+16`` and ``5e-05``.
    """
    value = value.cast("double")
    printed = value.cast("string")
    size = F.abs(value)
    digits = F.rtrim(printed.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    mantissa = F.regexp_replace(F.substring_index(printed, "E", 1), r"\.0$", "")
    power = F.substring_index(printed, "E", -1).try_cast("int")
    scaled = F.concat(mantissa, F.when(power < 0, "e-").otherwise("e+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    return F.when(value == 0, F.when(F.startswith(printed, F.lit("-")), "-0.0").otherwise("0.0")).when((size >= 1e-4) & (size < 1e16), plain).otherwise(scaled)


def short_real(value: Column) -> Column:
    """The shortest text that reads back as the same double, always with a decimal point."""
    text = F.replace(value.cast("double").cast("string"), F.lit("E"), F.lit("e"))
    return F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))


def duration(ms: Column) -> Column:
    """Whole seconds as ``T#2s``, everything else as ``T#500ms``."""
    ms = ms.cast("bigint")
    seconds = F.concat(F.lit("T#"), ((ms - ms % 1000) / 1000).cast("bigint").cast("string"), F.lit("s"))
    return F.when(ms % 1000 == 0, seconds).otherwise(F.concat(F.lit("T#"), ms.cast("string"), F.lit("ms")))


def forbidden_string(text: Column) -> Column:
    return text.rlike("[\"'<>&]")


def value_text(value: Column) -> Column:
    """Print a tagged value: struct(tag, text, pin, num).

    ref: ``text.pin``; var: ``text``; int, real, time_ms, bool read ``num``;
    string is quoted; code is ``text#pin`` with dotted digits in ``pin``.
    """
    tag, text, pin, num = value["tag"], value["text"], value["pin"], value["num"]
    return (
        F.when(tag == "ref", F.concat_ws(".", text, pin))
        .when(tag == "var", text)
        .when(tag == "int", num.cast("bigint").cast("string"))
        .when(tag == "real", short_real(num))
        .when(tag == "bool", F.when(num != 0, F.lit("TRUE")).otherwise(F.lit("FALSE")))
        .when(tag == "time_ms", duration(num))
        .when(tag == "string", F.concat(F.lit('"'), text, F.lit('"')))
        .when(tag == "code", F.concat_ws("#", text, pin))
    )


def value_refusal(value: Column) -> Column:
    """Why a value cannot be printed, or null."""
    return F.when(
        (value["tag"] == "string") & forbidden_string(value["text"]),
        F.concat(F.lit("literal carries a forbidden character: "), value["text"]),
    ).when(value_text(value).isNull(), F.lit("unknown value form"))
