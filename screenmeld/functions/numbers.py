"""Text forms of numbers, durations and truth values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fixed(value: Column, digits: int) -> Column:
    """Fixed digits, rounded from the exact binary value, half to even."""
    pattern = "0." + "0" * digits if digits else "0"
    return F.call_function("format_number", value.cast("double"), F.lit(pattern))


def report_number(value: Column, digits: int = 3) -> Column:
    """Fixed digits, exponent for very small or large, ``-`` for nothing, text as is."""
    text = F.btrim(value.cast("string"))
    number = text.try_cast("double")
    size = F.abs(number)
    exponent = F.regexp_replace(F.format_string("%.3e", number), "e([+-])(\\d)$", "e$10$2")
    return (F.when(text.isNull() | (text == ""), F.lit("-")).when(number.isNull(), text)
            .when((number != 0) & ((size < 1e-3) | (size >= 1e6)), exponent)
            .otherwise(fixed(number, digits)))


def property_number(value: Column) -> Column:
    """Whole numbers below 1000 plain, otherwise 2 to 4 digits by size."""
    v = value.cast("double")
    size = F.abs(v)
    return (F.when(v.isNull() | F.isnan(v), F.lit("—"))
            .when((v == F.floor(v)) & (size < 1000), v.cast("long").cast("string"))
            .when(size >= 100, fixed(v, 2))
            .when(size >= 1, fixed(v, 3)).otherwise(fixed(v, 4)))


def percent_text(value: Column) -> Column:
    v = value.cast("double")
    return F.when(v.isNull() | F.isnan(v), F.lit("—")).otherwise(fixed(v, 1))


def count_text(value: Column) -> Column:
    """Thousands separators; zero and nothing give a dash."""
    return (F.when(value.isNull() | (value == 0), F.lit("—"))
            .otherwise(F.format_number(value, 0)))


def duration_text(seconds: Column) -> Column:
    """``1h02m03s``, ``2m03s`` or ``3s``."""
    s = F.floor(seconds).cast("long")
    hours, minutes, rest = F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60
    return (F.when(hours > 0, F.format_string("%dh%02dm%02ds", hours, minutes, rest))
            .when(minutes > 0, F.format_string("%dm%02ds", minutes, rest))
            .otherwise(F.format_string("%ds", rest)))


def eta_seconds(done: Column, total: Column, elapsed: Column) -> Column:
    """Remaining time at the mean rate so far; NULL before the first result."""
    return (total - done) * elapsed / F.when(done > 0, done)


def breakable(s: Column, chunk: int = 12) -> Column:
    """Zero-width space after every ``chunk`` characters; ``-`` for nothing."""
    return (F.when(s.isNull() | (s == ""), F.lit("-"))
            .otherwise(F.regexp_replace(s, f"(?s)(.{{{chunk}}})(?=.)", "$1​")))


def truthy(s: Column) -> Column:
    return F.lower(F.btrim(s)).isin("true", "1", "yes", "on", "ja")


def success_flag(s: Column) -> Column:
    return F.lower(F.btrim(s)).isin("true", "1", "yes")


def number_or_null(s: Column) -> Column:
    """Double from text; blanks and words for nothing are NULL."""
    t = F.btrim(s)
    return F.when(~F.lower(t).isin("", "none", "null", "nan"), t.try_cast("double"))


def csv_number(value: Column, digits: int) -> Column:
    """Fixed digits for CSV sinks; NULL stays empty."""
    return fixed(value, digits)
