"""Numbers as text and text as sizes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from provlake.functions.text import col, trim_ws

# Decimal units when a size is read for scoring, binary units when it is
# read for the export vocabulary. The two readings differ on purpose.
DECIMAL_UNITS = [("TB", 1e12), ("GB", 1e9), ("MB", 1e6), ("KB", 1e3), ("B", 1.0)]
BINARY_UNITS = [("b", 1), ("byte", 1), ("bytes", 1),
                ("kb", 1024), ("kilobyte", 1024), ("kilobytes", 1024),
                ("mb", 1024 ** 2), ("megabyte", 1024 ** 2), ("megabytes", 1024 ** 2),
                ("gb", 1024 ** 3), ("gigabyte", 1024 ** 3), ("gigabytes", 1024 ** 3),
                ("tb", 1024 ** 4), ("terabyte", 1024 ** 4), ("terabytes", 1024 ** 4)]
NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"


def fixed(value, decimals: int) -> Column:
    """Fixed decimals, half-even on the exact binary value, no grouping."""
    return F.replace(F.format_number(col(value).cast("double"), decimals), F.lit(","), F.lit(""))


def round_fixed(value, decimals: int) -> Column:
    return fixed(value, decimals).cast("double")


def thousands(value) -> Column:
    return F.format_number(col(value), 0)


def format_size(size) -> Column:
    """1000-based size text with one decimal."""
    c = col(size)
    out = None
    for unit, factor in DECIMAL_UNITS[:-1]:
        text = F.concat(fixed(c / F.lit(factor), 1), F.lit(f" {unit}"))
        out = F.when(c >= factor, text) if out is None else out.when(c >= factor, text)
    return out.otherwise(F.concat(c.cast("bigint").cast("string"), F.lit(" B")))


def format_size_binary(size) -> Column:
    """1024-based size text with two decimals."""
    c = col(size).cast("double")
    out = None
    for power, unit in enumerate(["B", "KB", "MB", "GB", "TB"]):
        text = F.concat(fixed(c / F.lit(float(1024 ** power)), 2), F.lit(f" {unit}"))
        hit = c < float(1024 ** (power + 1))
        out = F.when(hit, text) if out is None else out.when(hit, text)
    return out.otherwise(F.concat(fixed(c / F.lit(float(1024 ** 5)), 2), F.lit(" PB")))


def parse_size_decimal(text) -> Column:
    """'1.2 TB', '500 mb' or bare bytes as a double; anything else is 0."""
    c = F.upper(trim_ws(text))
    number = F.regexp_extract(c, rf"\A({NUMBER})[\x00-\x20]*(?:[TGMK]?B)?\z", 1)
    unit = F.regexp_extract(c, r"([TGMK]?B)\z", 1)
    factor = F.lit(1.0)
    for name, value in DECIMAL_UNITS:
        factor = F.when(unit == name, F.lit(value)).otherwise(factor)
    return F.coalesce(F.nullif(number, F.lit("")).try_cast("double") * factor, F.lit(0.0))


def parse_size_binary(text) -> Column:
    """1024-based byte count, truncated; null when unreadable."""
    c = F.lower(trim_ws(text))
    number = F.regexp_extract(c, rf"\A({NUMBER})[\x00-\x20]*(?:(?:[kmgt]?b)|(?:(?:kilo|mega|giga|tera)?bytes?))\z", 1)
    unit = F.regexp_extract(c, r"([a-df-z][a-z]*)\z", 1)
    factor = F.lit(None).cast("double")
    for name, value in BINARY_UNITS:
        factor = F.when(unit == name, F.lit(float(value))).otherwise(factor)
    digits = F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("bigint"))
    return F.coalesce(digits, (F.nullif(number, F.lit("")).try_cast("double") * factor).cast("bigint"))


def format_tokens(raw) -> Column:
    """Format text as dotless lower-case tokens; 'unknown' and blanks dropped."""
    parts = F.split(F.coalesce(col(raw), F.lit("")), "[/,;]")
    clean = F.transform(parts, lambda p: F.lower(trim_ws(F.regexp_replace(trim_ws(p), r"\A\.+", ""))))
    return F.filter(clean, lambda t: (t != "") & (t != "unknown"))


def format_tokens_of(formats) -> Column:
    """Tokens of an array of raw formats."""
    return F.flatten(F.transform(col(formats), format_tokens))


def normal_format(formats) -> Column:
    """Tokens joined by ', ', or 'unknown'."""
    return F.coalesce(F.nullif(F.array_join(format_tokens_of(formats), ", "), F.lit("")), F.lit("unknown"))


# The formats a date text may have, tried in this order.
ISO_FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy"]


def parse_iso(text) -> Column:
    """Timestamp from a date text cut at its first dot; trailing text after a match is ignored."""
    c = F.substring_index(col(text), ".", 1)
    shapes = [r"\A\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", r"\A\d{4}-\d{2}-\d{2}", r"\A\d{2}/\d{2}/\d{4}"]
    tries = []
    for shape, fmt in zip(shapes, ISO_FORMATS):
        head = F.nullif(F.regexp_extract(c, f"({shape})", 1), F.lit(""))
        tries.append(F.try_to_timestamp(head, F.lit(fmt)))
    return F.coalesce(*tries).cast("timestamp_ntz")
