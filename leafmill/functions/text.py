"""Text functions as column expressions, with Python's meaning of white space and words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"[\p{IsWhite_Space}\x{1c}-\x{1f}]"


def strip(c: Column) -> Column:
    """Without white space at both ends, Unicode's included."""
    return F.regexp_replace(c, rf"^{SPACES}+|{SPACES}+$", "")


def words(c: Column) -> Column:
    """Split at runs of white space, no empty words."""
    return F.filter(F.split(c, rf"{SPACES}+"), lambda x: x != "")


def lines(c: Column) -> Column:
    return F.split(c, "\n", -1)


def blank(c: Column) -> Column:
    return ~c.rlike(rf"[^\p{{IsWhite_Space}}\x{{1c}}-\x{{1f}}]")


def count_of(c: Column, part: str) -> Column:
    """Occurrences of `part` that don't overlap."""
    return ((F.length(c) - F.length(F.replace(c, F.lit(part), F.lit("")))) / len(part)).cast("int")


def title_case(c: Column) -> Column:
    """Every letter that follows no letter large, all others small."""
    parts = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(F.substring(p, 2, 1 << 30)))), "")


def human_size(c: Column) -> Column:
    """Bytes as '14.2 MB'."""
    out = F.format_string("%.1f PB", c.cast("double") / 1024.0**5)
    for power, unit in reversed(list(enumerate(("B", "KB", "MB", "GB", "TB")))):
        out = F.when(F.abs(c.cast("double")) < 1024.0 ** (power + 1), F.format_string(f"%.1f {unit}", c.cast("double") / 1024.0**power)).otherwise(out)
    return out


def safe_filename(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N} ._-]", "_")


def md5_mod(c: Column, modulus: int = 10_000) -> Column:
    """The MD5 of a text, read as one number, modulo `modulus`; four hexadecimal digits at a time."""
    parts = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda i: F.conv(F.substring(F.md5(c), i * 4 + 1, F.lit(4)), 16, 10).cast("long"))
    return F.aggregate(parts, F.lit(0).cast("long"), lambda a, x: (a * 65536 + x) % modulus)
