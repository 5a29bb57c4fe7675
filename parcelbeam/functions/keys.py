"""Parcel-id cleaning, slicing and display formatting.

All functions return Column expressions, so they stay inside whole-stage
codegen; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode White_Space set that a full Unicode trim strips
# (tab..carriage return, space, next line, no-break space, ogham space mark,
# en quad..hair space, line separator, paragraph separator, narrow no-break
# space, medium mathematical space, ideographic space).
WHITESPACE_CLASS = (
    "[\\x{0009}-\\x{000D}\\x{0020}\\x{0085}\\x{00A0}\\x{1680}"
    "\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_unicode(c: Column | str) -> Column:
    """Strip leading/trailing Unicode white space (Spark ``trim`` only strips blanks)."""
    return F.regexp_replace(_col(c), f"^{WHITESPACE_CLASS}+|{WHITESPACE_CLASS}+$", "")


def strip_dashes(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "-", "")


def clean_pin(c: Column | str) -> Column:
    """Trim Unicode white space, then drop every dash: ' 01-02-003-004-0005\\t' -> '01020030040005'."""
    return strip_dashes(trim_unicode(c))


def pin10(c: Column | str) -> Column:
    """Building part of a parcel id: its first ten characters."""
    return F.substring(_col(c), 1, 10)


def pretty_pin(c: Column | str, full_length: bool = False) -> Column:
    """Dashed display form 2-2-3-3 (10 digits) or 2-2-3-3-4 (14 digits); NULL stays NULL."""
    c = _col(c)
    parts = [F.substring(c, 1, 2), F.substring(c, 3, 2), F.substring(c, 5, 3), F.substring(c, 8, 3)]
    if full_length:
        parts.append(F.substring(c, 11, 4))
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("-"))
        pieces.append(part)
    return F.concat(*pieces)


def pin_from_number(key: Column | str, units_per_building: int = 10) -> Column:
    """Synthetic 14-character parcel id from an integer key: building = key div n (10
    digits), unit = key mod n (4 digits).  Used by the stand-in warehouse views."""
    k = _col(key)
    building = F.floor(k / F.lit(units_per_building)).cast("long")
    unit = F.pmod(k, F.lit(units_per_building)).cast("long")
    return F.concat(F.lpad(building.cast("string"), 10, "0"), F.lpad(unit.cast("string"), 4, "0"))
