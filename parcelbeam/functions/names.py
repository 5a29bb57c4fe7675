"""Column-name transformations.

These run on the driver over the schema only -- no data is touched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# After title-casing, these substrings are upper-cased again.
ACRONYMS = {"Pin": "PIN", "Sf": "SF"}


def dots_to_blanks(name: str) -> str:
    return name.replace(".", " ")


def title_case(name: str) -> str:
    """'total_number_of_units' -> 'Total Number Of Units'."""
    words = name.replace("_", " ").split(" ")
    return " ".join(w[:1].upper() + w[1:].lower() for w in words)


def title_case_acronyms(name: str) -> str:
    """Title case, then 'Pin' -> 'PIN' and 'Sf' -> 'SF' anywhere in the name."""
    out = title_case(name)
    for old, new in ACRONYMS.items():
        out = out.replace(old, new)
    return out


def rename_all(df: DataFrame, fn: Callable[[str], str]) -> DataFrame:
    """Apply a name function to every column (one projection, no data movement)."""
    return df.select(*[F.col(f"`{c}`").alias(fn(c)) for c in df.columns])


def relocate(df: DataFrame, first: Iterable[str] = (), after: dict[str, list[str]] | None = None) -> DataFrame:
    """Move ``first`` to the front, and each list in ``after`` right behind its anchor."""
    first = list(first)
    after = after or {}
    moved = set(first) | {c for cols in after.values() for c in cols}
    order: list[str] = list(first)
    for c in df.columns:
        if c in moved:
            continue
        order.append(c)
        order.extend(after.get(c, []))
    return df.select(*[F.col(f"`{c}`") for c in order])


def dedupe_headers(columns: Sequence[str]) -> list[str]:
    """Make repeated header text unique by position, without regard to case: a, a -> a, a_2.
    A name that another column has already is passed over: a, a, a_2 -> a, a_3, a_2."""
    own = {c.lower() for c in columns}
    taken: set[str] = set()
    out = []
    for c in columns:
        name, n = c, 1
        while name.lower() in taken or (n > 1 and name.lower() in own):
            n += 1
            name = f"{c}_{n}"
        taken.add(name.lower())
        out.append(name)
    return out
