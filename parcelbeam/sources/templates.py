"""SQL template files with typed, named markers.

A template is a file with one SELECT.  Its first comment lines declare what it takes: ``-- :name
TYPE`` for a value, ``-- {name}`` for a table.  Values are bound as parameters of the declared
type, never pasted into the text, and tables are passed as DataFrames.  A marker that is not
declared, a declared one that the text lacks, and an argument that is missing, unknown or of another
type are errors that name it, before anything runs.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

# Types that a template may declare, and the Python values they take.
TYPES: dict[str, tuple[type, ...]] = {
    "STRING": (str,),
    "INT": (int,),
    "BIGINT": (int,),
    "DOUBLE": (float, int),
    "DECIMAL": (Decimal,),
    "BOOLEAN": (bool,),
    "DATE": (datetime.date,),
    "TIMESTAMP": (datetime.datetime,),
}
#: Comments, quoted text and quoted names: places where a colon or a brace is no marker.
LITERAL = re.compile(r"--[^\n]*|/\*.*?\*/|'(?:[^'\\]|\\.|'')*'|\"(?:[^\"\\]|\\.|\"\")*\"|`[^`]*`", re.DOTALL)
VALUE = re.compile(r"(?<![:\w]):([A-Za-z_]\w*)")
TABLE = re.compile(r"\{([A-Za-z_]\w*)\}")


class TemplateError(ValueError):
    """What a template or its arguments lack."""


class Template:
    """A parsed template: its text, the types of its values and the names of its tables."""

    def __init__(self, text: str, name: str = "template"):
        self.text, self.name = text, name
        self.values: dict[str, str] = {}
        self.tables: list[str] = []
        for line in text.splitlines():
            if not line.startswith("--"):
                break
            declared = re.fullmatch(r"--\s*:(\w+)\s+([A-Za-z]+)\s*", line)
            if declared:
                self.values[declared[1]] = declared[2].upper()
            elif re.fullmatch(r"--(\s*\{\w+\})+\s*", line):
                self.tables += TABLE.findall(line)
        unknown = sorted(t for t in self.values.values() if t not in TYPES)
        body = LITERAL.sub(" ", text)
        self._same("value", set(VALUE.findall(body)), set(self.values))
        self._same("table", set(TABLE.findall(body)), set(self.tables))
        if unknown:
            raise TemplateError(f"{name}: no type {', '.join(unknown)}")

    def _same(self, what: str, used: set[str], declared: set[str]) -> None:
        if used - declared:
            raise TemplateError(f"{self.name}: {what} {', '.join(sorted(used - declared))} is not declared")
        if declared - used:
            raise TemplateError(f"{self.name}: declared {what} {', '.join(sorted(declared - used))} is not used")

    def checked(self, values: Mapping[str, object], tables: Mapping[str, DataFrame]) -> None:
        """Raise unless the arguments are the declared ones, of the declared types."""
        for what, given, declared in (("value", values, self.values), ("table", tables, self.tables)):
            if set(given) - set(declared):
                raise TemplateError(f"{self.name}: unknown {what} {', '.join(sorted(set(given) - set(declared)))}")
            if set(declared) - set(given):
                raise TemplateError(f"{self.name}: no {what} {', '.join(sorted(set(declared) - set(given)))}")
        for key, value in values.items():
            kind = self.values[key]
            # True is an int and a datetime is a date in Python, not here
            mixed = ((isinstance(value, bool) and kind != "BOOLEAN")
                     or (isinstance(value, datetime.datetime) and kind == "DATE"))
            if value is not None and (mixed or not isinstance(value, TYPES[kind])):
                raise TemplateError(f"{self.name}: {key} is {kind}, got {type(value).__name__} {value!r}")

    def run(self, spark: SparkSession, tables: Mapping[str, DataFrame] | None = None, **values: object) -> DataFrame:
        """The template's rows, for these tables and values."""
        tables = dict(tables or {})
        self.checked(values, tables)
        # text and comments may hold braces that are no tables
        kept = LITERAL.sub(lambda m: " " if m[0].startswith(("--", "/*")) else m[0].replace("{", "{{").replace("}", "}}"), self.text)
        typed = {k: float(v) if self.values[k] == "DOUBLE" and v is not None else v for k, v in values.items()}
        return spark.sql(kept, args=typed, **tables) if typed else spark.sql(kept, **tables)


def load_template(spark: SparkSession, path: str) -> Template:
    """A template from a file on any file system that Spark reads."""
    rows = spark.read.text(path, wholetext=True).collect()
    if len(rows) != 1:
        raise TemplateError(f"{path}: {len(rows)} files")
    return Template(rows[0].value, path)


def packaged_template(name: str) -> Template:
    """A template that comes with the package."""
    from importlib.resources import files
    return Template(files("parcelbeam.plans").joinpath("templates", name).read_text(encoding="utf-8"), name)
