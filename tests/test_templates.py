"""SQL templates: typed markers, nothing pasted, everything checked first."""

import datetime
import os
from decimal import Decimal

import pytest

from parcelbeam.sources.templates import Template, TemplateError, load_template

TEXT = """-- Rows from a value on.
-- :low BIGINT
-- :name STRING
-- {t}
SELECT id, ':low {t} it''s' AS note -- :not_a_marker {neither}
FROM {t} WHERE id >= :low AND name = :name /* {x} :y */ AND id::string <> ''
"""


def test_values_and_tables_are_bound(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "q.sql")
    with open(path, "w") as f:
        f.write(TEXT)
    t = load_template(spark, path)
    df = spark.createDataFrame([(1, "a"), (2, "a'; DROP"), (3, "a'; DROP")], "id long, name string")
    got = t.run(spark, {"t": df}, low=2, name="a'; DROP").collect()
    assert [tuple(r) for r in got] == [(2, ":low {t} it's"), (3, ":low {t} it's")]
    assert t.run(spark, {"t": df}, low=2, name=None).count() == 0


@pytest.mark.parametrize("values,tables,message", [
    ({"low": 1}, ["t"], "no value name"), ({"low": 1, "name": "a", "more": 1}, ["t"], "unknown value more"),
    ({"low": "1", "name": "a"}, ["t"], "low is BIGINT, got str"), ({"low": True, "name": "a"}, ["t"], "low is BIGINT, got bool"),
    ({"low": 1.5, "name": "a"}, ["t"], "low is BIGINT, got float"), ({"low": 1, "name": "a"}, [], "no table t"),
    ({"low": 1, "name": "a"}, ["t", "u"], "unknown table u")])
def test_arguments_are_refused(spark, values, tables, message):
    with pytest.raises(TemplateError, match=message):
        Template(TEXT).run(spark, dict.fromkeys(tables, spark.range(1)), **values)


@pytest.mark.parametrize("text,message", [
    ("SELECT :x", "value x is not declared"), ("-- :x INT\nSELECT 1", "declared value x is not used"),
    ("-- :x WHOLE\nSELECT :x", "no type WHOLE"), ("SELECT * FROM {t}", "table t is not declared")])
def test_templates_are_refused(text, message):
    with pytest.raises(TemplateError, match=message):
        Template(text)


def test_types(spark):
    head = "".join(f"-- :v{i} {t}\n" for i, t in enumerate(["INT", "DOUBLE", "DECIMAL", "BOOLEAN", "DATE", "TIMESTAMP"]))
    t = Template(head + "SELECT :v0 AS a, :v1 AS b, :v2 AS c, :v3 AS d, :v4 AS e, :v5 AS f")
    when = datetime.datetime(2020, 1, 2, 3, 4, 5)
    row = t.run(spark, v0=1, v1=2, v2=Decimal("1.5"), v3=True, v4=when.date(), v5=when).first()
    assert tuple(row)[:5] == (1, 2.0, Decimal("1.5"), True, when.date())
    with pytest.raises(TemplateError, match="v4 is DATE"):
        t.run(spark, v0=1, v1=2, v2=Decimal(1), v3=True, v4=when, v5=when)
