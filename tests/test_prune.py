"""The bitmap of request keys, and names that clash in case."""

import pytest
from pyspark.sql import functions as F

from parcelbeam.operators import bitmap_filter as B
from parcelbeam.operators.attach import MAX_BROADCAST_ROWS_CONF
from parcelbeam.operators.change import value_change

HISTORY = "pin string, year string, class string, twoyr_pri_certified_tot long, oneyr_pri_certified_tot long, mailed_tot long"


@pytest.fixture()
def no_broadcast(spark):
    spark.conf.set(MAX_BROADCAST_ROWS_CONF, "0")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset(MAX_BROADCAST_ROWS_CONF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(32 * 1024 * 1024))


def test_all_wanted_rows_pass_and_few_others(spark, no_broadcast):
    history = spark.range(40000).select(F.lpad(F.col("id").cast("string"), 14, "0").alias("pin"))
    for n, buckets in ((1, 1), (3000, 1), (12000, 3)):
        wanted = history.filter(F.col("pin").cast("long") % (40000 // n) == 0)
        bitmap = B.key_bitmap(wanted, "pin", buckets)
        assert bitmap.count() <= buckets
        passed = B.possibly_wanted(history, "pin", bitmap, buckets)
        total = wanted.count()
        assert passed.join(wanted, "pin").count() == total
        assert passed.count() - total <= 0.2 * 40000
    twice = wanted.unionAll(wanted).unionAll(spark.createDataFrame([(None,)], "pin string"))
    assert B.keep_wanted(history, twice, "pin").count() == total


def _shuffled_rows(df):
    """Rows written by the exchanges of an executed plan."""
    df.collect()
    total, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "ShuffleExchangeExec":
            metric = node.metrics().get("shuffleRecordsWritten")
            if metric.isDefined():
                total[node.toString().split("\n")[0]] = metric.get().value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return sum(total.values())


def test_fewer_history_rows_are_shuffled(spark, no_broadcast, monkeypatch):
    rows = [(f"{i % 10000:014d}", str(1998 + i % 3), "202", i, i, 2 * i) for i in range(30000)]
    history = spark.createDataFrame(rows, HISTORY)
    requests = spark.createDataFrame([(f" {i * 25:014d}", "x") for i in range(400)] + [(None, "n")], "`Permanent Index Number` string, note string")
    pruned = value_change(requests, history, 2000)
    with monkeypatch.context() as m:
        m.setattr(B, "possibly_wanted", lambda df, *_: df)
        plain = value_change(requests, history, 2000)
    same = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert same(pruned) == same(plain)
    few, many = _shuffled_rows(pruned), _shuffled_rows(plain)
    assert few < many / 4, (few, many)


def test_names_that_differ_in_case_only(spark):
    history = spark.createDataFrame([("1", "2000", "202", 5, 10, 13)], HISTORY)
    requests = spark.createDataFrame([("1", "own", "c", "d")], "`Permanent Index Number` string, class string, `percent.change` string, `A.b` string")
    out = value_change(requests, history, 2000)
    assert out.columns == ["Permanent Index Number", "class x", "percent change x", "A b", "Class y", "1998 BoR Certified AV",
                           "1999 BoR Certified AV", "2000 Mailed AV", "Percent Change y", "Large Increase"]
    assert tuple(out.first())[1:5] == ("own", "c", "d", "202")


def test_newest_row_does_not_depend_on_row_order(spark):
    from parcelbeam.operators.attach import newest_per_key
    rows = [("a", "2020", "x", 1), ("a", "2021", "y", None), ("a", "2021", "y", 3), ("a", "2021", "b", 9), ("b", None, "z", 1), (None, "1", "q", 2)]
    for data in (rows, rows[::-1]):
        df = spark.createDataFrame(data, "pin string, year string, town string, n int").repartition(3)
        got = {tuple(r) for r in newest_per_key(df, "pin", "year").collect()}
        assert got == {("a", "2021", "b", 9), ("b", None, "z", 1), (None, "1", "q", 2)}
