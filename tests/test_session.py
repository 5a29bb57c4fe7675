"""Checkpoint folder handling and the lineage cut."""

from parcelbeam.session import ensure_checkpoint_dir, stable


def test_checkpoint_dir_is_read_not_replaced(spark):
    first = ensure_checkpoint_dir(spark)
    assert first
    assert ensure_checkpoint_dir(spark) == first  # a second call keeps the same folder


def test_stable_keeps_rows_and_cuts_lineage(spark):
    df = spark.range(100).selectExpr("id", "id * 2 AS twice").filter("id % 3 = 0")
    cut = stable(df)
    assert sorted(r["id"] for r in cut.collect()) == [i for i in range(100) if i % 3 == 0]
    plan = cut._jdf.queryExecution().logical().toString()
    assert "Range" not in plan  # the checkpointed frame no longer carries its source plan
