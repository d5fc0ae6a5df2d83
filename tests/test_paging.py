"""Positional pages against OFFSET, and what they read."""

from pyspark.sql import functions as F

from strata.operators.paging import PagedTable
from strata.plans import reports


def test_pages_equal_offset_and_read_few_ranges(spark, tmp_path):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.concat(F.lit("v"), "id").alias("v")).repartition(5)
    table = PagedTable(spark, str(tmp_path / "t"))
    table.write(df, [F.col("k").desc()], ranges=8)
    for page_no, size in ((1, 10), (3, 100), (10, 100), (100, 10), (11, 100), (2, 700), (1, 5000)):
        want = [tuple(r) for r in reports.page_read(df, [F.col("k").desc()], page_no, size).collect()]
        assert [tuple(r) for r in table.page(page_no, size).collect()] == want
    assert len(table.ranges_of(57, 10)[1]) <= 2
    plan = table.page(57, 10)._jdf.queryExecution().executedPlan().toString()
    assert "page_range" in plan.split("PartitionFilters: [")[1].split("]")[0]      # other ranges' folders are pruned


def test_ties_nulls_and_empty(spark, tmp_path):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (1, 4), (1, 5)], "k int, v int")
    table = PagedTable(spark, str(tmp_path / "t"))
    table.write(df, [F.col("k").asc_nulls_last(), F.col("v").asc()], ranges=3)
    assert [r.v for n in (1, 2, 3) for r in table.page(n, 2).collect()] == [3, 4, 5, 1, 2]
    empty = PagedTable(spark, str(tmp_path / "e"))
    empty.write(df.limit(0), [F.col("k").asc()])
    assert empty.page(1, 10).count() == 0


def test_views_are_shown_in_order(spark):
    df = spark.createDataFrame([("2024-01-01", "b"), (None, "a"), ("2024-02-01", None), ("2024-02-01", "a")], "date string, affiliate_id string")
    got = [tuple(r) for r in reports.in_order(df, "gold_affiliate_daily_metrics").collect()]
    assert got == [(None, "a"), ("2024-02-01", "a"), ("2024-02-01", None), ("2024-01-01", "b")]
