"""How the flights are put together."""

from skyledger import fixtures


def test_flights_by_date_moves_narrow_rows(spark, small):
    """Line items are gathered by day before their texts are made; the rows are those of the plain table, sorted in every part."""
    made = fixtures.flights_by_date(spark, small)
    above, below = made._jdf.queryExecution().optimizedPlan().toString().split("RebalancePartitions")
    assert "concat_ws" in above and "concat_ws" not in below and "lpad" not in below and "Sort [_day" in above
    plain = fixtures.flights(spark, small)
    assert made.columns == plain.columns and made.exceptAll(plain).isEmpty() and plain.exceptAll(made).isEmpty()


def test_a_small_table_joined_with_nations_is_still_small(spark, small):
    """Suppliers are sent to the line items, which the planner would not do with the estimate of suppliers and nations together."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        plan = fixtures.flights(spark, small, ("Origin", "TailNum", "row_key"))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan
