"""The base table deals its largest table out once, and both ways to fill agree."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from stayline.operators import contracts, joins, missing
from stayline.plans import abt, bindings


@pytest.mark.parametrize("direction", ["ffill", "bfill"])
def test_whole_groups_fill_like_pieces(spark, direction):
    rows = [(None if i % 17 == 0 else i % 5, None if i % 11 == 0 else i // 3, None if i % 3 else i, None if i % 4 else f"w{i}") for i in range(300)]
    df = spark.createDataFrame(rows, "k int, t int, v int, w string").repartition(5)
    pieces = missing.directional_fill(df, ["v", "w"], ["k"], ["t"], direction)
    whole = missing.directional_fill(df, ["v", "w"], ["k"], ["t"], direction, group_size=100)
    large = missing.directional_fill(df, ["v", "w"], ["k"], ["t"], direction, group_size=100, limit=10)
    assert whole.columns == df.columns
    found = [sorted(map(str, x.collect())) for x in (pieces, whole, large)]
    assert found[0] == found[1] == found[2]


def test_observations_are_dealt_out_once(spark, small):
    """Fill, duplicates and contracts use the partitioning of the join of the lines with their orders."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        loans = bindings.loans(spark, small)
        sizes = contracts.measure_sizes(loans)
        table = contracts.contract_table(abt.prepared_loans(loans, bindings.SEQUENCE, sizes=sizes), sizes=sizes)
        plan = table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # lines and orders by order, orders and customers by customer; nothing after that, and no Python
    assert plan.count("Exchange hashpartitioning") == 4
    assert "rangepartitioning" not in plan and "MapInArrow" not in plan


def test_most_complete_rows_are_dealt_out_once(spark, small):
    """The query of the deduplicated observations deals no line out after the join, nor writes it on the way."""
    import __spark_entry__

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = __spark_entry__.queries()["e02_most_complete"](spark, small)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "stayline-filled" not in plan
    assert plan.count("Exchange hashpartitioning") == 4


def test_latest_rows_by_array_are_those_carried_forward(spark):
    """Ties of a time, missing keys and times, keys without a match; few rows of a key need no carrying."""
    left = spark.createDataFrame(
        [(None if i % 13 == 0 else i % 6, None if i % 7 == 0 else i, i) for i in range(120)], "k int, t int, n int"
    )
    right = spark.createDataFrame(
        [(None if i % 9 == 0 else i % 5, None if i % 8 == 0 else i // 2 * 3, None if i % 4 == 0 else f"s{i}") for i in range(40)],
        "k int, at int, s string",
    )
    by_array = joins.latest_join(left, right, ["k"], "t", "at")
    carried = joins.latest_join(left, right, ["k"], "t", "at", limit=1)
    assert "MapInArrow" not in by_array._jdf.queryExecution().toString()
    assert by_array.columns == carried.columns
    assert sorted(map(str, by_array.collect())) == sorted(map(str, carried.collect()))
    assert by_array.filter("at IS NOT NULL").count() > 50
