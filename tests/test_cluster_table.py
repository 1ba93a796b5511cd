"""The query of the clustering table returns the whole of it by segment."""

import pytest
from pyspark.sql import functions as F

from stayline.plans import clustering
from stayline.sources.schema import numeric_columns


def test_segments_come_with_means_of_all_columns_and_rejected_rows(spark, small, monkeypatch):
    import __spark_entry__

    seen = []
    build, merge = clustering.build_cluster_table, clustering.build_segments
    monkeypatch.setattr(clustering, "build_cluster_table", lambda abt: seen.append(build(abt)) or seen[0])
    monkeypatch.setattr(clustering, "build_segments", lambda table: seen.append(merge(table)) or seen[1])
    rows = [r.asDict() for r in __spark_entry__.queries()["u07_cluster_table"](spark, small).collect()]
    built, segmented = seen
    columns = numeric_columns(built.table, ("CONTRIB",))
    assert len(columns) > 20 and any(c.startswith("CSP_") for c in columns)
    told = segmented.groupBy("segment_final").agg(F.count("*").alias("clients"), *[F.avg(c).alias(c) for c in columns]).collect()
    expected = {r["segment_final"]: r.asDict() for r in told}
    assert len(rows) == len(expected)
    for row in rows:
        assert row["rejected"] == built.rejected.count()
        assert row["clients"] == expected[row["segment_final"]]["clients"]
        for c in columns:
            assert row[c] == pytest.approx(expected[row["segment_final"]][c], rel=1e-9, abs=1e-6)
