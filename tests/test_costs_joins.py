"""Which side of the join of lines and parts is put in order, by the size of the parts."""

import os
import re

import pytest
from bloomledger.workloads.common import lines_with_parts


def joined(spark, folder, threshold, partitions):
    was = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        rows = lines_with_parts(spark, folder)
        kind = re.search(r"(\w+Join) ", rows._jdf.queryExecution().executedPlan().toString())[1]
        return kind, sorted(tuple(r) for r in rows.select("l_orderkey", "p_name").collect())
    finally:
        for key, value in was.items():
            spark.conf.set(key, value)


@pytest.fixture
def tables(spark, tmp_path):
    """Keys that repeat on both sides, that have no match, and that are null."""
    lines = [(i, i % 7 if i % 5 else None) for i in range(40)]
    parts = [(k, f"part {k}") for k in (0, 1, 1, 2, 3, 9, None)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_partkey bigint").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey bigint, p_name string").coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    at = f"{tmp_path}/part.parquet"
    size = sum(os.path.getsize(f"{at}/{f}") for f in os.listdir(at) if f.endswith(".parquet"))
    wanted = sorted((line, name) for line, key in lines for part, name in parts if key is not None and key == part)
    return str(tmp_path), size, wanted


def test_lines_are_not_sorted_for_parts_that_fit_a_map(spark, tables):
    folder, size, wanted = tables
    assert joined(spark, folder, size // 2, 8) == ("ShuffledHashJoin", wanted)


def test_small_and_large_parts_are_left_to_the_session(spark, tables):
    folder, size, wanted = tables
    assert joined(spark, folder, size * 2, 8) == ("BroadcastHashJoin", wanted)
    assert joined(spark, folder, size // 20, 8) == ("SortMergeJoin", wanted)
    assert joined(spark, folder, -1, 8) == ("SortMergeJoin", wanted)
