"""Helpers that every operator shares."""

import collections

import pytest
from pyspark.sql import functions as F

from tessera import shared


@pytest.mark.parametrize("parts", [1, 5])
def test_ranks_of_groups_over_partitions(spark, parts):
    rows = [("a" if i % 3 else None, i * 7919 % 101, i) for i in range(300)] + [("b", 1, 1000)]
    df = spark.createDataFrame(rows, "g string, v long, id long").repartition(4)
    got = shared.ranked(df, ["g"], [F.col("v"), F.col("id")], parts).collect()
    by = collections.defaultdict(list)
    for g, v, i in rows:
        by[g].append((v, i))
    assert len(got) == len(rows)
    for r in got:
        assert sorted(by[r.g]).index((r.v, r.id)) + 1 == r["rank"] and r.total == len(by[r.g])
    assert shared.ranked(df.filter("false"), ["g"], [F.col("v")], parts).collect() == []


@pytest.mark.parametrize("most", [0, 1000])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_of_hot_keys(spark, monkeypatch, most, how):
    monkeypatch.setattr(shared, "BROADCAST_ROWS", most)
    df = spark.createDataFrame([(0 if i < 500 else i % 50, i) for i in range(900)], "k long, v long")
    keys = df.groupBy("k").agg(F.count("*").alias("n")).filter("k % 2 = 0").withColumn("x", F.col("k") * 2)
    got = sorted(map(tuple, shared.join_hot(df, keys, ["k"], "n", how, hot=5).collect()))
    want = sorted((r.k, r.v, 2 * r.k if r.k % 2 == 0 else None) for r in df.collect() if how == "left" or r.k % 2 == 0)
    assert got == want


def test_work_folders_of_a_stage_go(spark, tmp_path):
    mark = shared.made()
    tables = [shared.materialize(spark.range(n), "t") for n in (3, 4, 5)]
    shared.drop_made(spark, mark)
    assert tables[-1].count() == 5 and shared.made() == mark + 1
    with pytest.raises(Exception, match="(?i)not exist|no such"):
        tables[0].count()


def test_a_cache_goes_when_another_operator_needs_one():
    from tessera.shared import process_cache

    process_cache("encoders")["x"] = 1
    assert process_cache("encoders") == {"x": 1}
    assert process_cache("shingles") == {} and process_cache("encoders") == {}
