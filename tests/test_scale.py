"""Queries whose pairs are many times their records: pairs are summed where they are made, not shuffled or sorted."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import features as X
from tessera.operators import grouping as W
from tessera.operators import made as M
from tessera.plans import registry


@pytest.fixture(scope="module")
def customers(spark, tmp_path_factory):
    """6000 customers, of which candidates makes some 56 000 pairs."""
    path = str(tmp_path_factory.mktemp("customers"))
    spark.range(6000).select(F.col("id").alias("c_custkey")).write.parquet(f"{path}/customer.parquet")
    return path


def _shuffled(spark) -> int:
    store = spark.sparkContext._jsc.sc().statusStore()
    stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), spark.sparkContext._jvm.java.util.ArrayList())
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def _pairs(spark, customers) -> int:
    return registry.linking.candidates(*registry.linking.people(spark, customers)).count()


def _rows(rows):
    return sorted(tuple(round(x, 5) if isinstance(x, float) else x for x in r) for r in rows)


def _same_as_sql(name, spark, customers):
    before = _shuffled(spark)
    got = registry.QUERIES[name](spark, customers)
    rows, written = got.collect(), _shuffled(spark) - before
    con = duckdb.connect()
    con.sql(f"create view customer as select * from '{customers}/customer.parquet/*.parquet'")
    con.sql("create view documents as select 0 as doc_id, '' as text, '' as lang")
    want = con.sql(registry.ORACLE_SQL[name])
    names = sorted(got.columns)
    assert _rows(tuple(r[n] for n in names) for r in rows) == _rows(tuple(r[want.columns.index(n)] for n in names) for r in want.fetchall())
    return written


def test_ledger_shuffles_records_only(spark, customers):
    assert _same_as_sql("loss_ledger", spark, customers) < _pairs(spark, customers)


def test_siblings_shuffle_records_only(spark, customers, tmp_path):
    _same_as_sql("siblings", spark, customers)
    # With ten times the pairs no claimant is sure, so that no pair is new.
    spark.range(20_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    assert _same_as_sql("siblings", spark, str(tmp_path)) < _pairs(spark, str(tmp_path)) / 2


def test_best_made(spark):
    rows = spark.createDataFrame([(1, 5, 0.5), (1, 3, 0.5), (1, 2, 0.1), (2, 9, 0.7), (2, 1, 0.2), (3, 4, 0.0)], "pool long, s1 long, p double")
    got = W.best_made(lambda pools: pools.join(rows, "pool"), rows.select("pool").distinct(), ["pool"], "s1", "p")
    assert _rows(got.select("pool", "s1", "p", "second").collect()) == [(1, 3, 0.5, 0.5), (2, 9, 0.7, 0.2), (3, 4, 0.0, 0.0)]


def test_rates_shuffle_records_only(spark, tmp_path):
    """what is shuffled grows with the texts compared, not with the pairs."""
    spark.range(20_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    assert _same_as_sql("rate_columns", spark, str(tmp_path)) < _pairs(spark, str(tmp_path))


def test_context_shuffles_records_only(spark, customers, monkeypatch):
    """pairs are ranked where they are made, also where several tasks share a block."""
    assert _same_as_sql("candidate_context", spark, customers) < _pairs(spark, customers) / 4
    monkeypatch.setattr(M, "CELLS", 200)
    monkeypatch.setattr(M, "STEP", 100)
    _same_as_sql("candidate_context", spark, customers)


def test_ranks_of_ties():
    """Equal scores go to the first; numbers are rounded like SQL's."""
    assert M.ranks(np.array([[0.5, 0.7, 0.5, 0.7]])).tolist() == [[2, 0, 3, 1]]
    assert M.rounded(np.array([-0.0000015, 0.1234567, 0.0]), 6).tolist() == [-0.000002, 0.123457, 0.0]


def _written(name, spark, path):
    """Records that the query shuffles."""
    before = _shuffled(spark)
    registry.QUERIES[name](spark, path).write.format("noop").mode("overwrite").save()
    return _shuffled(spark) - before


def test_pruner_shuffles_records_only(spark, customers, tmp_path):
    """the pruner's features of pairs that are made, and those of candidates, which SQL no longer looks at."""
    _same_as_sql("pruner_columns", spark, customers)
    one, two = registry.linking.people(spark, customers)
    want = registry.r6(X.prune_features(registry.linking.candidates(one, two), one, two), "s_name", "s_combo", "s_addr", "nt_jacc", "s_combo_gap1", "s_combo_gap2", "s_name_gap1", "amb_s1_name", "amb_pool_name_in_s1")
    got = registry.linking.pruner_columns(spark, customers)
    assert got.columns == want.columns
    assert _rows(map(tuple, got.collect())) == _rows(map(tuple, want.collect()))
    spark.range(20_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    assert _written("pruner_columns", spark, str(tmp_path)) < _pairs(spark, str(tmp_path)) / 2


def test_second_stage_shuffles_records_only(spark, customers, tmp_path, monkeypatch):
    """the second stage's features of pairs that are made, also where several tasks share a block, and those of candidates."""
    _same_as_sql("second_stage", spark, customers)
    one, two = registry.linking.people(spark, customers)
    got = registry.linking.second_stage(spark, customers)
    want = X.stage2_features(registry.linking.candidates(one, two).select(*X.PAIR, "src", "p1"), two)
    floats = [c for c, kind in want.dtypes if kind == "double" and c in got.columns]
    assert _rows(map(tuple, got.collect())) == _rows(map(tuple, registry.r6(want, *floats).select(got.columns).collect()))
    spark.range(20_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    assert _written("second_stage", spark, str(tmp_path)) < _pairs(spark, str(tmp_path)) / 4
    monkeypatch.setattr(M, "CELLS", 200)
    _same_as_sql("second_stage", spark, customers)


def test_pruner_shuffles_candidates_three_times(spark, customers):
    """F8: for their ranks in both records, and to meet S1; before, also to meet the pool and both records' ambiguity, with all columns."""
    one, two = registry.linking.people(spark, customers)
    cands = registry.linking.candidates(one, two).localCheckpoint()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        before = _shuffled(spark)
        X.prune_features(cands, one, two).write.format("noop").mode("overwrite").save()
        assert _shuffled(spark) - before < 4 * cands.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["list_scan", "written_lists"])
def test_lists_are_made_where_they_are_written(spark, customers, name, monkeypatch):
    """neither pairs nor lists are shuffled, and blocks that are too large to be copied give the same lists."""
    from tessera.sources import tables as IO

    assert _same_as_sql(name, spark, customers) < 6 * 6000
    whole = IO.write_block_lists
    monkeypatch.setattr(IO, "write_block_lists", lambda *a, **b: whole(*a, **b, most=0))
    _same_as_sql(name, spark, customers)


def test_block_lists_keep_the_order(spark, tmp_path):
    from tessera.shared import materialize
    from tessera.sources import tables as IO

    blocks = materialize(spark.createDataFrame([("a", "x,y"), ("b", "z")], "k string, ids string"), "blocks")
    entities = spark.range(500).selectExpr("id", "-id pos", "array('a', 'b', null)[cast(id % 3 as int)] k")
    for most in (1000, 0):
        IO.write_block_lists(entities, blocks, ["k"], f"{tmp_path}/{most}", "id", "pos", {"f": ("ids", F.col("ids"))}, most)
        rows = IO.read_tsv(spark, f"{tmp_path}/{most}/f.tsv", ("source1_entity_id", "ids"), "at").orderBy("at").collect()
        assert [(r.source1_entity_id, r.ids or "") for r in rows] == [(str(i), ["x,y", "z", ""][i % 3]) for i in range(499, -1, -1)]


def test_written_lists_are_packed(spark, tmp_path, monkeypatch):
    """files and what is shuffled are together less than the lists, which were all written, ranked and joined as they are."""
    from pathlib import Path

    from tessera.plans import results

    paths, new, store = [], results.new_path, spark.sparkContext._jsc.sc().statusStore()
    monkeypatch.setattr(results, "new_path", lambda *a: paths.append(new(*a)) or paths[-1])

    def written():
        stages = store.stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), spark.sparkContext._jvm.java.util.ArrayList())
        return sum(stages.apply(i).shuffleWriteBytes() for i in range(stages.size()))

    spark.range(20_000).select(F.col("id").alias("c_custkey")).write.parquet(f"{tmp_path}/customer.parquet")
    before, rows = written(), registry.QUERIES["written_lists"](spark, str(tmp_path))
    texts = rows.agg(F.sum(F.length("matched_entity_ids") + F.length("candidate_entity_ids"))).first()[0]
    files = sum(p.stat().st_size for p in Path(paths[0]).rglob("part-*"))
    assert texts > 5_000_000 and files + written() - before < 0.75 * texts


def test_rows_of_both_files(spark, tmp_path):
    from tessera.sources import tables as IO

    rows = spark.createDataFrame([(f"e{i}", f"é{i}" * (i % 3), f"c{i}") for i in range(40)], "k string, a string, b string").repartition(5)
    for name in "ab":
        IO.write_tsv(rows.orderBy(F.desc("k")).select(F.col("k").alias("source1_entity_id"), F.col(name).alias(f"ids_{name}")), f"{tmp_path}/{name}", "gzip")
    got = IO.rows_of_both(spark, (f"{tmp_path}/a", "ids_a"), (f"{tmp_path}/b", "ids_b"))
    assert sorted(map(tuple, got.collect())) == [(i, *r) for i, r in enumerate(sorted(map(tuple, rows.collect()), reverse=True))]


def test_blocks_are_dealt_one_by_one(spark, customers):
    """as many partitions as blocks, where there are more blocks than shuffle partitions; and nothing is made that isn't asked for."""
    one, two = registry.linking.people(spark, customers)
    blocks = one.join(two, registry.linking.BLOCK, "left_semi").select(*registry.linking.BLOCK).distinct().count()
    out = registry.linking.competition(one, two, {s: s for s in X.SCORES}, wanted=["s_name", "s_combo_rank1", "s_addr_gap2"])
    assert out.columns == [*registry.linking.BLOCK, "s1_id", "pool_id", "s_combo_rank1", "s_name", "s_addr_gap2", *X.SIZES.values()]
    assert blocks > 4 and out.rdd.getNumPartitions() == blocks
    whole = registry.linking.competition(one, two, {s: s for s in X.SCORES}).select(*out.columns)
    assert _rows(map(tuple, out.collect())) == _rows(map(tuple, whole.collect()))
