"""Every query against its SQL, over the small tables; queries without SQL against plain code."""

import itertools
import os
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.functions import similarity as SIM
from tessera.operators.decide import best_prefix
from tessera.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def _plain(v):
    return round(v, 5) if isinstance(v, float) else v


def _rows(rows, order):
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql(name, spark, duck):
    got = registry.QUERIES[name](spark, SF)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    assert _rows(got.collect(), [got.columns.index(n) for n in names]) == _rows(want.fetchall(), [want.columns.index(n) for n in names])


@pytest.mark.parametrize("name", ["parsed_records", "blocked_candidates"])
def test_rows(name, spark):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_features(spark):
    pruner, stages = registry.pruner_features(spark, SF), registry.stage_features(spark, SF)
    from tessera.operators.features import PRUNE

    assert len(PRUNE) == 41 and set(PRUNE) <= set(pruner.columns)
    assert len(stages.columns) == 3 + 118 + 26 + 26
    rows = stages.toPandas()
    assert len(rows) == pruner.count() and not rows.duplicated(["country", "s1_id", "pool_id"]).any()
    assert rows.notna().all().all()


def test_features_of_a_pair_are_shuffled_once(spark):
    """F16: what is known of a record meets it before its pairs, however large its table; features of a pair only go to meet what is keyed by the pair."""
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.debug.maxToStringFields": "1000", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    stages = registry.stage_features(spark, SF)
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        plan = stages._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    exchanges = [x for x in plan.split("\n\n") if "Exchange" in x.strip().partition("\n")[0] and "n_compact_jw#" in x and "Input" in x]
    assert len(exchanges) == 1


def _lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(last[j + 1], row[j])
    return row[-1]


def test_similarities():
    rng = np.random.default_rng(2)
    for _ in range(300):
        a, b = ("".join(rng.choice(list("abc d"), rng.integers(0, 12))) for _ in range(2))
        assert SIM.lcs(a, b) == _lcs(a, b)
        short, long = sorted((a, b), key=len)
        if short:
            windows = [long[max(0, e - len(short)) : e] for e in range(1, len(long) + len(short))]
            assert SIM.partial_ratio(a, b) == pytest.approx(max(SIM.ratio(short, w) for w in windows) if short not in long else 100.0)
    assert SIM.token_set_ratio("new york mets", "mets york new") == 100.0
    assert SIM.token_sort_ratio("b a", "a b") == 100.0
    assert SIM.token_set_ratio("", "x") == 0.0 and SIM.ratio("", "") == 100.0


def test_sql_names(spark):
    SIM.register(spark)
    row = spark.sql("select ratio('ab', 'ab') as r, digit_runs('12 b012 3') as d, sorted_letters('bcdefgha') as s, has_indic('aग') as i, ascii_text('Né') as a, grams('ab c', 3) as g, expected_prefix(array(1.0D, 0.75D), 0.0D) as k, expected_prefix(array(0.4D), 0.0D) as z").first()
    assert tuple(row) == (100.0, ["12", "3"], "abcdefgh", True, "ne", [" ab", "ab ", "b c", " c "], 2, 0)


@pytest.mark.parametrize("p", [[0.9], [0.4], [1.0, 0.7], [1.0, 0.75], [0.9, 0.8, 0.3, 0.1]])
def test_expected_f(p):
    """All outcomes enumerated, without missed matches."""
    best = {0: np.prod([1 - q for q in p])}
    for k in range(1, len(p) + 1):
        best[k] = 0.0
        for y in itertools.product((0, 1), repeat=len(p)):
            chance = np.prod([q if t else 1 - q for q, t in zip(p, y, strict=True)])
            best[k] += chance * 1.25 * sum(y[:k]) / (k + 0.25 * sum(y))
    top = max(best.values())
    assert best[best_prefix(np.array(p), 0.0)] == pytest.approx(top)


@pytest.mark.parametrize("p", [[0.9], [0.55], [0.9, 0.5], [0.8, 0.6, 0.3]])
@pytest.mark.parametrize("lam", [0.02, 0.4, 1.5])
def test_expected_f_with_missed_matches(p, lam):
    """All outcomes enumerated, with Poisson many true matches that were never found."""
    missed = [np.exp(-lam) * lam**m / np.prod(range(1, m + 1), dtype=float) for m in range(12)]
    value = {}
    for k in range(len(p) + 1):
        value[k] = 0.0
        for y in itertools.product((0, 1), repeat=len(p)):
            chance = np.prod([q if t else 1 - q for q, t in zip(p, y, strict=True)])
            for m, c in enumerate(missed):
                true = sum(y) + m
                value[k] += chance * c * ((1.0 if true == 0 else 0.0) if k == 0 else 1.25 * sum(y[:k]) / (k + 0.25 * true))
    assert value[best_prefix(np.array(p), lam)] == pytest.approx(max(value.values()))


def test_projection_recall(spark):
    """Recall at the query's own threshold."""
    near = registry.top_projected(spark, "/root/testdata/sf0.01").select("s1_id", "pool_id")
    exact = registry.top_cosine_global(spark, "/root/testdata/sf0.01").filter("score >= 0.6").select("s1_id", "pool_id")
    assert exact.join(near, ["s1_id", "pool_id"]).count() >= 0.9 * exact.count() > 0


def test_tsv_edge_cases(spark, tmp_path):
    from tessera.sources import tables as IO

    path = tmp_path / "a.tsv"
    path.write_text('entity_id\tcountry\tbusiness_name\nS1-1\tus\t"quoted\nS1-2\t\ta\\b\n', encoding="utf-8")
    got = {r.entity_id: tuple(r)[1:] for r in IO.read_tsv(spark, str(path)).collect()}
    assert got == {"S1-1": ('"quoted', "", "us"), "S1-2": ("a\\b", "", "")}
    truth = tmp_path / "t.tsv"
    truth.write_text("source1_entity_id\tids\nS1-1\tS2-1,S2-2\nS1-2\t\nS1-1\tS2-3,,\n", encoding="utf-8")
    assert [tuple(r) for r in IO.read_truth(spark, str(truth)).collect()] == [("S1-1", "S2-3")]


def test_stage_is_kept(spark, tmp_path):
    from tessera.sources import tables as IO

    path = str(tmp_path / "stage")
    assert IO.stage(spark.range(3), path).count() == 3
    assert IO.stage(spark.range(5), path).count() == 3
    assert IO.stage(spark.range(5), path, force=True).count() == 5


def test_translations(spark):
    from tessera.operators import regions as R

    pairs = spark.createDataFrame([("गणेश ट्रेडर्स", "ganes tredars", "ganesh traders")] * 3, "raw_name string, pool_name string, s1_name string")
    words = R.learn_translations(pairs)
    assert {r.word: r.meaning for r in words.collect()} == {"ganes": "ganesh", "tredars": "traders"}
    views = {c: "" for c in ("n_core", "n_core2", "n_sorted2", "n_compact", "n_skel", "n_first")}
    rows = spark.createDataFrame([("in", 1, "गणेश", "ganes tredars ltd"), ("in", 2, "plain", "ganes"), ("in", 3, "ग", "")], "country string, eid int, raw_name string, n_name string").withColumns({c: F.lit(v) for c, v in views.items()})
    for most in (20_000, 1):  # as a map, and joined by word
        got = {r.eid: r for r in R.translate_by(rows, words, most).collect()}
        assert (got[1].n_name, got[1].n_core2, got[1].n_skel) == ("ganesh traders ltd", "ganesh traders", "jns trdrs")
        assert got[2].n_name == "ganes" and got[3].n_name == ""
    assert R.translate_by(rows, words.filter("false")) is rows


def test_merges():
    from tessera.operators.regions import merged_roots

    assert merged_roots([("b", "a"), ("c", "b"), ("x", "y")]) == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x"}


def test_list_checks(spark):
    from tessera.operators import evaluate as E

    lines = spark.createDataFrame([("id\tids",), ("S1-1\tS2-1",), ("S1-2",), ("S1-3,S2-1",), ("a\tb\tc",)], "value string")
    assert {r.problem: r["count"] for r in E.check_lines(lines, "id\tids").collect()} == {"no tab": 1, "comma for tab": 1, "columns": 1}
    lists = spark.createDataFrame([("S1-1", "S2-1,S2-2"), ("S1-2", "")], "s1_id string, ids string")
    cands = spark.createDataFrame([("S1-1", "S2-1")], "s1_id string, ids string")
    assert [(r.s1_id, r.ids) for r in E.not_candidates(lists, cands).collect()] == [("S1-1", ["S2-2"])]
    assert tuple(E.list_counts(lists).first()) == (2, 1)


def _tiny(spark, path, texts):
    """A folder with documents only; ids from 0, so that every fourth is of source 1."""
    spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string").write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_truth_and_records_of_whole_texts(spark, tmp_path):
    head, long = "same words " * 10, "x" * 500
    sf = _tiny(spark, tmp_path, [head + "one", head + "two", head + "one", "other", f"{long} b c d e f g h i"])
    assert {tuple(r) for r in registry._strict_truth(spark, sf).collect()} == {("0", "2")}
    rows = {r.eid: r for r in registry.linkage_records(spark, sf).collect()}
    assert rows["4"].n_name.split()[1:] == ["b", "c", "d", "e", "f"] and rows["4"].addr_empty == 0


def test_partial_ratios_of_many_pairs():
    import random
    import time

    draw = random.Random(0)
    text = lambda n, letters: "".join(draw.choice(letters) for _ in range(draw.randint(0, n)))
    some = [(text(12, "ab "), text(30, "abc ")) for _ in range(2000)] + [(text(300, "abcdef "), text(300, "abcdefüग ")) for _ in range(12)]
    assert SIM.partial_ratios(some) == [SIM.partial_ratio(*p) for p in some]
    assert SIM.partial_token_set_ratios(some) == [SIM.partial_token_set_ratio(*p) for p in some]
    names = [(text(96, "abcdefghij "), text(96, "abcdefghij ")) for _ in range(600)]
    began = time.process_time()
    SIM.partial_ratios(names)
    many = time.process_time() - began
    began = time.process_time()
    one = [SIM.partial_ratio(*p) for p in names]
    assert SIM.partial_ratios(names) == one and many < (time.process_time() - began) / 3


def test_scores_of_many_pairs_at_once():
    """every score of text_similarities is made of many pairs at once, to the same last digit."""
    import time

    draw = random.Random(1)
    text = lambda n, letters: "".join(draw.choice(letters) for _ in range(draw.randint(0, n)))
    some = [(text(12, "ab "), text(30, "abc ")) for _ in range(3000)] + [(text(300, "abcd üग\U0001f600"), text(300, "abcd üग\U0001f600")) for _ in range(60)]
    some += [("", ""), ("", "a"), (" ", "a"), ("a" * 64, "a" * 64), ("a" * 65, "a" * 200), ("ab" * 64, "ba" * 64), ("x" * 500, "xy" * 200)]
    assert {"ratio", "token_sort_ratio", "token_set_ratio", "indel"} < set(SIM.BATCHED)
    for name, many in SIM.BATCHED.items():
        if not name.startswith("partial"):
            assert many(some) == [SIM.SCORERS[name](*p) for p in some], name
    every = tuple(SIM.SCORERS)
    assert SIM.scores(every, some) == {n: [SIM.SCORERS[n](*p) for p in some] for n in every} and SIM.scores(every, []) == {n: [] for n in every}
    names = [("".join(draw.choices("abcdefghij ", k=96)), "".join(draw.choices("abcdefghij ", k=90))) for _ in range(3000)]
    began = time.process_time()
    many = SIM.BATCHED["ratio"](names)
    took = time.process_time() - began
    began = time.process_time()
    assert many == [SIM.ratio(*p) for p in names] and took < (time.process_time() - began) * 2 / 3


def test_similarities_of_all_pairs(spark, tmp_path):
    sf = _tiny(spark, tmp_path, ["silver tech", "silver tek", "sunny silver", "other"])
    rows = {(r.s1_id, r.pool_id): r for r in registry.text_similarities(spark, sf).collect()}
    assert set(rows) == {(0, 1), (0, 2)} and rows[0, 1].ratio == pytest.approx(SIM.ratio("silver tech", "silver tek"))


def test_linked_runs_on_default_settings(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(registry.linkage, "fit", lambda one, two, truth, cfg: seen.append(cfg))
    monkeypatch.setattr(registry.linkage, "predict", lambda model, one, two, cfg: seen.append(cfg))
    registry.linked(spark, SF)
    default = registry.linkage.Settings()
    for cfg in seen:
        assert cfg.rounds == default.rounds and [getattr(cfg.blocking, k) for k in ("k_name", "k_combo", "k_addr")] == [8, 8, 4]
    assert len(seen) == 2


def test_places_over_files_of_any_size(spark, tmp_path):
    """large files are read first, but rows keep the place that the files' names and lines give."""
    from tessera.sources import tables as IO

    sizes = [3, 400, 1, 90]
    for i, n in enumerate(sizes):
        (tmp_path / f"part-{i:05}.csv").write_text("k\n" + "".join(f"{i}-{j:03}\n" for j in range(n)), encoding="utf-8")
    rows = IO.read_tsv(spark, str(tmp_path), ("k",), "at").orderBy("at").collect()
    assert [r.k for r in rows] == [f"{i}-{j:03}" for i, n in enumerate(sizes) for j in range(n)]


def test_equal_decisions_go_to_the_first(spark, monkeypatch):
    """means that differ in the last bit only, as sums in another order do, are equal."""
    from tessera.operators import evaluate, learning

    means = iter([0.1 + 0.2, 0.3, 0.3000000000000001, 0.1 + 0.2 + 1e-16])
    monkeypatch.setattr(evaluate, "entity_scores", lambda entities, picked, truth: entities.withColumn("f", F.lit(next(means))))
    entities = spark.createDataFrame([(i, "us") for i in range(4)], "s1_id long, country string")
    cands = spark.createDataFrame([("us", 1, 2, 0.5)], "country string, s1_id long, pool_id long, pc double")
    best = learning.choose_decision(cands, entities, cands.select("s1_id", "pool_id"), lams=(), thresholds=(0.9, 0.5, 0.65, 0.75))
    assert best["value"] == 0.9


@pytest.mark.parametrize("chunk", [3, 1000])
def test_blocks_of_vectors(spark, monkeypatch, chunk):
    """cosines are made in blocks of vectors; no row per pair that shares a gram is dealt. Ties go to the least id."""
    from tessera.operators import grams as G

    monkeypatch.setattr(G, "CHUNK", chunk)
    rng = np.random.default_rng(5)
    w = rng.random((24, 6)) * (rng.random((24, 6)) < 0.5)
    w[:, 5] += 0.1
    w[20:] = w[10]
    w /= np.sqrt((w * w).sum(axis=1))[:, None]
    rows = [("us", i, f"g{g}", float(w[i, g])) for i in range(24) for g in range(6) if w[i, g]]
    v = spark.createDataFrame(rows, "country string, id long, gram string, w double")
    a, b = v.filter("id < 8").withColumnRenamed("id", "x"), v.filter("id >= 8").withColumnRenamed("id", "y")
    plan = G.top_cosine(a, b, ["country"], "x", "y", 3, 0.3)
    assert "FlatMapGroupsInArrow" in plan._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.x, r.y): r.score for r in plan.collect()}
    want = {(x, y): w[x] @ w[y] for x in range(8) for y in sorted((y for y in range(8, 24) if w[x] @ w[y] >= 0.3), key=lambda y: (-round(w[x] @ w[y], 9), y))[:3]}
    assert got.keys() == want.keys() and all(got[p] == pytest.approx(want[p]) for p in want)
    pairs = spark.createDataFrame([("us", x, y) for x in range(0, 8, 2) for y in range(8, 30, 3)], "country string, x long, y long")
    found = {(r.x, r.y): r.score for r in G.pair_cosine(pairs, a, b, ["country"], "x", "y").collect()}
    assert len(found) == pairs.count() and all(s == pytest.approx(w[x] @ w[y] if y < 24 else 0.0) for (x, y), s in found.items())


def test_rates_look_at_words_once_per_text(spark, monkeypatch):
    """pairs are counted by their texts before words are compared; rates are those of all pairs."""
    from tessera.operators import features as X

    kept = {}
    monkeypatch.setattr(X, "materialize", lambda df, name: kept.setdefault(name, df))
    record = lambda ids, name, legal: [("us", i, name(i), legal(i)) for i in ids]
    columns = "country string, eid long, n_core2 string, n_legal string"
    one = spark.createDataFrame(record(range(10), lambda i: "arbor silver" if i % 2 else "arbor", lambda i: ""), columns)
    two = spark.createDataFrame(record(range(100, 120), lambda i: "arbor tech", lambda i: "llc"), columns)
    pairs = one.select("country", F.col("eid").alias("s1_id")).crossJoin(two.select(F.col("eid").alias("pool_id"))).withColumn("y", (F.col("pool_id") % 4 == 0).cast("int"))
    t = X.rate_tables(pairs, one, two)
    assert kept["compared texts"].count() == 2 and t["prior"] == 0.25
    assert [tuple(r) for r in t["extra"].collect()] == [("tech", pytest.approx(55 / 220))] and [r.word for r in t["missing"].collect()] == ["silver"]
    assert [(r.change, r.rate) for r in t["legal"].collect()] == [("->llc", pytest.approx(55 / 220))]


def test_vectors_of_blocking_are_made_once(spark, monkeypatch):
    """three kinds of vectors serve all searches and scores, and their grams are not shuffled."""
    from tessera.operators import grams as G

    kept, write = [], G.materialize
    monkeypatch.setattr(G, "materialize", lambda df, name: kept.append((name, df)) or write(df, name))
    registry.blocked_candidates(spark, SF)
    vectors = [df for name, df in kept if name == "vectors"]
    assert len(vectors) == 3
    assert all(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1 for df in vectors)
