"""The whole linkage pipeline, and the registry without the training-data operators."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import evaluate as E
from tessera.plans import linkage
from tessera.sources import tables as IO

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _records(spark, rows, src):
    return IO.normalised(spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string"), src)


@pytest.fixture(scope="module")
def world(spark):
    import random

    rng = random.Random(1)
    words = "alpha bravo cedar delta ember falcon garnet harbor indigo juniper kestrel lumen maple nectar onyx prism quartz river summit timber".split()
    one, two, three, truth = [], [], [], []
    for i in range(160):
        name = " ".join(rng.sample(words, 3)).title()
        place = f"{100 + i} {rng.choice(words).title()} Street, {rng.choice(words).title()}ville, {rng.choice(['TX', 'NV', 'OH'])}"
        one.append((f"S1-{i}", f"{name} LLC", place, "USA"))
        two.append((f"S2-{i}", f"The {name} L.L.C.", place.replace("Street", "St"), "us"))
        truth.append((f"S1-{i}", f"S2-{i}"))
        if i % 3 == 0:
            three.append((f"S3-{i}", name.upper(), place, "United States"))
            truth.append((f"S1-{i}", f"S3-{i}"))
        three.append((f"S3-{i + 1000}", " ".join(rng.sample(words, 3)), f"{900 + i} Other Road, Nowhere, TX", "us"))
    s1, pool = _records(spark, one, 1), _records(spark, two, 2).unionByName(_records(spark, three, 3))
    return s1, pool, spark.createDataFrame(truth, "s1_id string, pool_id string")


@pytest.fixture(scope="module")
def trained(spark, world, tmp_path_factory):
    """Files of both splits, and a model trained from them by the command line's function."""
    from tessera.plans import run

    s1, pool, truth = world
    data, work = (str(tmp_path_factory.mktemp(x)) for x in ("data", "work"))
    for split in ("train", "test"):
        for n, df in ((1, s1), (2, pool.filter("src = 2")), (3, pool.filter("src = 3"))):
            IO.write_tsv(df.select(F.col("eid").alias("entity_id"), F.col("raw_name").alias("business_name"), F.col("raw_addr").alias("business_address"), "country"), f"{data}/{split}_source{n}.tsv")
    lines = truth.groupBy("s1_id").agg(F.concat_ws("\t", "s1_id", F.array_join(F.collect_list("pool_id"), ",")).alias("value")).select("value")
    lines.write.text(f"{data}/train_ground_truth.tsv")
    cfg = linkage.Settings(universe=1.0, hidden=0.05, tab=0.25, train=0.4, val=0.25, rounds=(5, 5, 5), expand=True, blocking=B.Blocking(min_part=10, max_df=0.5))
    return run.train(spark, data, work, cfg), data, work, cfg


@pytest.fixture(scope="module")
def done(spark, world, trained):
    from tessera.shared import materialize

    model, _, _, cfg = trained
    return materialize(linkage.predict(model, world[0], world[1], cfg), "done")


def test_end_to_end(spark, world, done):
    s1, pool, truth = world
    matches = done.filter("match")
    scores = E.summary(E.entity_scores(s1.select(F.col("eid").alias("s1_id")), matches, truth)).first()
    assert scores.macro_f05 > 0.8
    assert matches.groupBy("pool_id").count().filter("count > 1").isEmpty()
    lists = IO.id_lists(s1.select(F.col("eid").alias("s1_id")), done, "s1_id", "pool_id", "match")
    assert lists.count() == 160
    known = pool.select(F.col("eid").alias("id"))
    assert E.validate(lists.select("s1_id", F.col("chosen_ids").alias("ids")), s1.select(F.col("eid").alias("s1_id")), known).isEmpty()
    found = E.ledger(s1.select(F.col("eid").alias("s1_id")), done, done, matches, truth, pool.select(F.col("eid").alias("pool_id"), "addr_empty")).first()
    assert found.oracle_after_blocking >= found.model_without_fp >= found.model and found.true_pairs == truth.count()


def test_command_line(spark, trained, done, tmp_path, capsys):
    """Prediction by the saved model from files, both lists valid, the exit status of a bad one, and single stages."""
    from tessera.plans import run

    model, data, work, cfg = trained
    out, again = str(tmp_path / "out"), linkage.load(spark, f"{work}/model")
    assert again.decision == model.decision and again.grid == model.grid
    scores = lambda df: sorted((r.s1_id, r.pool_id, round(r.pc, 9), r.match) for r in df.collect())
    assert scores(run.predict(spark, data, work, out, cfg)) == scores(done)
    assert spark.read.json(f"{out}/diagnostics.json").first().s1 == 160
    files = ["--matching", f"{out}/matching_results.tsv", "--candidates", f"{out}/candidate_pairs.tsv", "--data", data]
    assert run.main(["check", *files, "--check-ids"]) == 0 and "PASS" in capsys.readouterr().out
    assert run.main(["check", "--matching", f"{out}/candidate_pairs.tsv", "--data", data]) == 1 and "header" in capsys.readouterr().out
    run.main(["stage", "--data", data, "--work", work, "--stages", "norm,regions"])
    assert spark.read.parquet(f"{work}/train/s1_regions").count() == 160


def test_regions_of_records(spark, world):
    from tessera.operators import regions as R

    rows = {r.eid: r for r in R.add_regions(world[0], R.seed_aliases(spark)).select("eid", "a_comps", "region", "part", "a_loc2").collect()}
    assert all(r.region == r.a_comps[-1] == r.part and r.region not in r.a_loc2.split() for r in rows.values())


def test_registry_without_the_subpackage(tmp_path):
    for name in ("tessera", "__spark_entry__.py"):
        os.symlink(os.path.join(ROOT, name), tmp_path / name)
    code = "import sys; sys.modules['tessera.llm'] = None; import __spark_entry__ as e; assert e.queries() and not [q for q in e.queries() if q.startswith('op')]; assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={**os.environ, "PYTHONPATH": str(tmp_path)})
