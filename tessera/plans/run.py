"""The command line: train, predict, stage and check on folders of tab-separated files.

    python -m tessera.plans.run train --data DIR --work DIR
    python -m tessera.plans.run predict --data DIR --work DIR --out DIR
    python -m tessera.plans.run stage --data DIR --work DIR --stages norm,block
    python -m tessera.plans.run check --matching FILE --candidates FILE --data DIR [--check-ids]

DIR holds SPLIT_source1.tsv to SPLIT_source3.tsv (SPLIT train or test) and train_ground_truth.tsv. Finished stages
under the work folder are not made again unless --force is given.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import blocking as B
from tessera.operators import evaluate as E
from tessera.operators import regions as R
from tessera.plans import linkage
from tessera.sources import tables as IO


def norm(spark: SparkSession, data: str, work: str, split: str, force: bool = False) -> tuple[DataFrame, DataFrame]:
    """Normalised S1 (with pos, its order in the file) and pool of a split."""
    raw = lambda n: IO.read_tsv(spark, f"{data}/{split}_source{n}.tsv", position="pos")
    made = {"s1": IO.normalised(raw(1), 1).join(raw(1).select(F.col("entity_id").alias("eid"), "pos"), "eid"), "pool": IO.pool_of(raw(2), raw(3))}
    return tuple(IO.stage(df, f"{work}/{split}/norm_{name}", force=force) for name, df in made.items())


def train(spark: SparkSession, data: str, work: str, cfg: linkage.Settings, force: bool = False) -> linkage.Model:
    s1, pool = norm(spark, data, work, "train", force)
    truth = IO.read_truth(spark, f"{data}/train_ground_truth.tsv").select(F.col("entity").alias("s1_id"), F.col("pool").alias("pool_id"))
    model = linkage.fit(s1.drop("pos"), pool, truth, cfg, f"{work}/train", force)
    linkage.save(model, f"{work}/model")
    return model


def predict(spark: SparkSession, data: str, work: str, out: str, cfg: linkage.Settings, force: bool = False) -> DataFrame:
    """Writes both result lists and the diagnostics of every country under out; returns the scored pairs."""
    s1, pool = norm(spark, data, work, "test", force)
    done = linkage.predict(linkage.load(spark, f"{work}/model"), s1.drop("pos"), pool, cfg, f"{work}/test", force)
    sources = pool.select("country", F.col("eid").alias("pool_id"), "src")
    rows = done.join(sources, ["country", "pool_id"]).withColumn("place", F.struct("src", "pool_id"))
    entities = s1.select("country", F.col("eid").alias("s1_id"), "pos")
    IO.write_lists(IO.id_lists(entities, rows, "s1_id", "pool_id", "match", "place"), out, "s1_id", "pos")
    E.diagnostics(entities, sources, done).coalesce(1).write.mode("overwrite").json(f"{out}/diagnostics.json")
    return done


def stage(spark: SparkSession, data: str, work: str, names: list[str], cfg: linkage.Settings, split: str = "train", force: bool = False) -> None:
    """Single stages: norm, regions, block."""
    s1, pool = norm(spark, data, work, split, force and "norm" in names)
    if {"regions", "block"} & set(names):
        keep = linkage.keeper(f"{work}/{split}", force)
        one, two = (keep(R.add_regions(df, R.seed_aliases(spark)), name) for df, name in ((s1.drop("pos"), "s1 regions"), (pool, "pool regions")))
        if "block" in names:
            keep(B.block(one, two, cfg.blocking), "seed candidates")


def check(spark: SparkSession, matching: str, candidates: str | None, data: str, check_ids: bool = False) -> tuple[int, str]:
    """Exit status and report on result lists against the entities of a split."""
    warnings, parts = [], []
    required = IO.read_ids(spark, f"{data}/test_source1.tsv").withColumnRenamed("id", "s1_id")
    known = IO.read_ids(spark, f"{data}/test_source2.tsv").unionByName(IO.read_ids(spark, f"{data}/test_source3.tsv")) if check_ids else None
    if not check_ids:
        warnings.append("ids of matches are not looked up in the sources")
    lists = {}
    for name, path, header in (("matches", matching, "source1_entity_id\tmatched_entity_ids"), ("candidates", candidates, "source1_entity_id\tcandidate_entity_ids")):
        if path is None:
            warnings.append(f"no {name}: their checks are left out")
            continue
        parts.append(E.check_lines(spark.read.text(path), header).withColumn("id", F.lit("")))
        lists[name] = IO.read_lists(spark, path)
        parts.append(E.validate(lists[name], required, known))
    if len(lists) == 2:
        parts.append(E.not_candidates(lists["matches"], lists["candidates"]).select(F.lit("match that is no candidate").alias("problem"), F.col("s1_id").alias("id"), F.size("ids").alias("count")))
    problems = parts[0].select("problem", "id", "count")
    for part in parts[1:]:
        problems = problems.unionByName(part.select("problem", "id", "count"))
    return E.report(problems, tuple(warnings))


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="tessera.plans.run")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("train", "predict", "stage"):
        p = commands.add_parser(name)
        p.add_argument("--data", required=True)
        p.add_argument("--work", required=True)
        p.add_argument("--force", action="store_true")
        p.add_argument("--min-part", type=int, default=B.Blocking.min_part)
        p.add_argument("--max-df", type=float, default=B.Blocking.max_df)
        p.add_argument("--universe", type=float, default=linkage.Settings.universe)
        p.add_argument("--expand", action="store_true")
    commands.choices["predict"].add_argument("--out", required=True)
    commands.choices["stage"].add_argument("--stages", default="norm")
    commands.choices["stage"].add_argument("--split", default="train")
    p = commands.add_parser("check")
    p.add_argument("--matching", required=True)
    p.add_argument("--candidates")
    p.add_argument("--data", required=True)
    p.add_argument("--check-ids", action="store_true")
    a = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("tessera").getOrCreate()
    if a.command == "check":
        status, text = check(spark, a.matching, a.candidates, a.data, a.check_ids)
        print(text)
        return status
    cfg = linkage.Settings(universe=a.universe, expand=a.expand, blocking=B.Blocking(min_part=a.min_part, max_df=a.max_df))
    if a.command == "train":
        train(spark, a.data, a.work, cfg, a.force)
    elif a.command == "predict":
        predict(spark, a.data, a.work, a.out, cfg, a.force)
    else:
        stage(spark, a.data, a.work, a.stages.split(","), cfg, a.split, a.force)
    return 0


if __name__ == "__main__":
    sys.exit(main())
