"""Ranks, gaps and sums within groups, over rows that keep their keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.shared import materialize

Name = str
Names = str | list[str]


def _by(key: Names):
    return Window.partitionBy(*([key] if isinstance(key, str) else key))


def rank_gap(df: DataFrame, key: Names, score: Name, tie: Name, suffix: str) -> DataFrame:
    """Adds SCORE_rank (0 is best), SCORE_gap to the best, SCORE_best and group_size, each with the suffix."""
    w = _by(key)
    ranked = w.orderBy(F.desc(score), F.asc(tie))
    best = F.max(score).over(w)
    return df.withColumns({f"{score}_rank{suffix}": F.row_number().over(ranked) - 1, f"{score}_gap{suffix}": best - F.col(score), f"{score}_best{suffix}": best, f"group_size{suffix}": F.count(F.lit(1)).over(w)})


def second_best(key: Names, score: Name, tie: Name) -> Column:
    w = _by(key).orderBy(F.desc(score), F.asc(tie)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(F.nth_value(score, 2).over(w), F.lit(0.0))


def sum_and_count(key: Names, score: Name, least: float) -> tuple[Column, Column]:
    w = _by(key)
    return F.sum(score).over(w), F.count(F.when(F.col(score) >= least, 1)).over(w)


def others(key: Names, score: Name) -> Column:
    return F.sum(score).over(_by(key)) - F.col(score)


def relative(key: Names, score: Name) -> Column:
    best = F.max(score).over(_by(key))
    return F.when(best > 0, F.col(score) / F.greatest(best, F.lit(1e-6))).otherwise(0.0)


def running_sum(key: Names, value: Name, order: list[Column]) -> Column:
    return F.sum(value).over(_by(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))


def top(df: DataFrame, key: list[Name], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each key: row_number with a bound, which is applied before the shuffle too."""
    return df.withColumn("_rank", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).filter(F.col("_rank") <= k).drop("_rank")


def best_claimants(df: DataFrame, pool: Name, entity: Name, p: Name, available: Column) -> DataFrame:
    """Available rows whose entity has the highest p for their pool record, ties to the least entity."""
    return top(df.filter(available), [pool], [F.desc(p), F.asc(entity)], 1)


def best_made(pairs: Callable[[DataFrame], DataFrame], pools: DataFrame, pool: list[Name], entity: Name, p: Name) -> DataFrame:
    """pool, entity, p, second: best_claimants and the next p (0 without one), for pairs that are many times their records. pairs(pools)
    makes the pairs of pool records, further columns of theirs kept; they are made twice and summed where they are made, never sorted or shuffled."""
    best = materialize(pairs(pools).groupBy(*pool).agg(F.max(p).alias("_best")), "bests")
    is_best = F.col(p) == F.col("_best")
    sums = pairs(pools.join(best, pool)).groupBy(*pool, "_best").agg(F.min(F.when(is_best, F.col(entity))).alias(entity), F.count(F.when(is_best, 1)).alias("_n"), F.max(F.when(~is_best, F.col(p))).alias("_next"))
    second = F.when(F.col("_n") > 1, F.col("_best")).otherwise(F.coalesce("_next", F.lit(0.0)))
    return materialize(sums.select(*pool, entity, F.col("_best").alias(p), second.alias("second")), "claimants")


def lists_with_tail(df: DataFrame, key: Name, score: Name, item: Name, most: int) -> DataFrame:
    """Per key the items of the most best rows in order, and the score mass of the others."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(score), F.asc(item))))
    kept = F.array_sort(F.collect_list(F.when(F.col("_rank") <= most, F.struct("_rank", item))))
    return ranked.groupBy(key).agg(F.transform(kept, lambda x: x[item]).alias("items"), F.coalesce(F.sum(F.when(F.col("_rank") > most, F.col(score))), F.lit(0.0)).alias("tail"))


def prune(df: DataFrame, entity: Name, pool: Name, p: Name, tau: float = 0.002, keep_top: int = 3, cap: int = 40) -> DataFrame:
    """Rows of at least tau or among the keep_top best of their entity, cap at most."""
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(entity).orderBy(F.desc(p), F.asc(pool))) - 1)
    return ranked.filter(((F.col(p) >= tau) | (F.col("_rank") < keep_top)) & (F.col("_rank") < cap)).drop("_rank")


def majority(df: DataFrame, key: Name, value: Name, least: int, purity: float) -> DataFrame:
    """Per key its most frequent value (ties to the least), where the key is frequent and the value pure enough: key, value, share, total."""
    counts = df.groupBy(key, value).agg(F.count("*").alias("n"))
    best = counts.groupBy(key).agg(F.min(F.struct((-F.col("n")).alias("n"), F.col(value).alias("v"))).alias("b"), F.sum("n").alias("total"))
    out = best.select(key, F.col("b.v").alias(value), (-F.col("b.n") / F.col("total")).alias("share"), "total")
    return out.filter((F.col("total") >= least) & (F.col("share") >= purity))


def smoothed_rates(df: DataFrame, key: Name, y: Name, prior: float, alpha: float = 20.0, least: int = 5) -> DataFrame:
    """(positives + alpha prior) / (n + alpha) of every key with enough rows: key, rate."""
    return smoothed_counts(df.groupBy(key).agg(F.sum(y).alias("m"), F.count("*").alias("n")), key, prior, alpha, least)


def smoothed_counts(counts: DataFrame, key: Name, prior: float, alpha: float = 20.0, least: int = 5) -> DataFrame:
    """The same of keys whose positives m and rows n are counted already."""
    return counts.filter(F.col("n") >= least).select(key, ((F.col("m") + alpha * prior) / (F.col("n") + alpha)).alias("rate"))
