"""Mixing sources to target weights by systematic sampling.

Every document of a source has the same expected number of copies, target over
source size. Documents are laid end to end within their source, ordered by size,
and the running sum of expected copies plus one random offset per source (a hash
of seed and source) crosses an integer boundary once per copy to emit. The order
by size makes each stretch of like-sized documents contribute its share, so the
words taken stay within about one document of the target.

The running sum needs each document's rank in its source: rows (without texts)
are range-partitioned by (source, size, id hash), numbered inside each partition,
and shifted by the counts of the partitions before. A source of any size is
spread over as many partitions as its rows need, and sources may be any number: their order and
targets are found in Spark too.

Nulls: a null text has size 0; a null source is a source of its own, last. A
source of size 0 has target 0 and nothing is taken of it. Repeated rows are
separate documents; ties in size go by a hash of the id, then the id. A text of any length counts whole. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.shared import BROADCAST_ROWS, materialize, parts_for, ranked

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text) -> F.Column:
    """Number of maximal runs of other characters than ASCII white space."""
    return F.regexp_count(F.coalesce(text.cast("string"), F.lit("")), F.lit(WORD)).cast("long")


def with_targets(sources: DataFrame, share: float, most: float) -> DataFrame:
    """sources (size, weight and other columns) with target: share of the sum of sizes dealt by weight; what exceeds
    ``most`` times a size is dealt again by weight. The level of the rest rises round by round until no further source
    is full; a round is one aggregate, and the driver sees four numbers whatever the number of sources."""
    total, weights = sources.filter("size > 0").agg(F.sum("size"), F.sum("weight")).first()
    if not total:
        return sources.withColumn("target", F.lit(0.0))
    cap, level, full = F.lit(float(most)) * F.col("size"), share * total / weights, -1
    while True:
        over = F.col("weight") * F.lit(level) > cap
        n, taken, open_ = sources.filter("size > 0").agg(F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, cap)), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0))).first()
        if n == full or not open_:
            return sources.withColumn("target", F.when(F.col("size") > 0, F.least(F.col("weight") * F.lit(level), cap)).otherwise(0.0))
        full, level = n, (share * total - taken) / open_


def mixture(docs: DataFrame, weights: tuple = (3.0, 1.0, 2.0), share: float = 1.5, most: float = 2.0, seed: int = 17, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken.
    weights repeat over the sources in code-point order, null last."""
    spark = docs.sparkSession
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), word_count(F.col(text_col)).alias("size"))
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_for(docs, 64 << 20))
    # Written first: range partitioning reads its input twice, and texts should be read once.
    keyed = materialize(slim, "sizes")
    order = [F.col("size").asc(), F.xxhash64(F.lit(seed), "doc_id").asc(), F.col("doc_id").asc_nulls_last()]
    rows = ranked(keyed, ["source"], order, n).drop("total")
    sizes = materialize(keyed.groupBy("source").agg(F.sum("size").alias("size")), "sources")
    # Spark orders strings by their UTF-8 bytes, which is code-point order.
    numbered = ranked(sizes.withColumn("_all", F.lit(1)), ["_all"], [F.col("source").asc_nulls_last()], 8).drop("_all", "total")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.col("rank") - 1, F.lit(len(weights))).cast("int"))
    plan = materialize(with_targets(materialize(numbered.withColumn("weight", weight), "weights"), share, most), "plan")
    plan = plan.select(F.col("source").alias("_source"), F.col("size").alias("source_size"), "target")
    small = plan.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rows = rows.join(F.broadcast(plan) if small else plan, F.col("source").eqNullSafe(F.col("_source")))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    offset = F.pmod(F.xxhash64(F.lit(seed + 1), F.coalesce("source", F.lit("\0null"))), F.lit(1 << 30)) / float(1 << 30)
    copies = F.floor(F.col("rank") * rate + offset) - F.floor((F.col("rank") - 1) * rate + offset)
    copies = F.least(copies, F.lit(int(-(-most // 1)))).cast("long")
    return rows.select("doc_id", "source", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))
