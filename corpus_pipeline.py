"""The corpus pipeline: documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept, and
returns the columns of documents, except the last, which returns pieces of
sequences. ``run`` writes every stage's result to the shared folder, rereads it, and removes what it was made from.

Ids name documents: rows that share an id stay or go together, but for wholly equal
rows, of which exact dedup keeps one. A null id is an id too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.dedup_exact import exact_duplicates
from tessera.llm.mixing import mixture
from tessera.llm.ngram_join import jaccard_components
from tessera.llm.packing import pack
from tessera.llm.toxicity import held_out_third, score_column, train
from tessera.shared import drop_made, join_slim, made, materialize

#: No stage's rows can be stated in SQL from the first on: a trained classifier decides.
ORACLE_SQL = None
TOXIC = 0.7
_NO_ID = -(1 << 63)


def _by_id(docs: DataFrame, slim: DataFrame, how: str) -> DataFrame:
    """Joins docs with a materialized table of distinct ids (column _id); a null id joins its like."""
    keyed = docs.withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)))
    return join_slim(keyed, slim, ["_id"], how).drop("_id")


def _keep(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of docs whose id has a kept verdict. verdicts: doc_id, kept; the ids that go are fewer, so those are joined."""
    ids = verdicts.groupBy(F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id")).agg(F.max("kept").alias("kept"))
    return _by_id(docs, materialize(ids.filter("not kept").select("_id"), "gone"), "left_anti")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold."""
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out_third())
    return docs.filter(score_column(model, F.col("text")) < TOXIC)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    verdicts = materialize(exact_duplicates(docs).select("doc_id", "kept"), "verdicts")
    out = _keep(docs, verdicts)
    repeated = verdicts.groupBy("doc_id").count().filter("count > 1")
    return out if repeated.isEmpty() else out.dropDuplicates()


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each component of documents with similar five-word shingles."""
    found = jaccard_components(docs)
    return _keep(docs, found.select("doc_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept")))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; an empty one has no words to take and stays out or in by its draw."""
    copies = mixture(docs).groupBy(F.coalesce("doc_id", F.lit(_NO_ID)).alias("_id")).agg(F.max("copies").alias("_copies"))
    joined = _by_id(docs, materialize(copies.filter("_copies > 0"), "copies"), "inner")
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int")))).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard", drop_near_copies),
    ("mixing", mix),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, mark = spark.read.parquet(f"{sf_dir}/documents.parquet"), made()
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        drop_made(spark, mark)
    return STAGES[-1][1](spark, docs, sf_dir)
