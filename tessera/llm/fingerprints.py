"""Document fingerprints by consistent weighted sampling, in DataFrame functions only.

A document is a multiset of words (runs of other characters than ASCII white
space; an empty text is one empty word). For each of ``SAMPLES`` independent
samples k, every term S with weight w draws r, c ~ Gamma(2, 1) and b ~ U(0, 1) from
hashes of (term, k), then
    t = floor(ln w / r + b),  ln a = ln c - r (t - b) - r,
and the sample is the (term, t) with the least a. Two documents agree in a sample
with probability sum(min weights) / sum(max weights), the generalised Jaccard
similarity, so the share of equal samples estimates it with a standard deviation
of at most 0.5 / sqrt(SAMPLES).

ln a, which tells t apart, and a code of the term are packed in one long, so that a
sample is a plain min() in a hash aggregation. The fingerprint has four hex digits a sample.

``edited_likeness`` needs each row's successor in descending id order. Rows are
dealt by bucket of the id range (quantiles, then linear steps), and the first row
of every bucket is dealt to the bucket above as well, as the successor of its last
row; texts move once. Everything after that is grouped by bucket first and moves no more.

Nulls: a null text is empty; null ids count as lowest. Repeated ids are ordered by
their texts' hashes; equal rows are fingerprinted separately. Other columns are ignored.
An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Samples of a fingerprint. Two signatures of 48 and their keys stay within the 100 columns of whole-stage code.
SAMPLES = 48
#: Most buckets of ids: their first ids are broadcast, 16 bytes each.
MOST_BUCKETS = 200_000
QUANTILES = 100
WHITE = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    return F.split(F.btrim(text, F.lit(WHITE)), r"[\x20\x09-\x0D]+")


def _uniforms(h: Column) -> tuple[Column, Column]:
    """Two numbers in (0, 1) from the halves of a 64-bit hash."""
    scale = float(1 << 32)
    return ((F.shiftrightunsigned(h, 32) + F.lit(0.5)) / scale, (h.bitwiseAND(F.lit(0xFFFFFFFF)) + F.lit(0.5)) / scale)


def sample(k: int, term: Column, log_weight: Column) -> Column:
    """The packed sample number k of a term with this weight. The draws depend on term and
    k alone and are spelled out here, not selected first, so that code generation shares them
    between sides and compiles each sample as a method of its own."""
    (u1, u2), (u3, u4) = _uniforms(F.xxhash64(term, F.lit(2 * k))), _uniforms(F.xxhash64(term, F.lit(2 * k + 1)))
    h = F.xxhash64(term, F.lit(-k - 1))
    r, b = -F.log(u1 * u2), (F.shiftrightunsigned(h, 24) + F.lit(0.5)) / float(1 << 40)
    # ln a = ln c - r (t - b) - r, without t: the same for all weights.
    base = F.log(-F.log(u3 * u4)) + r * b - r
    log_a = base - r * F.floor(log_weight / r + b)
    return F.shiftleft(((log_a + 128.0) * float(1 << 31)).cast("long"), 24).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFF)))


def _signature(columns: list[Column]) -> Column:
    return F.lower(F.concat(*[F.lpad(F.hex(F.xxhash64(c).bitwiseAND(F.lit(0xFFFF))), 4, "0") for c in columns]))


def likeness(a: str, b: str, samples: int) -> Column:
    """Share of equal samples of two fingerprint columns."""
    same = [(F.substring(a, 4 * k + 1, 4) == F.substring(b, 4 * k + 1, 4)).cast("int") for k in range(samples)]
    return reduce(lambda x, y: x + y, same) / float(samples)


def _sampled(exploded: DataFrame, keys: list[str], sides: int, samples: int) -> DataFrame:
    """exploded: keys, term (64-bit hash), side. One row per key with fingerprint columns f0, f1 ..."""
    counted = exploded.groupBy(*keys, "term").agg(*[F.count(F.when(F.col("side") == s, 1)).alias(f"n{s}") for s in range(sides)])
    drawn = counted.select(*keys, *[F.when(F.col(f"n{s}") > 0, F.log(F.col(f"n{s}").cast("double"))).alias(f"w{s}") for s in range(sides)], "term")
    least = drawn.groupBy(*keys).agg(*[F.min(sample(k, F.col("term"), F.col(f"w{s}"))).alias(f"v{s}_{k}") for s in range(sides) for k in range(samples)])
    return least.select(*keys, *[_signature([F.col(f"v{s}_{k}") for k in range(samples)]).alias(f"f{s}") for s in range(sides)])


def fingerprints(docs: DataFrame, samples: int = SAMPLES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, fingerprint; one row per distinct (id, text)."""
    slim = docs.select(F.col(id_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).withColumn("key", F.xxhash64("text"))
    exploded = slim.select(id_col, "key", F.lit(0).alias("side"), F.explode(words(F.col("text"))).alias("word")).select(id_col, "key", "side", F.xxhash64("word").alias("term"))
    return _sampled(exploded, [id_col, "key"], 1, samples).select(id_col, F.col("f0").alias("fingerprint"))


def _bucketed(slim: DataFrame, rows_each: int) -> tuple[Column, int]:
    """A column that maps k to buckets of about rows_each rows, rising with k; and the number of buckets."""
    marks = [i / QUANTILES for i in range(QUANTILES + 1)]
    n, bounds = slim.agg(F.count("*"), F.percentile_approx("k", marks, 10_000)).first()
    bounds = sorted(set(bounds or [0]))
    steps = max(1, min(MOST_BUCKETS, n // rows_each) // max(1, len(bounds) - 1))
    if len(bounds) < 2:
        return F.lit(0).cast("long"), 1
    lits = F.array(*[F.lit(b).cast("long") for b in bounds])
    at = F.greatest(F.lit(1), F.least(F.lit(len(bounds) - 1), F.size(F.filter(lits, lambda b: b <= F.col("k")))))
    low, high = F.element_at(lits, at), F.element_at(lits, at + 1)
    within = F.floor((F.col("k").cast("double") - low) / (high.cast("double") - low) * steps)
    return (at * steps + F.greatest(F.lit(0), F.least(F.lit(steps - 1), within))).cast("long"), steps * (len(bounds) - 1)


def edited_likeness(docs: DataFrame, samples: int = SAMPLES, rows_each: int = 500, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    none = F.lit(-(1 << 63)).cast("long")
    slim = docs.select(F.coalesce(F.col(id_col).cast("long"), none).alias("k"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    bucket, _ = _bucketed(slim.select("k"), rows_each)
    heads = slim.select("k", bucket.alias("bucket")).groupBy("bucket").agg(F.max("k").alias("k"))
    # At most MOST_BUCKETS rows. Each bucket's highest row also ends the bucket above; that of the top bucket ends the lowest.
    above = F.coalesce(F.lead("bucket").over(Window.orderBy("bucket")), F.min("bucket").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    heads = heads.select("k", above.alias("above"))
    rows = slim.withColumn("bucket", bucket).join(F.broadcast(heads), "k", "left")
    own = F.struct(F.col("bucket"), F.lit(0).alias("guard"))
    dealt = F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, F.struct(F.col("above").alias("bucket"), F.lit(1).alias("guard"))))
    rows = rows.select("k", "text", F.explode(dealt).alias("to")).select("k", "text", "to.bucket", "to.guard")
    order = Window.partitionBy("bucket").orderBy("guard", F.desc("k"), F.xxhash64("text"))
    rows = rows.select("bucket", "k", "guard", "text", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("row"))
    edited = F.concat(F.expr("substr(text, 1, length(text) - cast(floor(length(text) / 2) as int))"), F.expr("substr(next, 1, cast(floor(length(text) / 2) as int))"))
    rows = rows.withColumn("edited", F.when(F.col("guard") == 0, edited))
    both = F.array(F.struct(F.lit(0).alias("side"), words(F.col("text")).alias("words")), F.struct(F.lit(1).alias("side"), words(F.col("edited")).alias("words")))
    exploded = rows.select("bucket", "row", F.explode(both).alias("x")).select("bucket", "row", "x.side", F.explode("x.words").alias("word"))
    exploded = exploded.select("bucket", "row", "side", F.xxhash64("word").alias("term"))
    found = _sampled(exploded, ["bucket", "row"], 2, samples)
    found = found.withColumn("f2", F.lead("f0").over(Window.partitionBy("bucket").orderBy("row")))
    found = found.select("bucket", "row", F.col("f0").alias("fingerprint"), F.col("f1").alias("edited_fingerprint"), likeness("f0", "f1", samples).alias("near_edited"), likeness("f0", "f2", samples).alias("near_next"))
    # The same columns as above, so that both branches read one shuffle.
    about = rows.filter("guard = 0").select("bucket", "row", F.when(F.col("k") != none, F.col("k")).alias("doc_id"), F.length("text").cast("long").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"))
    return about.join(found, ["bucket", "row"]).select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
