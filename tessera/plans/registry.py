"""Queries over the test tables, one or more per operator, and SQL that gives the same rows.

Documents serve as business records (``records``): the id's residue gives the
source, lang the country, the first 96 characters the name, its first letter the partition.
Numbers that are sums of floats are rounded to six places on both sides.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions import sets as S
from tessera.functions import text as T
from tessera.functions.similarity import similarities, similarity
from tessera.operators import blocking as B
from tessera.operators import decide as D
from tessera.operators import evaluate as E
from tessera.operators import features as X
from tessera.operators import grams as G
from tessera.operators import grouping as W
from tessera.operators import learning as L
from tessera.operators import regions as R
from tessera.plans import linkage
from tessera.shared import materialize, new_path
from tessera.sources import tables as IO

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a query under its function's name, with SQL where it has some. In SQL, {records} and the like are named subqueries."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = "WITH " + RECORDS + sql
        return f

    return add


RECORDS = f"""r AS (SELECT doc_id AS id, CASE WHEN doc_id % 4 = 0 THEN 1 ELSE 2 + doc_id % 2 END AS src, lang AS country, substr(trim(regexp_replace(translate(lower(substr(coalesce(text, ''), 1, 96)), '{T.ACCENTED}', '{T.PLAIN}'), '[^a-z0-9]+', ' ', 'g')), 1, 1) AS part,
    trim(regexp_replace(translate(lower(substr(coalesce(text, ''), 1, 96)), '{T.ACCENTED}', '{T.PLAIN}'), '[^a-z0-9]+', ' ', 'g')) AS name FROM documents) """
#: Pairs of both sides that share a word of five letters or more, words within caps: what blocking would offer.
PAIRS = """, kw AS (SELECT DISTINCT country, id, src, t FROM (SELECT country, id, src, unnest(string_split(name, ' ')) AS t FROM r) WHERE length(t) >= 5),
    kc AS (SELECT country, t FROM kw GROUP BY ALL HAVING count(*) FILTER (src = 1) BETWEEN 1 AND 30 AND count(*) FILTER (src > 1) BETWEEN 1 AND 60),
    kp AS (SELECT DISTINCT country, a.id AS s1_id, b.id AS pool_id FROM kw a JOIN kc USING (country, t) JOIN kw b USING (country, t) WHERE a.src = 1 AND b.src > 1),
    p AS (SELECT kp.country, s1_id, pool_id, list_distinct(list_filter(string_split(a.name, ' '), lambda x: x <> '')) AS ta, list_distinct(list_filter(string_split(b.name, ' '), lambda x: x <> '')) AS tb, a.name AS na, b.name AS nb FROM kp JOIN r a ON a.id = s1_id JOIN r b ON b.id = pool_id) """
SCORED = ", c AS (SELECT l_orderkey AS s1_id, l_partkey AS pool_id, max(l_discount) * 10 AS p, max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS y FROM lineitem GROUP BY ALL) "


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    src = F.when(F.col("doc_id") % 4 == 0, 1).otherwise((2 + F.col("doc_id") % 2).cast("int"))
    return d.select(F.col("doc_id").alias("id"), src.alias("src"), F.col("lang").alias("country"), T.simple_name(F.col("text")).alias("name")).withColumn("part", F.substring("name", 1, 1)).select("id", "src", "country", "part", "name")


def keyed(r: DataFrame) -> DataFrame:
    """country, id, src, t: the distinct words of five letters or more."""
    return r.select("country", "id", "src", F.explode(F.array_distinct(T.tokens(F.col("name")))).alias("t")).filter(F.length("t") >= 5)


def pairs(spark: SparkSession, sf_dir: str, most: tuple = (30, 60)) -> DataFrame:
    """S1 and pool records of a country that share a word within the caps, with their names and words."""
    r = records(spark, sf_dir)
    words = F.array_distinct(T.tokens(F.col("name")))
    k = keyed(r)
    side = lambda c, n: k.filter(c).select("country", "t", F.col("id").alias(n))
    found = B.capped_join(side("src = 1", "s1_id"), side("src > 1", "pool_id"), ["country", "t"], F.lit(most[0]), F.lit(most[1])).select("country", "s1_id", "pool_id").distinct()
    a = r.filter("src = 1").select("country", F.col("id").alias("s1_id"), words.alias("ta"), F.col("name").alias("na"))
    b = r.filter("src > 1").select("country", F.col("id").alias("pool_id"), words.alias("tb"), F.col("name").alias("nb"))
    return found.join(a, ["country", "s1_id"]).join(b, ["country", "pool_id"])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as scored pairs: orders as entities, parts as pool records."""
    rows = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("s1_id"), F.col("l_partkey").alias("pool_id"))
    return rows.agg((F.max("l_discount") * 10).alias("p"), F.max((F.col("l_returnflag") == "R").cast("int")).alias("y"))


def r6(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({n: F.round(F.col(n).cast("double"), 6) for n in names})


# Projections and text functions


@query("SELECT id, src, country, part, name FROM r")
def record_view(spark, sf_dir):
    return records(spark, sf_dir)


@query("SELECT id, array_to_string(list_filter(list_transform(range(1, len(t) + 1), lambda i: CASE WHEN i = 1 OR t[i] <> t[i - 1] THEN t[i] ELSE '' END), lambda x: x <> ''), ' ') AS words FROM (SELECT id, list_filter(string_split(name, ' '), lambda x: x <> '') AS t FROM r)")
def repeated_words(spark, sf_dir):
    return records(spark, sf_dir).select("id", F.array_join(T.drop_repeats(T.tokens(F.col("name"))), " ").alias("words"))


@query("SELECT id, CASE WHEN length(name) >= 8 THEN array_to_string(list_sort(string_split(name, '')), '') ELSE '' END AS letters, split_part(name, ' ', 1) AS first FROM r")
def sorted_letters(spark, sf_dir):
    return records(spark, sf_dir).select("id", T.sorted_letters(F.col("name")).alias("letters"), T.first_token(F.col("name")).alias("first"))


_SKEL = "t"
for _c in "eiy":
    _SKEL = f"replace({_SKEL}, 'c{_c}', 's{_c}')"
for _a, _b in [("tion", "sn"), ("sion", "sn"), ("ph", "f"), ("x", "ks"), ("q", "k"), ("ck", "k"), ("sh", "s"), ("ch", "k"), ("th", "t"), ("kh", "k"), ("bh", "b"), ("dh", "d"), ("gh", "j"), ("g", "j"), ("z", "s"), ("w", "v"), ("c", "k")]:
    _SKEL = f"replace({_SKEL}, '{_a}', '{_b}')"


@query(f", w AS (SELECT DISTINCT t, string_split(regexp_replace({_SKEL}, '[aeiouyh]', '', 'g'), '') AS k FROM (SELECT unnest(string_split(name, ' ')) AS t FROM r) WHERE t <> '') SELECT t AS word, CASE WHEN length(t) < 3 OR regexp_full_match(t, '[0-9]+') THEN t ELSE coalesce(array_to_string(list_filter(list_transform(range(1, len(k) + 1), lambda i: CASE WHEN i = 1 OR k[i] <> k[i - 1] THEN k[i] ELSE '' END), lambda x: x <> ''), ''), '') END AS skel FROM w")
def skeletons(spark, sf_dir):
    words = records(spark, sf_dir).select(F.explode(T.tokens(F.col("name"))).alias("word")).distinct()
    return words.select("word", T.skeleton(F.col("word")).alias("skel"))


@query(", w AS (SELECT p_partkey AS id, lower(replace(replace(p_name, 'o', '0'), ' ', '')) AS t FROM part) SELECT id, t AS token, CASE WHEN regexp_full_match(t, '[a-z0-9$@]{3,}') AND regexp_matches(t, '[a-z]{2}') AND regexp_matches(t, '[0-9$@]') AND length(regexp_replace(t, '[^013456789$@]', '', 'g')) <= 2 AND length(regexp_replace(t, '[^013456789$@]', '', 'g')) < length(t) - 1 THEN translate(t, '013456789$@', 'oleasgtbgsa') ELSE t END AS plain FROM w")
def leet_digits(spark, sf_dir):
    t = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.lower(F.replace(F.replace("p_name", F.lit("o"), F.lit("0")), F.lit(" "), F.lit(""))).alias("token"))
    return t.withColumn("plain", T.unleet(F.col("token")))


@query("SELECT n_nationkey AS id, CASE x WHEN 'united states' THEN 'us' ELSE x END AS country FROM (SELECT n_nationkey, trim(regexp_replace(trim(lower(n_name)), '[^a-z ]', '', 'g')) AS x FROM nation)")
def country_names(spark, sf_dir):
    return table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), T.country(F.col("n_name")).alias("country"))


@query()
def parsed_records(spark, sf_dir):
    """All name and address views; composed parsers have no SQL, their cases are in tests."""
    return linkage_records(spark, sf_dir).select("eid", "country", "n_name", "n_core2", "n_skel", "n_legal", "a_hn", "a_street", "a_loc", "a_nums", "a_ncomp", "addr_empty")


# Sets, numbers and similarities


@query(PAIRS + "SELECT s1_id, pool_id, len(list_intersect(ta, tb)) AS inter, len(ta) AS na, len(tb) AS nb, len(tb) - len(list_intersect(ta, tb)) AS extra, len(ta) - len(list_intersect(ta, tb)) AS missing, round(CASE WHEN len(ta) + len(tb) > len(list_intersect(ta, tb)) THEN len(list_intersect(ta, tb)) / (len(ta) + len(tb) - len(list_intersect(ta, tb)))::DOUBLE ELSE 0 END, 6) AS jacc, round(CASE WHEN least(len(ta), len(tb)) > 0 THEN len(list_intersect(ta, tb)) / least(len(ta), len(tb))::DOUBLE ELSE 0 END, 6) AS overlap FROM p")
def set_statistics(spark, sf_dir):
    stats = S.set_stats(F.col("ta"), F.col("tb"))
    return r6(pairs(spark, sf_dir).select("s1_id", "pool_id", *[c.alias(n) for n, c in stats.items()]), "jacc", "overlap")


_NUM = ", n AS (SELECT l_orderkey AS o, l_linenumber AS l, CAST(l_partkey AS VARCHAR) AS a, CAST(l_suppkey * CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 10 END AS VARCHAR) AS b, [CAST(l_partkey AS VARCHAR), CAST(l_linenumber AS VARCHAR)] AS ra, [CAST(l_suppkey * CASE WHEN l_linenumber % 2 = 0 THEN 1 ELSE 10 END AS VARCHAR), CAST(l_suppkey AS VARCHAR)] AS rb FROM lineitem), m AS (SELECT *, a = b AS eq, a <> b AND ((starts_with(a, b) AND length(a) = length(b) + 1) OR (starts_with(b, a) AND length(b) = length(a) + 1)) AS pre, len(list_intersect(ra, rb)) AS it, len(list_distinct(ra || rb)) AS un, list_contains(rb, a) OR list_contains(ra, b) AS sb FROM n) "


@query(_NUM + "SELECT o, l, 1 AS hn_both, eq::INT AS hn_eq, pre::INT AS hn_prefix, sb::INT AS hn_sub, it AS hn_runs_inter, round(it / greatest(1, un)::DOUBLE, 6) AS hn_runs_jacc, CASE WHEN NOT eq AND length(a) = length(b) THEN least(abs(a::BIGINT - b::BIGINT), 10000) ELSE -1 END AS hn_absdiff, 0 AS hn_one_missing, (it = 0 AND NOT pre)::INT AS hn_conflict, (sb AND NOT eq)::INT AS flag_sub, (NOT eq AND NOT pre AND NOT sb)::INT AS flag_conflict FROM m")
def number_relations(spark, sf_dir):
    text = lambda c: c.cast("string")
    b = F.col("l_suppkey") * F.when(F.col("l_linenumber") % 2 == 0, 1).otherwise(10)
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o"), F.col("l_linenumber").alias("l"), text(F.col("l_partkey")).alias("a"), text(b).alias("b"), F.array(text(F.col("l_partkey")), text(F.col("l_linenumber"))).alias("ra"), F.array(text(b), text(F.col("l_suppkey"))).alias("rb"))
    cols = [F.col(c) for c in ("a", "b", "ra", "rb")]
    flags = S.number_flags(*cols)
    return r6(rows.select("o", "l", *[c.alias(n) for n, c in S.number_relations(*cols).items()], flags["hn_sub"].alias("flag_sub"), flags["hn_conflict"].alias("flag_conflict")), "hn_runs_jacc")


@query(", q AS (SELECT a.id, replace(a.name, ' ', '') AS w, split_part(b.name, ' ', 1) AS d FROM r a JOIN r b ON b.id = a.id + 1), l AS (SELECT id, w, d, unnest(list_distinct(string_split(d, ''))) AS c FROM q WHERE d <> '') SELECT id, round(sum(least(length(d) - length(replace(d, c, '')), length(w) - length(replace(w, c, '')))) / any_value(length(d))::DOUBLE, 6) AS cover FROM l GROUP BY id")
def letter_cover(spark, sf_dir):
    r = records(spark, sf_dir)
    b = r.select((F.col("id") - 1).alias("id"), T.first_token(F.col("name")).alias("d"))
    rows = r.select("id", F.replace("name", F.lit(" "), F.lit("")).alias("w")).join(b, "id").filter("d <> ''")
    return r6(rows.select("id", S.letter_cover(F.col("d"), F.col("w")).alias("cover")), "cover")


@query(PAIRS + "SELECT s1_id, pool_id, round(jaro_winkler_similarity(na, nb), 6) AS jw FROM p WHERE na <> '' AND nb <> ''")
def jaro_winkler(spark, sf_dir):
    rows = pairs(spark, sf_dir).filter("na <> '' and nb <> ''")
    return r6(rows.select("s1_id", "pool_id", similarity("jaro_winkler", F.col("na"), F.col("nb")).alias("jw")), "jw")


@query()
def text_similarities(spark, sf_dir):
    """Indel and token scores of all pairs; tests hold them against a plain dynamic programme."""
    rows = pairs(spark, sf_dir)
    names = ("ratio", "token_sort_ratio", "token_set_ratio", "partial_ratio", "partial_token_set_ratio", "indel")
    return rows.select("s1_id", "pool_id", similarities(names, F.col("na"), F.col("nb")).alias("_s")).select("s1_id", "pool_id", "_s.*")


# Grams and joins

_GRAMS = ", d AS (SELECT country, part, src, id, ' ' || substr(regexp_replace(name, '[^a-z0-9 ]', ' ', 'g'), 1, 96) || ' ' AS p FROM r WHERE name <> ''), g AS (SELECT country, part, src, id, gram, count(*) AS tf FROM (SELECT country, part, src, id, unnest(list_transform(range(1, length(p) - 1), lambda i: substr(p, i, 3))) AS gram FROM d) WHERE trim(gram) <> '' GROUP BY ALL), n AS (SELECT country, count(DISTINCT id) AS docs FROM g GROUP BY country), f AS (SELECT country, gram, df, ln((1 + docs) / (1 + df)::DOUBLE) + 1 AS idf FROM (SELECT country, gram, count(*) AS df FROM g GROUP BY ALL) JOIN n USING (country) WHERE df >= 2 AND df <= docs * 0.2), v0 AS (SELECT g.*, (1 + ln(tf)) * idf AS w0 FROM g JOIN f USING (country, gram)), v AS (SELECT country, part, src, id, gram, w0 / sqrt(sum(w0 * w0) OVER (PARTITION BY country, id)) AS w FROM v0) "


def _vectors(spark, sf_dir):
    # Both sides of a join read these tables; without them each would count all grams again.
    counts = materialize(G.grams(records(spark, sf_dir), ["country", "part", "src", "id"], "name"), "counts")
    table_ = materialize(G.idf(counts, ["country"], ["id"], 2, 0.2), "idf")
    return counts, table_, materialize(G.weights(counts, table_, ["country"], ["id"]), "weights")


@query(_GRAMS + "SELECT country, gram, df, round(idf, 6) AS idf FROM f")
def gram_idf(spark, sf_dir):
    return r6(_vectors(spark, sf_dir)[1], "idf")


@query(_GRAMS + "SELECT id, gram, round(w, 6) AS w FROM v")
def gram_weights(spark, sf_dir):
    return r6(_vectors(spark, sf_dir)[2].select("id", "gram", "w"), "w")


def _top_sql(left: str, right: str, on: str, k: int, least: float) -> str:
    a, b = ("s1_id", "pool_id") if left == "src = 1" else ("pool_id", "s1_id")
    return f"{_GRAMS}, s AS (SELECT a.id AS {a}, b.id AS {b}, sum(a.w * b.w) AS score FROM v a JOIN v b ON {on} AND a.gram = b.gram WHERE a.{left} AND b.{right} GROUP BY ALL HAVING sum(a.w * b.w) >= {least}) SELECT s1_id, pool_id, round(score, 6) AS score FROM s QUALIFY row_number() OVER (PARTITION BY {a} ORDER BY round(score, 9) DESC, {b}) <= {k}"


def _top(spark, sf_dir, on, k, least, reverse=False):
    v = _vectors(spark, sf_dir)[2]
    one, two = v.filter("src = 1").withColumnRenamed("id", "s1_id"), v.filter("src > 1").withColumnRenamed("id", "pool_id")
    found = G.top_cosine(two, one, on, "pool_id", "s1_id", k, least) if reverse else G.top_cosine(one, two, on, "s1_id", "pool_id", k, least)
    return r6(found.select("s1_id", "pool_id", "score"), "score")


@query(_top_sql("src = 1", "src > 1", "a.country = b.country AND a.part = b.part", 8, 0.15))
def top_cosine_partitioned(spark, sf_dir):
    return _top(spark, sf_dir, ["country", "part"], 8, 0.15)


@query(_top_sql("src = 1", "src > 1", "a.country = b.country", 8, 0.30))
def top_cosine_global(spark, sf_dir):
    return _top(spark, sf_dir, ["country"], 8, 0.30)


@query(_top_sql("src > 1", "src = 1", "a.country = b.country AND a.part = b.part", 2, 0.15))
def top_cosine_reverse(spark, sf_dir):
    return _top(spark, sf_dir, ["country", "part"], 2, 0.15, reverse=True)


@query(_GRAMS + PAIRS + "SELECT s1_id, pool_id, round(coalesce(s, 0), 6) AS score FROM kp LEFT JOIN (SELECT a.id AS s1_id, b.id AS pool_id, sum(a.w * b.w) AS s FROM v a JOIN v b ON a.country = b.country AND a.gram = b.gram AND a.src = 1 AND b.src > 1 GROUP BY ALL) USING (s1_id, pool_id)")
def pair_cosine(spark, sf_dir):
    v = _vectors(spark, sf_dir)[2]
    some = pairs(spark, sf_dir).select("country", "s1_id", "pool_id")
    found = G.pair_cosine(some, v.filter("src = 1").withColumnRenamed("id", "s1_id"), v.filter("src > 1").withColumnRenamed("id", "pool_id"), ["country"], "s1_id", "pool_id")
    return r6(found.select("s1_id", "pool_id", "score"), "score")


@query()
def top_projected(spark, sf_dir):
    """Random projections and bands: approximate candidates, exact scores; a test measures recall."""
    v = _vectors(spark, sf_dir)[2]
    return G.top_projected(v.filter("src = 1").withColumnRenamed("id", "s1_id"), v.filter("src > 1").withColumnRenamed("id", "pool_id"), ["country"], "s1_id", "pool_id", 8, 0.6)


_KEYED = ", k AS (SELECT DISTINCT country, id, src, t FROM (SELECT country, id, src, unnest(string_split(name, ' ')) AS t FROM r) WHERE length(t) >= 5) "


@query(_KEYED + ", ok AS (SELECT country, t FROM k GROUP BY ALL HAVING count(*) FILTER (src = 1) BETWEEN 1 AND 4 AND count(*) FILTER (src > 1) BETWEEN 1 AND 30) SELECT DISTINCT a.id AS s1_id, b.id AS pool_id FROM k a JOIN ok USING (country, t) JOIN k b USING (country, t) WHERE a.src = 1 AND b.src > 1")
def capped_key_join(spark, sf_dir):
    k = keyed(records(spark, sf_dir))
    side = lambda c, n: k.filter(c).select("country", "t", F.col("id").alias(n))
    return B.capped_join(side("src = 1", "s1_id"), side("src > 1", "pool_id"), ["country", "t"], F.lit(4), F.lit(30)).select("s1_id", "pool_id").distinct()


@query(PAIRS + "SELECT s1_id, pool_id, bit_or(ch) AS ch, (bit_or(ch) & 8 > 0)::INT AS by_key FROM (SELECT s1_id, pool_id, 1 AS ch FROM p WHERE len(list_intersect(ta, tb)) >= 3 UNION ALL SELECT s1_id, pool_id, 8 AS ch FROM p WHERE na = nb UNION ALL SELECT s1_id, pool_id, 16 AS ch FROM p WHERE split_part(na, ' ', 1) = split_part(nb, ' ', 1)) GROUP BY ALL")
def channel_union(spark, sf_dir):
    p, ids = pairs(spark, sf_dir), ["country", "s1_id", "pool_id"]
    parts = [p.filter(c).select(*ids, F.lit(bit).alias("ch")) for c, bit in (("size(array_intersect(ta, tb)) >= 3", B.NAME), ("na = nb", B.KEY), ("split_part(na, ' ', 1) = split_part(nb, ' ', 1)", B.REV))]
    return B.union_channels(parts).select("s1_id", "pool_id", "ch", (F.col("ch").bitwiseAND(F.lit(B.KEY)) > 0).cast("int").alias("by_key"))


@query()
def blocked_candidates(spark, sf_dir):
    """All channels over parsed records."""
    one, two = _sides(spark, sf_dir)
    return B.block(one, two, B.Blocking(min_part=5))


# Groups and windows


@query(SCORED + "SELECT s1_id, pool_id, row_number() OVER w - 1 AS p_rank1, round(max(p) OVER g - p, 6) AS p_gap1, max(p) OVER g AS p_best1, count(*) OVER g AS group_size1 FROM c WINDOW g AS (PARTITION BY s1_id), w AS (PARTITION BY s1_id ORDER BY p DESC, pool_id)")
def group_ranks(spark, sf_dir):
    return r6(W.rank_gap(scored(spark, sf_dir), "s1_id", "p", "pool_id", "1").drop("p", "y"), "p_gap1")


@query(SCORED + "SELECT s1_id, pool_id, coalesce(nth_value(p, 2) OVER w, 0) AS second, round(sum(p) OVER g, 6) AS total, count(*) FILTER (p >= 0.5) OVER g AS half, round(sum(p) OVER g - p, 6) AS others, round(CASE WHEN max(p) OVER g > 0 THEN p / greatest(max(p) OVER g, 1e-6) ELSE 0 END, 6) AS relative, round(sum(y) OVER (PARTITION BY s1_id ORDER BY p DESC, pool_id ROWS UNBOUNDED PRECEDING), 6) AS hits FROM c WINDOW g AS (PARTITION BY s1_id), w AS (PARTITION BY s1_id ORDER BY p DESC, pool_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)")
def group_statistics(spark, sf_dir):
    total, half = W.sum_and_count("s1_id", "p", 0.5)
    out = scored(spark, sf_dir).select("s1_id", "pool_id", W.second_best("s1_id", "p", "pool_id").alias("second"), total.alias("total"), half.alias("half"), W.others("s1_id", "p").alias("others"), W.relative("s1_id", "p").alias("relative"), W.running_sum("s1_id", "y", [F.desc("p"), F.asc("pool_id")]).alias("hits"))
    return r6(out, "total", "others", "relative", "hits")


@query(SCORED + "SELECT pool_id, s1_id, p FROM (SELECT pool_id, s1_id, max(p) AS p FROM c GROUP BY ALL) WHERE p >= 0.3 QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY p DESC, s1_id) = 1")
def best_claimants(spark, sf_dir):
    best = scored(spark, sf_dir).groupBy("pool_id", "s1_id").agg(F.max("p").alias("p"))
    return W.best_claimants(best, "pool_id", "s1_id", "p", F.col("p") >= 0.3)


@query(SCORED + ", k AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, pool_id) AS rn FROM c) SELECT s1_id, array_to_string(list(pool_id ORDER BY rn) FILTER (rn <= 3), ',') AS items, round(coalesce(sum(p) FILTER (rn > 3), 0), 6) AS tail FROM k GROUP BY s1_id")
def lists_with_tail(spark, sf_dir):
    out = W.lists_with_tail(scored(spark, sf_dir), "s1_id", "p", "pool_id", 3)
    return r6(out.select("s1_id", F.array_join(F.transform("items", lambda x: x.cast("string")), ",").alias("items"), "tail"), "tail")


@query(SCORED + ", k AS (SELECT *, row_number() OVER (PARTITION BY s1_id ORDER BY p DESC, pool_id) - 1 AS rk FROM c) SELECT s1_id, pool_id, p FROM k WHERE (p >= 0.8 OR rk < 2) AND rk < 3")
def pruned(spark, sf_dir):
    return W.prune(scored(spark, sf_dir), "s1_id", "pool_id", "p", 0.8, 2, 3).select("s1_id", "pool_id", "p")


@query(", k AS (SELECT l_partkey AS part, l_returnflag AS flag, count(*) AS n FROM lineitem GROUP BY ALL) SELECT part, flag, round(n / total::DOUBLE, 6) AS share, total FROM (SELECT part, flag, n, sum(n) OVER (PARTITION BY part)::BIGINT AS total FROM k) WHERE total >= 5 QUALIFY row_number() OVER (PARTITION BY part ORDER BY n DESC, flag) = 1 AND n / total::DOUBLE >= 0.5")
def majority_values(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("part"), F.col("l_returnflag").alias("flag"))
    return r6(W.majority(rows, "part", "flag", 5, 0.5), "share")


@query(SCORED + ", k AS (SELECT pool_id, sum(y) AS m, count(*) AS n FROM c GROUP BY ALL) SELECT pool_id, round((m + 20 * 0.25) / (n + 20), 6) AS rate FROM k WHERE n >= 5")
def smoothed_rates(spark, sf_dir):
    return r6(W.smoothed_rates(scored(spark, sf_dir), "pool_id", "y", 0.25), "rate")


@query(", k AS (SELECT country, name, part, src, id, split_part(name, ' ', 1) AS core FROM r) SELECT id, round(ln(1 + count(*) OVER (PARTITION BY country, core)), 6) AS amb_s1_name, round(ln(1 + count(*) OVER (PARTITION BY country, core, part)), 6) AS amb_s1_name_part FROM k WHERE src = 1")
def ambiguity(spark, sf_dir):
    r = records(spark, sf_dir).select("country", F.col("id").alias("eid"), "part", "src", T.first_token(F.col("name")).alias("n_core2"))
    one, _ = X.ambiguity(r.filter("src = 1"), r.filter("src > 1"))
    return r6(one.select(F.col("s1_id").alias("id"), "amb_s1_name", "amb_s1_name_part"), "amb_s1_name", "amb_s1_name_part")


_IDF = ", t AS (SELECT country, id, src, unnest(list_distinct(list_filter(string_split(name, ' '), lambda x: x <> ''))) AS word FROM r), nd AS (SELECT country, count(*) AS n FROM r GROUP BY country), wi AS (SELECT country, word, ln((1 + n) / (1 + count(*))::DOUBLE) AS idf FROM t JOIN nd USING (country) GROUP BY country, word, n) "


@query(PAIRS + _IDF + ", a AS (SELECT p.s1_id, p.pool_id, t.word, 1 AS side, idf FROM p JOIN t ON t.id = p.s1_id JOIN wi ON wi.country = t.country AND wi.word = t.word UNION ALL SELECT p.s1_id, p.pool_id, t.word, 2, idf FROM p JOIN t ON t.id = p.pool_id JOIN wi ON wi.country = t.country AND wi.word = t.word), b AS (SELECT s1_id, pool_id, word, sum(side) AS s, any_value(idf) AS idf FROM a GROUP BY ALL) SELECT s1_id, pool_id, round(coalesce(sum(idf) FILTER (s = 3), 0) / sum(idf), 5) AS nt_wjacc, round(coalesce(sum(idf) FILTER (s = 2), 0), 5) AS nt_wextra, round(coalesce(sum(idf) FILTER (s = 1), 0), 5) AS nt_wmissing FROM b GROUP BY s1_id, pool_id".replace("sum(side) AS s, any_value(idf) AS idf FROM a GROUP BY ALL", "sum(side) AS s, any_value(idf) AS idf FROM a GROUP BY s1_id, pool_id, word"))
def weighted_sets(spark, sf_dir):
    r = records(spark, sf_dir).select("country", F.col("id").alias("eid"), "src", F.col("name").alias("n_core2"))
    out = X.weighted_sets(pairs(spark, sf_dir), r.filter("src = 1"), r.filter("src > 1"), {"n_core2": "nt"}).drop("country")
    return out.withColumns({c: F.round(c, 5) for c in ("nt_wjacc", "nt_wextra", "nt_wmissing")})


# Regions, roles, decisions, metrics

_PLACES = ", s AS (SELECT s_suppkey AS eid, 'place ' || chr(97 + n_nationkey) AS n_name, [s_name, 'place ' || chr(97 + n_nationkey), CASE s_suppkey % 4 WHEN 0 THEN 'TX' WHEN 1 THEN 'Nevada' WHEN 2 THEN 'Town of Ohio' ELSE 'Springfield' END, CASE s_suppkey % 7 WHEN 0 THEN 'CA' ELSE 'Plaza' END] AS comps FROM supplier JOIN nation ON s_nationkey = n_nationkey) "


def _places(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    third = F.when(F.col("s_suppkey") % 4 == 0, "TX").when(F.col("s_suppkey") % 4 == 1, "Nevada").when(F.col("s_suppkey") % 4 == 2, "Town of Ohio").otherwise("Springfield")
    fourth = F.when(F.col("s_suppkey") % 7 == 0, "CA").otherwise("Plaza")
    return s.select(F.col("s_suppkey").alias("eid"), F.lit("us").alias("country"), F.array("s_name", F.concat(F.lit("place "), F.char(97 + F.col("n_nationkey"))), third, fourth).alias("a_comps"))


@query(_PLACES + "SELECT eid, 'us' AS country, CASE WHEN eid % 7 = 0 AND eid % 4 < 2 THEN '' WHEN eid % 7 = 0 THEN 'ca' WHEN eid % 4 = 0 THEN 'tx' WHEN eid % 4 = 1 THEN 'nv' WHEN eid % 4 = 2 THEN 'oh' ELSE '' END AS region, CASE WHEN eid % 7 = 0 AND eid % 4 < 2 THEN -1 WHEN eid % 7 = 0 THEN 3 WHEN eid % 4 < 3 THEN 2 ELSE -1 END AS comp_index FROM s")
def region_codes(spark, sf_dir):
    return R.assign(_places(spark, sf_dir), R.seed_aliases(spark))


@query(_PLACES + ", k AS (SELECT comps, CASE WHEN eid % 7 = 0 AND eid % 4 < 2 THEN '' WHEN eid % 7 = 0 THEN 'ca' WHEN eid % 4 = 0 THEN 'tx' WHEN eid % 4 = 1 THEN 'nv' WHEN eid % 4 = 2 THEN 'oh' ELSE '' END AS code, CASE WHEN eid % 7 = 0 THEN 4 ELSE 3 END AS at_region FROM s), u AS (SELECT code, trim(regexp_replace(lower(c), '[^a-z0-9]+', ' ', 'g')) AS key FROM (SELECT code, at_region, unnest(comps) AS c, generate_subscripts(comps, 1) AS i FROM k WHERE code <> '') WHERE i <> at_region), c AS (SELECT key, code, count(*) AS n FROM u WHERE length(key) >= 3 AND NOT regexp_matches(key, '[0-9]') AND key NOT IN ('nevada', 'ohio') GROUP BY ALL) SELECT 'us' AS country, key, code FROM (SELECT *, sum(n) OVER (PARTITION BY key) AS t FROM c) WHERE t >= 2 QUALIFY row_number() OVER (PARTITION BY key ORDER BY n DESC, code) = 1 AND n / t::DOUBLE >= 0.6")
def learned_aliases(spark, sf_dir):
    """Every alias that the components beside the region teach."""
    return R.learn_unsupervised(_places(spark, sf_dir), R.seed_aliases(spark), min_count=2, purity=0.6)


@query(", a AS (SELECT id AS eid, country, row_number() OVER (PARTITION BY country ORDER BY md5(CAST(id AS VARCHAR)), id) AS k, count(*) OVER (PARTITION BY country) AS n FROM r WHERE src = 1), b AS (SELECT *, floor(0.3 * n) AS u FROM a) SELECT eid, country, CASE WHEN k > u THEN 'skip' WHEN k <= floor(0.188 * u) THEN 'hidden' WHEN k <= floor(0.188 * u) + floor(0.12 * u) THEN 'tab' WHEN k <= floor(0.188 * u) + floor(0.12 * u) + floor(0.4 * u) THEN 'train' WHEN k <= floor(0.188 * u) + floor(0.12 * u) + floor(0.4 * u) + floor(0.12 * u) THEN 'val' ELSE 'context' END AS role FROM b")
def entity_roles(spark, sf_dir):
    return L.roles(records(spark, sf_dir).filter("src = 1").select(F.col("id").alias("eid"), "country"))


_TRUTH = ", t AS (SELECT DISTINCT a.id AS s1_id, b.id AS pool_id FROM r a JOIN r b ON a.country = b.country AND a.name = b.name AND a.src = 1 AND b.src > 1 WHERE a.name <> ''), ds AS (SELECT doc_id, md5(text) AS h, lang FROM documents), pr AS (SELECT DISTINCT a.doc_id AS s1_id, b.doc_id AS pool_id FROM ds a JOIN ds b ON a.h = b.h AND a.lang = b.lang WHERE a.doc_id % 4 = 0 AND b.doc_id % 4 <> 0 UNION SELECT id, id + 1 FROM r WHERE src = 1 AND id % 16 = 0), e AS (SELECT id AS s1_id FROM r WHERE src = 1), m AS (SELECT e.s1_id, (SELECT count(*) FROM t WHERE t.s1_id = e.s1_id) AS n_true, (SELECT count(*) FROM pr WHERE pr.s1_id = e.s1_id) AS n_pred, (SELECT count(*) FROM pr JOIN t ON t.s1_id = pr.s1_id AND t.pool_id = pr.pool_id WHERE pr.s1_id = e.s1_id) AS tp FROM e), fs AS (SELECT *, CASE WHEN n_true = 0 AND n_pred = 0 THEN 1.0 WHEN n_true = 0 OR n_pred = 0 THEN 0.0 ELSE 1.25 * tp / (n_pred + 0.25 * n_true) END AS f FROM m) "


def _predicted(spark, sf_dir):
    """Entities, loose truth (equal names), and predictions: equal texts and some wrong pairs."""
    r = records(spark, sf_dir)
    one, two = r.filter("src = 1"), r.filter("src > 1")
    truth = one.filter("name <> ''").select("country", "name", F.col("id").alias("s1_id")).join(two.select("country", "name", F.col("id").alias("pool_id")), ["country", "name"]).select("s1_id", "pool_id")
    d = table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("h"), "lang")
    same = d.filter("doc_id % 4 = 0").withColumnRenamed("doc_id", "s1_id").join(d.filter("doc_id % 4 <> 0").withColumnRenamed("doc_id", "pool_id"), ["h", "lang"]).select("s1_id", "pool_id")
    wrong = one.filter("id % 16 = 0").select(F.col("id").alias("s1_id"), (F.col("id") + 1).alias("pool_id"))
    return one.select(F.col("id").alias("s1_id")), truth, same.unionByName(wrong).distinct()


@query(_TRUTH + "SELECT s1_id, n_true, n_pred, tp, round(f, 6) AS f FROM fs")
def entity_scores(spark, sf_dir):
    entities, truth, predicted = _predicted(spark, sf_dir)
    return r6(E.entity_scores(entities, predicted, truth), "f")


@query(_TRUTH + "SELECT round(avg(f), 6) AS macro_f05, round(sum(tp) / sum(n_pred)::DOUBLE, 6) AS pair_precision, round(sum(tp) / greatest(sum(n_true), 1)::DOUBLE, 6) AS pair_recall, sum(n_pred - tp)::BIGINT AS fp, sum(n_true - tp)::BIGINT AS fn, sum(n_pred)::BIGINT AS n_pred, sum(n_true)::BIGINT AS n_true, round(count(*) FILTER (n_true = 0 AND n_pred > 0) / greatest(1, count(*) FILTER (n_true = 0))::DOUBLE, 6) AS singleton_fp_rate, round(avg(n_pred), 6) AS pred_per_s1, round(avg(n_true), 6) AS true_per_s1, round(avg((n_pred = 0)::INT), 6) AS empty_share FROM fs")
def metric_summary(spark, sf_dir):
    entities, truth, predicted = _predicted(spark, sf_dir)
    return r6(E.summary(E.entity_scores(entities, predicted, truth)), "macro_f05", "pair_precision", "pair_recall", "singleton_fp_rate", "pred_per_s1", "true_per_s1", "empty_share")


@query(_TRUTH + "SELECT (SELECT count(*) FROM t) AS n_true, count(*) AS found, round(count(*) / (SELECT count(*) FROM t)::DOUBLE, 6) AS recall FROM pr JOIN t USING (s1_id, pool_id)")
def pair_recall(spark, sf_dir):
    _, truth, predicted = _predicted(spark, sf_dir)
    return r6(E.pair_recall(predicted, truth), "recall")


@query(_TRUTH + "SELECT e.s1_id, coalesce(string_agg(CAST(pr.pool_id AS VARCHAR), ',' ORDER BY CAST(pr.pool_id AS VARCHAR)), '') AS ids, coalesce(string_agg(CAST(pr.pool_id AS VARCHAR), ',' ORDER BY CAST(pr.pool_id AS VARCHAR)) FILTER (t.pool_id IS NOT NULL), '') AS chosen_ids FROM e LEFT JOIN pr ON pr.s1_id = e.s1_id LEFT JOIN t ON t.s1_id = pr.s1_id AND t.pool_id = pr.pool_id GROUP BY e.s1_id")
def result_lists(spark, sf_dir):
    entities, truth, predicted = _predicted(spark, sf_dir)
    rows = E.labelled(predicted, truth).select("s1_id", F.col("pool_id").cast("string").alias("pool_id"), (F.col("y") == 1).alias("chosen"))
    return IO.id_lists(entities, rows, "s1_id", "pool_id", "chosen")


@query(SCORED + ", b AS (SELECT pool_id, s1_id, max(p) AS p FROM c GROUP BY ALL) SELECT pool_id, s1_id FROM b WHERE p >= 0.7 QUALIFY row_number() OVER (PARTITION BY pool_id ORDER BY p DESC, s1_id) = 1")
def threshold_decision(spark, sf_dir):
    best = scored(spark, sf_dir).groupBy("pool_id", "s1_id").agg(F.max("p").alias("pc")).withColumn("country", F.lit("us"))
    return D.decide(best, "pc", "thr", thr=0.7).select("pool_id", "s1_id")


@query()
def expected_decision(spark, sf_dir):
    """Exact expected-F0.5 prefixes; a test compares them with all outcomes enumerated."""
    best = scored(spark, sf_dir).groupBy("pool_id", "s1_id").agg(F.max("p").alias("pc")).withColumn("country", F.lit("us"))
    return D.decide(best, "pc", "ef", rounds=2)


@query(", l AS (SELECT 'S1-' || o_orderkey AS s1_id, string_agg(CASE WHEN l_linenumber = 7 THEN 'S1-' || l_partkey WHEN l_linenumber = 6 THEN 'X' || l_partkey WHEN l_linenumber % 2 = 0 THEN 'S2-' || l_partkey ELSE 'S3-' || l_suppkey END, ',') AS ids FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE o_orderkey % 10 <> 3 GROUP BY 1), i AS (SELECT s1_id, unnest(string_split(ids, ',')) AS item FROM l), q AS (SELECT 'S1-' || o_orderkey AS s1_id FROM orders WHERE o_orderkey % 10 <> 4), k AS (SELECT 'S2-' || p_partkey AS id FROM part WHERE p_partkey % 50 <> 0 UNION ALL SELECT 'S3-' || s_suppkey FROM supplier) SELECT 'missing row' AS problem, s1_id AS id, count(*) AS count FROM q WHERE s1_id NOT IN (SELECT s1_id FROM l) GROUP BY ALL UNION ALL SELECT 'extra row', s1_id, count(*) FROM l WHERE s1_id NOT IN (SELECT s1_id FROM q) GROUP BY ALL UNION ALL SELECT 'id twice', s1_id, 1 FROM i GROUP BY s1_id HAVING count(*) <> count(DISTINCT item) UNION ALL SELECT 'self match', item, count(*) FROM i WHERE item LIKE 'S1-%' GROUP BY ALL UNION ALL SELECT 'wrong prefix', item, count(*) FROM i WHERE item LIKE 'X%' GROUP BY ALL UNION ALL SELECT 'unknown id', item, count(*) FROM i WHERE (item LIKE 'S2-%' OR item LIKE 'S3-%') AND item NOT IN (SELECT id FROM k) GROUP BY ALL")
def validation(spark, sf_dir):
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    item = F.when(F.col("l_linenumber") == 7, F.concat(F.lit("S1-"), "l_partkey")).when(F.col("l_linenumber") == 6, F.concat(F.lit("X"), "l_partkey")).when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("S2-"), "l_partkey")).otherwise(F.concat(F.lit("S3-"), "l_suppkey"))
    name = F.concat(F.lit("S1-"), "o_orderkey").alias("s1_id")
    lists = orders.filter("o_orderkey % 10 <> 3").join(lines, F.col("l_orderkey") == F.col("o_orderkey")).groupBy(name).agg(F.array_join(F.collect_list(item), ",").alias("ids"))
    known = table(spark, sf_dir, "part").filter("p_partkey % 50 <> 0").select(F.concat(F.lit("S2-"), "p_partkey").alias("id")).unionByName(table(spark, sf_dir, "supplier").select(F.concat(F.lit("S3-"), "s_suppkey").alias("id")))
    return E.validate(lists, orders.filter("o_orderkey % 10 <> 4").select(name), known)


@query("SELECT c_custkey AS s1_id, CASE WHEN c_mktsegment IN ('BUILDING') AND c_custkey % 3 <> 0 THEN 'o' || c_custkey WHEN c_custkey % 5 <> 0 THEN 'b' || c_custkey ELSE '' END AS ids FROM customer")
def overlay(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s1_id"), F.col("c_mktsegment").alias("country"))
    named = lambda f, letter: c.filter(f).select("s1_id", F.concat(F.lit(letter), "s1_id").alias("ids"))
    return E.overlay(named("s1_id % 5 <> 0", "b"), named("s1_id % 3 <> 0", "o"), c, ["BUILDING"])


# Sources and sinks


@query("SELECT c_custkey::VARCHAR AS entity_id, c_name AS business_name, '' AS business_address, c_mktsegment AS country FROM customer")
def tsv_round_trip(spark, sf_dir):
    path = new_path(spark, "tsv")
    c = table(spark, sf_dir, "customer")
    IO.write_tsv(c.select(F.col("c_mktsegment").alias("country"), F.col("c_custkey").cast("string").alias("entity_id"), F.col("c_name").alias("business_name"), "c_acctbal"), path)
    return IO.read_tsv(spark, path)


@query("SELECT DISTINCT 'S1-' || l_orderkey AS entity, 'S2-' || l_partkey AS pool FROM lineitem")
def truth_scan(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.concat(F.lit("S1-"), "l_orderkey", F.lit("\t"), F.array_join(F.collect_set(F.concat(F.lit("S2-"), "l_partkey")), ",")).alias("value"))
    return IO.truth_pairs(lines)


# Learning and the whole pipeline


def linkage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as raw business records, parsed: words 1 to 6 are the name, the next ones the address."""
    d = table(spark, sf_dir, "documents")
    words = F.split(F.coalesce("text", F.lit("")), r"[\s]+")
    name = F.array_join(F.slice(words, 1, 6), " ")
    address = F.concat(F.pmod(F.xxhash64(F.array_join(F.slice(words, 7, 3), " ")), F.lit(997)).cast("string"), F.lit(" "), F.array_join(F.slice(words, 7, 2), " "), F.lit(" Street, "), F.array_join(F.slice(words, 9, 1), " "), F.lit(", "), F.col("source"))
    raw = d.select(F.col("doc_id").cast("string").alias("entity_id"), name.alias("business_name"), F.when(F.size(words) > 8, address).otherwise("").alias("business_address"), F.col("lang").alias("country"))
    src = F.when(F.col("eid").cast("long") % 4 == 0, 1).otherwise((2 + F.col("eid").cast("long") % 2).cast("int"))
    return IO.normalised(raw, 0).withColumn("src", src)


def _sides(spark, sf_dir):
    rows = materialize(R.add_regions(linkage_records(spark, sf_dir), R.seed_aliases(spark)), "records")
    return rows.filter("src = 1"), rows.filter("src > 1")


def _strict_truth(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id"), F.sha2("text", 256).alias("h"), "lang")
    return d.filter("doc_id % 4 = 0").select(F.col("doc_id").cast("string").alias("s1_id"), "h", "lang").join(d.filter("doc_id % 4 <> 0").select(F.col("doc_id").cast("string").alias("pool_id"), "h", "lang"), ["h", "lang"]).select("s1_id", "pool_id")


@query()
def pruner_features(spark, sf_dir):
    one, two = _sides(spark, sf_dir)
    return X.prune_features(materialize(B.block(one, two, B.Blocking(min_part=5)), "cands"), one, two)


@query()
def stage_features(spark, sf_dir):
    """First-stage features and, with the cosine of names as score, second-stage features."""
    one, two = _sides(spark, sf_dir)
    cands = materialize(E.labelled(B.block(one, two, B.Blocking(min_part=5)), _strict_truth(spark, sf_dir)).withColumn("pp", F.col("s_combo")), "cands")
    rates = X.rate_tables(cands, one, two)
    first = X.stage1_features(cands, one, two, rates)
    p1 = cands.select(*X.PAIR, F.col("s_name").alias("p1")).join(two.select("country", F.col("eid").alias("pool_id"), "src"), ["country", "pool_id"])
    return first.join(X.stage2_features(p1, two), X.PAIR)


@query()
def linked(spark, sf_dir):
    """Training and prediction end to end."""
    rows = materialize(linkage_records(spark, sf_dir), "records")
    one, two = rows.filter("src = 1"), rows.filter("src > 1")
    truth = materialize(_strict_truth(spark, sf_dir), "truth")
    cfg = linkage.Settings(universe=0.9, hidden=0.05, tab=0.25, train=0.4, val=0.25, blocking=B.Blocking(min_part=10))
    return linkage.predict(linkage.fit(one, two, truth, cfg), one, two, cfg)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates by exact top-K cosine within country and partition."""
    return top_cosine_partitioned(spark, sf_dir)


from tessera.plans import linking, parsing, results  # noqa: E402, F401  they register their queries
