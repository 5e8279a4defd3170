"""Pair, context and sibling features of candidate pairs.

Candidates carry country, s1_id, pool_id; every feature frame keeps those keys, and
frames meet by key. Record columns come in by one join per side, words with their weights among them;
rates by one join per word table, aggregated back to the pair.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.sets import flag, letter_cover, number_flags, number_relations, set_stats
from tessera.functions.similarity import similarity
from tessera.functions.text import has_indic, tokens
from tessera.operators import blocking as B
from tessera.operators.grouping import others, rank_gap, relative, second_best, smoothed_counts, sum_and_count, top
from tessera.shared import join_hot, join_slim, materialize

PAIR = ["country", "s1_id", "pool_id"]
RECORD = ["n_name", "n_name_alt", "n_core2", "n_sorted2", "n_compact", "n_skel", "n_legal", "n_dom", "n_first", "n_ntok", "a_alpha", "a_hn", "a_hn_runs", "a_nums", "a_street", "a_stype", "a_loc2", "a_unit", "a_has_hn_kw", "a_ncomp", "addr_empty", "raw_name", "region", "part", "src"]


def with_records(cands: DataFrame, s1: DataFrame, pool: DataFrame, columns: list[str] = RECORD, of_s1: tuple = (), of_pool: tuple = ()) -> DataFrame:
    """cands with the records' columns, those of S1 as s_COLUMN and of the pool as p_COLUMN in structs s and p, and further columns of one side.
    Candidates that are dealt by pool record already, as after competition, are shuffled once."""
    left = s1.select("country", F.col("eid").alias("s1_id"), F.struct(*columns, *of_s1).alias("s"))
    right = pool.select("country", F.col("eid").alias("pool_id"), F.struct(*columns, *of_pool).alias("p"))
    return cands.join(right, ["country", "pool_id"]).join(left, ["country", "s1_id"])


def ambiguity(s1: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame]:
    """log1p of how many S1 (or pool) records have a record's core name: per S1 id and per pool id."""
    log = lambda c: F.log1p(F.coalesce(c, F.lit(0)).cast("double"))
    one = s1.select("country", F.col("eid").alias("s1_id"), "n_core2", "part")
    two = pool.select("country", F.col("eid").alias("pool_id"), "n_core2")
    # Counted with map-side sums and joined back: an empty name of half a country is no group of one task.
    parts = materialize(one.groupBy("country", "n_core2", "part").agg(F.count("*").alias("in_part")), "parts")
    names = materialize(parts.groupBy("country", "n_core2").agg(F.sum("in_part").alias("in_s1")), "names")
    in_pool = materialize(two.groupBy("country", "n_core2").agg(F.count("*").alias("in_pool")).join(names, ["country", "n_core2"], "left").withColumn("rows", F.col("in_pool")), "pool names")
    per_part = materialize(parts.join(names, ["country", "n_core2"]).withColumn("rows", F.col("in_part")), "part names")
    per_s1 = join_hot(one, per_part, ["country", "n_core2", "part"], "rows").select("country", "s1_id", log(F.col("in_s1")).alias("amb_s1_name"), log(F.col("in_part")).alias("amb_s1_name_part"))
    per_pool = join_hot(two, in_pool, ["country", "n_core2"], "rows").select("country", "pool_id", log(F.col("in_pool")).alias("amb_pool_name"), log(F.col("in_s1")).alias("amb_pool_name_in_s1"))
    return per_s1, per_pool


SCORES = ("s_combo", "s_name", "s_addr")
SIZES = {"group_size1": "cand_per_s1", "group_size2": "claimants_per_pool"}


def competition(cands: DataFrame, scores: tuple = SCORES) -> DataFrame:
    """Ranks, gaps and bests of scores within the S1 record (1) and the pool record (2), over all candidates."""
    out = cands
    for key, tie, suffix in (("s1_id", "pool_id", "1"), ("pool_id", "s1_id", "2")):
        for score in scores:
            out = rank_gap(out, ["country", key], score, tie, suffix)
    return out.withColumnsRenamed(SIZES)


def channels() -> dict[str, Column]:
    bits = {"ch_name": B.NAME, "ch_combo": B.COMBO, "ch_addr": B.ADDR, "ch_key": B.KEY, "ch_rev": B.REV, "ch_global": B.GLOBAL}
    return {n: flag(F.col("ch").bitwiseAND(F.lit(b)) > 0) for n, b in bits.items()}


def region_flags() -> dict[str, Column]:
    a, b = F.col("s.part"), F.col("p.part")
    return {"reg_same": flag((a != "") & (a == b)), "reg_conflict": flag((a != "") & (b != "") & (a != b))}


def _equal(column: str, guarded: bool) -> Column:
    a, b = F.col(f"s.{column}"), F.col(f"p.{column}")
    return flag((a == b) & (a != "")) if guarded else flag(a == b)


def _words(column: str, side: str) -> Column:
    value = F.col(f"{side}.{column}")
    return F.array_distinct(value if column == "a_nums" else tokens(value))


PRUNE = "s_name s_combo s_addr ch_name ch_combo ch_addr ch_key ch_rev ch_global n_first_eq n_core_eq n_sorted_eq n_compact_eq n_skel_eq hn_both hn_eq hn_prefix hn_sub hn_conflict a_empty reg_same reg_conflict src3 loc_inter street_inter nt_jacc nt_inter s_combo_rank1 s_combo_gap1 s_combo_rank2 s_combo_gap2 s_name_rank1 s_name_gap1 s_name_rank2 s_addr_rank1 cand_per_s1 claimants_per_pool amb_s1_name amb_pool_name_in_s1 n_ntok1 n_ntok2".split()


#: Record columns that the pruner compares, put together where they recur together.
COMPARED = {"name": ["n_first", "n_core2", "n_sorted2", "n_compact", "n_skel"], "number": ["a_hn", "a_hn_runs"], "place": ["a_loc2", "a_street", "part"]}


def compared(kind: str) -> dict[str, Column]:
    """The pruner's features that only need the columns of one kind in COMPARED, from structs s and p."""
    if kind == "number":
        return number_flags(F.col("s.a_hn"), F.col("p.a_hn"), F.col("s.a_hn_runs"), F.col("p.a_hn_runs"))
    if kind == "place":
        return region_flags() | {f"{n}_inter": set_stats(_words(c, "s"), _words(c, "p"))["inter"] for n, c in (("loc", "a_loc2"), ("street", "a_street"))}
    names = set_stats(_words("n_core2", "s"), _words("n_core2", "p"))
    equal = {f"{n}_eq": _equal(c, True) for n, c in (("n_first", "n_first"), ("n_core", "n_core2"), ("n_sorted", "n_sorted2"), ("n_compact", "n_compact"), ("n_skel", "n_skel"))}
    return equal | {"nt_inter": names["inter"], "nt_jacc": names["jacc"]}


def prune_features(cands: DataFrame, s1: DataFrame, pool: DataFrame) -> DataFrame:
    """The 41 features of the pruner, with the pair's keys and the columns that cands has besides."""
    per_s1, per_pool = ambiguity(s1, pool)
    # What a record is known by meets it before the pairs, which are shuffled with no column that isn't asked for.
    one = s1.join(per_s1.withColumnRenamed("s1_id", "eid"), ["country", "eid"])
    two = pool.join(per_pool.withColumnRenamed("pool_id", "eid"), ["country", "eid"])
    needed = [*sum(COMPARED.values(), []), "n_ntok", "src", "addr_empty"]
    rows = with_records(competition(cands), one, two, needed, ("amb_s1_name",), ("amb_pool_name_in_s1",))
    made = channels() | {"a_empty": F.col("p.addr_empty"), "src3": flag(F.col("p.src") == 3), "n_ntok1": F.col("s.n_ntok"), "n_ntok2": F.col("p.n_ntok"), "amb_s1_name": F.col("s.amb_s1_name"), "amb_pool_name_in_s1": F.col("p.amb_pool_name_in_s1")}
    for kind in COMPARED:
        made |= compared(kind)
    kept = [c for c in ("y", "role") if c in cands.columns]
    return rows.withColumns(made).select(*PAIR, "ch", *kept, *PRUNE)


def numbered(records: DataFrame, columns: list[str], name: str) -> tuple[DataFrame, DataFrame]:
    """The records with name, the number of their distinct values of columns; and the numbered values."""
    # Numbers are given as the values are written, and stay.
    views = materialize(records.select(*columns).distinct().withColumn(name, F.monotonically_increasing_id()), name)
    same = reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in columns])
    return join_slim(records, views.withColumnsRenamed({c: f"_{c}" for c in columns}), same, "inner").drop(*[f"_{c}" for c in columns]), views


def prune_made(s1: DataFrame, pool: DataFrame, on: list[str], pairs: Callable[..., DataFrame], places: int | None = None) -> DataFrame:
    """prune_features of all pairs of records that agree in ``on``, where they are many times the records: what is compared is compared once for
    two values, and pairs meet it by numbers. pairs(s1, pool, their columns): PAIR, ch, the columns and the competition of SCORES;
    places: of other numbers than the scores, where they are rounded."""
    small = lambda df, *names: df if places is None else df.withColumns({n: F.round(F.col(n).cast("double"), places) for n in names})
    per_s1, per_pool = ambiguity(s1, pool)
    one = s1.join(small(per_s1.select("country", F.col("s1_id").alias("eid"), "amb_s1_name"), "amb_s1_name"), ["country", "eid"]).withColumn("n_ntok1", F.col("n_ntok"))
    two = pool.join(small(per_pool.select("country", F.col("pool_id").alias("eid"), "amb_pool_name_in_s1"), "amb_pool_name_in_s1"), ["country", "eid"])
    two = two.withColumns({"n_ntok2": F.col("n_ntok"), "a_empty": F.col("addr_empty"), "src3": flag(F.col("src") == 3)})
    views = {}
    for kind, columns in COMPARED.items():
        one, a = numbered(one, columns, f"{kind}1")
        two, b = numbered(two, columns, f"{kind}2")
        views[kind] = a.select(f"{kind}1", F.struct(*columns).alias("s")), b.select(f"{kind}2", F.struct(*columns).alias("p"))
    one, two = materialize(one, "s1"), materialize(two, "pool")
    out = pairs(one, two, ["amb_s1_name", "n_ntok1", *[f"{k}1" for k in COMPARED]], ["amb_pool_name_in_s1", "n_ntok2", "a_empty", "src3", *[f"{k}2" for k in COMPARED]])
    for kind, (a, b) in views.items():
        both = [f"{kind}1", f"{kind}2"]
        met = one.select(*on, both[0]).distinct().join(two.select(*on, both[1]).distinct(), on).select(*both).distinct()
        made = met.join(a, both[0]).join(b, both[1]).select(*both, *[c.alias(n) for n, c in compared(kind).items()])
        made = materialize(small(made, "nt_jacc") if kind == "name" else made, f"compared {kind}")
        # One number finds the row faster than two do; the numbers themselves are only compared.
        numbers = F.xxhash64(*both)
        same = reduce(lambda x, y: x & y, [F.col(c) - F.col(f"_{c}") == 0 for c in both])
        made = made.withColumn("_found", numbers).withColumnsRenamed({c: f"_{c}" for c in both})
        out = join_slim(out, made, (numbers == F.col("_found")) & same, "inner").drop("_found", *[f"_{c}" for c in both])
    return out.withColumns(channels()).select(*PAIR, "ch", *[c for c in ("y", "role") if c in out.columns], *PRUNE)


def record_weights(s1: DataFrame, pool: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """country, s1_id (or pool_id), and per word column an array w_COLUMN of struct word, idf of the record's distinct words;
    idf = ln((1 + N) / (1 + df)) over the N records of both sides of a country. Weights meet words once a record, not once a pair."""
    both = s1.select("country", F.lit(1).alias("side"), "eid", *columns).unionByName(pool.select("country", F.lit(2).alias("side"), "eid", *columns))
    words = lambda c: F.array_distinct(F.col(c) if c == "a_nums" else tokens(F.col(c)))
    typed = [F.transform(words(c), lambda w: F.struct(F.lit(i).alias("c"), w.alias("word"))) for i, c in enumerate(columns)]
    rows = materialize(both.select("country", "side", "eid", F.explode(F.flatten(F.array(*typed))).alias("x")).select("country", "side", "eid", "x.c", "x.word"), "words")
    total = both.groupBy("country").agg(F.count("*").alias("n"))
    df = rows.groupBy("country", "c", "word").agg(F.count("*").alias("df"))
    weighed = materialize(df.join(F.broadcast(total), "country").select("country", "c", "word", "df", F.log((1 + F.col("n")) / (1 + F.col("df"))).alias("idf")), "idf")
    arrays = [F.array_sort(F.collect_list(F.when(F.col("c") == i, F.struct("word", "idf")))).alias(f"w_{c}") for i, c in enumerate(columns)]
    sums = materialize(join_hot(rows, weighed, ["country", "c", "word"], "df").groupBy("country", "side", "eid").agg(*arrays), "weights")
    of = lambda side, ident: sums.filter(F.col("side") == side).select("country", F.col("eid").alias(ident), *[f"w_{c}" for c in columns])
    return of(1, "s1_id"), of(2, "pool_id")


def weighted_stats(a: Column, b: Column, prefix: str) -> dict[str, Column]:
    """prefix_wjacc, prefix_wextra, prefix_wmissing of two arrays of struct word, idf; null is empty."""
    mass = lambda xs: F.coalesce(F.aggregate(xs, F.lit(0.0), lambda acc, x: acc + x["idf"]), F.lit(0.0))
    names = F.transform(b, lambda x: x["word"])
    inter = mass(F.filter(a, lambda x: F.coalesce(F.array_contains(names, x["word"]), F.lit(False))))
    union = mass(a) + mass(b) - inter
    return {f"{prefix}_wjacc": F.when(union > 0, inter / union).otherwise(0.0), f"{prefix}_wextra": mass(b) - inter, f"{prefix}_wmissing": mass(a) - inter}


def weighted_sets(pairs: DataFrame, s1: DataFrame, pool: DataFrame, columns: dict[str, str]) -> DataFrame:
    """PAIR + PREFIX_wjacc, PREFIX_wextra, PREFIX_wmissing for every word column: prefix in columns."""
    left, right = record_weights(s1, pool, list(columns))
    renamed = right.withColumnsRenamed({f"w_{c}": f"v_{c}" for c in columns})
    rows = pairs.select(*PAIR).join(left, ["country", "s1_id"], "left").join(renamed, ["country", "pool_id"], "left")
    made = {}
    for c, prefix in columns.items():
        made |= weighted_stats(F.col(f"w_{c}"), F.col(f"v_{c}"), prefix)
    return rows.select(*PAIR, *[v.alias(k) for k, v in made.items()])


def numbered_texts(s1: DataFrame, pool: DataFrame) -> tuple[DataFrame, DataFrame, dict]:
    """The records with s_text (or p_text), the number of a record's name and legal form; and per side (s, p) the numbered texts."""
    views, out = {}, []
    for side, records in (("s", s1), ("p", pool)):
        names = records.select(F.col("n_core2").alias(f"{side}_n_core2"), F.col("n_legal").alias(f"{side}_n_legal"))
        # Numbers are given as the texts are written, and stay.
        views[side] = materialize(names.distinct().withColumn(f"{side}_text", F.monotonically_increasing_id()), f"{side} texts")
        same = F.col("n_core2").eqNullSafe(F.col(f"{side}_n_core2")) & F.col("n_legal").eqNullSafe(F.col(f"{side}_n_legal"))
        out.append(records.join(views[side], same).drop(f"{side}_n_core2", f"{side}_n_legal"))
    return *out, views


def compared_texts(pairs: DataFrame, s1: DataFrame, pool: DataFrame, views: dict | None = None) -> dict:
    """What rates need of the texts that pairs compare: rows (PAIR, s_text, p_text) and counts (s_text, p_text with n_core2 and n_legal of
    each, pairs n, and of labelled pairs the known and their sum m). Texts recur far more often than they differ, so that words are looked
    at once for two texts. views: of numbered_texts, where pairs were made of such records and have s_text and p_text already."""
    known = [c for c in ("y",) if c in pairs.columns]
    if views is None:
        one, two, views = numbered_texts(s1, pool)
        numbers = lambda df, side, ident: materialize(df.select("country", F.col("eid").alias(ident), f"{side}_text"), f"{side} numbers")
        pairs = pairs.select(*PAIR, *known).join(numbers(two, "p", "pool_id"), ["country", "pool_id"]).transform(join_slim, numbers(one, "s", "s1_id"), ["country", "s1_id"], "inner")
    y = F.col("y") if known else F.lit(None).cast("int")
    counts = pairs.groupBy("s_text", "p_text").agg(F.sum(y).alias("m"), F.count(y).alias("known"), F.count("*").alias("n"))
    counts = materialize(counts.join(views["s"], "s_text").join(views["p"], "p_text"), "compared texts")
    return {"rows": pairs.select(*PAIR, "s_text", "p_text"), "counts": counts}


#: The side that has a word and the side that lacks it.
_EXTRA = {"extra": "ps", "missing": "sp"}


def _only(kind: str) -> Column:
    """The words that only the pool's name (extra) or only the name of S1 (missing) has."""
    return F.array_except(*[F.array_distinct(tokens(F.col(f"{side}_n_core2"))) for side in _EXTRA[kind]])


def _change() -> Column:
    return F.concat_ws("->", "s_n_legal", "p_n_legal")


def rate_tables(labelled: DataFrame, s1: DataFrame, pool: DataFrame, alpha: float = 20.0, least: int = 5, compared: dict | None = None) -> dict:
    """Smoothed match rates of extra words, missing words and legal-form changes, from labelled pairs (PAIR, y); and the prior.
    compared: compared_texts of these pairs, where they are known."""
    rows = (compared or compared_texts(labelled, s1, pool))["counts"]
    total = rows.agg(F.sum("m").alias("m"), F.sum("known").alias("known")).first()
    prior = float(total.m) / total.known if total.known else 0.05
    rate = lambda df, key: smoothed_counts(df.groupBy(key).agg(F.sum("m").alias("m"), F.sum("n").alias("n")), key, prior, alpha, least)
    return {k: rate(rows.select("m", "n", F.explode(_only(k)).alias("word")), "word") for k in _EXTRA} | {"legal": rate(rows.select("m", "n", _change().alias("change")), "change"), "prior": prior}


def rate_features(pairs: DataFrame, s1: DataFrame, pool: DataFrame, tables: dict, compared: dict | None = None, places: int | None = None) -> DataFrame:
    """PAIR + least and greatest rate of extra and missing name words (1 and 0 without any), identity and noise counts, lg_rate.
    compared: compared_texts of these pairs, where they are known; places: rates are rounded to so many, once for two texts."""
    compared, prior = compared or compared_texts(pairs, s1, pool), F.lit(float(tables["prior"]))
    texts, both = compared["counts"], ["s_text", "p_text"]
    out = texts.select(*both, _change().alias("change")).join(tables["legal"].withColumnRenamed("rate", "lg_rate"), "change", "left").select(*both, F.coalesce("lg_rate", prior).alias("lg_rate"))
    for kind in _EXTRA:
        exploded = texts.select(*both, F.explode(_only(kind)).alias("word")).join(tables[kind], "word", "left").withColumn("rate", F.coalesce("rate", prior))
        sums = exploded.groupBy(*both).agg(F.min("rate").alias("lo"), F.max("rate").alias("hi"), F.count(F.when(F.col("rate") < 0.02, 1)).alias("ident"), F.count(F.when(F.col("rate") > 0.15, 1)).alias("noise"))
        out = out.join(sums, both, "left")
        named = {f"nt_{kind}_rate_min": F.coalesce("lo", F.lit(1.0)), f"nt_{kind}_rate_max": F.coalesce("hi", F.lit(0.0)), f"nt_{kind}_identity": F.coalesce("ident", F.lit(0))} | ({"nt_extra_noise": F.coalesce("noise", F.lit(0))} if kind == "extra" else {})
        out = out.withColumns(named).drop("lo", "hi", "ident", "noise")
    rates = [c for c in out.columns if "rate" in c]
    out = out if places is None else out.withColumns({c: F.round(F.col(c).cast("double"), places) for c in rates})
    return join_slim(compared["rows"], materialize(out, "text rates"), both, "inner").drop(*both)


def pair_features(cands: DataFrame, s1: DataFrame, pool: DataFrame, tables: dict) -> DataFrame:
    """The 118 pair features, with PAIR."""
    per_s1, per_pool = ambiguity(s1, pool)
    # What a record is known by meets it before the pairs: what is made of a pair is shuffled once, to meet what is keyed by the pair.
    known = lambda records, more, ident: records.join(more.withColumnRenamed(ident, "eid"), ["country", "eid"])
    amb_s1, amb_pool = [[c for c in df.columns if c.startswith("amb_")] for df in (per_s1, per_pool)]
    rows = with_records(cands.select(*PAIR, "ch", "s_name", "s_combo", "s_addr"), known(s1, per_s1, "s1_id"), known(pool, per_pool, "pool_id"), RECORD, tuple(amb_s1), tuple(amb_pool))
    s, p = (lambda c: F.col(f"s.{c}")), (lambda c: F.col(f"p.{c}"))
    raw = lambda side: F.lower(F.coalesce(F.col(f"{side}.raw_name"), F.lit("")))
    score = lambda name, a, b: similarity(name, a, b) / (1.0 if name in ("jaro_winkler", "indel") else 100.0)
    has_alt, has_dom = p("n_name_alt") != "", p("n_dom") != ""
    la, lb = s("n_legal"), p("n_legal")
    f: dict[str, Column] = channels()
    f |= {"n_ratio": score("ratio", s("n_core2"), p("n_core2")), "n_tset": score("token_set_ratio", s("n_core2"), p("n_core2")), "n_tsort": score("token_sort_ratio", s("n_core2"), p("n_core2")), "n_partial": score("partial_ratio", s("n_core2"), p("n_core2")), "n_full_ratio": score("ratio", s("n_name"), p("n_name")), "n_compact_jw": score("jaro_winkler", s("n_compact"), p("n_compact")), "n_compact_indel": score("indel", s("n_compact"), p("n_compact")), "n_raw_ratio": score("ratio", raw("s"), raw("p")), "n_raw_eq": flag(raw("s") == raw("p"))}
    f |= {"n_eq": _equal("n_name", False), "n_core_eq": _equal("n_core2", True), "n_sorted_eq": _equal("n_sorted2", False), "n_compact_eq": _equal("n_compact", False), "n_skel_eq": _equal("n_skel", False), "n_skel_ratio": score("ratio", s("n_skel"), p("n_skel")), "n_first_eq": _equal("n_first", True)}
    f |= {"n_has_alt": flag(has_alt), "n_alt_ratio": F.when(has_alt, score("token_set_ratio", s("n_core2"), p("n_name_alt"))).otherwise(0.0), "n_has_dom": flag(has_dom), "n_dom_cover": letter_cover(p("n_dom"), s("n_compact")), "n_dom_partial": F.when(has_dom, score("partial_ratio", p("n_dom"), s("n_compact"))).otherwise(0.0)}
    f |= {"lg_both": flag((la != "") & (lb != "")), "lg_eq": flag((la != "") & (la == lb)), "lg_s1_only": flag((la != "") & (lb == "")), "lg_pool_only": flag((lb != "") & (la == "")), "lg_conflict": flag((la != "") & (lb != "") & (la != lb))}
    f |= {f"nt_{k}": v for k, v in set_stats(_words("n_core2", "s"), _words("n_core2", "p")).items()}
    f |= {"a_empty": p("addr_empty"), "a_ncomp1": s("a_ncomp"), "a_ncomp2": p("a_ncomp"), "a_alpha_tset": score("token_set_ratio", s("a_alpha"), p("a_alpha")), "a_alpha_ratio": score("ratio", s("a_alpha"), p("a_alpha")), "a_street_ratio": score("ratio", s("a_street"), p("a_street")), "a_loc_tset": score("token_set_ratio", s("a_loc2"), p("a_loc2")), "a_loc_partial": score("partial_ratio", s("a_loc2"), p("a_loc2"))}
    for name, column in (("a_stype", "a_stype"), ("a_unit", "a_unit")):
        f |= {f"{name}_eq": _equal(column, True), f"{name}_conflict": flag((s(column) != "") & (p(column) != "") & (s(column) != p(column)))}
    f |= number_relations(s("a_hn"), p("a_hn"), s("a_hn_runs"), p("a_hn_runs")) | {"hn_kw_pool": p("a_has_hn_kw")}
    for name in ("street", "loc", "alpha", "nums"):
        column = {"loc": "a_loc2"}.get(name, f"a_{name}")
        stats = set_stats(_words(column, "s"), _words(column, "p"))
        f |= {f"{name}_{k}": stats[k] for k in ("inter", "jacc", "overlap", "na", "nb")}
    f |= region_flags() | {"reg_pool_unknown": flag(p("region") == "")}
    f |= {"x_name_in_addr": F.greatest(score("partial_token_set_ratio", s("n_core2"), p("a_alpha")), score("partial_token_set_ratio", p("n_core2"), s("a_alpha"))), "src3": flag(p("src") == 3), "pool_script": flag(has_indic(p("raw_name"))), "n_ntok1": s("n_ntok"), "n_ntok2": p("n_ntok"), "n_len1": F.length(s("n_core2")), "n_len2": F.length(p("n_core2"))}
    known_by = [F.col(f"{side}.{c}") for side, cs in (("s", amb_s1), ("p", amb_pool)) for c in cs]
    out = rows.select(*PAIR, "s_name", "s_combo", "s_addr", *[c.alias(n) for n, c in f.items()], *known_by)
    out = out.join(weighted_sets(cands, s1, pool, {"n_core2": "nt", "a_street": "street", "a_loc2": "loc", "a_alpha": "alpha"}), PAIR)
    return out.join(rate_features(cands, s1, pool, tables), PAIR)


def context_features(cands: DataFrame) -> DataFrame:
    """PAIR + the 26 features of the candidate set: competition of the three scores and of pp."""
    out = competition(cands)
    if "pp" in cands.columns:
        out = competition(out.drop("cand_per_s1", "claimants_per_pool"), ("pp",))
    return out.select(*PAIR, *context_columns("pp" in cands.columns))


def context_columns(pp: bool) -> list[str]:
    wanted = [f"{s}_{k}{i}" for s in SCORES for i in "12" for k in ("rank", "gap", "best")] + list(SIZES.values())
    return wanted + (["pp", "pp_rank1", "pp_gap1", "pp_rank2", "pp_gap2", "pp_best2"] if pp else [])


def stage1_features(cands: DataFrame, s1: DataFrame, pool: DataFrame, tables: dict) -> DataFrame:
    return pair_features(cands, s1, pool, tables).join(context_features(cands), PAIR)


def logit(p: Column) -> Column:
    clip = lambda x, most: F.least(F.greatest(x, F.lit(1e-6)), F.lit(most))
    return F.log(clip(p, 1 - 1e-6) / clip(1 - p, 1.0))


def anchors(scored: DataFrame, anchor: float = 0.9, most: int = 3) -> DataFrame:
    """country, s1_id, src, anchor_id: the surest pairs of an S1 record and source."""
    return top(scored.filter(F.col("p1") >= anchor), ["country", "s1_id", "src"], [F.desc("p1"), F.asc("pool_id")], most).select("country", "s1_id", "src", F.col("pool_id").alias("anchor_id"))


def anchor_pairs(scored: DataFrame, anchor: float = 0.9, most: int = 3, cap: float = 0.95) -> DataFrame:
    """PAIR + anchor_id: pairs under cap with the anchors of their S1 record and source, themselves aside."""
    asked = scored.filter(F.col("p1") < cap).select(*PAIR, "src")
    return asked.join(anchors(scored, anchor, most), ["country", "s1_id", "src"]).filter(F.col("anchor_id") != F.col("pool_id"))


def stage2_features(scored: DataFrame, pool: DataFrame, anchor: float = 0.9, most: int = 3, cap: float = 0.95) -> DataFrame:
    """PAIR + the 26 features over first-stage scores p1. scored: PAIR, src, p1."""
    one, two = ["country", "s1_id"], ["country", "pool_id"]
    out = scored.select(*PAIR, "src", "p1").withColumn("p1_logit", logit(F.col("p1")))
    out = rank_gap(rank_gap(out, one, "p1", "pool_id", "1"), two, "p1", "s1_id", "2").drop("group_size1", "group_size2")
    total, half = sum_and_count(one, "p1", 0.5)
    out = out.withColumns({"p1_second1": second_best(one, "p1", "pool_id"), "p1_second2": second_best(two, "p1", "s1_id"), "p1_sum1": total, "p1_n05_1": half, "p1_n09_1": sum_and_count(one, "p1", 0.9)[1], "p1_rel2": relative(two, "p1"), "p1_others2": others(two, "p1")})
    for s in (2, 3):
        sure = F.when((F.col("src") == s) & (F.col("p1") >= anchor), 1).otherwise(0)
        out = out.withColumn(f"anch_s{s}", F.sum(sure).over(Window.partitionBy(*one)) - sure)
    views = pool.select("country", F.col("eid"), F.struct(F.lower(F.coalesce("raw_name", F.lit(""))).alias("raw"), has_indic(F.col("raw_name")).alias("script"), "n_name", "a_hn", "a_street", "a_loc2", "n_legal").alias("v"))
    both = anchor_pairs(scored, anchor, most, cap).join(views.select("country", F.col("eid").alias("pool_id"), F.col("v").alias("a")), ["country", "pool_id"]).join(views.select("country", F.col("eid").alias("anchor_id"), F.col("v").alias("b")), ["country", "anchor_id"])
    a, b = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    both = both.select(*PAIR, (similarity("ratio", a("raw"), b("raw")) / 100).alias("sib_raw"), (similarity("token_set_ratio", a("n_name"), b("n_name")) / 100).alias("sib_name"), flag((a("a_hn") != "") & (a("a_hn") == b("a_hn"))).alias("sib_hn"), (similarity("ratio", a("a_street"), b("a_street")) / 100).alias("sib_street"), (similarity("token_set_ratio", a("a_loc2"), b("a_loc2")) / 100).alias("sib_loc"), flag(a("n_legal") == b("n_legal")).alias("sib_legal"), flag(a("script") == b("script")).alias("sib_script"))
    names = ["sib_raw", "sib_name", "sib_hn", "sib_street", "sib_loc", "sib_legal", "sib_script"]
    best = both.groupBy(*PAIR).agg(F.count("*").alias("sib_n"), *[F.max(c).alias(c) for c in names])
    out = out.join(best, PAIR, "left").fillna(0, ["sib_n", *names])
    return out.withColumn("sib_comp_best", F.max(F.greatest("sib_raw", "sib_name")).over(Window.partitionBy("country", "pool_id"))).drop("src")
