"""Queries of the name and address rules, over names made from parts and addresses made from customers.

The SQL has no look-around, so it finds legal forms between padding characters, one after another;
the names hold one legal form each, for which that is the same.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from tessera.functions import address as A
from tessera.functions import text as T
from tessera.functions import vocabulary as V
from tessera.plans.registry import query, table

#: One text for both engines: names with every decoration that the parser knows.
NAME = """CASE p_partkey % 14 WHEN 0 THEN p_name || ' Private Limited' WHEN 1 THEN 'M/s. ' || p_name || ' & Co.' WHEN 2 THEN 'Old ' || p_name || ' formerly known as ' || p_name || ' S.A.R.L.'
    WHEN 3 THEN p_name || ' L.L.C. | www.' || replace(p_name, ' ', '-') || p_partkey || '.c0m' WHEN 4 THEN '#' || replace(p_name, ' ', '_') WHEN 5 THEN replace(replace(p_name, 'o', '0'), 'l', '1') || ' Inc.'
    WHEN 6 THEN 'The The ' || p_name || ' (ID: ' || p_partkey || ') Group' WHEN 7 THEN p_name || ' t/a Shop ' || p_partkey || ' P. Ltd' WHEN 8 THEN 'Shri "' || p_name || '" Traders - 1234567'
    WHEN 9 THEN replace(p_name, ' ', '') || '.co.in' WHEN 10 THEN 'Incorporated' WHEN 11 THEN p_name || chr(39) || 's [A+B] Partners/Public Limited Company' WHEN 12 THEN p_name || ' dba' ELSE 'www.sh0p' || p_partkey || '.net services' END"""
#: Likewise addresses.
ADDRESS = """CASE c_custkey % 9 WHEN 0 THEN 'H.No. ' || c_custkey || '-' || c_nationkey || '-007' WHEN 1 THEN 'Suite ' || (c_custkey % 50) || ', 0' || c_custkey WHEN 2 THEN c_custkey || ' bis' WHEN 3 THEN '#' || c_custkey
    WHEN 4 THEN 'PO Box ' || c_custkey WHEN 5 THEN (c_custkey % 90 + 4) || 'th' WHEN 6 THEN 'Plot No. ' || c_custkey || 'A' WHEN 7 THEN 'Flat ' || (c_custkey % 9) || ' Old Tower ' || c_nationkey || ' 00' || c_custkey ELSE '' END
    || ' ' || CASE c_custkey % 7 WHEN 0 THEN 'Main' WHEN 1 THEN 'M.G.' WHEN 2 THEN 'de la Paix' WHEN 3 THEN 'North Oak' WHEN 4 THEN 'Saint Ann 2nd' WHEN 5 THEN '5th [Cross]' ELSE 'Oak Oak' END
    || ' ' || CASE c_custkey % 11 WHEN 0 THEN 'Street' WHEN 1 THEN 'Rd.' WHEN 2 THEN 'Avenue' WHEN 3 THEN 'rue' WHEN 4 THEN 'Plaza' WHEN 5 THEN 'Nagar' WHEN 6 THEN 'Boulevard, Unit B' || c_nationkey WHEN 7 THEN 'Ste. 9' WHEN 8 THEN 'Allee' WHEN 9 THEN 'x1y2 Road' ELSE 'Loop #12' END
    || ', ' || CASE c_custkey % 5 WHEN 0 THEN 'Springfield' WHEN 1 THEN 'near City Park' WHEN 2 THEN 'Hyderabad District 500001' WHEN 3 THEN 'Lyon & Co' ELSE 'null' END || CASE c_custkey % 4 WHEN 0 THEN ', TX 75002' WHEN 1 THEN ', , 12 Lyon' WHEN 2 THEN '; (India).' ELSE '' END"""


def _tokens(x: str) -> str:
    return rf"list_filter(string_split(trim(regexp_replace({x}, '\s+', ' ', 'g')), ' '), lambda w: w <> '')"


def _quoted(words) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


def _squeeze(x: str) -> str:
    return rf"trim(regexp_replace({x}, '\s+', ' ', 'g'))"


_IDS = lambda x: f"regexp_replace({x}, '{V.ID_NUMBERS}', ' ', 'g')"
_PLAIN = lambda x: _squeeze(rf"""regexp_replace(replace(replace(replace(replace({x}, '&', ' and '), '+', ' and '), '''', ''), '"', ' '), '[\[\](){{}}<>*!?:;,_~^=/\-]+', ' ', 'g')""")
_HONORIFIC = lambda x: f"regexp_replace({x}, '{V.HONORIFIC}', '')"


def _legal(x: str) -> str:
    spelled = sorted(((s, form) for form, ss in V.LEGAL_SPELLINGS.items() for s in ss), key=lambda p: (-len(p[0]), p[0]))
    dotted = lambda s: "".join(f"[{c}]" if c in ".()" else c for c in s)
    return "trim(" + reduce(lambda t, p: rf"regexp_replace({t}, '([^a-z0-9]){dotted(p[0])}([^a-z0-9])', '\1{p[1]}\2', 'g')", spelled, f"' ' || {x} || ' '") + ")"


_UNLEET = "CASE WHEN regexp_full_match(t, '[a-z0-9$@]{3,}') AND regexp_matches(t, '[a-z]{2}') AND regexp_matches(t, '[0-9$@]') AND NOT regexp_full_match(t, '[0-9]+(st|nd|rd|th)') AND length(regexp_replace(t, '[^013456789$@]', '', 'g')) <= 2 AND length(regexp_replace(t, '[^013456789$@]', '', 'g')) < length(t) - 1 THEN translate(t, '013456789$@', 'oleasgtbgsa') ELSE t END"


def _cleaned(ids: str, column: str) -> str:
    """CTEs that give clean(id, words) from a table with id and an ASCII text column."""
    return f""", {ids}0 AS (SELECT id, {_HONORIFIC(_PLAIN(_IDS(column)))} AS x FROM {ids}), {ids}1 AS (SELECT id, {_tokens(f"replace({_legal('x')}, '.', ' ')")} AS w FROM {ids}0),
        {ids}2 AS (SELECT id, list_filter(list_transform(w, lambda t: {_UNLEET}), lambda t: t <> '|') AS w FROM {ids}1),
        {ids}_clean AS (SELECT id, list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN i = 1 OR w[i] <> w[i - 1] THEN w[i] ELSE '' END), lambda t: t <> '') AS words FROM {ids}2)"""


_NAMES = f", n AS (SELECT p_partkey AS id, replace(lower({NAME}), '|', ' | ') AS t FROM part) "


def _names(spark, sf_dir):
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.expr(NAME).alias("raw")).withColumn("t", T.ascii_text(F.col("raw")))


@query(_NAMES + f"SELECT id, t, {_IDS('t')} AS no_ids, {_PLAIN('t')} AS plain, {_HONORIFIC('t')} AS no_honorific FROM n")
def name_marks(spark, sf_dir):
    """Ids, decoration and honorifics, each by itself."""
    t = F.col("t")
    return _names(spark, sf_dir).select("id", "t", T.without_ids(t).alias("no_ids"), T.without_decoration(t).alias("plain"), T.without_honorific(t).alias("no_honorific"))


@query(_NAMES + f"SELECT id, {_legal(_PLAIN('t'))} AS name FROM n")
def legal_forms(spark, sf_dir):
    return _names(spark, sf_dir).select("id", T.canonical_legal(T.without_decoration(F.col("t"))).alias("name"))


@query(_NAMES + _cleaned("n", "t") + "SELECT id, array_to_string(words, ' ') AS name FROM n_clean")
def clean_names(spark, sf_dir):
    return _names(spark, sf_dir).select("id", F.array_join(T.canonical_words(F.col("t")), " ").alias("name"))


_BARE = """trim(w, ',;:!?()[]{}<>*"''')"""
_WEB_OF = f"regexp_extract({_BARE}, '{V.DOMAIN}', 1) || regexp_extract({_BARE}, '{V.HANDLE}', 1)"
_WEB = f""", web0 AS (SELECT id, len({_tokens('t')}) <= 2 AS few, {_tokens("replace(t, '|', ' ')")} AS ws FROM src),
    web1 AS (SELECT id, few, w, i, translate({_WEB_OF}, '-_', '') AS h, regexp_matches({_BARE}, '{V.HANDLE}') AS handle FROM (SELECT id, few, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM web0)),
    web2 AS (SELECT *, CASE WHEN regexp_matches(h, '[a-z]') THEN translate(h, '0135', 'oles') ELSE h END AS web FROM web1),
    web AS (SELECT src.id, coalesce(first(web ORDER BY i) FILTER (web <> ''), '') AS dom, coalesce(string_agg(CASE WHEN web = '' THEN w ELSE web END, ' ' ORDER BY i) FILTER (web = '' OR handle OR (few AND i = 1)), '') AS rest FROM src LEFT JOIN web2 ON web2.id = src.id GROUP BY src.id) """


@query(f", src AS (SELECT page_id AS id, CASE page_id % 3 WHEN 0 THEN lower(regexp_extract(url, '^https?://[^/]+')) WHEN 1 THEN 'visit ' || lower(regexp_extract(url, '^https?://([^/]+)', 1)) || ' or #shop_' || page_id || ', our c0rner.com!' ELSE '\"' || lower(regexp_extract(url, '^https?://([^/]+)', 1)) || '\"' END AS t FROM pages) {_WEB} SELECT id, dom, rest FROM web")
def web_names(spark, sf_dir):
    """Domains and handles in texts around the pages' hosts."""
    host = F.lower(F.regexp_extract("url", "^https?://([^/]+)", 1))
    text = F.when(F.col("page_id") % 3 == 0, F.lower(F.regexp_extract("url", "^https?://[^/]+", 0))).when(F.col("page_id") % 3 == 1, F.concat(F.lit("visit "), host, F.lit(" or #shop_"), "page_id", F.lit(", our c0rner.com!"))).otherwise(F.concat(F.lit('"'), host, F.lit('"')))
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), T.split_web(text).alias("w")).select("id", "w.dom", "w.rest")


_ALIAS = f"""a0 AS (SELECT id, t, regexp_extract(' ' || t || ' ', '(?s)^(.*?)(?:{V.ALIAS_MARKER})(.*)$', 1) AS a, regexp_extract(' ' || t || ' ', '(?s)^(.*?)(?:{V.ALIAS_MARKER})(.*)$', 2) AS b, regexp_matches(' ' || t || ' ', '{V.ALIAS_MARKER}') AS found FROM al),
    a1 AS (SELECT id, trim(CASE WHEN found THEN a ELSE t END) AS a, trim(CASE WHEN found THEN b ELSE '' END) AS b FROM a0), alias AS (SELECT id, CASE WHEN b <> '' THEN b ELSE a END AS name, CASE WHEN b <> '' THEN a ELSE '' END AS alt FROM a1) """


@query(_NAMES + ", al AS (SELECT id, t FROM n), " + _ALIAS + "SELECT id, name, alt FROM alias")
def alias_names(spark, sf_dir):
    return _names(spark, sf_dir).select("id", T.split_alias(F.col("t")).alias("s")).select("id", "s.name", "s.alt")


_SKEL_OF = reduce(lambda t, r: f"replace({t}, '{r[0]}', '{r[1]}')", [*V.SKELETON, ("c", "k")], "replace(replace(replace(t, 'ce', 'se'), 'ci', 'si'), 'cy', 'sy')")
_VIEWS = (
    _NAMES
    + ", src AS (SELECT id, t FROM n)"
    + _WEB
    + ", al AS (SELECT id, rest AS t FROM web), "
    + _ALIAS
    + ", p AS (SELECT id, name AS t FROM alias), q AS (SELECT id, alt AS t FROM alias)"
    + _cleaned("p", "t")
    + _cleaned("q", "t")
    + f""", v0 AS (SELECT id, dom, q_clean.words AS alt, CASE WHEN len(p_clean.words) > 0 THEN p_clean.words WHEN dom <> '' THEN [dom] ELSE [] END AS w FROM web JOIN p_clean USING (id) JOIN q_clean USING (id)),
    v1 AS (SELECT *, list_filter(w, lambda t: t NOT IN ({_quoted(V.LEGAL)})) AS c0 FROM v0), v2 AS (SELECT *, CASE WHEN len(c0) > 0 THEN c0 ELSE w END AS core, list_filter(c0, lambda t: t NOT IN ({_quoted(V.GENERIC)})) AS d0 FROM v1),
    v AS (SELECT *, CASE WHEN len(d0) > 0 THEN d0 ELSE core END AS core2 FROM v2),
    k AS (SELECT id, i, t, string_split(regexp_replace({_SKEL_OF}, '[aeiouyh]', '', 'g'), '') AS k FROM (SELECT id, unnest(core2) AS t, generate_subscripts(core2, 1) AS i FROM v)),
    k1 AS (SELECT id, i, CASE WHEN length(t) < 3 OR regexp_full_match(t, '[0-9]+') THEN t ELSE coalesce(array_to_string(list_filter(list_transform(range(1, len(k) + 1), lambda j: CASE WHEN j = 1 OR k[j] <> k[j - 1] THEN k[j] ELSE '' END), lambda x: x <> ''), ''), '') END AS s FROM k),
    sk AS (SELECT id, string_agg(s, ' ' ORDER BY i) FILTER (s <> '') AS skel FROM k1 GROUP BY id) """
)


@query(_VIEWS + f"SELECT id, array_to_string(w, ' ') AS name, array_to_string(alt, ' ') AS name_alt, array_to_string(core, ' ') AS core, array_to_string(core2, ' ') AS core2, array_to_string(list_sort(core2), ' ') AS sorted2, array_to_string(core2, '') AS compact, coalesce(skel, '') AS skel, array_to_string(list_sort(list_distinct(list_filter(w, lambda t: t IN ({_quoted(V.LEGAL)})))), ' ') AS legal, dom, coalesce(core2[1], '') AS first, len(core2) AS ntok FROM v LEFT JOIN sk USING (id)")
def name_parser(spark, sf_dir):
    """All eleven views of a name."""
    return _names(spark, sf_dir).select("id", T.name_views(F.col("raw")).alias("v")).select("id", "v.*")


@query("SELECT doc_id AS id, lower(coalesce(text, '')) AS raw, regexp_matches(coalesce(text, ''), '[ऀ-෿]') AS indic, regexp_replace(strip_accents(regexp_replace(lower(coalesce(text, '')), 'ß', 'ss', 'g')), '[|]', ' | ', 'g') AS t FROM documents")
def ascii_texts(spark, sf_dir):
    """Whole texts in lower-case ASCII; those that are ASCII already stay in the JVM."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lower(F.coalesce("text", F.lit(""))).alias("raw"), T.has_indic(F.col("text")).alias("indic"), T.ascii_text(F.col("text")).alias("t"))


# Addresses


_CLEAN = r"""trim(regexp_replace(replace(regexp_replace(replace(replace(c, '&', ' and '), '''', ''), '[\[\](){}<>*!?:;_~^="]+', ' ', 'g'), '#', ' # '), '\s+', ' ', 'g'), ' .-')"""
_ADDRESSES = rf""", a AS (SELECT c_custkey AS id, regexp_replace({_squeeze(f"lower({ADDRESS})")}, '{V.PO_BOX}', ' ', 'g') AS t FROM customer),
    cs AS (SELECT id, t, list_filter(list_transform(string_split(t, ','), lambda c: {_CLEAN}), lambda c: c <> '') AS comps FROM a),
    sp(w, form) AS (VALUES {", ".join(f"('{w}', '{f}')" for w, f in A.WORDS.items())}),
    c0 AS (SELECT id, unnest(comps) AS comp, generate_subscripts(comps, 1) AS i FROM cs),
    c1 AS (SELECT id, i, comp, len(list_filter(string_split(comp, ' '), lambda w: regexp_matches(w, '[0-9]') AND NOT regexp_matches(w, '{V.ORDINAL}'))) > 0 AS numbered, rtrim(string_split(comp, ' ')[1], '.') AS f FROM c0),
    c2 AS (SELECT id, i, CASE WHEN NOT numbered THEN 2 WHEN coalesce(form, f) IN ({_quoted(V.UNIT)}) OR f IN ('po', 'p.o', 'box') THEN 1 ELSE 0 END AS rank FROM c1 LEFT JOIN sp ON sp.w = f),
    h AS (SELECT id, arg_min(i, rank * 1000 + i) FILTER (rank < 2) AS house FROM c2 GROUP BY id),
    w0 AS (SELECT id, i, i = house AS at_house, unnest(ws) AS word, generate_subscripts(ws, 1) AS j FROM (SELECT c0.id, i, house, {_tokens(f"replace(CASE WHEN i = house THEN regexp_replace(comp, '{V.HOUSE_KEYWORD}', ' ', 'g') ELSE comp END, '#', ' ')")} AS ws FROM c0 JOIN h USING (id))),
    w1 AS (SELECT id, i, j, coalesce(at_house, false) AS at_house, coalesce(form, rtrim(word, '.')) AS canon FROM w0 LEFT JOIN sp ON sp.w = rtrim(word, '.')),
    w2 AS (SELECT *, canon IN ({_quoted(V.UNIT)}) AS is_unit, regexp_matches(canon, '{V.ORDINAL}') AS ordinal, regexp_replace(canon, '[^a-z]', '', 'g') AS letters, lead(canon) OVER u AS next, lag(canon IN ({_quoted(V.UNIT)})) OVER u AS skipped FROM w1 WINDOW u AS (PARTITION BY id, i ORDER BY j)),
    w3 AS (SELECT *, CASE WHEN skipped THEN '' WHEN is_unit OR ordinal THEN canon WHEN regexp_matches(canon, '[0-9]') AND length(letters) <= 2 THEN '' ELSE letters END AS word, i * 1000 + j AS pl FROM w2),
    d0 AS (SELECT id, i, pl, at_house, unnest(regexp_extract_all(canon, '[0-9]+')) AS d, generate_subscripts(regexp_extract_all(canon, '[0-9]+'), 1) AS k FROM w3 WHERE NOT ordinal),
    d1 AS (SELECT id, pl * 100 + k AS pl, at_house, d, regexp_replace(d, '^0+([0-9])', '\1') AS n FROM d0),
    st AS (SELECT id, arg_max(word, pl) FILTER (word IN ({_quoted(A.TYPES)})) AS stype FROM w3 WHERE at_house GROUP BY id) """
_ONCE = lambda name, cond: f"{name} AS (SELECT id, string_agg(word, ' ' ORDER BY pl) AS {name} FROM (SELECT id, word, min(pl) AS pl FROM w3 LEFT JOIN st USING (id) WHERE word <> '' AND {cond} GROUP BY id, word) GROUP BY id)"
_RUNS = lambda name, cond: f"{name} AS (SELECT id, string_agg(n, ' ' ORDER BY pl) AS {name} FROM (SELECT id, n, min(pl) AS pl FROM d1 WHERE {cond} GROUP BY id, n) GROUP BY id)"


def _addresses(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.expr(ADDRESS).alias("raw"))


@query(_ADDRESSES + rf"SELECT id, t, array_to_string(comps, '|') AS comps, (regexp_matches(t, '{V.HOUSE_KEYWORD}') OR contains(t, '#'))::INT AS keyword, coalesce(house, 0) - 1 AS house FROM cs LEFT JOIN h USING (id)")
def address_components(spark, sf_dir):
    """PO boxes, components, house-number keywords, and the component with the house number."""
    rows = _addresses(spark, sf_dir).withColumn("t", A.drop_po_box(T.squeeze(T.ascii_text(F.col("raw"))))).withColumn("c", A.components(F.col("t")))
    return rows.select("id", "t", F.array_join("c", "|").alias("comps"), A.house_keyword(F.col("t")).alias("keyword"), A.house_component(F.col("c")).alias("house"))


@query(_ADDRESSES + "SELECT id, i - 1 AS i, string_agg(canon, ' ' ORDER BY j) AS canon, string_agg(word, ' ' ORDER BY j) FILTER (word <> '') AS words, first(next ORDER BY j) FILTER (is_unit AND next IS NOT NULL) AS unit FROM w3 GROUP BY id, i")
def address_words(spark, sf_dir):
    """Canonical words, alphabetic words and unit values of every component that has words."""
    rows = _addresses(spark, sf_dir).select("id", T.let(A.components(A.drop_po_box(T.squeeze(T.ascii_text(F.col("raw"))))), A.parts).alias("p")).select("id", F.posexplode("p").alias("i", "p")).filter("size(p.canon) > 0")
    return rows.select("id", "i", F.array_join("p.canon", " ").alias("canon"), F.when(F.size("p.words") > 0, F.array_join("p.words", " ")).alias("words"), A.unit_value(F.col("p.canon")).alias("unit"))


@query(_ADDRESSES + "," + ", ".join([_ONCE("alpha", f"word NOT IN ({_quoted([*V.LOCALITY_JUNK, *V.UNIT])})"), _ONCE("street", f"at_house AND word NOT IN ({_quoted([*V.HOUSE, *V.UNIT, *V.LOCALITY_JUNK, *V.STREET_STOP])}) AND word <> coalesce(stype, '')"), _ONCE("loc", f"NOT at_house AND NOT regexp_matches(word, '{V.ORDINAL}') AND word NOT IN ({_quoted([*V.LOCALITY_JUNK, *A.TYPES, *V.UNIT, *V.STREET_STOP])})"), _RUNS("hn_runs", "at_house"), _RUNS("nums", "true")]) + ", o AS (SELECT id, first(n ORDER BY pl) FILTER (at_house) AS hn, first(d ORDER BY pl) FILTER (NOT at_house AND length(d) BETWEEN 5 AND 6) AS postal FROM d1 GROUP BY id), un AS (SELECT id, first(next ORDER BY pl) FILTER (is_unit AND next <> '') AS unit FROM w3 GROUP BY id) SELECT cs.id, array_to_string(comps, '|') AS comps, coalesce(alpha, '') AS alpha, coalesce(hn, '') AS hn, coalesce(hn_runs, '') AS hn_runs, coalesce(nums, '') AS nums, coalesce(street, '') AS street, coalesce(stype, '') AS stype, coalesce(loc, '') AS loc, coalesce(unit, '') AS unit, coalesce(postal, '') AS postal, " + rf"(regexp_matches(t, '{V.HOUSE_KEYWORD}') OR contains(t, '#'))::INT AS has_hn_kw, len(comps) AS ncomp, (len(comps) = 0)::INT AS addr_empty FROM cs LEFT JOIN alpha USING (id) LEFT JOIN street USING (id) LEFT JOIN loc USING (id) LEFT JOIN hn_runs USING (id) LEFT JOIN nums USING (id) LEFT JOIN o USING (id) LEFT JOIN un USING (id) LEFT JOIN st USING (id)")
def address_parser(spark, sf_dir):
    """All views of an address, lists joined."""
    rows = _addresses(spark, sf_dir).select("id", A.address_views(F.col("raw")).alias("v")).select("id", "v.*")
    joined = {c: F.array_join(c, "|" if c == "comps" else " ") for c in ("comps", "hn_runs", "nums")}
    return rows.withColumn("addr_empty", (F.size("comps") == 0).cast("int")).withColumns(joined)
