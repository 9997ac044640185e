"""Registered queries: master catalog, name vectors, candidates and matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.functions.vectors import DIMENSIONS, cosine, slot_weights, weighted
from bloomledger.operators.adjudication import MatchRules, adjudicate, judge
from bloomledger.operators.similarity import top_k
from bloomledger.plans import matching as mt
from bloomledger.plans.catalog import build_catalog
from bloomledger.plans.incremental import answered, decide_new, refresh_candidates
from bloomledger.workloads.common import Query, table
from bloomledger.workloads.text_queries import sql_catalog_name, sql_phrase

# --- master catalog --------------------------------------------------------------
# Sold items are lines, varieties parts, product groups brands, colors nations.

_EXCLUDED_VARIETIES = ["1", "2", "3", "5", "8", "13", "21", "34", "55", "89", "144"]
_EXCLUDED_GROUPS = ["Brand#1", "Brand#4", "Brand#9", "Brand#16", "Brand#20", "Brand#24"]

_VARIETY_NAME = """CASE p_partkey % 7 WHEN 0 THEN p_name || ' (sometimes blush)' WHEN 1 THEN p_name || ' (Jumbo)'
  WHEN 2 THEN p_name || ' *fragrance* ' || p_type WHEN 3 THEN p_type || ' ' || p_name WHEN 4 THEN 'Box ' || p_name
  WHEN 5 THEN p_name || ' 2nd ' || p_type ELSE p_type || ' spray ' || p_name END"""
_COMMON_NAME = "CASE p_size % 4 WHEN 0 THEN 'Garden Roses' WHEN 1 THEN NULL WHEN 2 THEN 'Disbuds/ Mums' ELSE 'Carnations' END"
_COLOR_NAME = "CASE n_nationkey % 4 WHEN 0 THEN 'Dark Red' WHEN 1 THEN 'light pink tone' WHEN 2 THEN 'White cream' ELSE NULL END"


def catalog_tables(spark, sf_dir):
    """items, variety, product_group, color from the given tables."""
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    items = lines.select(
        F.expr("CASE WHEN l_linenumber = 7 AND l_returnflag = 'R' THEN NULL ELSE CAST(l_partkey AS STRING) END").alias("variety"),
        F.expr("'Brand#' || (l_suppkey % 27)").alias("product_group"),
    )
    variety = parts.select(
        F.col("p_partkey").cast("string").alias("_KEY"),
        F.expr(f"CASE WHEN p_size = 50 THEN NULL ELSE {_VARIETY_NAME} END").alias("variety_name"),
        F.expr("CAST(p_partkey % 30 AS STRING)").alias("color"),
        F.expr("CASE WHEN p_size = 49 THEN 'none' ELSE p_brand END").alias("product_group"),
    )
    group = parts.groupBy(F.col("p_brand").alias("_KEY")).agg(F.min("p_size").alias("p_size")).select(
        "_KEY", F.expr(_COMMON_NAME).alias("common_name")
    )
    color = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("_KEY"), F.expr(_COLOR_NAME).alias("color_name")
    )
    return items, variety, group, color


def catalog_build(spark, sf_dir):
    return build_catalog(
        *catalog_tables(spark, sf_dir), excluded_varieties=_EXCLUDED_VARIETIES, excluded_groups=_EXCLUDED_GROUPS
    )


def _listed(keys):
    return ", ".join(f"'{k}'" for k in keys)


def _free_of(column):
    """No excluded keyword, as a condition; unknown for a null text."""
    return " AND ".join(f"position('{word}' IN {column}) = 0" for word in fv.EXCLUDED_KEYWORDS)


_COLOR_WORDS = "string_split(lower(color_name), ' ')"
_TWO_WORD_COLOR = " OR ".join(f"starts_with(lower(color_name), '{m} ')" for m in fv.COLOR_MODIFIERS)
_COLOR_TEXT = f"coalesce(array_to_string({_COLOR_WORDS}[1:CASE WHEN {_TWO_WORD_COLOR} THEN 2 ELSE 1 END], ' '), '')"

# Varieties first, with their color and the check of their own group; then the groups
# under which each was sold.
CATALOG_BUILD = f"""
WITH brand AS (SELECT p_brand AS k, min(p_size) AS p_size FROM part GROUP BY p_brand),
grp AS (SELECT k, lower(coalesce({_COMMON_NAME}, '')) AS common FROM brand),
tint AS (SELECT CAST(n_nationkey AS VARCHAR) AS k, {_COLOR_NAME} AS color_name FROM nation),
kind AS (
  SELECT CAST(p_partkey AS VARCHAR) AS variety, lower(CASE WHEN p_size <> 50 THEN {_VARIETY_NAME} END) AS name,
         CAST(p_partkey % 30 AS VARCHAR) AS tint_key, CASE WHEN p_size = 49 THEN 'none' ELSE p_brand END AS home FROM part),
usable AS (
  SELECT variety, name, (SELECT {_COLOR_TEXT} FROM tint WHERE tint.k = tint_key) AS prefix FROM kind
  WHERE EXISTS (SELECT 1 FROM grp WHERE grp.k = home) AND {_free_of('name')}),
sold AS (
  SELECT DISTINCT CASE WHEN NOT (l_linenumber = 7 AND l_returnflag = 'R') THEN CAST(l_partkey AS VARCHAR) END AS variety,
         'Brand#' || (l_suppkey % 27) AS under FROM lineitem),
wanted AS (
  SELECT * FROM sold WHERE variety NOT IN ({_listed(_EXCLUDED_VARIETIES)}) AND under NOT IN ({_listed(_EXCLUDED_GROUPS)})),
named AS (
  SELECT variety, coalesce(prefix, '') || ' ' || name || ' ' || coalesce(common, '') AS raw
  FROM wanted JOIN usable USING (variety) LEFT JOIN grp ON grp.k = under WHERE {_free_of("coalesce(common, '')")})
SELECT DISTINCT {sql_catalog_name('phrase')} AS product_name, variety
FROM (SELECT variety, {sql_phrase('raw')} AS phrase FROM named)"""

# --- similarity --------------------------------------------------------------------


def topk_cosine(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return top_k(
        vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector")),
        vectors.select(F.col("vec_id").alias("catalog_id"), F.col("embedding").alias("catalog_vector")),
        k=10,
    ).withColumn("score", F.round("score", 6))


TOPK_COSINE = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS catalog_id, round(list_cosine_similarity(q.e, c.e), 9) AS score FROM v q, v c),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, catalog_id) AS rank FROM pairs)
SELECT query_id, catalog_id, round(score, 6) AS score, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= 10"""


def label_of_best(spark, sf_dir):
    """Label of each vector's nearest neighbours, looked up by id, counted per pair."""
    labels = table(spark, sf_dir, "embeddings").select("vec_id", "label")
    found = topk_cosine(spark, sf_dir)
    named = found.join(labels.withColumnsRenamed({"vec_id": "query_id", "label": "query_label"}), "query_id").join(
        labels.withColumnsRenamed({"vec_id": "catalog_id", "label": "found_label"}), "catalog_id"
    )
    return named.groupBy("query_label", "found_label").agg(F.count("*").alias("n_found"), F.min("rank").alias("best_rank"))


LABEL_OF_BEST = f"""
SELECT q.label AS query_label, c.label AS found_label, count(*) AS n_found, min(rank) AS best_rank
FROM ({TOPK_COSINE}) t JOIN embeddings q ON q.vec_id = t.query_id JOIN embeddings c ON c.vec_id = t.catalog_id
GROUP BY ALL"""


def pair_cosine(spark, sf_dir):
    """Each vector against the one with the next id."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    nxt = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return vectors.join(nxt, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("score"))


PAIR_COSINE = """
SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1"""

# --- matching ------------------------------------------------------------------------

# Names another seller uses for the parts: word order, plurals and colors differ.
_SELLER_NAME = """CASE p_partkey % 6
  WHEN 0 THEN split_part(p_name, ' ', 2) || 's ' || p_type || ' ' || split_part(p_name, ' ', 1)
  WHEN 1 THEN p_name || ' ' || p_type WHEN 2 THEN 'Pink ' || p_type || ' ' || p_name
  WHEN 3 THEN 'Spray ' || p_type || ' ' || p_name WHEN 4 THEN split_part(p_name, ' ', 1) || ' ' || p_type
  ELSE 'GARDEN ' || p_name || ' Iris' END"""
_OWN_NAME = "p_type || ' ' || p_name || CASE p_size % 5 WHEN 0 THEN ' Spray' WHEN 1 THEN '' WHEN 2 THEN ' Irises' ELSE 's' END"

_RULES = MatchRules(
    color_words=("red", "blue", "pink", "hot", "cold"),
    type_words=("ring", "widget", "bolt", "gear", "anvil", "rod", "plate", "gizmo"),
)


def seller_products(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("competitor_product_id"), F.expr(_SELLER_NAME).alias("product_name")
    )


def own_catalog(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.expr(_OWN_NAME).alias("product_name"), F.col("p_brand").alias("variety")
    ).distinct()


def vectorise_names(spark, sf_dir):
    """Non-zero slots of every name's vector."""
    vectors = mt.vectorise(seller_products(spark, sf_dir))
    slots = vectors.select("name", F.posexplode_outer("vector").alias("slot", "n"))
    return slots.filter(F.col("n") != 0).select("name", "slot", F.col("n").cast("int").alias("n"))


def vectorise_weighted(spark, sf_dir):
    """Non-zero slots of the sellers' names, weighted by how few names of the catalog use them."""
    weights = slot_weights(mt.vectorise(own_catalog(spark, sf_dir)))
    vectors = weighted(mt.vectorise(seller_products(spark, sf_dir)), weights)
    slots = vectors.select("name", F.posexplode_outer("vector").alias("slot", "value"))
    return slots.filter(F.col("value") != 0).select("name", "slot", F.round("value", 4).alias("value"))


def _slots_sql(names: str) -> str:
    """`name`, `slot`, `n` rows of the trigram vectors of a query giving `name`."""
    return rf"""
SELECT name, slot, CAST(count(*) AS INTEGER) AS n FROM (
  SELECT name, CAST(CAST('0x' || substr(md5(substr(padded, i, 3)), 1, 6) AS BIGINT) % {DIMENSIONS} AS INTEGER) AS slot FROM (
    SELECT name, padded, unnest(generate_series(1, length(padded) - 2)) AS i FROM (
      SELECT name, ' ' || lower(trim(regexp_replace(name, '\s+', ' ', 'g'))) || ' ' AS padded FROM ({names}))))
GROUP BY name, slot"""


_SELLER_NAMES = f"SELECT DISTINCT {_SELLER_NAME} AS name FROM part"
_OWN_NAMES = f"SELECT DISTINCT {_OWN_NAME} AS name FROM part"

VECTORISE_NAMES = _slots_sql(_SELLER_NAMES)

VECTORISE_WEIGHTED = f"""
WITH used AS (SELECT slot, count(*) AS uses FROM ({_slots_sql(_OWN_NAMES)}) GROUP BY slot),
total AS (SELECT count(*) AS names FROM ({_OWN_NAMES}) WHERE name IS NOT NULL)
SELECT name, slot, round(CAST(n * (ln(CAST(1 + names AS DOUBLE) / (1 + coalesce(uses, 0))) + 1) AS FLOAT), 4) AS value
FROM ({VECTORISE_NAMES}) CROSS JOIN total LEFT JOIN used USING (slot)"""

# `c` is materialised: the ranked candidates of all names.
_CANDIDATES = f"""
q AS ({_slots_sql(_SELLER_NAMES)}), o AS ({_slots_sql(_OWN_NAMES)}),
ql AS (SELECT name, sqrt(CAST(sum(n * n) AS DOUBLE)) AS len FROM q GROUP BY name),
ol AS (SELECT name, sqrt(CAST(sum(n * n) AS DOUBLE)) AS len FROM o GROUP BY name),
dots AS (SELECT q.name AS query_name, o.name AS candidate_name, CAST(sum(q.n * o.n) AS DOUBLE) AS dot
         FROM q JOIN o USING (slot) GROUP BY ALL),
scored AS (
  SELECT ql.name AS query_name, ol.name AS candidate_name, round(COALESCE(dot, 0) / (ql.len * ol.len), 9) AS score
  FROM ql CROSS JOIN ol LEFT JOIN dots ON query_name = ql.name AND candidate_name = ol.name),
c AS MATERIALIZED (
  SELECT query_name, candidate_name, score, rank FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY query_name ORDER BY score DESC, candidate_name) AS INTEGER) AS rank FROM scored)
  WHERE rank <= 10)"""


def match_candidates(spark, sf_dir):
    return mt.candidates(mt.vectorise(seller_products(spark, sf_dir)), mt.vectorise(own_catalog(spark, sf_dir)))


MATCH_CANDIDATES = f"WITH {_CANDIDATES} SELECT * FROM c"


def match_incremental(spark, sf_dir):
    """The candidates of all names, brought up to date from a run before names came and went.

    Then, sellers had no small parts and two names that are gone; the catalog had no large parts,
    and names that are gone stood among the candidates of a third of all names.
    """
    size, sellers = F.col("p_size"), table(spark, sf_dir, "part")
    earlier = sellers.filter(size > 10).select(F.expr(_SELLER_NAME).alias("product_name"))
    earlier = earlier.union(spark.createDataFrame([("Gone Rose",), ("Gone Lily",)], "product_name string"))
    old_names = sellers.filter(size <= 40).select(F.expr(_OWN_NAME).alias("product_name"))
    gone = sellers.filter("p_partkey % 3 = 0").select(F.expr(f"({_SELLER_NAME}) || ' Mini'").alias("product_name"))
    old_queries, old_catalog = mt.vectorise(earlier), mt.vectorise(old_names.union(gone))
    before = mt.candidates(old_queries, old_catalog)
    queries, catalog = mt.vectorise(seller_products(spark, sf_dir)), mt.vectorise(own_catalog(spark, sf_dir))
    return refresh_candidates(before, old_queries, old_catalog, queries, catalog)


def kept_decisions(spark, sf_dir):
    """Decisions of all names, most of them kept from a run in which a tenth of the names had fewer candidates."""
    found = match_candidates(spark, sf_dir)
    shorter = found.filter(F.col("rank") <= F.when(F.length("query_name") % 10 == 0, 5).otherwise(10))
    none = spark.createDataFrame([], "digest string, matched_name string")
    known = decide_new(shorter, none, _RULES)[1]
    asked, new = decide_new(found, known, _RULES)
    return answered(asked, known.unionByName(new))


def candidate_list(spark, sf_dir):
    return mt.candidate_lists(match_candidates(spark, sf_dir))


CANDIDATE_LIST = f"""
WITH {_CANDIDATES} SELECT query_name, string_agg('- ' || candidate_name, chr(10) ORDER BY rank) AS candidate_list FROM c GROUP BY query_name"""


def match_judgement(spark, sf_dir):
    return judge(match_candidates(spark, sf_dir), _RULES).select(
        "query_name", "candidate_name", "overlap", F.col("accepted").cast("int").alias("accepted")
    )


def _words_sql(name: str) -> str:
    words = rf"list_filter(regexp_split_to_array(lower({name}), '[^\p{{L}}0-9]+'), lambda w: w <> '')"
    singular = rf"regexp_replace(regexp_replace(regexp_replace(w, '(..)ies$', '\1y'), '(.(?:sh|ch|x|ss|is|us))es$', '\1'), '(..[^siu])s$', '\1')"
    return f"list_distinct(list_transform({words}, lambda w: {singular}))"


def _list_sql(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


_GENERIC = _list_sql(dict.fromkeys(_RULES.color_words + _RULES.type_words + _RULES.subtype_words))
_TYPES, _SUBTYPES = _list_sql(_RULES.type_words), _list_sql(_RULES.subtype_words)

_JUDGED = f"""{_CANDIDATES},
w AS (SELECT *, {_words_sql('query_name')} AS qw, {_words_sql('candidate_name')} AS cw FROM c),
own AS (SELECT *, list_filter(qw, lambda x: NOT list_contains({_GENERIC}, x)) AS qo, list_filter(cw, lambda x: NOT list_contains({_GENERIC}, x)) AS co FROM w),
rated AS (
  SELECT query_name, candidate_name, rank,
    CASE WHEN len(qo) + len(co) = 0 THEN 0e0
         ELSE CAST(len(list_intersect(qo, co)) AS DOUBLE) / len(list_distinct(list_concat(qo, co))) END AS overlap,
    list_sort(list_intersect(qw, {_SUBTYPES})) = list_sort(list_intersect(cw, {_SUBTYPES})) AS same_subtype,
    (NOT list_has_any(qw, {_TYPES}) OR NOT list_has_any(cw, {_TYPES})
      OR len(list_intersect(list_intersect(qw, cw), {_TYPES})) > 0) AS type_agrees
  FROM own),
judged AS (
  SELECT query_name, candidate_name, rank, overlap,
         CAST(overlap > 0 AND overlap >= 5e-1 AND same_subtype AND type_agrees AS INTEGER) AS accepted FROM rated)"""

MATCH_JUDGEMENT = f"WITH {_JUDGED} SELECT query_name, candidate_name, overlap, accepted FROM judged"


def match_decision(spark, sf_dir):
    return adjudicate(match_candidates(spark, sf_dir), _RULES)


_DECIDED = f"""{_JUDGED},
decided AS (
  SELECT query_name, COALESCE((array_agg(candidate_name ORDER BY overlap DESC, rank) FILTER (accepted = 1))[1], 'Null') AS matched_name
  FROM judged GROUP BY query_name)"""

MATCH_DECISION = f"WITH {_DECIDED} SELECT * FROM decided"


def match_assemble(spark, sf_dir):
    return mt.match_products(seller_products(spark, sf_dir), own_catalog(spark, sf_dir), _RULES)


_ASSEMBLED = f"""{_DECIDED},
keys AS (SELECT {_OWN_NAME} AS own_name, max(p_brand) AS variety_key FROM part GROUP BY 1),
assembled AS (
  SELECT CAST(p_partkey AS VARCHAR) AS competitor_product_id, {_SELLER_NAME} AS competitor, matched_name, COALESCE(variety_key, 'Null') AS variety_key
  FROM part JOIN decided ON query_name = {_SELLER_NAME} LEFT JOIN keys ON own_name = matched_name)"""

MATCH_ASSEMBLE = f"WITH {_ASSEMBLED} SELECT * FROM assembled"


def match_yield(spark, sf_dir):
    return mt.match_yield(match_assemble(spark, sf_dir))


MATCH_YIELD = f"""
WITH {_ASSEMBLED} SELECT count(*) AS n_products, count(*) FILTER (variety_key <> 'Null') AS n_matched FROM assembled"""


def name_lookup(spark, sf_dir):
    """Variety of each seller name that the catalog holds literally."""
    names = seller_products(spark, sf_dir).select(F.initcap("product_name").alias("matched_name"))
    catalog = table(spark, sf_dir, "part").select(
        F.initcap(F.concat_ws(" ", "p_name", "p_type")).alias("product_name"), F.col("p_brand").alias("variety")
    )
    return mt.lookup_variety(names, catalog).groupBy("matched_name", "variety_key").agg(F.count("*").alias("n_products"))


_INITCAP = "array_to_string(list_transform(string_split({}, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ')"

NAME_LOOKUP = f"""
SELECT matched_name, COALESCE(k.variety_key, 'Null') AS variety_key, count(*) AS n_products
FROM (SELECT {_INITCAP.format(_SELLER_NAME)} AS matched_name FROM part)
LEFT JOIN (SELECT {_INITCAP.format("p_name || ' ' || p_type")} AS name, max(p_brand) AS variety_key FROM part GROUP BY 1) k ON name = matched_name
GROUP BY ALL"""

QUERIES = {
    "topk_cosine": Query(topk_cosine, TOPK_COSINE),
    "label_of_best": Query(label_of_best, LABEL_OF_BEST),
    "pair_cosine": Query(pair_cosine, PAIR_COSINE),
    "catalog_build": Query(catalog_build, CATALOG_BUILD),
    "vectorise_names": Query(vectorise_names, VECTORISE_NAMES),
    "vectorise_weighted": Query(vectorise_weighted, VECTORISE_WEIGHTED),
    "match_candidates": Query(match_candidates, MATCH_CANDIDATES),
    "match_incremental": Query(match_incremental, MATCH_CANDIDATES),
    "kept_decisions": Query(kept_decisions, MATCH_DECISION),
    "candidate_list": Query(candidate_list, CANDIDATE_LIST),
    "match_judgement": Query(match_judgement, MATCH_JUDGEMENT),
    "match_decision": Query(match_decision, MATCH_DECISION),
    "match_assemble": Query(match_assemble, MATCH_ASSEMBLE),
    "match_yield": Query(match_yield, MATCH_YIELD),
    "name_lookup": Query(name_lookup, NAME_LOOKUP),
}
