"""Registered queries: names, sizes and texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.functions import measures as ms
from bloomledger.functions import text as tx
from bloomledger.operators.filters import has_no_keyword, not_in_keys
from bloomledger.plans.names import read_names, unread_names, with_names
from bloomledger.workloads.common import (
    FROM_LINES_WITH_PARTS,
    LISTING_NAMES_SQL,
    PRICE_TEXT,
    Query,
    lines_with_parts,
    listing_names,
    sql_aggressive_clean,
    sql_merged_or_range,
    sql_replace,
    sql_stem_length,
    sql_stems_per_unit,
    sql_title_case,
    table,
)

_KEY = ["l_orderkey", "l_linenumber"]


def _over_names(alias, function, sql):
    """A column function over all listing names."""

    def build(spark, sf_dir):
        names = listing_names(spark, sf_dir)
        return names.select(*_KEY, "raw_name", function(F.col("raw_name")).alias(alias))

    return Query(
        build,
        f"SELECT l_orderkey, l_linenumber, raw_name, {sql('raw_name')} AS {alias} "
        f"FROM ({LISTING_NAMES_SQL})",
    )


# Blanks as Python and the Unicode white space define them, for DuckDB.
_ANY_BLANK = (
    r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)


def clean_safe(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", tx.safe_clean(F.col("text")).alias("clean_text"))


CLEAN_SAFE = f"""
SELECT doc_id, CASE WHEN text <> '' THEN trim({sql_replace('text', _ANY_BLANK, ' ')}) END AS clean_text
FROM documents"""


def word_dedup(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    words = tx.distinct_words(F.col("text"))
    return docs.select(
        "doc_id",
        F.array_join(words, " ").alias("distinct_text"),
        F.size(words).cast("bigint").alias("n_words"),
    )


WORD_DEDUP = r"""
WITH words AS (
  SELECT doc_id, unnest(string_split(text, ' ')) AS word,
         generate_subscripts(string_split(text, ' '), 1) AS pos
  FROM documents),
firsts AS (
  SELECT doc_id, word, min(pos) AS pos FROM words
  WHERE word <> '' AND NOT regexp_matches(word, '\d') GROUP BY doc_id, word),
joined AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS distinct_text, count(*) AS n_words
  FROM firsts GROUP BY doc_id)
SELECT d.doc_id, COALESCE(distinct_text, '') AS distinct_text,
       CAST(COALESCE(n_words, 0) AS BIGINT) AS n_words
FROM documents d LEFT JOIN joined USING (doc_id)"""


# Titles with codes, prices and origins.
_TITLE = f"p_name || ' ' || l_returnflag || l_linestatus || ' x ' || l_linestatus || l_returnflag || CASE l_linenumber % 3 WHEN 0 THEN ' ($' || {PRICE_TEXT} || ' Each)' WHEN 1 THEN ' ( $' || {PRICE_TEXT} || ' Each )' ELSE '' END"


def title_price(spark, sf_dir):
    titles = lines_with_parts(spark, sf_dir).select(*_KEY, F.expr(_TITLE).alias("title"))
    title = F.col("title")
    return titles.select(
        *_KEY, "title",
        ms.each_price(title).alias("each_price"),
        tx.strip_each_price(title).alias("bare_title"),
    )


TITLE_PRICE = rf"""
SELECT l_orderkey, l_linenumber, title,
       TRY_CAST(NULLIF(regexp_extract(title, '\(\s*\$(\d+\.\d{{2}})\s*Each\s*\)', 1), '') AS DOUBLE) AS each_price,
       regexp_replace(title, '\(\$\d+\.\d{{2}}\s*Each\)', '', 'gi') AS bare_title
FROM (SELECT l_orderkey, l_linenumber, {_TITLE} AS title {FROM_LINES_WITH_PARTS})"""


def strip_codes(spark, sf_dir):
    titles = lines_with_parts(spark, sf_dir).select(*_KEY, F.expr(_TITLE).alias("title"))
    return titles.select(*_KEY, tx.strip_two_letter_codes(F.col("title")).alias("name"))


STRIP_CODES = rf"""
SELECT l_orderkey, l_linenumber,
       regexp_replace(regexp_replace(title, '\s+[A-Z]{{2}}$', '', 'g'), '\s+[A-Z]{{2}}\s+', ' ', 'g') AS name
FROM (SELECT l_orderkey, l_linenumber, {_TITLE} AS title {FROM_LINES_WITH_PARTS})"""

_ORIGIN = "CASE s_suppkey % 3 WHEN 0 THEN s_name WHEN 1 THEN s_name || ' Origin: x Origin:  ' || n_name || ' ' ELSE 'Origin:' || n_name END"


def origin_text(spark, sf_dir):
    suppliers, nations = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    joined = suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"])
    return joined.select("s_suppkey", tx.text_after_label(F.expr(_ORIGIN)).alias("origin"))


ORIGIN_TEXT = f"""
SELECT s_suppkey, CASE WHEN contains(t, 'Origin:') THEN trim(string_split(t, 'Origin:')[-1]) ELSE '' END AS origin
FROM (SELECT s_suppkey, {_ORIGIN} AS t FROM supplier JOIN nation ON s_nationkey = n_nationkey)"""

_COLOR = "CASE p_partkey % 5 WHEN 0 THEN 'Dark ' || p_name WHEN 1 THEN 'light ' || p_name WHEN 2 THEN NULL WHEN 3 THEN p_name ELSE '' END"


def color_prefix(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    return parts.select(
        "p_partkey",
        tx.color_prefix(F.expr(_COLOR)).alias("color_prefix"),
        F.lower("p_type").alias("variety_name"),
        F.lower(F.coalesce(F.expr(_COLOR), F.lit(""))).alias("common_name"),
    )


COLOR_PREFIX = f"""
SELECT p_partkey,
       CASE WHEN c IS NULL THEN '' WHEN c LIKE 'dark %' OR c LIKE 'light %' THEN split_part(c, ' ', 1) || ' ' || split_part(c, ' ', 2)
            ELSE split_part(c, ' ', 1) END AS color_prefix,
       lower(p_type) AS variety_name, COALESCE(c, '') AS common_name
FROM (SELECT p_partkey, p_type, lower({_COLOR}) AS c FROM part)"""

_TAGS = "' ' || p_type || ' '"


def first_tag(spark, sf_dir):
    parts = table(spark, sf_dir, "part")
    tags = F.when(F.col("p_size") % 3 == 0, F.array()).when(
        F.col("p_size") % 3 == 1, F.array(F.expr(_TAGS), F.col("p_name"))
    )
    return parts.select("p_partkey", tx.first_tag(tags.cast("array<string>")).alias("color"))


FIRST_TAG = "SELECT p_partkey, CASE WHEN p_size % 3 = 1 THEN p_type ELSE '' END AS color FROM part"

_CATALOG_RAW = "CASE p_partkey % 6 WHEN 0 THEN p_name || ' (Jumbo ' || p_type || ')' WHEN 1 THEN p_name || ' * Fragrance * ' || p_type WHEN 2 THEN p_name || ' (' || p_type || ') cannot be cancelled' WHEN 3 THEN p_name || '/' || p_type || ' (petite) (x)' WHEN 4 THEN p_name || ' ' || p_name || ' 4you' ELSE chr(9) || p_type || chr(9) || ' x' END"


def catalog_phrases(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.expr(_CATALOG_RAW)).alias("raw"))
    phrase = tx.keep_listed_parentheses(tx.drop_phrases(F.col("raw")))
    return parts.select("p_partkey", phrase.alias("phrase"), tx.catalog_name(phrase).alias("product_name"))


def sql_phrase(text: str) -> str:
    """Pieces between parentheses, and of these the inner texts with a listed word, in turn."""
    phrases = rf"[\*\s]*{fv.REMOVED_WITH_STARS}[\*\s]*|\b{fv.REMOVED_PHRASE}\b"
    text = sql_replace(text, phrases, "", "gi")
    outer = rf"string_split_regex({text}, '\([^)]*\)')"
    inner = rf"regexp_extract_all({text}, '\(([^)]*)\)', 1)"
    listed = rf"\b({'|'.join(fv.KEPT_IN_PARENTHESES)})\b"
    kept = f"list_transform({inner}, lambda w: CASE WHEN regexp_matches(w, '{listed}') THEN w ELSE '' END)"
    return f"array_to_string(list_transform(list_zip({outer}, {kept}), lambda z: z[1] || coalesce(z[2], '')), '')"


def sql_catalog_name(phrase: str) -> str:
    words = f"list_filter(string_split({phrase}, ' '), lambda w: w <> '' AND NOT regexp_matches(w, '\\d'))"
    first = f"list_filter({words}, lambda w, i: list_position({words}, w) = i)"
    joined = sql_replace(f"array_to_string({first}, ' ')", r"\s+", " ")
    return sql_title_case(f"trim({joined})")


CATALOG_PHRASES = f"""
SELECT p_partkey, phrase, {sql_catalog_name('phrase')} AS product_name
FROM (SELECT p_partkey, {sql_phrase('raw')} AS phrase FROM (SELECT p_partkey, lower({_CATALOG_RAW}) AS raw FROM part))"""


def title_case(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return events.select("event_id", tx.title_case(F.expr("event_type || '/' || props || ' ' || event_type")).alias("title"))


TITLE_CASE = f"""
SELECT event_id, {sql_title_case('t')} AS title
FROM (SELECT event_id, event_type || '/' || props || ' ' || event_type AS t FROM events)"""

_KEYS = ["1", "2", "3", "5", "8", "13", "21", "34", "55", "89", "144"]
_GROUPS = ["Brand#1", "Brand#4", "Brand#9", "Brand#16", "Brand#20", "Brand#25"]


def excluded_keys(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.expr("CASE WHEN p_size = 7 THEN NULL ELSE CAST(p_partkey AS STRING) END").alias("variety"),
        F.col("p_brand").alias("product_group"),
    )
    return parts.filter(not_in_keys(F.col("variety"), _KEYS) & not_in_keys(F.col("product_group"), _GROUPS))


def _listed(keys):
    return ", ".join(f"'{k}'" for k in keys)


EXCLUDED_KEYS = f"""
SELECT variety, product_group FROM (
  SELECT CASE WHEN p_size = 7 THEN NULL ELSE CAST(p_partkey AS VARCHAR) END AS variety, p_brand AS product_group FROM part)
WHERE variety NOT IN ({_listed(_KEYS)}) AND product_group NOT IN ({_listed(_GROUPS)})"""

_KEYWORD_NAME = "CASE p_partkey % 6 WHEN 0 THEN p_name || ' Bouquet' WHEN 1 THEN 'BOXwood ' || p_name WHEN 2 THEN NULL ELSE p_name END"
_KEYWORD_GROUP = "CASE p_size % 4 WHEN 0 THEN 'Total ' || p_type ELSE p_type END"


def keyword_exclusion(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", F.expr(_KEYWORD_NAME).alias("variety_name"), F.expr(_KEYWORD_GROUP).alias("common_name")
    )
    return parts.filter(has_no_keyword(F.col("variety_name"), F.col("common_name")))


KEYWORD_EXCLUSION = f"""
SELECT * FROM (SELECT p_partkey, {_KEYWORD_NAME} AS variety_name, {_KEYWORD_GROUP} AS common_name FROM part)
WHERE variety_name NOT ILIKE '%bouquet%' AND variety_name NOT ILIKE '%box%' AND variety_name NOT ILIKE '%total%'
  AND common_name NOT ILIKE '%bouquet%' AND common_name NOT ILIKE '%box%' AND common_name NOT ILIKE '%total%'"""

def clean_by_dictionary(spark, sf_dir):
    """Clean names of all listings, by a dictionary whose earlier part was read before."""
    listings = listing_names(spark, sf_dir)
    known = read_names(listings.filter(F.length("raw_name") % 4 != 0))
    dictionary = known.unionByName(read_names(unread_names(listings, known)))
    return with_names(listings, dictionary).select(*_KEY, "raw_name", "clean_name")


QUERIES = {
    "clean_safe": Query(clean_safe, CLEAN_SAFE),
    "clean_aggressive": _over_names("clean_name", tx.aggressive_clean, sql_aggressive_clean),
    "clean_by_dictionary": Query(clean_by_dictionary, _over_names("clean_name", tx.aggressive_clean, sql_aggressive_clean).sql),
    "stem_length": _over_names("stem_length", ms.stem_length, sql_stem_length),
    "stems_per_unit": _over_names("stems_per_unit", ms.stems_per_unit, sql_stems_per_unit),
    "merged_length": _over_names("merged_length", ms.merged_or_range_length, sql_merged_or_range),
    "title_price": Query(title_price, TITLE_PRICE),
    "strip_codes": Query(strip_codes, STRIP_CODES),
    "origin_text": Query(origin_text, ORIGIN_TEXT),
    "color_prefix": Query(color_prefix, COLOR_PREFIX),
    "first_tag": Query(first_tag, FIRST_TAG),
    "word_dedup": Query(word_dedup, WORD_DEDUP),
    "catalog_phrases": Query(catalog_phrases, CATALOG_PHRASES),
    "title_case": Query(title_case, TITLE_CASE),
    "excluded_keys": Query(excluded_keys, EXCLUDED_KEYS),
    "keyword_exclusion": Query(keyword_exclusion, KEYWORD_EXCLUSION),
}
