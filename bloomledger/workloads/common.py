"""Shared parts of the registered queries: tables, derived names, SQL texts.

The given tables stand in for the real feeds: a listing is a `lineitem` row, its
product a `part`, its price `l_extendedprice`.  Derived texts are written once,
in SQL that Spark and DuckDB both read, so that both sides start from the same
values; what is then done with them is written separately for each side.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv


@dataclass(frozen=True)
class Query:
    """A registered query and, where SQL can express it, its DuckDB twin."""

    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(rows: DataFrame) -> DataFrame:
    """Rows dealt out over all cores, for work that costs far more than moving them.

    A small file is read by few tasks, whatever is then done with its rows.
    """
    return rows.repartition(4 * rows.sparkSession.sparkContext.defaultParallelism)


def hashed(rows: DataFrame) -> DataFrame:
    """Rows as the smaller side of a join, which a map by the key is built from in each partition.

    Without the hint, rows beyond the broadcast threshold make Spark sort the far larger other
    side too.  The bound is Spark's own for such maps; beyond it, and below the threshold, the
    join is left to the session.
    """
    conf = rows.sparkSession._jsparkSession.sessionState().conf()
    threshold = conf.autoBroadcastJoinThreshold()
    size = int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return rows.hint("shuffle_hash") if threshold < size < threshold * conf.numShufflePartitions() else rows


def lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    parts = hashed(table(spark, sf_dir, "part"))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"])


FROM_LINES_WITH_PARTS = "FROM lineitem JOIN part ON l_partkey = p_partkey"

# --- derived texts (read by both engines) ------------------------------------

_ABBREVIATION = " ".join(
    f"WHEN {i} THEN '{short}'" for i, (short, _) in enumerate(fv.ABBREVIATIONS)
)
_Q = "CAST(l_quantity AS INT)"

# Listing names with every abbreviation and every form of size, pack and code.
LISTING_NAME = f"""
CASE WHEN l_linenumber = 7 THEN 'SpRose ' ELSE '' END || p_name || ' '
|| CASE l_partkey % {len(fv.ABBREVIATIONS) + 8} {_ABBREVIATION} ELSE 'Spray' END
|| CASE (l_orderkey + l_linenumber) % 14
   WHEN 0 THEN ' ' || {_Q} || 'cm'
   WHEN 1 THEN ' ' || {_Q} || '/' || ({_Q} + 10) || 'cm EC'
   WHEN 2 THEN ' x' || {_Q}
   WHEN 3 THEN '  ' || {_Q} || 'pk'
   WHEN 4 THEN ' ' || {_Q} || ' Stems'
   WHEN 5 THEN '  ' || {_Q} || ' '
   WHEN 6 THEN ' CO ' || {_Q} || '-' || ({_Q} + 10)
   WHEN 7 THEN ' Mex'
   WHEN 8 THEN ' Lt'
   WHEN 9 THEN ' ' || ({_Q} + 20) || ({_Q} + 30)
   WHEN 10 THEN ' 3D'
   WHEN 11 THEN ' +' || {_Q} || ' ' || {_Q} || 'x'
   WHEN 12 THEN ' ' || {_Q} || ' in St' || {_Q}
   ELSE '' END
"""

# The same for Spark: the abbreviation is looked up, which keeps the generated code short enough
# for the JVM to compile it.
SPARK_LISTING_NAME = LISTING_NAME.replace(
    f"CASE l_partkey % {len(fv.ABBREVIATIONS) + 8} {_ABBREVIATION} ELSE 'Spray' END",
    f"coalesce(get(split('{'|'.join(short for short, _ in fv.ABBREVIATIONS)}', '[|]'), "
    f"CAST(l_partkey % {len(fv.ABBREVIATIONS) + 8} AS INT)), 'Spray')",
)

# Price with two digits behind the point, as text.
PRICE_TEXT = "CAST(l_extendedprice AS DECIMAL(18,2))"


def listing_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`l_orderkey`, `l_linenumber`, `raw_name` of every line."""
    return lines_with_parts(spark, sf_dir).select(
        "l_orderkey", "l_linenumber", F.expr(SPARK_LISTING_NAME).alias("raw_name")
    )


LISTING_NAMES_SQL = (
    f"SELECT l_orderkey, l_linenumber, {LISTING_NAME} AS raw_name {FROM_LINES_WITH_PARTS}"
)

# --- DuckDB texts of the name and price rules ----------------------------------


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def sql_replace(text: str, pattern: str, by: str = "", flags: str = "g") -> str:
    return f"regexp_replace({text}, {_quoted(pattern)}, {_quoted(by)}, '{flags}')"


def sql_collapse(text: str) -> str:
    return f"trim({sql_replace(text, chr(92) + 's+', ' ')})"


def sql_safe_clean(text: str) -> str:
    return f"CASE WHEN {text} <> '' THEN {sql_collapse(text)} END"


def sql_aggressive_clean(text: str) -> str:
    units, packs = "|".join(fv.NAME_LENGTH_UNITS), "|".join(fv.PACK_UNITS)
    sizes = [
        p.replace("{units}", units).replace("{packs}", packs)
        for p in (fv.LENGTH_IN_NAME, fv.COUNT_THEN_PACK, fv.PACK_THEN_COUNT)
    ]
    out = sql_replace(sql_collapse(text), rf"{fv.NAME_PREFIX}\s*", "", "gi")
    for short, full in fv.ABBREVIATIONS:
        out = sql_replace(out, rf"\b{re.escape(short)}\b", full, "gi")
    for pattern in (
        *sizes,
        rf"\b(?:{'|'.join(fv.ORIGIN_CODES)})\b",
        fv.TRAILING_NUMBER,
    ):
        out = sql_replace(out, pattern, "", "gi")
    return f"CASE WHEN {text} <> '' THEN {sql_collapse(out)} END"


def _sql_int(text: str, pattern: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({text}, {_quoted(pattern)}, 1, 'i'), '') AS BIGINT)"


def sql_stem_length(text: str) -> str:
    low, high = fv.STEM_LENGTH_RANGE
    units = "|".join(fv.STEM_LENGTH_UNITS)
    bare = _sql_int(text, r"(\d+)(?:\W|$)")
    merged = _sql_int(text, fv.MERGED_PAIR)
    with_unit = _sql_int(text, fv.LENGTH_WITH_UNIT.replace("{units}", units))
    return (
        f"COALESCE({with_unit}, CASE WHEN {bare} BETWEEN {low} AND {high} THEN {bare} END, "
        f"CASE WHEN {merged} BETWEEN {low} AND {high} THEN {merged} END)"
    )


def sql_stems_per_unit(text: str) -> str:
    return (
        f"COALESCE({_sql_int(text, fv.STEM_COUNT)}, {_sql_int(text, fv.TIMES_COUNT)}, "
        f"{_sql_int(text, fv.SPLIT_COUNT)}, CAST(1 AS BIGINT))"
    )


def sql_merged_or_range(text: str) -> str:
    return f"COALESCE({_sql_int(text, fv.MERGED_PAIR)}, {_sql_int(text, fv.NUMBER_RANGE)})"


def sql_round_cents(value: str) -> str:
    """Two places by the exact binary value, ties to even, in whole numbers.

    A double from 2^-8 up is a whole number of 2^-60ths; a hundred times it, divided
    with remainder, is rounded exactly.
    """
    sixtieths = f"(100 * CAST(({value}) * 1152921504606846976e0 AS HUGEINT))"
    one = "CAST(1152921504606846976 AS HUGEINT)"
    half = "CAST(576460752303423488 AS HUGEINT)"
    whole, rest = f"({sixtieths} // {one})", f"({sixtieths} % {one})"
    up = f"CASE WHEN {rest} > {half} THEN 1 WHEN {rest} = {half} THEN {whole} % 2 ELSE 0 END"
    return f"(CAST({whole} + {up} AS DOUBLE) / 1e2)"


def sql_title_case(text: str) -> str:
    """Letter by letter: capital at the start and behind a delimiter."""
    marks = fv.TITLE_CASE_DELIMITERS.replace("'", "''")
    letters = f"string_split(lower({text}), '')"
    return (
        f"array_to_string(list_transform({letters}, lambda c, i: CASE WHEN i = 1 "
        f"OR contains('{marks}', {letters}[i - 1]) THEN upper(c) ELSE c END), '')"
    )
