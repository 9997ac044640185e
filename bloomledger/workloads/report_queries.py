"""Registered queries: mapping joins, price reports, monitoring, exports."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomledger.functions.text import count_line
from bloomledger.operators import analytics as an
from bloomledger.operators.asof import as_of_join, validity_ranges
from bloomledger.operators.filters import first_rows
from bloomledger.sinks import tables as tb
from bloomledger.workloads.common import Query, table

_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


def line_prices(spark, sf_dir):
    """Lines as prices: part is the product, supplier's region the competitor."""
    lines = table(spark, sf_dir, "lineitem")
    suppliers, nations, regions = (table(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    sellers = (
        suppliers.join(nations, suppliers["s_nationkey"] == nations["n_nationkey"])
        .join(regions, nations["n_regionkey"] == regions["r_regionkey"])
        .select("s_suppkey", "s_name", F.col("r_name").alias("competitor"))
    )
    joined = lines.join(sellers, lines["l_suppkey"] == sellers["s_suppkey"])
    return joined.select(
        "competitor",
        F.col("l_partkey").cast("string").alias("competitor_product_id"),
        F.date_format("l_shipdate", "yyyy-MM").alias("eta_date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("stem_price"),
        F.col("l_quantity").cast("bigint").alias("available_units"),
        F.col("s_name").alias("grower_name"),
        F.col("l_extendedprice").alias("base_price"),
        F.col("l_tax").alias("freight_price"),
        F.col("l_discount").alias("margin"),
    )


LINE_PRICES = """
SELECT r_name AS competitor, CAST(l_partkey AS VARCHAR) AS competitor_product_id, strftime(l_shipdate, '%Y-%m') AS eta_date,
       l_extendedprice / l_quantity AS stem_price, CAST(l_quantity AS BIGINT) AS available_units, s_name AS grower_name,
       l_extendedprice AS base_price, l_tax AS freight_price, l_discount AS margin
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


def part_mapping(spark, sf_dir):
    """Mapping of the smaller products; the others are still to be mapped."""
    parts = table(spark, sf_dir, "part")
    return parts.filter(F.col("p_size") <= 25).select(
        F.col("p_partkey").cast("string").alias("competitor_product_id"), F.col("p_brand").alias("variety_key")
    )


PART_MAPPING = "SELECT CAST(p_partkey AS VARCHAR) AS competitor_product_id, p_brand AS variety_key FROM part WHERE p_size <= 25"


def price_mapping_join(spark, sf_dir):
    mapped = an.with_mapping(line_prices(spark, sf_dir), part_mapping(spark, sf_dir))
    return mapped.select("competitor", "competitor_product_id", "eta_date", "available_units", "variety_key")


PRICE_MAPPING_JOIN = f"""
SELECT competitor, competitor_product_id, eta_date, available_units, variety_key
FROM ({LINE_PRICES}) LEFT JOIN ({PART_MAPPING}) USING (competitor_product_id)"""


def new_products(spark, sf_dir):
    return an.unmapped_products(line_prices(spark, sf_dir), part_mapping(spark, sf_dir))


NEW_PRODUCTS = f"""
SELECT DISTINCT competitor_product_id FROM ({LINE_PRICES})
WHERE competitor_product_id NOT IN (SELECT competitor_product_id FROM ({PART_MAPPING}))"""


def source_summary(spark, sf_dir):
    return an.source_counts(line_prices(spark, sf_dir))


SOURCE_SUMMARY = f"""
SELECT competitor, count(*) AS n_products, CAST(grouping(competitor) AS INTEGER) AS is_total
FROM ({LINE_PRICES}) GROUP BY ROLLUP (competitor)"""


def summary_text(spark, sf_dir):
    counts = source_summary(spark, sf_dir)
    label = F.when(F.col("is_total") == 1, F.lit("total products")).otherwise(F.lower("competitor"))
    return counts.select(count_line(label, F.col("n_products")).alias("line"))


SUMMARY_TEXT = f"""
SELECT array_to_string(list_transform(string_split(label, ' '), lambda w: upper(w[1]) || lower(w[2:])), ' ') || ': '
       || format('{{:,}}', n_products) AS line
FROM (SELECT CASE WHEN is_total = 1 THEN 'total products' ELSE lower(competitor) END AS label, n_products FROM ({SOURCE_SUMMARY}))"""


def variety_price_range(spark, sf_dir):
    mapped = an.with_mapping(line_prices(spark, sf_dir), part_mapping(spark, sf_dir))
    return an.price_range(mapped, ["variety_key"])


VARIETY_PRICE_RANGE = f"""
SELECT variety_key, min(stem_price) AS cheapest_price_per_stem, max(stem_price) AS highest_price_per_stem
FROM ({LINE_PRICES}) LEFT JOIN ({PART_MAPPING}) USING (competitor_product_id) GROUP BY variety_key"""


def price_comparison(spark, sf_dir):
    mapped = an.with_mapping(line_prices(spark, sf_dir), part_mapping(spark, sf_dir))
    return an.compare_competitors(mapped.filter(F.col("variety_key").isNotNull()), _REGIONS)


_MINIMA = ", ".join(f"""min(stem_price) FILTER (competitor = '{r}') AS "{r}" """ for r in _REGIONS)
_QUOTED = ", ".join(f'"{r}"' for r in _REGIONS)
_SELLERS = " + ".join(f"""CAST("{r}" IS NOT NULL AS INTEGER)""" for r in _REGIONS)

PRICE_COMPARISON = f"""
SELECT *, CAST({_SELLERS} AS BIGINT) AS n_competitors, greatest({_QUOTED}) - least({_QUOTED}) AS spread FROM (
  SELECT variety_key, eta_date, {_MINIMA},
    count(stem_price) FILTER (competitor IS NULL OR competitor NOT IN ({", ".join(f"'{r}'" for r in _REGIONS)})) AS n_other
  FROM ({LINE_PRICES}) JOIN ({PART_MAPPING}) USING (competitor_product_id) GROUP BY ALL)"""


def grower_view(spark, sf_dir):
    view = an.grower_prices(line_prices(spark, sf_dir))
    return view.select("grower_name", "n_offers", *[F.round(c, 4).alias(c) for c in ("avg_base_price", "avg_freight_price", "avg_margin")])


def _mean(name):
    return f"round(CAST(sum(CAST({name} AS DECIMAL(18,6))) AS DOUBLE) / count({name}), 4) AS avg_{name}"


GROWER_VIEW = f"""
SELECT grower_name, count(*) AS n_offers, {_mean('base_price')}, {_mean('freight_price')}, {_mean('margin')}
FROM ({LINE_PRICES}) GROUP BY grower_name"""


def volume_drop(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_type", F.date_format("ts", "yyyy-MM-dd").alias("day"))
    drops = an.volume_drops(events, "event_type", "day", min_ratio=0.9)
    return drops.withColumn("is_drop", F.col("is_drop").cast("int"))


VOLUME_DROP = """
SELECT *, CAST(COALESCE(n_products < n_before * 9e-1, false) AS INTEGER) AS is_drop FROM (
  SELECT *, lag(n_products) OVER (PARTITION BY event_type ORDER BY day) AS n_before FROM (
    SELECT event_type, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n_products FROM events GROUP BY ALL))"""


def capped_sources(spark, sf_dir):
    return an.capped_sources(line_prices(spark, sf_dir), cap=200)


CAPPED_SOURCES = f"""
SELECT competitor, eta_date, count(*) AS n_products FROM ({LINE_PRICES}) GROUP BY ALL HAVING count(*) >= 200"""


def stock_alert(spark, sf_dir):
    """Lines as monthly stock; a line of one to three pieces counts as sold out."""
    stock = line_prices(spark, sf_dir).withColumn(
        "available_units", F.when(F.col("available_units") > 3, F.col("available_units")).otherwise(F.lit(0).cast("bigint"))
    )
    return an.stock_alerts(stock)


STOCK_ALERT = f"""
WITH rows AS (SELECT competitor, competitor_product_id, eta_date, CASE WHEN available_units > 3 THEN available_units ELSE 0 END AS units FROM ({LINE_PRICES})),
stock AS (SELECT competitor, competitor_product_id, eta_date, CAST(sum(units) AS BIGINT) AS units FROM rows GROUP BY ALL),
days AS (SELECT DISTINCT competitor, eta_date FROM rows),
steps AS (SELECT s.*, (SELECT min(d.eta_date) FROM days d WHERE d.competitor = s.competitor AND d.eta_date > s.eta_date) AS next_day FROM stock s)
SELECT a.competitor, a.competitor_product_id, a.next_day AS eta_date, a.units AS units_before,
       CASE WHEN b.units IS NULL THEN 'missing' ELSE 'sold_out' END AS alert
FROM steps a LEFT JOIN stock b ON b.competitor = a.competitor AND b.competitor_product_id = a.competitor_product_id AND b.eta_date = a.next_day
WHERE a.units > 0 AND a.next_day IS NOT NULL AND (b.units IS NULL OR b.units = 0)"""


def allowlist_projection(spark, sf_dir):
    """Customers as products; only the names on the export list get through."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("competitor_product_id"),
        F.col("c_mktsegment").alias("competitor"),
        F.col("c_name").alias("competitor_product_name"),
        F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise(F.lit("n/a")).alias("stem_length"),
        F.col("c_acctbal").alias("unit_price"),
        F.lit("2024-02-01").alias("created_at"),
        F.lit("not exported").alias("color"),
    )
    return tb.export_columns(customers, "PetalJet")


ALLOWLIST_PROJECTION = """
SELECT c_mktsegment AS competitor, CAST(c_custkey AS VARCHAR) AS competitor_product_id, c_name AS competitor_product_name,
       CASE WHEN c_nationkey % 2 = 0 THEN CAST(c_nationkey AS BIGINT) END AS stem_length, c_acctbal AS unit_price, '2024-02-01' AS created_at
FROM customer"""


def _customers_with_gaps(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name",
        F.when(F.col("c_acctbal") < -5000, F.col("c_acctbal")).alias("never"), F.lit("").alias("blank"),
        F.when(F.col("c_custkey") == 7, F.lit("x")).otherwise(F.lit("")).alias("once"),
        F.array().cast("array<string>").alias("no_tags"),
        F.lit(0).alias("zero"),
    )


def filled_columns(spark, sf_dir):
    return tb.filled_columns(_customers_with_gaps(spark, sf_dir))


_GAPS_SQL = """
SELECT c_custkey, c_name, CASE WHEN c_acctbal < -5000 THEN c_acctbal END AS never, '' AS blank,
       CASE WHEN c_custkey = 7 THEN 'x' ELSE '' END AS once, CAST([] AS VARCHAR[]) AS no_tags, 0 AS zero FROM customer"""
_GAP_TESTS = {
    "c_custkey": "c_custkey IS NOT NULL", "c_name": "c_name <> ''", "never": "never IS NOT NULL", "blank": "blank <> ''",
    "once": "once <> ''", "no_tags": "len(no_tags) > 0", "zero": "zero IS NOT NULL",
}

FILLED_COLUMNS = (
    "SELECT " + ", ".join(f"CAST(coalesce(max(CASE WHEN {t} THEN 1 ELSE 0 END), 0) AS INTEGER) AS {c}" for c, t in _GAP_TESTS.items())
    + f" FROM ({_GAPS_SQL})"
)


def prune_empty_columns(spark, sf_dir):
    """Columns left, with their values: one row per column and text of a value."""
    kept = tb.prune_empty_columns(_customers_with_gaps(spark, sf_dir))
    cells = F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in kept.columns])
    return kept.select(F.explode(cells).alias("cell")).groupBy("cell.name", "cell.value").agg(F.count("*").alias("n_rows"))


PRUNE_EMPTY_COLUMNS = " UNION ALL ".join(
    f"SELECT '{c}' AS name, CAST({c} AS VARCHAR) AS value, count(*) AS n_rows FROM ({_GAPS_SQL}) "
    f"WHERE EXISTS (SELECT 1 FROM ({_GAPS_SQL}) WHERE {t}) GROUP BY ALL"
    for c, t in _GAP_TESTS.items()
)


def mapping_as_of(spark, sf_dir):
    """The variety of each line as of its ship date: suppliers as products, orders as the mapping's history."""
    history = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("product"), F.col("o_orderpriority").alias("variety_key"), F.col("o_orderdate").alias("since")
    )
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_suppkey").alias("product"), F.col("l_shipdate").alias("day")
    )
    ranges = validity_ranges(history, ["product"], "variety_key", "since")
    return as_of_join(lines, ranges, ["product"], "variety_key", "day").drop("day")


MAPPING_AS_OF = """
SELECT l_orderkey, l_linenumber, l_suppkey AS product, variety_key
FROM lineitem ASOF LEFT JOIN (
  SELECT o_custkey, o_orderdate, max(o_orderpriority) AS variety_key FROM orders GROUP BY o_custkey, o_orderdate
) ON l_suppkey = o_custkey AND l_shipdate >= o_orderdate"""


def first_n_ordered(spark, sf_dir):
    """A plain limit: the first rows of a stated order."""
    lines = table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    return first_rows(lines, 12000, "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")


FIRST_N_ORDERED = """
SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber FROM lineitem ORDER BY ALL LIMIT 12000"""

QUERIES = {
    "price_mapping_join": Query(price_mapping_join, PRICE_MAPPING_JOIN),
    "mapping_as_of": Query(mapping_as_of, MAPPING_AS_OF),
    "new_products": Query(new_products, NEW_PRODUCTS),
    "source_summary": Query(source_summary, SOURCE_SUMMARY),
    "summary_text": Query(summary_text, SUMMARY_TEXT),
    "variety_price_range": Query(variety_price_range, VARIETY_PRICE_RANGE),
    "price_comparison": Query(price_comparison, PRICE_COMPARISON),
    "grower_view": Query(grower_view, GROWER_VIEW),
    "volume_drop": Query(volume_drop, VOLUME_DROP),
    "capped_sources": Query(capped_sources, CAPPED_SOURCES),
    "stock_alert": Query(stock_alert, STOCK_ALERT),
    "allowlist_projection": Query(allowlist_projection, ALLOWLIST_PROJECTION),
    "filled_columns": Query(filled_columns, FILLED_COLUMNS),
    "prune_empty_columns": Query(prune_empty_columns, PRUNE_EMPTY_COLUMNS),
    "first_n_ordered": Query(first_n_ordered, FIRST_N_ORDERED),
}
