"""Registered queries: prices, tiers and margins."""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.functions import measures as ms
from bloomledger.functions import prices as pr
from bloomledger.operators.conformers import without_price
from bloomledger.workloads.common import PRICE_TEXT, Query, sql_round_cents, table

_KEY = ["l_orderkey", "l_linenumber"]

# Offers of one listing row: two to four quantities with their prices.
_OFFERS = f"""CAST(l_quantity AS INT) || ' @ $' || {PRICE_TEXT} || ', '
|| (CAST(l_quantity AS INT) * 2) || '@' || ({PRICE_TEXT} * 2 - l_linenumber) || ' or '
|| CASE l_linenumber % 3 WHEN 0 THEN '0 @ $1.00' WHEN 1 THEN l_linenumber || '  @  $' || CAST(ROUND(l_tax * 100) AS INT) || '.50' ELSE '5 @ 7' END"""


def best_offer(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*_KEY, F.expr(_OFFERS).alias("offers"))
    found = lines.select(*_KEY, ms.quantity_prices(F.col("offers")).alias("parsed"))
    best = found.select(*_KEY, F.size("parsed").cast("bigint").alias("n_offers"), pr.best_value(F.col("parsed")).alias("b"))
    return best.select(*_KEY, "n_offers", F.col("b.qty").alias("qty"), F.col("b.price").alias("price"))


BEST_OFFER = rf"""
WITH texts AS (SELECT row_number() OVER () AS id, l_orderkey, l_linenumber, {_OFFERS} AS t FROM lineitem),
found AS (
  SELECT id, l_orderkey, l_linenumber,
         regexp_extract_all(t, '(\d+)\s*@\s*\$?(\d+\.\d+)', 1) AS qs,
         regexp_extract_all(t, '(\d+)\s*@\s*\$?(\d+\.\d+)', 2) AS ps FROM texts),
offers AS (
  SELECT id, unnest(qs)::BIGINT AS qty, unnest(ps)::DOUBLE AS price, generate_subscripts(qs, 1) AS pos FROM found),
ranked AS (
  SELECT id, qty, price, row_number() OVER (PARTITION BY id ORDER BY price / qty, pos) AS r FROM offers WHERE qty <> 0)
SELECT l_orderkey, l_linenumber, CAST(len(qs) AS BIGINT) AS n_offers, qty, price
FROM found LEFT JOIN (SELECT * FROM ranked WHERE r = 1) USING (id)"""


def tier_price(spark, sf_dir):
    def tier(selection, landed):
        return F.struct(F.lit(selection).alias("selection"), landed.cast("string").alias("landed_price"))

    price = F.expr(PRICE_TEXT)
    lines = table(spark, sf_dir, "lineitem")
    tiers = F.array(
        tier("two", F.lit("1.00")),
        tier("one", F.when(F.col("l_linenumber") % 2 == 0, F.lit("n/a")).otherwise(price.cast("string"))),
        tier("three", F.when(F.col("l_linenumber") == 6, F.lit(None)).otherwise(F.lit("12.5"))),
        tier("one", F.when(F.col("l_returnflag") == "R", F.lit(" 99.50 "))),
    )
    tiers = F.when(F.col("l_linenumber") != 5, tiers)
    return lines.select(*_KEY, pr.tier_price(tiers).alias("landed_price"))


TIER_PRICE = f"""
SELECT l_orderkey, l_linenumber, CAST(CASE
  WHEN l_linenumber = 5 THEN NULL
  WHEN l_linenumber % 2 = 1 THEN {PRICE_TEXT}
  WHEN l_returnflag = 'R' THEN 99.5
  WHEN l_linenumber <> 6 THEN 12.5 END AS DOUBLE) AS landed_price
FROM lineitem"""


def round_cents(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    ratio = F.col("l_extendedprice") / F.col("l_quantity")
    return lines.select(
        *_KEY,
        pr.round_cents(ratio).alias("per_piece"),
        pr.round_cents(F.col("l_extendedprice") / 8.0).alias("eighth"),
    )


ROUND_CENTS = f"""
SELECT l_orderkey, l_linenumber, {sql_round_cents('l_extendedprice / l_quantity')} AS per_piece,
       {sql_round_cents('l_extendedprice / 8e0')} AS eighth FROM lineitem"""


def per_stem_price(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    stems = F.col("l_quantity").cast("bigint")
    each = F.expr("CASE l_linenumber % 3 WHEN 0 THEN 0D WHEN 1 THEN NULL ELSE l_tax + 1 END")
    unit = F.expr("CASE WHEN l_linenumber = 4 THEN 0D ELSE l_extendedprice END")
    return lines.select(
        *_KEY,
        pr.price_per_stem(F.col("l_extendedprice"), stems).alias("from_tier"),
        pr.each_price_or_share(each, unit, stems).alias("from_title"),
    )


PER_STEM_PRICE = f"""
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity > 1 THEN {sql_round_cents('l_extendedprice / l_quantity')} ELSE l_extendedprice END AS from_tier,
       CASE WHEN l_linenumber % 3 = 2 THEN l_tax + 1e0
            WHEN l_linenumber <> 4 THEN {sql_round_cents('l_extendedprice / l_quantity')}
            WHEN l_linenumber % 3 = 0 THEN 0e0 END AS from_title
FROM lineitem"""


def margin(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    markup = F.expr("CASE l_linenumber WHEN 1 THEN 0D WHEN 2 THEN NULL ELSE 1 + l_discount END")
    return lines.select(*_KEY, pr.margin_percent(markup).alias("margin"))


MARGIN = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber > 2 THEN (1e0 - (1e0 / (1 + l_discount))) * 1e2 END AS margin
FROM lineitem"""

_PRICE_WORDS = f"CASE l_linenumber % 3 WHEN 0 THEN 'from $' || {PRICE_TEXT} || ' to $9' WHEN 1 THEN CAST(l_quantity AS INT) || ' each' ELSE 'on request' END"


def first_price(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(*_KEY, ms.first_price(F.expr(_PRICE_WORDS)).alias("price"))


FIRST_PRICE = f"""
SELECT l_orderkey, l_linenumber, CAST(CASE l_linenumber % 3 WHEN 0 THEN {PRICE_TEXT} WHEN 1 THEN l_quantity END AS DOUBLE) AS price
FROM lineitem"""


def missing_price(spark, sf_dir):
    priced = table(spark, sf_dir, "lineitem").select(
        *_KEY, F.when(F.col("l_discount") < 0.09, F.col("l_extendedprice")).alias("stem_price")
    )
    return without_price(priced).select(*_KEY)


MISSING_PRICE = "SELECT l_orderkey, l_linenumber FROM lineitem WHERE NOT l_discount < 9e-2"


def missing_value_rules(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_nationkey") % 2 == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    return customers.select(
        "c_custkey",
        pr.id_text(F.col("c_nationkey")).alias("nation_id"),
        pr.text_or_else(segment, F.col("c_name")).alias("label"),
        pr.count_or_else(F.col("c_nationkey").cast("bigint"), F.lit(-1).cast("bigint")).alias("nation"),
        pr.number_or_else(F.round(F.col("c_acctbal") / 10000) * 1.0, F.lit(-1.0)).alias("level"),
        pr.prefixed_url(fv.INVENTORY_URL_PREFIX, segment).alias("url"),
    )


MISSING_VALUE_RULES = f"""
SELECT c_custkey, CASE WHEN c_nationkey <> 0 THEN CAST(c_nationkey AS VARCHAR) END AS nation_id,
       CASE WHEN c_nationkey % 2 = 0 THEN c_name ELSE c_mktsegment END AS label,
       CAST(CASE WHEN c_nationkey = 0 THEN -1 ELSE c_nationkey END AS BIGINT) AS nation,
       CASE WHEN round(c_acctbal / 10000) = 0 THEN -1e0 ELSE round(c_acctbal / 10000) END AS level,
       CASE WHEN c_nationkey % 2 <> 0 THEN '{fv.INVENTORY_URL_PREFIX}' || c_mktsegment END AS url
FROM customer"""

QUERIES = {
    "parse_qty_price_best_tier": Query(best_offer, BEST_OFFER),
    "tier_price": Query(tier_price, TIER_PRICE),
    "round_cents": Query(round_cents, ROUND_CENTS),
    "per_stem_price": Query(per_stem_price, PER_STEM_PRICE),
    "margin": Query(margin, MARGIN),
    "first_price": Query(first_price, FIRST_PRICE),
    "missing_price": Query(missing_price, MISSING_PRICE),
    "missing_value_rules": Query(missing_value_rules, MISSING_VALUE_RULES),
}
