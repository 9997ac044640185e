"""Registered queries: payload pages, conformers and checks on them.

Payload pages are made by Spark from the given tables (one page per row, a few
products on each) and then read back like landed ones.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger import schema as sc
from bloomledger.operators import conformers as cf
from bloomledger.operators.dates import earliest_delivery_date, stamp_eta
from bloomledger.operators.filters import removed_count, union_sources
from bloomledger.sources import html_pages as hp
from bloomledger.sources import json_pages as jp
from bloomledger.workloads.common import (
    FROM_LINES_WITH_PARTS,
    LISTING_NAME,
    PRICE_TEXT,
    SPARK_LISTING_NAME,
    Query,
    lines_with_parts,
    sql_aggressive_clean,
    sql_merged_or_range,
    sql_round_cents,
    sql_safe_clean,
    sql_stem_length,
    sql_stems_per_unit,
    spread,
    table,
)

_KEY = ("l_orderkey", "l_linenumber")
_DAY, _ETA = "2024-02-01", "2024-02-14"


def _payload(frame, keep, body):
    """Pages with a JSON payload built by the SQL expression `body`."""
    return frame.select(*keep, F.to_json(F.expr(body)).alias("payload"))


def _conformed(rows, columns):
    """Valid and rejected rows of a conformer with the columns worth comparing."""
    out = sc.conform(stamp_eta(rows, _ETA), F.lit(_DAY))
    return out.select(*columns, "created_at", "eta_date", sc.REJECT_REASON)


# --- inventory feed ------------------------------------------------------------

_INVENTORY_BODY = f"""named_struct('products', array(
  named_struct('product_id', l_partkey, 'name', {SPARK_LISTING_NAME}, 'category_name', ' ' || p_type || ' ',
    'category_id', p_size % 5, 'unit_type', 'Bunch',
    'color_name', CASE WHEN l_linenumber = 1 THEN NULL ELSE ' Red ' END,
    'grade_name', p_size || 'cm', 'unit_count', CASE WHEN l_linenumber % 2 = 0 THEN 0D ELSE l_quantity END,
    'price_per_unit', CAST(l_extendedprice AS STRING), 'price_per_stem', l_extendedprice / l_quantity,
    'main_landed_cost', l_extendedprice * (1 - l_discount), 'freight', CASE WHEN l_linenumber = 6 THEN 'n/a' ELSE CAST(l_tax AS STRING) END,
    'markup', CASE l_linenumber WHEN 3 THEN 0D WHEN 4 THEN NULL ELSE 1 + l_discount END,
    'qty', CAST(CAST(l_quantity AS BIGINT) AS STRING), 'farm_name', p_brand, 'country_name', l_returnflag,
    'seo_url', CASE WHEN l_linestatus = 'F' THEN '' ELSE 'p/' || l_partkey END, 'unknown', 1)))"""

_INVENTORY_COLUMNS = [
    "competitor", "competitor_product_id", "competitor_product_name", "competitor_product_group_name",
    "competitor_product_group_id", "unit", "state", "color", "stem_length", "stems_per_unit", "unit_price",
    "stem_price", "base_price", "freight_price", "margin", "available_units", "grower_name",
    "grower_country", "highlight_name", "product_url", "product_group_key",
]


def inventory_products(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), _KEY, _INVENTORY_BODY)
    return cf.conform_inventory(jp.inventory_rows(pages))


def conform_json_feed(spark, sf_dir):
    return _conformed(inventory_products(spark, sf_dir), _INVENTORY_COLUMNS)


CONFORM_JSON_FEED = f"""
SELECT '{fv.SOURCE_LABELS["mayesh"]}' AS competitor,
  CASE WHEN l_partkey <> 0 THEN CAST(l_partkey AS VARCHAR) END AS competitor_product_id,
  {sql_aggressive_clean('raw_name')} AS competitor_product_name,
  p_type AS competitor_product_group_name,
  CASE WHEN p_size % 5 <> 0 THEN CAST(p_size % 5 AS VARCHAR) END AS competitor_product_group_id,
  'Bunch' AS unit, '{fv.INVENTORY_STATE}' AS state,
  CASE WHEN l_linenumber = 1 THEN '' ELSE 'Red' END AS color,
  COALESCE(NULLIF({sql_stem_length('raw_name')}, 0), CAST(p_size AS BIGINT)) AS stem_length,
  CASE WHEN l_linenumber % 2 = 0 THEN {sql_stems_per_unit('raw_name')} ELSE CAST(l_quantity AS BIGINT) END AS stems_per_unit,
  l_extendedprice AS unit_price, l_extendedprice / l_quantity AS stem_price,
  l_extendedprice * (1 - l_discount) AS base_price, CASE WHEN l_linenumber <> 6 THEN l_tax END AS freight_price,
  CASE WHEN l_linenumber NOT IN (3, 4) THEN (1e0 - 1e0 / (1 + l_discount)) * 1e2 END AS margin,
  CAST(l_quantity AS BIGINT) AS available_units, p_brand AS grower_name, l_returnflag AS grower_country,
  CAST(NULL AS VARCHAR) AS highlight_name,
  CASE WHEN l_linestatus <> 'F' THEN '{fv.INVENTORY_URL_PREFIX}p/' || l_partkey END AS product_url,
  CASE WHEN p_size % 5 <> 0 THEN CAST(p_size % 5 AS VARCHAR) END AS product_group_key,
  '{_DAY}' AS created_at, '{_ETA}' AS eta_date,
  CASE WHEN l_partkey = 0 THEN 'missing competitor_product_id' WHEN l_linenumber = 6 THEN 'unreadable freight_price' END AS reject_reason
FROM (SELECT *, {LISTING_NAME} AS raw_name {FROM_LINES_WITH_PARTS})"""

# --- listing feed ----------------------------------------------------------------

_LISTING_BODY = f"""named_struct('pages', array('1', CAST(l_linenumber AS STRING)), 'items', CASE WHEN l_linenumber <> 6 THEN array(
  named_struct('id', l_orderkey * 10 + l_linenumber, 'name', {SPARK_LISTING_NAME}, 'cat', ' ' || p_type, 'unit', 'Box',
    'unit_price', CASE WHEN l_linenumber = 2 THEN CAST({PRICE_TEXT} AS STRING) END, 'grower_country', l_returnflag,
    'prices_data', CASE WHEN l_linenumber > 2 THEN array(
       named_struct('selection', 'three', 'landed_price', CAST({PRICE_TEXT} AS STRING), 'stock', '10'),
       named_struct('selection', 'one', 'landed_price', CASE WHEN l_linenumber = 3 THEN 'sold out' ELSE '81.35' END, 'stock', '3')) END),
  named_struct('id', 0, 'name', '', 'cat', NULL, 'unit', NULL, 'unit_price', NULL, 'grower_country', NULL, 'prices_data', NULL)) END)"""

_LISTING_COLUMNS = [
    "competitor", "competitor_product_id", "competitor_product_name", "competitor_product_group_name",
    "unit", "stem_length", "stems_per_unit", "stem_price", "grower_country",
]


def listing_products(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), _KEY, _LISTING_BODY)
    return cf.conform_listing(jp.listing_rows(pages))


def conform_listing_feed(spark, sf_dir):
    return _conformed(listing_products(spark, sf_dir), _LISTING_COLUMNS)


_LISTING_PRICE = f"""CAST(CASE l_linenumber WHEN 1 THEN NULL WHEN 2 THEN {PRICE_TEXT} WHEN 3 THEN {PRICE_TEXT} ELSE 81.35 END AS DOUBLE)"""

CONFORM_LISTING_FEED = f"""
WITH named AS (SELECT *, {LISTING_NAME} AS raw_name {FROM_LINES_WITH_PARTS} WHERE l_linenumber <> 6),
read AS (SELECT *, CASE WHEN {sql_stems_per_unit('raw_name')} = 0 THEN 1 ELSE {sql_stems_per_unit('raw_name')} END AS stems,
                {_LISTING_PRICE} AS price FROM named)
SELECT '{fv.SOURCE_LABELS["flowermarketplace"]}' AS competitor, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS competitor_product_id,
  {sql_aggressive_clean('raw_name')} AS competitor_product_name, p_type AS competitor_product_group_name, 'Box' AS unit,
  {sql_stem_length('raw_name')} AS stem_length, CAST(stems AS BIGINT) AS stems_per_unit,
  CASE WHEN stems > 1 THEN {sql_round_cents('price / stems')} ELSE price END AS stem_price, l_returnflag AS grower_country,
  '{_DAY}' AS created_at, '{_ETA}' AS eta_date, CAST(NULL AS VARCHAR) AS reject_reason FROM read
UNION ALL
SELECT '{fv.SOURCE_LABELS["flowermarketplace"]}', NULL, NULL, '', NULL, NULL, 1, NULL, NULL, '{_DAY}', '{_ETA}', 'missing competitor_product_id' FROM named"""

# --- product feed with variants -----------------------------------------------------

_VARIANT_BODY = f"""named_struct('products', CASE WHEN l_linenumber <> 5 THEN array(
  named_struct('id', l_partkey + 1, 'title', ' ' || p_name || '  Rose ($' || {PRICE_TEXT} || ' Each) ', 'product_type', p_type || ' ',
    'tags', CASE WHEN l_linenumber = 1 THEN array() ELSE array(' ' || p_brand, 'x') END,
    'variants', array(
      named_struct('title', CAST(l_quantity AS INT) || ' Stems ($' || {PRICE_TEXT} || ' Each)', 'price', CAST({PRICE_TEXT} AS STRING)),
      named_struct('title', {SPARK_LISTING_NAME}, 'price', CASE l_linenumber WHEN 2 THEN '0' WHEN 3 THEN 'ask' ELSE CAST({PRICE_TEXT} AS STRING) END)))) END)"""

_VARIANT_COLUMNS = [
    "competitor", "competitor_product_id", "competitor_variant_id", "competitor_product_name",
    "competitor_product_group_name", "color", "stem_length", "stems_per_unit", "unit_price", "stem_price",
]


def variant_products(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), _KEY, _VARIANT_BODY)
    return cf.conform_variants(jp.variant_rows(pages))


def conform_variant_feed(spark, sf_dir):
    return _conformed(variant_products(spark, sf_dir), _VARIANT_COLUMNS)


def _variant_select(stem_length, stems, unit_price, stem_price):
    return f"""
SELECT '{fv.SOURCE_LABELS["petaljet"]}' AS competitor, CAST(l_partkey + 1 AS VARCHAR) AS competitor_product_id,
  CAST(NULL AS VARCHAR) AS competitor_variant_id, p_name || ' Rose' AS competitor_product_name,
  p_type AS competitor_product_group_name, CASE WHEN l_linenumber = 1 THEN '' ELSE p_brand END AS color,
  {stem_length} AS stem_length, {stems} AS stems_per_unit, {unit_price} AS unit_price, {stem_price} AS stem_price,
  '{_DAY}' AS created_at, '{_ETA}' AS eta_date, CAST(NULL AS VARCHAR) AS reject_reason FROM read"""


CONFORM_VARIANT_FEED = f"""
WITH named AS (SELECT *, {LISTING_NAME} AS raw_name, CAST({PRICE_TEXT} AS DOUBLE) AS price {FROM_LINES_WITH_PARTS} WHERE l_linenumber <> 5),
read AS (SELECT *, {sql_stems_per_unit('raw_name')} AS stems,
  CASE l_linenumber WHEN 2 THEN 0e0 WHEN 3 THEN NULL ELSE price END AS second_price FROM named)
{_variant_select(sql_stem_length("(CAST(l_quantity AS INT) || ' Stems ($' || " + PRICE_TEXT + " || ' Each)')"), "CAST(l_quantity AS BIGINT)", "price", "price")}
UNION ALL
{_variant_select(sql_stem_length('trim(raw_name)'), "stems", "second_price",
                 f"CASE WHEN second_price <> 0 AND stems <> 0 THEN {sql_round_cents('second_price / stems')} END")}"""

# --- HTML feed -------------------------------------------------------------------------

_PAGE_URL = "'https://shop.example/' || p_brand || '/' || p_partkey"
_PART_PRICE = "CAST(p_retailprice AS DECIMAL(18,2))"
_PART_NAME = """p_name || CASE p_partkey % 5
  WHEN 0 THEN ' CO ' || p_size || '/' || (p_size + 10) || 'cm' WHEN 1 THEN ' Wht EC' WHEN 2 THEN ' ' || (p_size + 20) || (p_size + 30)
  WHEN 3 THEN ' ' || p_size || '-' || (p_size + 5) || ' x10' ELSE '  Rd ' END"""
_CELLS_REST = "<td></td><td>.</td><td>.</td><td><a>$3.00</a></td></tr>"
_HIDDEN_ROW = f"<tr><td>9</td><td>hidden</td><td><a>hidden</a></td><td>Box</td><td>1 @ 0.01</td>{_CELLS_REST}"
# Every fourth page has a table in a cell, with cells that end nowhere; another fourth a form in the form.
_INNER_TABLE = "' || CASE p_partkey % 4 WHEN 1 THEN '<table><tr><td>in<td>ner</table>' ELSE '' END || '"
_INNER_FORM = "' || CASE p_partkey % 4 WHEN 2 THEN '<form>' ELSE '' END || '"
_PART_PAGE = f"""'<html><body><div data-id="PageText"><form></form><form><table>{_HIDDEN_ROW}</table></form></div>
<div class="x" id="PageText"><div><p>Welcome</p></div><form><table><tr><td>search</td></tr></table></form>
<form method=post>{_INNER_FORM}<table width=9><tbody><tr><th>No</th></tr>
<tr><td>.</td><td>Item ##</td><td>Name</td><td>Sold as</td><td>Offer</td><td>.</td><td>.</td><td>.</td><td>Price</td></tr>
<TR class="a"><td>1<td> <b>' || p_partkey || '</b> </td><td><a href="/p"> ' || {_PART_NAME} || ' </a><br>Origin: ' || p_brand
|| ' </td><td>Box &amp;&nbsp;Bag&#39;s</td><td>' || p_size || ' @ $' || {_PART_PRICE} || ' <i>' || (p_size * 2) || '</i> @ ' || ({_PART_PRICE} * 2 - p_partkey % 2)
|| '</td>{_CELLS_REST.replace('</td></tr>', _INNER_TABLE + '</td></tr>')}<tr><td>short</td></tr><!-- <tr><td>no</td></tr> {_HIDDEN_ROW} -->
<tr><td>2</td><td>' || p_partkey || '</td><td><a>again</a></td><td>Box</td><td>1 @ 0.01</td>{_CELLS_REST}
<tr><td>3</td><td>' || p_partkey || '-B</td><td>no link</td><td></td><td>call</td>{_CELLS_REST}
</tbody><tbody>{_HIDDEN_ROW}</tbody></table><table>{_HIDDEN_ROW}</table></form></div>
<form><table>{_HIDDEN_ROW}</table></form></body></html>'"""
# Every tenth page landed twice.
_LANDINGS = "CASE WHEN p_partkey % 10 = 0 THEN array(1, 2) ELSE array(1) END"


def html_products(spark, sf_dir):
    pages = spread(table(spark, sf_dir, "part")).select(
        F.expr(_PAGE_URL).alias("url"), F.expr(_PART_PAGE).alias("html"), F.explode(F.expr(_LANDINGS)).alias("landing")
    )
    context = table(spark, sf_dir, "part").select(
        F.expr(_PAGE_URL).alias("url"), F.col("p_type").alias("product_group"), F.col("p_brand").alias("color")
    )
    return cf.conform_html(hp.with_page_context(hp.listing_table_items(pages), context))


_HTML_COLUMNS = [
    "competitor", "competitor_product_id", "competitor_product_name", "competitor_product_group_name", "unit",
    "color", "stem_length", "stems_per_unit", "unit_price", "stem_price", "available_units", "grower_country",
]


def conform_html_feed(spark, sf_dir):
    return _conformed(html_products(spark, sf_dir), _HTML_COLUMNS)


_SQL_CODES = r"regexp_replace(regexp_replace(trim(raw), '\s+[A-Z]{2}$', '', 'g'), '\s+[A-Z]{2}\s+', ' ', 'g')"

CONFORM_HTML_FEED = f"""
WITH named AS (SELECT *, {_PART_NAME} AS raw, CAST({_PART_PRICE} AS DOUBLE) AS p1, CAST({_PART_PRICE} * 2 - p_partkey % 2 AS DOUBLE) AS p2 FROM part),
landed AS (SELECT * FROM named UNION ALL SELECT * FROM named WHERE p_partkey % 10 = 0),
coded AS (SELECT *, {_SQL_CODES} AS name, p1 / p_size <= p2 / (p_size * 2) AS first_wins FROM landed)
SELECT '{fv.SOURCE_LABELS["dvflora"]}' AS competitor, CAST(p_partkey AS VARCHAR) AS competitor_product_id,
  {sql_aggressive_clean('name')} AS competitor_product_name, p_type AS competitor_product_group_name,
  'Box &' || chr(160) || 'Bag''s' AS unit, p_brand AS color,
  COALESCE(NULLIF({sql_stem_length('name')}, 0), {sql_merged_or_range('name')}) AS stem_length,
  {sql_stems_per_unit('name')} AS stems_per_unit,
  CASE WHEN first_wins THEN p1 ELSE p2 END AS unit_price, CASE WHEN first_wins THEN p1 ELSE p2 END AS stem_price,
  CAST(CASE WHEN first_wins THEN p_size ELSE p_size * 2 END AS BIGINT) AS available_units, p_brand AS grower_country,
  '{_DAY}' AS created_at, '{_ETA}' AS eta_date, CAST(NULL AS VARCHAR) AS reject_reason FROM coded
UNION ALL
SELECT '{fv.SOURCE_LABELS["dvflora"]}', p_partkey || '-B', NULL, p_type, '', p_brand, NULL, 1, NULL, NULL, NULL, '', '{_DAY}', '{_ETA}', NULL FROM landed"""


# --- all sources ---------------------------------------------------------------------------


def union_of_sources(spark, sf_dir):
    """Counts per source and reason over the union of all four feeds."""
    rows = union_sources(
        *[
            sc.conform(stamp_eta(feed(spark, sf_dir), _ETA), F.lit(_DAY))
            for feed in (inventory_products, listing_products, variant_products, html_products)
        ]
    )
    return rows.groupBy("competitor", sc.REJECT_REASON).agg(
        F.count("*").alias("n_rows"), F.count("stem_price").alias("n_priced")
    )


UNION_OF_SOURCES = f"""
SELECT competitor, reject_reason, count(*) AS n_rows, count(stem_price) AS n_priced FROM (
  SELECT competitor, reject_reason, stem_price FROM ({CONFORM_JSON_FEED})
  UNION ALL SELECT competitor, reject_reason, stem_price FROM ({CONFORM_LISTING_FEED})
  UNION ALL SELECT competitor, reject_reason, stem_price FROM ({CONFORM_VARIANT_FEED})
  UNION ALL SELECT competitor, reject_reason, stem_price FROM ({CONFORM_HTML_FEED}))
GROUP BY ALL"""


def conform_validate(spark, sf_dir):
    """Rows with missing keys and unreadable values, counted by reason."""
    broken = table(spark, sf_dir, "lineitem").select(
        F.expr("CASE WHEN l_linenumber <> 1 THEN l_returnflag END").alias("competitor"),
        F.expr("CASE WHEN l_linenumber <> 2 THEN l_partkey END").alias("competitor_product_id"),
        F.expr("CASE WHEN l_linenumber = 3 THEN l_discount * 100 + 0.5 ELSE l_quantity END").alias("stem_length"),
        F.expr("CASE WHEN l_linenumber = 4 THEN 'n/a' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END").alias("available_units"),
        F.expr("CASE WHEN l_linenumber = 5 THEN 'ask' ELSE CAST(l_tax AS STRING) END").alias("stem_price"),
        F.col("l_linestatus").alias("not_a_field"),
    )
    checked = sc.conform(broken, F.lit(_DAY))
    return checked.groupBy(F.coalesce(sc.REJECT_REASON, F.lit("valid")).alias("reason")).agg(
        F.count("*").alias("n_rows"), F.sum("available_units").alias("units")
    )


CONFORM_VALIDATE = """
SELECT CASE l_linenumber WHEN 1 THEN 'missing competitor' WHEN 2 THEN 'missing competitor_product_id'
         WHEN 3 THEN CASE WHEN l_discount * 100 + 0.5 <> floor(l_discount * 100 + 0.5) THEN 'unreadable stem_length' ELSE 'valid' END
         WHEN 4 THEN 'unreadable available_units' WHEN 5 THEN 'unreadable stem_price' ELSE 'valid' END AS reason,
       count(*) AS n_rows, CAST(sum(CASE WHEN l_linenumber <> 4 THEN l_quantity END) AS BIGINT) AS units
FROM lineitem GROUP BY 1"""

# --- pages ------------------------------------------------------------------------------


def json_props(spark, sf_dir):
    """Event properties as payloads: the elements of an array built from `k`."""
    events = table(spark, sf_dir, "events")
    wrapped = F.concat(
        F.lit('{"dates": [{"delivery_date": "'), F.date_format("ts", "yyyy-MM-dd"),
        F.lit('", "program_id": '), F.get_json_object("props", "$.k"), F.lit("}]}"),
    )
    payload = F.when(F.col("event_id") % 10 == 0, F.lit('{"dates": [')).otherwise(wrapped)
    return jp.delivery_dates(events.select("event_id", payload.alias("payload")))


JSON_PROPS = """
SELECT strftime(ts, '%Y-%m-%d') AS delivery_date, CAST(json_extract(props, '$.k') AS INTEGER) AS program_id
FROM events WHERE event_id % 10 <> 0"""


def unreadable_pages(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    payload = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props"))
    pages = events.select("event_id", payload.alias("payload"))
    return jp.unreadable_pages(pages, "k int").select("event_id")


UNREADABLE_PAGES = "SELECT event_id FROM events WHERE event_type = 'error'"


def listing_pages(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), _KEY, _LISTING_BODY)
    return jp.listing_rows(pages).select(*_KEY, F.col("item.id").cast("string").alias("id"), "item.unit", F.size("item.prices_data").alias("n_tiers"))


LISTING_PAGES = f"""
SELECT l_orderkey, l_linenumber, CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS id, 'Box' AS unit,
       CAST(CASE WHEN l_linenumber > 2 THEN 2 END AS INTEGER) AS n_tiers {FROM_LINES_WITH_PARTS} WHERE l_linenumber <> 6
UNION ALL SELECT l_orderkey, l_linenumber, '0', NULL, NULL {FROM_LINES_WITH_PARTS} WHERE l_linenumber <> 6"""


def variant_pages(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), _KEY, _VARIANT_BODY)
    return jp.variant_rows(pages).select(
        *_KEY, F.col("item.id").cast("string").alias("id"), "item.product_type", F.size("item.variants").alias("n_variants")
    )


VARIANT_PAGES = f"""
SELECT l_orderkey, l_linenumber, CAST(l_partkey + 1 AS VARCHAR) AS id, p_type || ' ' AS product_type, 2 AS n_variants
{FROM_LINES_WITH_PARTS} WHERE l_linenumber <> 5"""


def page_item_counts(spark, sf_dir):
    pages = _payload(lines_with_parts(spark, sf_dir), ["p_brand"], _LISTING_BODY)
    return jp.items_per_page(pages).groupBy("p_brand").agg(
        F.count("*").alias("n_pages"), F.sum("n_items").alias("n_items")
    )


PAGE_ITEM_COUNTS = f"""
SELECT p_brand, count(*) AS n_pages, CAST(sum(CASE WHEN l_linenumber <> 6 THEN 2 ELSE 0 END) AS BIGINT) AS n_items
{FROM_LINES_WITH_PARTS} GROUP BY p_brand"""


def announced_pages(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    pages = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN array('1', substring(o_orderpriority, 1, 1)) "
        "WHEN 'O' THEN array('1', o_orderpriority) ELSE array('1') END"
    )
    return orders.select("o_orderkey", jp.page_count(pages).alias("n_pages"))


ANNOUNCED_PAGES = """
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderpriority[1] AS INTEGER) ELSE 1 END AS n_pages FROM orders"""


def page_completeness(spark, sf_dir):
    """Lines 1..n missing from an order, n being the priority digit of the order."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).cast("int").alias("n_pages")
    )
    landed = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_linenumber").alias("page")
    )
    return jp.missing_pages(orders, landed, "o_orderkey")


PAGE_COMPLETENESS = """
SELECT o_orderkey, page FROM (
  SELECT o_orderkey, unnest(generate_series(1, CAST(o_orderpriority[1] AS BIGINT))) AS page FROM orders) w
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_linenumber = page)"""

_PAGE_GROUP = "CASE WHEN page_id % 3 = 0 THEN 'Roses' ELSE 'Other' END"


def page_context_join(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    context = pages.select("url", F.expr(_PAGE_GROUP).alias("product_group")).distinct()
    joined = hp.with_page_context(pages, context)
    return joined.select("page_id", "url", "product_group", F.length("html").cast("bigint").alias("html_length"))


PAGE_CONTEXT_JOIN = f"""
SELECT page_id, url, product_group, CAST(length(html) AS BIGINT) AS html_length
FROM pages JOIN (SELECT DISTINCT url, {_PAGE_GROUP} AS product_group FROM pages) USING (url)"""


def html_rows(spark, sf_dir):
    return hp.list_items(table(spark, sf_dir, "pages").select("page_id", "html")).drop("li")


HTML_ROWS = r"""
WITH items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1)) AS li,
         generate_subscripts(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1), 1) - 1 AS pos FROM pages)
SELECT page_id, CAST(pos AS INTEGER) AS row_pos,
       trim(replace(replace(replace(regexp_replace(li, '(?s)\s*</?[a-zA-Z!][^>]*>\s*', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS item_text
FROM items"""


def html_links(spark, sf_dir):
    return hp.page_links(table(spark, sf_dir, "pages").select("page_id", "html"))


HTML_LINKS = r"""
SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS row_pos, unnest(l) AS href FROM (
  SELECT page_id, regexp_extract_all(html, '(?is)<a\b[^>]*?\bhref\s*=\s*["'']([^"'']*)["'']', 1) AS l FROM pages)"""


def page_first_dedup(spark, sf_dir):
    """First list item of each text within a page, as it was written; other pages are separate."""
    pages = table(spark, sf_dir, "pages")
    # Items that differ in their markup only are repeats; every other one is set in bold.
    marked = F.regexp_replace("html", r"(?is)<li>(.*?)</li>\s*<li>(.*?)</li>", "<li>$1</li><li><b>$2</b></li><li>$1</li>")
    return hp.list_items(pages.select("page_id", marked.alias("html")), first_only=True)


PAGE_FIRST_DEDUP = r"""
WITH marked AS (
  SELECT page_id, regexp_replace(html, '(?is)<li>(.*?)</li>\s*<li>(.*?)</li>', '<li>\1</li><li><b>\2</b></li><li>\1</li>', 'g') AS html FROM pages),
items AS (
  SELECT page_id, unnest(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1)) AS li,
         generate_subscripts(regexp_extract_all(html, '(?is)<li\b[^>]*>(.*?)</li\s*>', 1), 1) - 1 AS pos FROM marked),
texts AS (
  SELECT *, trim(replace(replace(replace(regexp_replace(li, '(?s)\s*</?[a-zA-Z!][^>]*>\s*', '', 'g'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&')) AS item_text FROM items)
SELECT page_id, item_text, CAST(min(pos) AS INTEGER) AS row_pos, arg_min(li, pos) AS li FROM texts GROUP BY page_id, item_text"""


def earliest_eligible(spark, sf_dir):
    """Every order stamped with the first date of the eligible priority."""
    orders = table(spark, sf_dir, "orders")
    dates = orders.select(
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("delivery_date"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("program_id"),
    )
    return stamp_eta(orders.select("o_orderkey"), earliest_delivery_date(dates))


EARLIEST_ELIGIBLE = """
SELECT o_orderkey, (SELECT min(strftime(o_orderdate, '%Y-%m-%d')) FROM orders WHERE o_orderpriority LIKE '5%') AS eta_date
FROM orders"""


def removed_items(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(
        F.expr("CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'Item ##' ELSE p_name END").alias("competitor_product_id")
    )
    return removed_count(parts)


REMOVED_ITEMS = """
SELECT count(*) FILTER (p_size % 5 > 2) AS n_kept, count(*) FILTER (p_size % 5 <= 2) AS n_removed FROM part"""

QUERIES = {
    "conform_json_feed": Query(conform_json_feed, CONFORM_JSON_FEED),
    "conform_listing_feed": Query(conform_listing_feed, CONFORM_LISTING_FEED),
    "conform_variant_feed": Query(conform_variant_feed, CONFORM_VARIANT_FEED),
    "conform_html_feed": Query(conform_html_feed, CONFORM_HTML_FEED),
    "union_of_sources": Query(union_of_sources, UNION_OF_SOURCES),
    "conform_validate": Query(conform_validate, CONFORM_VALIDATE),
    "json_props": Query(json_props, JSON_PROPS),
    "unreadable_pages": Query(unreadable_pages, UNREADABLE_PAGES),
    "listing_pages": Query(listing_pages, LISTING_PAGES),
    "variant_pages": Query(variant_pages, VARIANT_PAGES),
    "page_item_counts": Query(page_item_counts, PAGE_ITEM_COUNTS),
    "announced_pages": Query(announced_pages, ANNOUNCED_PAGES),
    "page_completeness": Query(page_completeness, PAGE_COMPLETENESS),
    "page_context_join": Query(page_context_join, PAGE_CONTEXT_JOIN),
    "html_rows": Query(html_rows, HTML_ROWS),
    "html_links": Query(html_links, HTML_LINKS),
    "page_first_dedup": Query(page_first_dedup, PAGE_FIRST_DEDUP),
    "earliest_eligible": Query(earliest_eligible, EARLIEST_ELIGIBLE),
    "removed_items": Query(removed_items, REMOVED_ITEMS),
}
