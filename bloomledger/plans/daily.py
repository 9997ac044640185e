"""The daily run: landed payloads of all sources to one conformed price table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bloomledger import fixed_values as fv
from bloomledger import schema as sc
from bloomledger.operators import conformers as cf
from bloomledger.operators.analytics import with_mapping
from bloomledger.operators.dates import earliest_delivery_date, stamp_eta
from bloomledger.operators.filters import union_sources, valid_item
from bloomledger.plans import quarantine as qn
from bloomledger.sinks import manifest as mf
from bloomledger.sinks.tables import append_prices, save_snapshot, snapshot_path
from bloomledger.sources import html_pages as hp
from bloomledger.sources import json_pages as jp


def raw_products(
    source: str, landed: DataFrame, context: DataFrame | None = None, keep: tuple[str, ...] = ()
) -> DataFrame:
    """Conformer columns of one source's landed pages, and those of the page that are in `keep`.

    JSON sources take `payload` texts; the HTML source takes `url` and `payload`
    (or `html`) and the URL list with group and color.
    """
    if source == "mayesh":
        return cf.conform_inventory(jp.inventory_rows(landed), keep=keep)
    if source == "flowermarketplace":
        return cf.conform_listing(jp.listing_rows(landed), keep=keep)
    if source == "petaljet":
        return cf.conform_variants(jp.variant_rows(landed), keep=keep)
    if source == "dvflora":
        if context is None:
            raise ValueError("the HTML source needs its URL list")
        pages = landed.withColumnRenamed("payload", "html").select("url", "html", *keep)
        rows = hp.with_page_context(hp.listing_table_items(pages), context.select("url", "product_group", "color"))
        items = cf.conform_html(rows, keep=keep)
        return items.filter(valid_item(F.col("competitor_product_id")))
    raise ValueError(f"unknown source: {source!r}")


def conformed_products(
    source: str,
    landed: DataFrame,
    eta: str | DataFrame,
    context: DataFrame | None = None,
    created_at: Column | None = None,
) -> DataFrame:
    """All rows of a source in the product schema, with `reject_reason`."""
    return sc.conform(stamp_eta(raw_products(source, landed, context), eta), created_at)


def check_inputs(landed: dict[str, DataFrame], context: DataFrame | None) -> None:
    """Fail before anything is written if a source is unknown or lacks its URL list."""
    for source in landed:
        if source not in fv.SOURCE_LABELS:
            raise ValueError(f"unknown source: {source!r}")
        if source not in fv.EXPORT_COLUMNS:
            raise ValueError(f"no export columns are defined for table {source!r}")
    if "dvflora" in landed and context is None:
        raise ValueError("the HTML source needs its URL list")
    if not landed:
        raise ValueError("no source has landed")


CONFORMED = T.StructType([*sc.PRODUCT_SCHEMA.fields, T.StructField(sc.REJECT_REASON, T.StringType()), T.StructField("source", T.StringType())])


def conformed_rows(spark: SparkSession, root: str, source: str = "", eta: str = "") -> DataFrame:
    """Conformed rows of all days, of a source, or of its day, as the current manifest names them."""
    prefix = "/".join([p for p in (source, eta) if p])
    return mf.read_parts(spark, root, "conformed", CONFORMED, f"{prefix}/" if prefix else "")


def run_day(
    landed: dict[str, DataFrame],
    dates: DataFrame,
    root: str,
    context: DataFrame | None = None,
    created_at: Column | None = None,
    mapping: DataFrame | None = None,
    expected_pages: dict[str, tuple[DataFrame, DataFrame, str]] | None = None,
) -> DataFrame:
    """Conform, store, snapshot and export every source; returns the day's prices.

    All sources are conformed in one job and written once; what could not be used goes to
    quarantine (`plans.quarantine`).  Both become visible together, by one manifest: until then
    readers of `conformed_rows` see the day as it was.  Running a day again replaces all of it,
    also where a source has no rows any more.  Later steps read that table, so raw payloads
    are conformed a single time and a lost executor costs no more than its own tasks.

    mapping: `competitor_product_id`, `variety_key` as of the day (`sinks.tables.read_mapping`);
    prices get their variety key by it.  expected_pages: for a source its listings
    (key, `n_pages`), the pages that landed (key, `page`), and the name of the key.
    """
    check_inputs(landed, context)
    spark = dates.sparkSession
    root = root.rstrip("/")
    eta = earliest_delivery_date(dates).first()["eta_date"]
    if created_at is None:  # one day for all sources, also when the run crosses midnight
        created_at = F.lit(spark.range(1).select(sc.run_date().alias("day")).first()["day"])
    day = str(spark.range(1).select(created_at.cast("string").alias("day")).first()["day"])
    conformed = union_sources(
        *[
            conformed_products(source, pages, eta, context, created_at).withColumn("source", F.lit(source))
            for source, pages in landed.items()
        ]
    )
    if mapping is not None:
        conformed = with_mapping(conformed, mapping)
    parts = mf.write_parts(conformed.select(CONFORMED.names), root, "conformed", ["source", "eta_date"])
    stored = mf.read_folders(spark, root, parts, CONFORMED)
    letters = [qn.unusable_rows(stored)]
    letters += [qn.unreadable(source, pages, eta) for source, pages in landed.items()]
    letters += [qn.page_gaps(source, *about, eta) for source, about in (expected_pages or {}).items()]
    parts |= mf.write_parts(union_sources(*letters), root, "quarantine", ["source", "eta_date"])
    replaced = tuple(f"{table}/{source}/{eta}/" for table in ("conformed", "quarantine", "replayed") for source in landed)
    mf.change(spark, root, parts, replaced)
    days = []
    for source in landed:
        prices = sc.valid_products(conformed_rows(spark, root, source, eta).drop("source")).select(*sc.PRODUCT_SCHEMA.names)
        save_snapshot(prices, snapshot_path(f"{root}/output", source, eta))
        append_prices(prices, source, f"{root}/prices", day)
        days.append(prices)
    return union_sources(*days)


def replay_day(
    spark: SparkSession,
    root: str,
    source: str,
    eta: str,
    created_at: Column,
    context: DataFrame | None = None,
    reader: Callable[[DataFrame], DataFrame] | None = None,
) -> int:
    """Read a source's quarantined pages of a day again; the number of pages that are done now.

    reader: pages (`url`, `payload`, `digest`) to conformer columns that keep `digest`; by default
    the source's own reader, which may have been mended since.  Their rows join the day's conformed
    rows; the price table of the day is brought up to date as well.
    """
    root = root.rstrip("/")

    def conform(pages: DataFrame) -> DataFrame:
        raw = reader(pages) if reader is not None else raw_products(source, pages, context, keep=("digest",))
        rows = sc.conform(stamp_eta(raw, eta), created_at, keep=("digest",)).withColumn("source", F.lit(source))
        return rows.select(*CONFORMED.names, "digest")

    done = qn.replay(spark, root, source, eta, conform)
    if done:
        prices = sc.valid_products(conformed_rows(spark, root, source, eta).drop("source")).select(*sc.PRODUCT_SCHEMA.names)
        append_prices(prices, source, f"{root}/prices")
    return done
