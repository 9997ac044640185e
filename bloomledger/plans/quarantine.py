"""What the daily run could not use, kept with its reason, and read again after a fix.

* pages that cannot be read, with their payload;
* rows that violate the product schema, and products without a price;
* pages that a listing announced but that did not land.

A page is known by the digest of its payload, so one that landed twice is there once.  After a
reader was mended, `replay` reads the kept pages again; the rows that come out of it and the note
that the page is done become visible in one step, so a page gives its rows exactly once.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bloomledger import schema as sc
from bloomledger.sinks import manifest as mf
from bloomledger.sources import json_pages as jp
from bloomledger.sources.html_pages import page_rows

UNREADABLE, NO_TABLE, NO_PRICE, NO_PAGE = "unreadable page", "no listing table", "no price", "missing page"

PAYLOADS = {"mayesh": sc.INVENTORY_PAYLOAD, "flowermarketplace": sc.LISTING_PAYLOAD, "petaljet": sc.VARIANT_PAYLOAD}



def _texts(*names: str) -> StructType:
    return StructType([StructField(name, StringType()) for name in names])


SCHEMA = _texts("source", "eta_date", "reason", "digest", "url", "payload", "detail")
DONE = _texts("source", "eta_date", "digest")


def _letters(rows: DataFrame, source: str, eta: str, reason, digest, detail, payload=None, url=None) -> DataFrame:
    text = lambda c: F.lit(None).cast("string") if c is None else c.cast("string")
    return rows.select(
        F.lit(source).alias("source"),
        F.lit(eta).alias("eta_date"),
        reason.alias("reason"),
        digest.alias("digest"),
        text(url).alias("url"),
        text(payload).alias("payload"),
        text(detail).alias("detail"),
    )


def unreadable(source: str, landed: DataFrame, eta: str) -> DataFrame:
    """Pages of a source that give no rows because they cannot be read, each payload once."""
    payload = "html" if "html" in landed.columns else "payload"
    if source in PAYLOADS:
        broken, reason = jp.unreadable_pages(landed, PAYLOADS[source], payload), UNREADABLE
    else:
        broken, reason = landed.filter(F.size(page_rows(F.col(payload))) == 0), NO_TABLE
    url = F.col("url") if "url" in landed.columns else F.lit(None).cast("string")
    named = broken.select(F.col(payload).alias("payload"), url.alias("url")).filter(F.col("payload").isNotNull())
    named = named.withColumn("digest", F.sha2(F.col("payload").cast("binary"), 256))
    once = named.groupBy("digest").agg(F.first("payload").alias("payload"), F.min("url").alias("url"))
    return _letters(once, source, eta, F.lit(reason), F.col("digest"), None, F.col("payload"), F.col("url"))


def unusable_rows(conformed: DataFrame) -> DataFrame:
    """Rows of conformed products (with `source`) that are rejected, and valid ones without a price."""
    reason = F.coalesce(F.col(sc.REJECT_REASON), F.when(F.col("stem_price").isNull(), F.lit(NO_PRICE)))
    bad = conformed.withColumn("reason", reason).filter(F.col("reason").isNotNull())
    detail = F.to_json(F.struct("competitor_product_id", "competitor_variant_id", "competitor_product_name", "grower_name"))
    digest = F.sha2(F.concat_ws("|", "source", detail).cast("binary"), 256)
    rows = bad.select("source", F.col("eta_date").cast("string").alias("eta_date"), "reason", digest.alias("digest"), detail.alias("detail"))
    return rows.distinct().select(
        "source", "eta_date", "reason", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("payload"), "detail"
    )


def page_gaps(source: str, expected: DataFrame, arrived: DataFrame, key: str, eta: str) -> DataFrame:
    """Announced pages that did not land: `key` and page number as detail."""
    gaps = jp.missing_pages(expected, arrived, key)
    detail = F.concat_ws(" ", F.col(key).cast("string"), F.lit("page"), F.col("page").cast("string"))
    return _letters(gaps, source, eta, F.lit(NO_PAGE), F.sha2(detail.cast("binary"), 256), detail)


def quarantined(spark: SparkSession, root: str, prefix: str = "") -> DataFrame:
    """What is in quarantine and not yet replayed."""
    kept = mf.read_parts(spark, root, "quarantine", SCHEMA, prefix)
    done = mf.read_parts(spark, root, "replayed", DONE, prefix)
    return kept.join(done, ["source", "eta_date", "digest"], "left_anti").select(SCHEMA.names)


def replay(spark: SparkSession, root: str, source: str, eta: str, conform: Callable[[DataFrame], DataFrame]) -> int:
    """Read a day's kept pages of a source again; the number of pages that are done now.

    conform: pages (`url`, `payload`, `digest`) to conformed rows that keep `digest`, by a reader
    that was mended.  Pages that still give no rows stay in quarantine.
    """
    pages = quarantined(spark, root, f"{source}/{eta}/").filter(F.col("payload").isNotNull()).select("url", "payload", "digest")
    rows = conform(pages)
    # One write for both: what is done is taken from the rows that were written.
    run = f"replay-{uuid.uuid4().hex}"
    folder = f"data/{run}/rows"
    rows.write.parquet(f"{root.rstrip('/')}/{folder}")
    written = spark.read.schema(rows.schema).parquet(f"{root.rstrip('/')}/{folder}")
    done = written.select(F.lit(source).alias("source"), F.lit(eta).alias("eta_date"), "digest").distinct()
    done.write.parquet(f"{root.rstrip('/')}/data/{run}/done")
    n_done = spark.read.schema(DONE).parquet(f"{root.rstrip('/')}/data/{run}/done").count()
    if n_done:
        new = {f"conformed/{source}/{eta}/{run}/": folder, f"replayed/{source}/{eta}/{run}/": f"data/{run}/done"}
        mf.change(spark, root, new, ())
    return n_done
