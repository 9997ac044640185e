"""Incremental form of the daily run: conform payload files as they land."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bloomledger import schema as sc
from bloomledger.plans.daily import raw_products


def stream_landed(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """Stream of landed payload files, one row per file."""
    reader = spark.readStream.format("text").option("wholetext", True)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path).select(F.col("value").alias("payload"))


def stream_products(spark: SparkSession, source: str, path: str, eta_date: str) -> DataFrame:
    """Stream of conformed rows of a JSON source, with `reject_reason`.

    Conforming a JSON page needs no state, so there is no watermark and a late
    file is treated like any other.
    """
    if source == "dvflora":
        raise ValueError("HTML pages need their URL list and run in batch")
    rows = raw_products(source, stream_landed(spark, path))
    return sc.conform(rows.withColumn("eta_date", F.lit(eta_date)))


def append_stream(products: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append what has landed since the last run and stop.

    Valid rows go to `path/prices`, rejected ones with their reason to
    `path/rejected`.  Each batch has a folder of its own, which a restarted run
    writes again, so no row is there twice; `checkpoint` lies in shared storage.
    """

    def write(batch: DataFrame, number: int) -> None:
        # Conformed once, for both tables.
        batch.withColumn("is_valid", F.col(sc.REJECT_REASON).isNull()).write.mode("overwrite").partitionBy(
            "is_valid"
        ).parquet(f"{path}/conformed/batch={number}")
        stored = batch.sparkSession.read.schema(batch.schema).parquet(f"{path}/conformed/batch={number}")
        for name, rows in (("prices", sc.valid_products(stored)), ("rejected", sc.rejected_products(stored))):
            rows.write.mode("overwrite").partitionBy("created_at").parquet(f"{path}/{name}/batch={number}")

    return (
        products.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
