"""Readers for files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_CSV = {"header": True, "escape": '"', "enforceSchema": False}


def read_competitor_catalog(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Competitor catalog CSV; columns are found by header, in any order.

    Outer blanks of names are kept and ids stay text.  Names with line breaks
    need `multi_line`, which reads each file in one task.
    """
    return (
        spark.read.options(**_CSV, multiLine=multi_line, inferSchema=False)
        .csv(path)
        .select("competitor_product_id", "product_name")
    )


def read_mapping_csv(spark: SparkSession, path: str) -> DataFrame:
    """Mapping CSV with both keys as text, so that long ids keep their form."""
    return (
        spark.read.options(**_CSV, inferSchema=False)
        .csv(path)
        .select(
            F.col("competitor_product_id").cast("string"), F.col("variety_key").cast("string")
        )
    )


def read_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A catalog table, or a Parquet path when the name holds a slash."""
    if "/" in name_or_path:
        return spark.read.parquet(name_or_path)
    return spark.table(name_or_path)


def read_mart(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The four tables the master catalog is built from."""
    names = ["cart_box_item", "variety", "product_group", "color"]
    return {n: read_table(spark, f"{root.rstrip('/')}/{n}") for n in names}


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed payload files, one row each: `path`, `payload`."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("payload")
    )

