"""A stored dictionary of raw names: each is cleaned and read once, on whatever day it comes up.

Cleaning a name takes up to forty ordered patterns, and from one day to the next nearly all
names are the same.  The dictionary holds what the patterns gave; only names it lacks are read.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.functions import measures as ms
from bloomledger.functions import text as tx

# Goes into the dictionary's folder: names that older rules read do not count.
RULES = "rules-1"


def read_names(names: DataFrame, raw: str = "raw_name") -> DataFrame:
    """`raw_name`, `clean_name`, `stem_length`, `stems_per_unit`, `merged_length` of distinct names."""
    distinct = names.select(F.col(raw).alias("raw_name")).filter(F.col(raw).isNotNull()).distinct()
    name = F.col("raw_name")
    return distinct.select(
        "raw_name",
        tx.aggressive_clean(name).alias("clean_name"),
        ms.stem_length(name).alias("stem_length"),
        ms.stems_per_unit(name).alias("stems_per_unit"),
        ms.merged_or_range_length(name).alias("merged_length"),
    )


def unread_names(names: DataFrame, known: DataFrame, raw: str = "raw_name") -> DataFrame:
    """Distinct names that the dictionary lacks."""
    distinct = names.select(F.col(raw).alias("raw_name")).filter(F.col(raw).isNotNull()).distinct()
    return distinct.join(known.select("raw_name"), "raw_name", "left_anti")


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def name_dictionary(names: DataFrame, root: str, raw: str = "raw_name", rules: str = RULES) -> DataFrame:
    """The dictionary under `root`, with all of these names; new ones are read and added."""
    spark = names.sparkSession
    path = f"{root.rstrip('/')}/rules={rules}"
    known = _stored(spark, path)
    new = names if known is None else unread_names(names, known, raw)
    if known is None or not new.isEmpty():
        read_names(new, raw if known is None else "raw_name").write.mode("append").parquet(path)
    return spark.read.parquet(path)


def with_names(rows: DataFrame, dictionary: DataFrame, raw: str = "raw_name") -> DataFrame:
    """Rows with what the dictionary knows of their name.

    A dictionary below the session's broadcast threshold is broadcast; past it the join shuffles
    rows and dictionary by name, where adaptive execution splits a hot one.  Rows without a name
    stay out of the join.
    """
    columns = ["clean_name", "stem_length", "stems_per_unit", "merged_length"]
    known = dictionary.select(F.col("raw_name").alias("_raw"), *columns)
    named = rows.filter(F.col(raw).isNotNull()).join(known, F.col(raw) == F.col("_raw"), "left").drop("_raw")
    nothing = {c: F.lit(None).cast(dictionary.schema[c].dataType) for c in columns}
    return named.unionByName(rows.filter(F.col(raw).isNull()).withColumns(nothing))
