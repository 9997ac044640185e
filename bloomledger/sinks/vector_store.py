"""Stored name vectors, candidates, decisions and match results."""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.functions.vectors import trigram_vector
from bloomledger.plans.matching import Vectoriser, vectorise


def _stored(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def name_vectors(
    names: DataFrame,
    root: str,
    as_of: str,
    name: str = "product_name",
    vectoriser: Vectoriser = trigram_vector,
) -> DataFrame:
    """`name`, `vector` for every name, stored under `root/as_of=<day>`.

    A name that the day's store already has is not computed again; only new
    names are added.  The result is read from the store.
    """
    spark = names.sparkSession
    path = f"{root.rstrip('/')}/as_of={as_of}"
    stored = _stored(spark, path)
    wanted = names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
    missing = wanted if stored is None else wanted.join(stored.select("name"), "name", "left_anti")
    if stored is None or not missing.isEmpty():
        vectorise(missing, "name", vectoriser).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted, "name", "left_semi")


def store_matches(matches: DataFrame, path: str) -> DataFrame:
    """Replace the stored match results and return them as stored."""
    matches.write.mode("overwrite").parquet(path)
    return matches.sparkSession.read.parquet(path)


def vectors_of(
    names: DataFrame,
    root: str,
    version: str,
    name: str = "product_name",
    vectoriser: Vectoriser = trigram_vector,
) -> DataFrame:
    """`name`, `vector` for every name, from one store for all days.

    Vectors depend on the name and the vectoriser alone: `version` names the latter, and a name
    is computed once for each version, on whatever day it comes up first.
    """
    spark = names.sparkSession
    path = f"{root.rstrip('/')}/version={version}"
    stored = _stored(spark, path)
    wanted = names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
    missing = wanted if stored is None else wanted.join(stored.select("name"), "name", "left_anti")
    if stored is None or not missing.isEmpty():
        vectorise(missing, "name", vectoriser).write.mode("append").parquet(path)
    return spark.read.parquet(path).join(wanted, "name", "left_semi")


def publish(tables: dict[str, DataFrame], path: str, tag: str) -> dict[str, DataFrame]:
    """Store tables that belong together and name them as the current ones; returns them as stored.

    They go into a folder of their own, and a one-row pointer names it when all are written: a
    run that fails leaves the earlier ones in place.  `tag` says what they were made with.
    """
    spark = next(iter(tables.values())).sparkSession
    folder = f"{path.rstrip('/')}/version={uuid.uuid4().hex}"
    for name, rows in tables.items():
        rows.write.parquet(f"{folder}/{name}")
    named = spark.range(1).select(F.current_timestamp().alias("since"), F.lit(folder).alias("folder"), F.lit(tag).alias("tag"))
    named.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/current")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in tables}


def published(spark: SparkSession, path: str, tag: str, names: list[str]) -> dict[str, DataFrame] | None:
    """The tables that were published last, if they were made with the same things."""
    pointers = _stored(spark, f"{path.rstrip('/')}/current")
    last = None if pointers is None else pointers.orderBy(F.desc("since")).first()
    if last is None or last["tag"] != tag:
        return None
    return {name: spark.read.parquet(f"{last['folder']}/{name}") for name in names}


def known_decisions(spark: SparkSession, path: str) -> DataFrame:
    """`digest`, `matched_name` of every question that was decided so far."""
    stored = _stored(spark, path)
    return spark.createDataFrame([], "digest string, matched_name string") if stored is None else stored


def keep_decisions(new: DataFrame, path: str) -> DataFrame:
    """Add decisions to the store and return all of them."""
    new.write.mode("append").parquet(path)
    return new.sparkSession.read.parquet(path)
