"""Matching external product names to the master catalog."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.functions.text import bullet_list
from bloomledger.functions.vectors import trigram_vector
from bloomledger.operators.adjudication import MatchRules, adjudicate
from bloomledger.operators.similarity import top_k

Vectoriser = Callable[[Column], Column]
Decider = Callable[[DataFrame], DataFrame]


def vectorise(names: DataFrame, name: str = "product_name", vectoriser: Vectoriser = trigram_vector) -> DataFrame:
    """`name`, `vector` of each distinct name; vectors may also come from elsewhere.

    Names are few bytes and much work each, so they are dealt out over all cores by a stated
    number of partitions, which adaptive execution does not merge by their size.
    """
    distinct = names.select(F.col(name).alias("name")).filter(F.col("name").isNotNull()).distinct()
    spread = distinct.repartition(2 * names.sparkSession.sparkContext.defaultParallelism)
    return spread.withColumn("vector", vectoriser(F.col("name")).cast("array<float>"))


def candidates(query_vectors: DataFrame, catalog_vectors: DataFrame, k: int = fv.CANDIDATES_PER_NAME) -> DataFrame:
    """Best `k` catalog names per query name, from two (`name`, `vector`) tables."""
    best = top_k(
        query_vectors.select(F.col("name").alias("query_id"), F.col("vector").alias("query_vector")),
        catalog_vectors.select(F.col("name").alias("catalog_id"), F.col("vector").alias("catalog_vector")),
        k,
    )
    return best.select(
        F.col("query_id").alias("query_name"), F.col("catalog_id").alias("candidate_name"), "score", "rank"
    )


def candidate_lists(found: DataFrame) -> DataFrame:
    """One row per query name: its candidates as a bullet list in rank order.

    A group holds at most k rows, so collecting it is bounded.
    """
    ordered = F.array_sort(F.collect_list(F.struct("rank", "candidate_name")))
    return found.groupBy("query_name").agg(
        bullet_list(F.transform(ordered, lambda c: c["candidate_name"])).alias("candidate_list")
    )


def variety_of_name(catalog: DataFrame) -> DataFrame:
    """One variety per catalog name; of several the greatest key is taken."""
    return catalog.groupBy("product_name").agg(F.max("variety").alias("variety_key"))


def lookup_variety(matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Add `variety_key` for `matched_name`, `Null` when the catalog lacks it."""
    keys = variety_of_name(catalog).withColumnRenamed("product_name", "matched_name")
    return matches.join(keys, "matched_name", "left").withColumn(
        "variety_key", F.coalesce("variety_key", F.lit(fv.NO_MATCH))
    )


def assemble(products: DataFrame, decisions: DataFrame, catalog: DataFrame) -> DataFrame:
    """One match row per product row, repeats included.

    Decisions are made once per distinct name and joined back by name.
    """
    decided = lookup_variety(decisions, catalog).withColumnRenamed("query_name", "product_name")
    # Products without a name have no decision; they would all meet in one partition.
    named = products.filter(F.col("product_name").isNotNull()).join(decided, "product_name", "left")
    unnamed = products.filter(F.col("product_name").isNull())
    return named.unionByName(unnamed, allowMissingColumns=True).select(
        "competitor_product_id",
        F.col("product_name").alias("competitor"),
        F.coalesce("matched_name", F.lit(fv.NO_MATCH)).alias("matched_name"),
        F.coalesce("variety_key", F.lit(fv.NO_MATCH)).alias("variety_key"),
    )


def match_products(
    products: DataFrame,
    catalog: DataFrame,
    rules: MatchRules = MatchRules(),
    k: int = fv.CANDIDATES_PER_NAME,
    query_vectors: DataFrame | None = None,
    catalog_vectors: DataFrame | None = None,
    decide: Decider | None = None,
) -> DataFrame:
    """`competitor_product_id`, `competitor`, `matched_name`, `variety_key`.

    products: `competitor_product_id`, `product_name`; catalog: `product_name`,
    `variety`.  Both are read more than once, so they are best stored tables.
    Stored vectors can be given instead of computing them, and `decide` replaces
    the rules: it turns candidate rows into (`query_name`, `matched_name`).
    """
    queries = vectorise(products) if query_vectors is None else query_vectors
    known = vectorise(catalog) if catalog_vectors is None else catalog_vectors
    found = candidates(queries, known, k)
    decisions = adjudicate(found, rules) if decide is None else decide(found)
    return assemble(products, decisions, catalog)


def match_yield(matches: DataFrame) -> DataFrame:
    """One row: products handled, and how many of them found a variety."""
    return matches.agg(
        F.count("*").alias("n_products"),
        F.count_if(F.col("variety_key") != fv.NO_MATCH).alias("n_matched"),
    )
