"""The master catalog: readable product names for every sold variety."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv
from bloomledger.functions import text as tx
from bloomledger.operators.filters import has_no_keyword, not_in_keys


def build_catalog(
    items: DataFrame,
    variety: DataFrame,
    product_group: DataFrame,
    color: DataFrame,
    excluded_varieties: list[str] | None = None,
    excluded_groups: list[str] | None = None,
) -> DataFrame:
    """Distinct (`product_name`, `variety`) of the items sold.

    items: `variety`, `product_group`; variety: `_KEY`, `variety_name`, `color`,
    `product_group`; product_group: `_KEY`, `common_name`; color: `_KEY`,
    `color_name`.

    The item table is the only large input and only its (variety, group) pairs
    matter, so it is reduced to them first, by a partial aggregate in the scan
    stage; joins and text work then see one row per pair, however often a
    variety is sold.
    """
    varieties = fv.EXCLUDED_VARIETIES if excluded_varieties is None else excluded_varieties
    groups_out = fv.EXCLUDED_PRODUCT_GROUPS if excluded_groups is None else excluded_groups
    wanted = not_in_keys(F.col("variety"), varieties) & not_in_keys(F.col("product_group"), groups_out)
    pairs = items.select("variety", "product_group").filter(wanted).distinct()

    # A variety counts only with an existing group of its own; the name shown
    # comes from the group of the item.
    groups = product_group.select(F.col("_KEY").alias("group_key"), F.lower(F.coalesce("common_name", F.lit(""))).alias("common"))
    usable = (
        variety.select(
            F.col("_KEY").alias("variety_key"),
            F.lower("variety_name").alias("name"),
            F.col("color").alias("color_key"),
            F.col("product_group").alias("own_group"),
        )
        .filter(has_no_keyword(F.col("name")))
        .join(groups.select(F.col("group_key").alias("own_group")), "own_group", "left_semi")
    )
    colors = color.select(F.col("_KEY").alias("color_key"), tx.color_prefix(F.col("color_name")).alias("prefix"))

    joined = (
        pairs.join(usable, pairs["variety"] == usable["variety_key"])
        .join(groups, pairs["product_group"] == groups["group_key"], "left")
        .join(colors, "color_key", "left")
        .select(
            "variety",
            F.coalesce("prefix", F.lit("")).alias("prefix"),
            "name",
            F.coalesce("common", F.lit("")).alias("common"),
        )
        .filter(has_no_keyword(F.col("common")))
    )
    phrase = tx.catalog_phrase(F.col("prefix"), F.col("name"), F.col("common"))
    return joined.select(tx.catalog_name(phrase).alias("product_name"), "variety").distinct()
