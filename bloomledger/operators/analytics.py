"""Reports on conformed prices: mapping, comparison, stock and volume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bloomledger import fixed_values as fv

# --- mapping -----------------------------------------------------------------


def with_mapping(
    prices: DataFrame, mapping: DataFrame, key: str | list[str] = "competitor_product_id"
) -> DataFrame:
    """Prices with their variety key; unmapped products keep a null key.

    `key` may be several columns, such as the competitor and its product id.  Prices
    without a key can have no mapping; they stay out of the join, where they would all
    meet in one partition.

    No join hint: a mapping below the session's broadcast threshold is
    broadcast, a larger one is joined by shuffle, where adaptive execution
    splits the partition of a hot product.
    """
    on = [key] if isinstance(key, str) else list(key)
    keys = mapping.select(*on, F.col("variety_key").alias("mapped_key"))
    others = [c for c in prices.columns if c != "variety_key"]
    has_key = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in on])
    mapped = prices.filter(has_key).join(keys, on, "left")
    unkeyed = prices.filter(~has_key).withColumn("mapped_key", F.lit(None).cast(keys.schema["mapped_key"].dataType))
    return mapped.select(*others, "mapped_key").unionByName(unkeyed.select(*others, "mapped_key")).withColumnRenamed(
        "mapped_key", "variety_key"
    )


def unmapped_products(prices: DataFrame, mapping: DataFrame, key: str = "competitor_product_id") -> DataFrame:
    """Product ids that have a price but no mapping yet.

    Ids of both sides are made distinct first, by partial aggregates, so the join
    sees each product once.
    """
    return prices.select(key).distinct().join(mapping.select(key).distinct(), key, "left_anti")


# --- price reports -----------------------------------------------------------


def price_range(prices: DataFrame, by: list[str], price: str = "stem_price") -> DataFrame:
    """Cheapest and highest price per stem of each group."""
    return prices.groupBy(*by).agg(
        F.min(price).alias("cheapest_price_per_stem"), F.max(price).alias("highest_price_per_stem")
    )


def compare_competitors(
    prices: DataFrame,
    competitors: list[str],
    by: tuple[str, ...] = ("variety_key", "eta_date"),
    price: str = "stem_price",
) -> DataFrame:
    """Lowest price of each competitor side by side, and the spread between them.

    Competitors are named by the caller, so the pivot needs no extra pass.  `n_other`
    counts the prices of sources that are not named, so that a new one is noticed.
    """
    lowest = [F.min(F.when(F.col("competitor") == c, F.col(price))).alias(c) for c in competitors]
    unnamed = ~F.coalesce(F.col("competitor").isin(*competitors), F.lit(False))
    table = prices.groupBy(*by).agg(*lowest, F.count_if(unnamed & F.col(price).isNotNull()).alias("n_other"))
    quoted = [F.col(f"`{c}`") for c in competitors]
    sellers = F.lit(0)
    for column in quoted:
        sellers = sellers + column.isNotNull().cast("int")
    spread = F.greatest(*quoted) - F.least(*quoted) if len(quoted) > 1 else F.lit(0.0)
    return table.withColumns({"n_competitors": sellers.cast("bigint"), "spread": spread})


def grower_prices(prices: DataFrame) -> DataFrame:
    """Farm-side view: averages of base price, freight and margin per grower.

    Sums are taken on exact decimals, so the result does not depend on the order
    in which partitions arrive.
    """
    def mean(name: str) -> Column:
        total = F.sum(F.col(name).cast("decimal(18,6)")).cast("double")
        return F.try_divide(total, F.count(name).cast("double")).alias(f"avg_{name}")

    return prices.filter(F.col("grower_name").isNotNull()).groupBy("grower_name").agg(
        F.count("*").alias("n_offers"), mean("base_price"), mean("freight_price"), mean("margin")
    )


# --- monitoring --------------------------------------------------------------


def source_counts(products: DataFrame, source: str = "competitor") -> DataFrame:
    """Products per source and the total (source null, `is_total` 1)."""
    return products.rollup(source).agg(
        F.count("*").alias("n_products"), F.grouping(source).cast("int").alias("is_total")
    )


def capped_sources(products: DataFrame, cap: int = fv.INVENTORY_ROW_CAP, by: tuple[str, ...] = ("competitor", "eta_date")) -> DataFrame:
    """Snapshots holding exactly the row cap of a request or more: likely cut off."""
    return products.groupBy(*by).agg(F.count("*").alias("n_products")).filter(F.col("n_products") >= cap)


def volume_drops(
    products: DataFrame, source: str, day: str, min_ratio: float = 0.5
) -> DataFrame:
    """Rows per source and day, with the day before and a flag for a sharp drop.

    The window sees one row per day, never the products themselves.
    """
    daily = products.groupBy(source, day).agg(F.count("*").alias("n_products"))
    before = F.lag("n_products").over(Window.partitionBy(source).orderBy(day))
    return daily.withColumn("n_before", before).withColumn(
        "is_drop",
        F.coalesce(F.col("n_products") < F.col("n_before") * min_ratio, F.lit(False)),
    )


def stock_alerts(
    products: DataFrame,
    source: str = "competitor",
    product: str = "competitor_product_id",
    day: str = "eta_date",
    units: str = "available_units",
) -> DataFrame:
    """Products that ran out: `sold_out` (stock falls to 0) or `missing`.

    A product is missing when its source has a later snapshot in which the
    product, in stock until then, does not appear.  `day` is the snapshot that
    shows the change.

    Products are first reduced to one row per snapshot by a partial aggregate;
    the windows then hold at most one row per day, however many rows one product
    has.
    """
    stock = products.groupBy(source, product, day).agg(F.sum(units).alias("units"))
    # Days come from the grouped table, so products are read once.  The count keeps its
    # columns the same on both paths; the plan then uses one shuffle for both.
    days = stock.groupBy(source, day).agg(F.count("units").alias("n_counted")).filter("n_counted >= 0")
    calendar = (
        days.select(source, day)
        .withColumn("next_day", F.lead(day).over(Window.partitionBy(source).orderBy(day)))
    )
    timeline = Window.partitionBy(source, product).orderBy(day)
    seen = stock.select(
        source, product, day, "units",
        F.lead("units").over(timeline).alias("later_units"),
        F.lead(day).over(timeline).alias("later_day"),
    ).filter(F.col("units") > 0)
    changes = seen.join(calendar, [source, day])
    state = F.when(
        F.col("next_day").isNotNull()
        & (F.col("later_day").isNull() | (F.col("later_day") > F.col("next_day"))),
        F.lit("missing"),
    ).when(F.col("later_units") == 0, F.lit("sold_out"))
    return changes.select(
        source, product, F.col("next_day").alias(day), F.col("units").alias("units_before"), state.alias("alert")
    ).filter(F.col("alert").isNotNull())
