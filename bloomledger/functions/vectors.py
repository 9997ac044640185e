"""Column functions for name vectors and cosine similarity."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bloomledger.functions.text import collapse_blanks

DIMENSIONS = 256


def _bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value evaluated once, however often body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def trigrams(name: Column) -> Column:
    """Character trigrams of the lower-cased name, with a blank at both ends."""
    padded = F.concat(F.lit(" "), F.lower(collapse_blanks(name)), F.lit(" "))

    def windows(text: Column) -> Column:
        starts = F.sequence(F.lit(1), F.length(text) - 2)
        return F.when(
            F.length(text) > 2, F.transform(starts, lambda i: text.substr(i, F.lit(3)))
        ).otherwise(F.array().cast("array<string>"))

    return _bind(padded, windows)


def trigram_vector(name: Column, dimensions: int = DIMENSIONS) -> Column:
    """Trigram counts of a name, hashed into `dimensions` slots.

    The vector depends on the name alone, so it can be stored and reused when
    other names come and go.  It is not scaled: cosine similarity ignores length.
    """
    slots = F.transform(
        trigrams(name),
        lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 6), 16, 10).cast("int") % dimensions,
    )

    def dense(found: Column) -> Column:
        used = F.array_distinct(found)
        counts = F.transform(used, lambda u: F.size(found) - F.size(F.array_remove(found, u)))
        return _bind(
            F.map_from_arrays(used, counts),
            lambda by_slot: F.transform(
                F.sequence(F.lit(0), F.lit(dimensions - 1)),
                lambda d: F.coalesce(F.try_element_at(by_slot, d), F.lit(0)).cast("float"),
            ),
        )

    return F.when(name.isNotNull(), _bind(slots, dense))


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity of two arrays of equal length; 0 for a zero vector.

    Meant for a handful of pairs per row; whole tables go through
    `operators.similarity.top_k`.
    """

    def dot(x: Column, y: Column) -> Column:
        products = F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)

    return F.coalesce(
        F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))), F.lit(0.0)
    )


def slot_weights(vectors: DataFrame, vector: str = "vector") -> DataFrame:
    """One row: `n_names`, and `weights`, what each slot counts by how few names use it.

    weight = ln((1 + names) / (1 + names that use the slot)) + 1.  Fitted on the catalog's counts
    and stored with a version, it is joined when vectors are used; the counts stay as they are
    when the catalog grows.  Uses are partial sums of one number a slot, so nothing is gathered.
    """
    named = vectors.filter(F.col(vector).isNotNull())
    slots = named.select(F.posexplode(vector).alias("slot", "n"))
    used = slots.groupBy("slot").agg(F.count_if(F.col("n") != 0).alias("uses"), F.count("*").alias("names"))
    weight = F.log((1 + F.col("names")) / (1 + F.col("uses"))) + 1
    ordered = F.array_sort(F.collect_list(F.struct("slot", weight.alias("weight"))))  # as many as a vector has slots
    return used.agg(F.coalesce(F.max("names"), F.lit(0)).alias("n_names"), F.transform(ordered, lambda s: s["weight"]).alias("weights"))


def weighted(vectors: DataFrame, weights: DataFrame, vector: str = "vector") -> DataFrame:
    """Vectors with each slot multiplied by its weight; `weights` is the one row of `slot_weights`.

    It holds a number for each slot of a vector, so it is read once and sent as a constant of the query.
    """
    numbered = vectors.withColumn("_weights", weights.select("weights").scalar())
    return numbered.withColumn(vector, F.zip_with(vector, "_weights", lambda n, w: (n * w).cast("float"))).drop("_weights")
