"""Joining rows with the value that was valid at their time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SLICE_DAYS = 32


def validity_ranges(history: DataFrame, key: list[str], value: str, since: str) -> DataFrame:
    """Key, value, `valid_from`, `valid_to` (null: still valid) from values with the time they came up.

    history: a row for each key and time at which a value, or null for its end, was set; of
    several for one time the greatest counts.  Rows that repeat the value before them open no
    range, so a key has as many rows as changes, however often it was written.
    """
    once = history.filter(F.col(since).isNotNull()).groupBy(*key, since).agg(F.max(value).alias(value))
    timeline = Window.partitionBy(*key).orderBy(since)
    changes = once.withColumn("_before", F.lag(value).over(timeline)).withColumn("_first", F.row_number().over(timeline) == 1)
    changes = changes.filter(F.col("_first") | ~F.col(value).eqNullSafe(F.col("_before")))
    ranges = changes.withColumn("valid_to", F.lead(since).over(timeline))
    return ranges.filter(F.col(value).isNotNull()).select(*key, value, F.col(since).alias("valid_from"), "valid_to")


def _slice(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / F.lit(days)).cast("int")


def as_of_join(
    rows: DataFrame, ranges: DataFrame, key: list[str], value: str, at: str, days: int = SLICE_DAYS
) -> DataFrame:
    """Rows with the value whose range their time `at` lies in (null without one).

    ranges: as `validity_ranges` gives them; those of one key do not overlap.  Times are dates
    or timestamps.  Times are cut into slices of `days` days, and the join is by key and slice: a
    row meets only the ranges of its own slice, and a hot product is spread over its slices, whose
    rows adaptive execution splits further.  A range is sent only to slices in which its key has
    rows, so what is sent is at most one range for each such key and slice and one more for each
    change.  Rows without a key or time stay out of the join.
    """
    others = [c for c in rows.columns if c != value]
    usable = F.col(at).isNotNull()
    for column in key:
        usable &= F.col(column).isNotNull()
    met = rows.filter(usable).select(*others, _slice(F.col(at), days).alias("_slice"))
    wanted = met.select(*[F.col(c).alias(f"_key_{i}") for i, c in enumerate(key)], F.col("_slice").alias("_range_slice")).distinct()
    spans = ranges.select(
        *[F.col(c).alias(f"_of_{i}") for i, c in enumerate(key)], F.col(value).alias("_value"), "valid_from", "valid_to",
        _slice(F.col("valid_from"), days).alias("_begin"), _slice(F.col("valid_to"), days).alias("_end"),
    )
    meets = (F.col("_begin") <= F.col("_range_slice")) & (F.col("_end").isNull() | (F.col("_range_slice") <= F.col("_end")))
    for i in range(len(key)):
        meets &= F.col(f"_key_{i}") == F.col(f"_of_{i}")
    cut = wanted.join(spans, meets).select(*[f"_key_{i}" for i in range(len(key))], "_range_slice", "_value", "valid_from", "valid_to")
    same = met["_slice"] == F.col("_range_slice")
    for i, column in enumerate(key):
        same &= met[column] == F.col(f"_key_{i}")
    inside = (F.col("valid_from") <= met[at]) & (F.col("valid_to").isNull() | (met[at] < F.col("valid_to")))
    joined = met.join(cut, same & inside, "left").select(*others, F.col("_value").alias(value))
    unusable = rows.filter(~usable).select(*others, F.lit(None).cast(ranges.schema[value].dataType).alias(value))
    return joined.unionByName(unusable)
