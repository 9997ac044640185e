"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target of words: the total is shared out by weight, no source gets
more than `MOST` times its own size, and what is over is shared again (water filling,
solved in closed form on the table of sources).  A document is then taken
floor(target / size of its source) times for certain.  The rest of a target is a fixed
number of words, drawn without replacement: document i has the inclusion probability
p_i, which rises with its length, and a uniform number u_i from a hash of its id; in the
order of [u_i / (1 - u_i)] / [p_i / (1 - p_i)] documents are taken until the next would go
beyond the target.  Last, the one document left whose size is nearest to what is missing
is added if that brings the source nearer.

A source may hold any share of the rows: ranks are cut into `BUCKETS` slices, words are
summed by source and slice before any shuffle, and only the slice in which a target is
reached is put in order.

Rows with one doc_id, source and text cannot be told apart: they are counted first, by partial
aggregates, and drawn as a whole, except at the cut, where as many of them are taken as fit.
Rows with equal doc_id and other texts draw the same number and stand in the order of their
texts' digests.  So a source meets its target within one document, whatever its ids are.

Null text has size 0 and is never taken.  A null source is a source of its own, the last.
A null doc_id draws as the text "null".  An empty table gives an empty result.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import digest_of, settle, table, with_small

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
BUCKETS = 4096
SEED = "mix-1"

_HASH_DIGITS = 13
_HASH_RANGE = 16**_HASH_DIGITS


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number between 0 and 1, both excluded, that depends on the id and the seed."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("null")))
    digits = F.conv(F.substring(F.md5(name.cast("binary")), 1, _HASH_DIGITS), 16, 10)
    return (digits.cast("double") + F.lit(0.5)) / F.lit(float(_HASH_RANGE))


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST) -> DataFrame:
    """source, source_size, n_docs, target: one row per source.

    `sized` has a row per document with source and size, or rows with how many documents
    (`times`) they stand for.  The table of sources is small next to that of documents, so it is
    ordered in one place.
    """
    times = F.col("times") if "times" in sized.columns else F.lit(1)
    sources = sized.groupBy("source").agg(
        F.sum(F.col("size") * times).alias("source_size"), F.sum(times).cast("long").alias("n_docs")
    )
    turn = F.pmod(F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1, F.lit(len(weights)))
    sources = sources.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    sources = sources.withColumn("cap", (F.lit(most) * F.col("source_size")).cast("double"))
    # A source is full if the level reached without it and all that fill up earlier is above its own.
    by_level = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    sources = (
        sources.withColumn("total", F.sum("source_size").over(everything).cast("double"))
        .withColumn("all_w", F.sum("w").over(everything))
        .withColumn("cap_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
        .withColumn("w_before", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
        .withColumn(
            "full",
            (F.col("total") - F.col("cap_before")) / (F.col("all_w") - F.col("w_before")) > F.col("cap") / F.col("w"),
        )
        .withColumn("full_cap", F.sum(F.when(F.col("full"), F.col("cap")).otherwise(0.0)).over(everything))
        .withColumn("open_w", F.sum(F.when(F.col("full"), 0.0).otherwise(F.col("w"))).over(everything))
    )
    level = (F.col("total") - F.col("full_cap")) / F.col("open_w")
    target = F.when(F.col("full"), F.col("cap")).otherwise(F.least(F.col("cap"), level * F.col("w")))
    return sources.select("source", "source_size", "n_docs", target.alias("target"))


def mixed_documents(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """A row for each doc_id, source and text that is there: how many rows, and what is taken of them.

    doc_id, source, digest, size, times, source_size, target; `whole` copies are taken of each of
    the rows, and one more of `extra` of them.
    """
    named = docs.select(
        "doc_id", F.col("source").cast("string").alias("source"), digest_of("text").alias("digest"), word_count(F.col("text")).alias("size")
    )
    sized = settle(named.groupBy("doc_id", "source", "digest", "size").agg(F.count("*").alias("times")))
    targets = source_targets(sized, weights, most)
    some = F.col("source_size") > 0
    whole = F.when(some, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    targets = (
        targets.withColumn("whole", whole)
        .withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
        .withColumn("fraction", F.when(some, F.col("rest") / F.col("source_size")).otherwise(0.0))
        .withColumn("mean_size", F.col("source_size") / F.col("n_docs"))
    )
    targets = settle(targets)

    chance = F.col("fraction") * (0.5 + 0.5 * (F.col("size") / (F.col("size") + F.col("mean_size"))))
    ranked = (
        with_small(sized, targets, sized["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("u", uniform(F.col("doc_id"), seed))
        .withColumn("p", F.when((F.col("fraction") > 0) & (F.col("size") > 0), chance))
        .withColumn("q", (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p"))))
        .withColumn("bucket", F.floor(F.lit(float(buckets)) * (F.col("q") / (1 + F.col("q")))))
        .withColumn("words", F.col("size") * F.col("times"))
        .drop("u", "p", "fraction", "mean_size", "n_docs")
    )

    # The slice of ranks in which a source reaches its target, and the words in the slices before.
    in_order = Window.partitionBy("source").orderBy("bucket")
    slices = (
        ranked.filter("q is not null")
        .groupBy("source", "bucket", "rest")
        .agg(F.sum("words").alias("in_slice"))
        .withColumn("words_through", F.sum("in_slice").over(in_order))
        .filter(F.col("words_through") > F.col("rest"))
        .groupBy("source")
        .agg(F.min(F.struct("bucket", (F.col("words_through") - F.col("in_slice")).alias("words_before"))).alias("cut"))
        .select(F.col("source").alias("cut_source"), "cut.bucket", "cut.words_before")
        .withColumnRenamed("bucket", "cut_bucket")
    )
    slices = settle(slices)
    ranked = with_small(ranked, slices, F.col("source").eqNullSafe(F.col("cut_source")), "left").drop("cut_source")

    # Inside that slice documents are taken in order, as many as fit.
    at_cut = F.coalesce(F.col("bucket") == F.col("cut_bucket"), F.lit(False))
    order = Window.partitionBy("source").orderBy("q", "doc_id", "digest")
    before = F.coalesce(F.sum("words").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col("words_before")
    fit = F.floor((F.col("rest") - before) / F.col("size")).cast("long")
    cut = settle(ranked.filter(at_cut).withColumn("extra", F.greatest(F.lit(0), F.least(F.col("times"), fit)).cast("long")))
    all_of_them = F.col("q").isNotNull() & (F.col("cut_bucket").isNull() | (F.col("bucket") < F.col("cut_bucket")))
    outside = ranked.filter(~at_cut).withColumn("extra", F.when(all_of_them, F.col("times")).otherwise(F.lit(0)).cast("long"))

    # The document whose size is nearest to what the source still lacks is added.
    taken = cut.groupBy("source").agg(
        (F.first("rest") - F.first("words_before") - F.sum(F.col("extra") * F.col("size"))).alias("lacks")
    )
    taken = settle(taken.withColumnRenamed("source", "cut_source"))
    drawn = cut.unionByName(outside)
    candidates = with_small(
        drawn.filter("q is not null and cut_bucket is not null and extra < times"),
        taken,
        F.col("source").eqNullSafe(F.col("cut_source")),
    )
    nearest = (
        candidates.withColumn("off", F.abs(F.col("size") - F.col("lacks")))
        .filter(F.col("off") < F.col("lacks"))
        .groupBy("source")
        .agg(F.min(F.struct("off", "q", "doc_id", "digest")).alias("best"))
        .select(F.col("source").alias("best_source"), "best")
    )
    nearest = settle(nearest)
    drawn = with_small(drawn, nearest, F.col("source").eqNullSafe(F.col("best_source")), "left")
    added = F.col("doc_id").eqNullSafe(F.col("best.doc_id")) & (F.col("digest") == F.col("best.digest")) & F.col("q").isNotNull()
    extra = F.col("extra") + F.coalesce(added, F.lit(False)).cast("long")
    taken_at_all = F.col("size") > 0
    return drawn.select(
        "doc_id",
        "source",
        "digest",
        "size",
        "times",
        "source_size",
        "target",
        F.when(taken_at_all, F.col("whole")).otherwise(F.lit(0)).cast("long").alias("whole"),
        F.when(taken_at_all, extra).otherwise(F.lit(0)).cast("long").alias("extra"),
    )


def pareto_mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, seed: str = SEED, buckets: int = BUCKETS
) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken words for every row."""
    mixed = mixed_documents(docs, weights, most, seed, buckets)
    rows = mixed.withColumn("number", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    copies = F.col("whole") + (F.col("number") <= F.col("extra")).cast("long")
    return rows.withColumn("copies", copies).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = pareto_mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


OP2_SQL = f"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{WORD}')), 0) AS BIGINT) AS size FROM documents
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS n_docs,
    CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS DOUBLE) AS w
  FROM sized GROUP BY source
), levels AS (
  SELECT *, CAST(3 * source_size AS DOUBLE) AS cap,
    CAST(sum(source_size) OVER () AS DOUBLE) AS total, sum(w) OVER () AS all_w,
    coalesce(CAST(sum(3 * source_size) OVER prior AS DOUBLE), 0) AS cap_before, coalesce(sum(w) OVER prior, 0) AS w_before
  FROM sources
  WINDOW prior AS (ORDER BY CAST(3 * source_size AS DOUBLE) / w, source NULLS LAST
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), filled AS (
  SELECT *, (total - cap_before) / (all_w - w_before) > cap / w AS is_full FROM levels
), shares AS (
  SELECT *, (total - sum(CASE WHEN is_full THEN cap ELSE 0 END) OVER ()) / nullif(sum(CASE WHEN is_full THEN 0 ELSE w END) OVER (), 0) AS level
  FROM filled
), targets AS (
  SELECT source, source_size, n_docs, CASE WHEN is_full THEN cap ELSE least(cap, level * w) END AS target FROM shares
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM targets
), rests AS (
  SELECT *, target - whole * source_size AS rest FROM parts
), drawn_numbers AS (
  SELECT d.doc_id, d.size, r.*,
    (CAST(('0x' || substr(md5('{SEED}:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, {_HASH_DIGITS})) AS BIGINT) + 0.5::DOUBLE)
      / {_HASH_RANGE}.0::DOUBLE AS u,
    CASE WHEN rest > 0 AND d.size > 0
      THEN rest / source_size * (0.5::DOUBLE + 0.5::DOUBLE * (d.size / (d.size + source_size / n_docs))) END AS p
  FROM sized d JOIN rests r ON d.source IS NOT DISTINCT FROM r.source
), ranked AS (
  SELECT *, (u / (1 - u)) / (p / (1 - p)) AS q FROM drawn_numbers
), ordered AS (
  SELECT *, sum(size) OVER (PARTITION BY source, p IS NULL ORDER BY q, doc_id) AS through FROM ranked
), marked AS (
  SELECT *, p IS NOT NULL AND through <= rest AS drawn,
    max(CASE WHEN p IS NOT NULL AND through <= rest THEN through ELSE 0 END) OVER (PARTITION BY source) AS got
  FROM ordered
), offs AS (
  SELECT *, CASE WHEN p IS NOT NULL AND NOT drawn AND abs(size - (rest - got)) < rest - got THEN abs(size - (rest - got)) END AS off FROM marked
), best AS (
  SELECT *, CASE WHEN off IS NOT NULL THEN row_number() OVER (PARTITION BY source ORDER BY off NULLS LAST, q, doc_id) END AS place FROM offs
)
SELECT doc_id, size, source_size, target,
  CAST(CASE WHEN size > 0 THEN size * (whole + CAST(drawn OR coalesce(place = 1, FALSE) AS BIGINT)) ELSE 0 END AS BIGINT) AS taken
FROM best
"""
