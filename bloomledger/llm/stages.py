"""Stages of the corpus pipeline: an operator's decisions applied to the documents.

Every stage takes (spark, docs, sf_dir), reads the columns of `documents`, and all but the
last return exactly those columns, as their types were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm import decontamination, language_id, mixing, near_dedup, sharding
from bloomledger.llm.common import digest_of, key_of, settle, table, with_small

NEAR_PERCENT = 80  # likeness of shingle sets from which documents are near copies

_KEY, _COPIES, _ROW, _DIGEST, _SOURCE = "__key", "__copies", "__row", "__digest", "__source"
_TIMES, _WHOLE, _EXTRA = "__times", "__whole", "__extra"


def _row_of() -> Column:
    """Identity of a document as a long: rows with one id and one text are the same one."""
    return F.xxhash64(key_of("doc_id"), digest_of())


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text is in one of the learned languages."""
    return language_id.accepted(docs, language_id.learn(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id.

    Rows with one id and one text are one document; different texts are judged on their own.
    """
    tagged = docs.select(
        _row_of().alias("k"), F.col("text").cast("string").alias("text"), key_of("doc_id").alias(_KEY), digest_of().alias(_DIGEST)
    )
    groups = near_dedup.near_groups(tagged.select("k", "text"), NEAR_PERCENT)
    groups = groups.select(F.col("k").alias(_ROW), "component").distinct()
    rows = tagged.select(F.col("k").alias(_ROW), _KEY, _DIGEST).distinct().join(groups, _ROW)
    kept = rows.groupBy("component").agg(F.min(F.struct(_KEY, _DIGEST, _ROW))[_ROW].alias(_ROW)).select(_ROW)
    found = docs.withColumns({_ROW: _row_of(), _KEY: key_of("doc_id"), _DIGEST: digest_of()}).join(kept, _ROW)
    return found.dropDuplicates([_ROW, _KEY, _DIGEST]).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no passage of the benchmark occurs; short items do not count."""
    tagged = docs.withColumn(_ROW, _row_of())
    rows = tagged.select(F.col(_ROW).alias("doc_id"), "text")
    leaks = decontamination.contamination(rows, decontamination.long_items(table(spark, sf_dir, "benchmark")))
    leaks = settle(leaks.select(F.col("doc_id").alias(_KEY)).distinct())
    kept = with_small(tagged, leaks, tagged[_ROW] == leaks[_KEY], "left_anti")
    return kept.select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or repeated.

    Of rows with one id, source and text a part may be taken; which of them is told by a hash of
    all their columns.
    """
    mixed = mixing.mixed_documents(docs).filter("whole + extra > 0").select(
        key_of("doc_id").alias(_KEY), F.col("source").alias(_SOURCE), F.col("digest").alias(_DIGEST), "times", "whole", "extra"
    ).withColumnsRenamed({"times": _TIMES, "whole": _WHOLE, "extra": _EXTRA})
    found = docs.withColumns({"__own_key": key_of("doc_id"), "__own_digest": digest_of(), "__own_source": F.col("source").cast("string")})
    same = (
        (F.col("__own_key") == F.col(_KEY))
        & (F.col("__own_digest") == F.col(_DIGEST))
        & F.col("__own_source").eqNullSafe(F.col(_SOURCE))
    )
    found = found.join(mixed, same)
    part = (F.col(_EXTRA) > 0) & (F.col(_EXTRA) < F.col(_TIMES))
    copies = F.col(_WHOLE) + F.when(F.col(_EXTRA) == F.col(_TIMES), 1).otherwise(0)
    every = found.withColumn(_COPIES, copies.cast("int")).select(*docs.columns, _COPIES)
    # At most two documents of a source are taken in part: one of their rows stands for that part.
    row = F.struct(*docs.columns)
    some = found.filter(part).groupBy(_KEY, _DIGEST, _SOURCE, _EXTRA).agg(F.max_by(row, F.xxhash64(*docs.columns)).alias("__one"))
    some = some.select("__one.*", F.col(_EXTRA).cast("int").alias(_COPIES))
    out = every.unionByName(some).filter(F.col(_COPIES) > 0)
    return out.withColumn(_COPIES, F.explode(F.sequence(F.lit(1), F.col(_COPIES)))).select(*docs.columns)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with the name of their shard."""
    return sharding.place(docs)
