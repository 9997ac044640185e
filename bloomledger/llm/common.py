"""Shared helpers: tables, keys, reliable checkpoints, bounded views of Arrow text."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# A null doc_id takes part in joins and orders as the smallest id.
NULL_ID = -(2**63)

# Rows of a table that may be broadcast.
SMALL_ROWS = 100_000

# Text bytes that one step inside a task holds in work arrays.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_of(column: str | Column = "doc_id") -> Column:
    """The id as a long that is never null."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(column.cast("long"), F.lit(NULL_ID))


def id_of(column: str | Column) -> Column:
    """The id that `key_of` was made of."""
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != F.lit(NULL_ID), column)


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints that all executors share, as `spark.checkpoint.dir` names it.

    A session without that setting gets a folder of its own if it is a local one (a test);
    on a cluster a folder of the driver's machine would be lost on executors, so that is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not (context.master == "local" or context.master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir has to name a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoints-"))
    return context.getCheckpointDir()


def settle(frame: DataFrame) -> DataFrame:
    """The frame's rows, written once to the shared checkpoint folder, with no lineage."""
    shared_folder(frame.sparkSession)
    return frame.checkpoint(eager=True)


def stored(frame: DataFrame) -> DataFrame:
    """The frame's rows from a Parquet table in the shared folder; smaller than a checkpoint."""
    path = f"{shared_folder(frame.sparkSession)}/table-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def digest_of(text: str | Column = "text") -> Column:
    """What tells the texts of rows with one id apart; empty for null."""
    text = F.col(text) if isinstance(text, str) else text
    return F.coalesce(F.md5(text.cast("string").cast("binary")), F.lit(""))


class RowKeys:
    """Texts by a long key of their own for each id and text; keys are in the order of the ids.

    Where every id is there once, ids are the keys (a null id is the smallest).  Else the
    distinct pairs of id and digest of the text are numbered in their order, over ranges, and
    texts are joined with their numbers once.  Rows with one id and one text share a key.
    """

    def __init__(self, docs: DataFrame):
        rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        met = rows.groupBy(key_of("doc_id").alias("k")).agg(F.count("*").alias("n"))
        self._ids = None
        if not met.filter("n > 1").limit(1).count():
            self.texts = rows.select(key_of("doc_id").alias("k"), "text")
            return
        named = rows.withColumn("digest", digest_of("text"))
        own = named.select("doc_id", "digest").distinct().repartitionByRange("doc_id", "digest")
        own = own.sortWithinPartitions("doc_id", "digest").withColumn("k", F.monotonically_increasing_id())
        self._ids = settle(own)
        ids = self._ids.withColumnsRenamed({"doc_id": "own", "digest": "own_digest"})
        same = named["doc_id"].eqNullSafe(ids["own"]) & (named["digest"] == ids["own_digest"])
        self.texts = stored(named.join(ids, same).select("k", "text"))

    def one_each(self) -> DataFrame:
        """k, text: one row of each key."""
        return self.texts if self._ids is None else stored(self.texts.dropDuplicates(["k"]))

    def with_id(self, frame: DataFrame, key: str, name: str = "doc_id") -> DataFrame:
        """The frame with the id that a key stands for."""
        if self._ids is None:
            return frame.withColumn(name, id_of(key))
        ids = self._ids.select(F.col("k").alias("__key"), F.col("doc_id").alias(name))
        return frame.join(ids, frame[key] == ids["__key"], "left").drop("__key")


def with_small(big: DataFrame, small: DataFrame, on: Column, how: str = "inner") -> DataFrame:
    """A join with a table that is expected to be small.

    It is broadcast after its rows were counted; a larger one is joined by a shuffle, whose
    hot keys adaptive execution splits.  `small` should be settled, as it is read twice.
    """
    few = small.count() <= SMALL_ROWS
    return big.join(F.broadcast(small) if few else small, on, how)


def most_frequent(counted: DataFrame, count: str, most: int) -> Column:
    """Whether a row is above a count that at most `most` rows reach, from a histogram of counts."""
    step = F.floor(F.log2(F.col(count)) * 8)
    histogram = counted.groupBy(step.alias("step")).agg(F.count("*").alias("n"))  # 500 rows at most
    total, least = 0, None
    for row in sorted(histogram.collect(), reverse=True):
        total += row["n"]
        if total > most:
            break
        least = row["step"]
    return F.lit(False) if least is None else step >= F.lit(least)


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the n + 1 offsets of its rows; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most `most` bytes each; a longer row is a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        end = int(np.searchsorted(offsets, offsets[start] + most, side="right")) - 1
        end = min(max(end, start + 1), rows)
        yield start, end
        start = end


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (splitmix64's finaliser)."""
    values = values.astype(np.uint64, copy=True)
    values ^= values >> np.uint64(30)
    values *= np.uint64(0xBF58476D1CE4E5B9)
    values ^= values >> np.uint64(27)
    values *= np.uint64(0x94D049BB133111EB)
    values ^= values >> np.uint64(31)
    return values


def empty_batch(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([], f.type) for f in schema], schema=schema)
