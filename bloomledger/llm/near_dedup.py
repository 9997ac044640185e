"""Near-duplicate groups by one-permutation hashing with optimal densification.

1. Every text becomes its set of word shingles.  Documents with equal sets are one class.
2. A set's 64-bit hashes fall into `BINS` bins by their leading bits, and a bin keeps its
   least one.  An empty bin borrows from a filled one that a fixed random order of its
   own picks (optimal densification).  `ROWS` bins make a band; equal bands are a bucket.
   At a threshold of 85 % a pair misses all 32 bands of 7 with a probability below 1e-5, at
   80 % all 40 bands of 6 with one below 1e-5 (`bands_for`).
3. In a bucket only edges to its centre are candidates (a star).  The centre is the class
   that meets most others over all its buckets, which in a group of copies of one text is
   that text.  Edges are confirmed on the full sets.
4. A star can hide a link between two members whose centre is linked to one of them at
   most.  In buckets that still hold more than one component, all members are compared, as
   a product of their shingle matrices inside a task, and only links between components
   leave it.  So every link inside a bucket counts, and no pairs are listed.  Large buckets
   are cut into pairs of blocks of bounded size.
5. Connected components of the confirmed links.

Edges of a hot centre are cut into blocks of bounded size.  Band rows are counted before
they are joined, and full sets are computed from text again where they are compared.

Null or blank text: empty set, linked with nothing, a component of its own.  A null doc_id is
the smallest, and so is its component_id.  Each row is judged by its own text: different texts
of one doc_id, or without one, are linked if they are alike, and each is a document that can be
kept; rows with one doc_id and one text are one document.  An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm.common import RowKeys, mix64, row_chunks, settle, table, text_buffers
from bloomledger.llm.components import connected_components
from bloomledger.llm.shingles import shingle_sets

PERCENT = 85
BLOCK = 256  # edges of a centre, or members of a bucket, that one group holds
COLUMNS = 4096  # shingles of a matrix part


class Bands:
    """How signatures are cut into buckets: bins, and bands of rows."""

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        # Order in which an empty bin (row) looks for a filled one (column).
        self.borrow = mix64(np.arange(self.bins**2, dtype=np.uint64) + np.uint64(1)).reshape(self.bins, self.bins)
        self.seeds = mix64(np.arange(bands, dtype=np.uint64) + np.uint64(0xBA2D))


def bands_for(percent: int) -> Bands:
    """Bands that a pair at the threshold misses altogether with a probability below 1e-5."""
    if percent < 80:
        raise ValueError("near copies are sought at 80 % and more")
    return Bands(32, 7) if percent >= 85 else Bands(40, 6)


def signature(hashes: np.ndarray, how: Bands) -> np.ndarray:
    """The least hash of each bin, empty bins filled; `hashes` is sorted and not empty."""
    bins = ((hashes >> np.uint64(32)) * np.uint64(how.bins) >> np.uint64(32)).astype(np.int64)
    first = np.flatnonzero(np.diff(bins, prepend=-1))
    filled = bins[first]
    out = np.zeros(how.bins, np.uint64)
    out[filled] = hashes[first]
    if len(filled) < how.bins:
        empty = np.ones(how.bins, bool)
        empty[filled] = False
        empty = np.flatnonzero(empty)
        out[empty] = out[filled[how.borrow[np.ix_(empty, filled)].argmin(axis=1)]]
    return out


def band_keys(signatures: np.ndarray, how: Bands) -> np.ndarray:
    """One 64-bit bucket key per band: rows x bands."""
    parts = signatures.reshape(len(signatures), how.bands, how.rows)
    keys = np.broadcast_to(how.seeds, parts.shape[:2]).copy()
    for j in range(how.rows):
        keys = mix64(keys * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, j])
    return keys


_PRINTS = "k long, n_shingles long, set_a long, set_b long, bands array<long>"


def _prints(bands: int, rows: int):
    """Size, two hashes and bucket keys of each row's shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        how = Bands(bands, rows)
        for batch in batches:
            data, offsets = text_buffers(batch.column("text"))
            for start, end in row_chunks(offsets):
                part = offsets[start : end + 1]
                sets = shingle_sets(data[part[0] : part[-1]], part - part[0])
                sizes = np.array([len(s) for s in sets], np.int64)
                some = [s for s in sets if len(s)]
                with np.errstate(over="ignore"):
                    one = np.array([mix64(s ^ np.uint64(0x5BD1E995)).sum(dtype=np.uint64) for s in sets], np.uint64)
                    two = np.array([np.bitwise_xor.reduce(mix64(s + np.uint64(0xC2B2AE35))) for s in sets], np.uint64)
                    keys = band_keys(np.array([signature(s, how) for s in some]), how) if some else np.zeros((0, bands), np.uint64)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("k").slice(start, end - start),
                        pa.array(sizes),
                        pa.array(one.view(np.int64)),
                        pa.array(two.view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel().view(np.int64))),
                    ],
                    names=["k", "n_shingles", "set_a", "set_b", "bands"],
                )

    return run


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Overlap of members with the centre whose row precedes theirs (rows are in that order)."""
    centre_id, centre = None, np.zeros(0, np.uint64)
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        ids, members = batch.column("a").to_pylist(), batch.column("b").to_pylist()
        found: list[tuple[int, int, int, int]] = []
        for start, end in row_chunks(offsets):
            part = offsets[start : end + 1]
            sets = shingle_sets(data[part[0] : part[-1]], part - part[0])
            for row, own in enumerate(sets, start):
                if members[row] is None:
                    centre_id, centre = ids[row], own
                    continue
                assert centre_id == ids[row], "a centre's row comes before its members'"
                at = np.minimum(np.searchsorted(centre, own), len(centre) - 1)
                shared = int((centre[at] == own).sum()) if len(centre) else 0
                found.append((ids[row], members[row], shared, len(own) + len(centre) - shared))
        columns = zip(*found) if found else ((), (), (), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], names=["a", "b", "shared", "either"]
        )


def overlaps(texts: DataFrame, edges: DataFrame) -> DataFrame:
    """a, b, shared, either: sizes of intersection and union of the full sets of each edge."""
    blocks = edges.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BLOCK)).alias("blocks"))
    cut = edges.join(blocks, "a").withColumn("block", F.pmod(F.xxhash64("b"), F.col("blocks"))).select("a", "b", "block")
    cut = settle(cut)
    members = cut.select(F.col("b").alias("k"), "a", "block", "b")
    centres = cut.select("a", "block").distinct()
    centres = centres.select(F.col("a").alias("k"), "a", "block", F.lit(None).cast("long").alias("b"))
    grouped = members.unionByName(centres).join(texts, "k").select("a", "block", "b", "text").repartition("a", "block")
    ordered = grouped.sortWithinPartitions("a", "block", F.col("b").asc_nulls_first())
    return ordered.select("a", "b", "text").mapInArrow(_compare, "a long, b long, shared long, either long")


def near_groups(texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """k, n_shingles and component (a key) of every row (k, text); rows of one key have one text."""
    how = bands_for(percent)
    prints = settle(texts.mapInArrow(_prints(how.bands, how.rows), _PRINTS))
    same = ["set_a", "set_b", "n_shingles"]
    classes = settle(
        prints.filter("n_shingles > 0").groupBy(*same).agg(F.min("k").alias("r"), F.first("bands").alias("bands"))
    )

    rows = classes.select("r", F.explode("bands").alias("bucket"))
    shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
    rows = settle(rows.join(shared, "bucket"))
    meets = rows.groupBy("r").agg(F.sum("n").alias("meets"))
    rows = rows.join(meets, "r").select("bucket", "r", "meets")
    centres = rows.groupBy("bucket").agg(F.min(F.struct(-F.col("meets"), "r"))["r"].alias("centre"))
    rows = settle(rows.select("bucket", "r").join(centres, "bucket"))

    # All comparisons are between classes that share a bucket: their texts are moved once.
    texts = settle(texts.join(rows.select(F.col("r").alias("k")).distinct(), "k", "left_semi"))
    stars = rows.filter("r <> centre").select(F.col("centre").alias("a"), F.col("r").alias("b")).distinct()
    measured = overlaps(texts, stars).groupBy("a", "b").agg(F.max(F.struct("shared", "either")).alias("o"))
    measured = settle(measured.select("a", "b", "o.*"))
    linked = f"100 * shared >= {percent} * either"
    groups = settle(connected_components(measured.filter(linked).select("a", "b")))

    late = settle(_hidden_links(rows, groups, texts, percent))
    edges = groups.select(F.col("id").alias("a"), F.col("component").alias("b"))
    groups = settle(connected_components(edges.unionByName(late)))

    classes = classes.drop("bands").join(groups, classes["r"] == groups["id"], "left")
    classes = classes.select(*same, F.coalesce("component", "r").alias("component"))
    out = prints.drop("bands").join(classes, same, "left")
    return out.select("k", "n_shingles", F.coalesce("component", "k").alias("component"))


def links_between(sets: list[np.ndarray], component: np.ndarray, block: np.ndarray, percent: int) -> np.ndarray:
    """Pairs of rows (i < j) of different components that are linked.

    If rows are of two blocks, only pairs across them are looked at.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    common = counts[column] > 1  # a shingle of one row alone adds to no intersection
    owner, column = owner[common], column[common]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    for low in range(0, int(column.max()) + 1 if len(column) else 0, COLUMNS):
        start, end = np.searchsorted(column, [low, low + COLUMNS])
        part = np.zeros((len(sets), COLUMNS), np.float32)
        part[owner[start:end], column[start:end] - low] = 1
        shared += part @ part.T
    either = sizes[:, None] + sizes[None, :] - shared
    linked = (100 * shared >= percent * either) & (component[:, None] != component[None, :])
    if len(np.unique(block)) > 1:
        linked &= block[:, None] != block[None, :]
    return np.argwhere(np.triu(linked, 1))


def _hidden_links(rows: DataFrame, groups: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links between components inside buckets; those of the centres are known."""
    rows = rows.join(groups, rows["r"] == groups["id"], "left").select(
        "bucket", "r", "centre", F.coalesce("component", "r").alias("component")
    )
    buckets = rows.groupBy("bucket").agg(
        F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("n")
    )
    mixed = buckets.filter("lo <> hi and n > 2").select("bucket", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    rows = rows.filter("r <> centre").join(mixed, "bucket")
    rows = rows.withColumn("block", F.pmod(F.xxhash64("r"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        F.col("r").alias("k"), "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"), "block", "component"
    )
    key = ["bucket", "one", "two"]
    grouped = settle(rows).join(texts, "k").repartition(*key).sortWithinPartitions(*key)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, blocks, components, sets in _whole_groups(batches):
            pairs = links_between(sets, components, blocks, percent)
            if len(pairs):
                yield pa.RecordBatch.from_arrays([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], names=["a", "b"])

    return grouped.select(*key, "k", "block", "component", "text").mapInArrow(compare, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Ids, blocks, components and shingle sets of the rows with one key, which follow each other."""
    key, ids, blocks, components, sets = None, [], [], [], []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in ("bucket", "one", "two"))))
        own = [batch.column(c).to_pylist() for c in ("k", "block", "component")]
        data, offsets = text_buffers(batch.column("text"))
        for start, end in row_chunks(offsets):
            part = offsets[start : end + 1]
            for row, one in enumerate(shingle_sets(data[part[0] : part[-1]], part - part[0]), start):
                if keys[row] != key:
                    if len(ids) > 1:
                        yield np.array(ids), np.array(blocks), np.array(components), sets
                    key, ids, blocks, components, sets = keys[row], [], [], [], []
                ids.append(own[0][row])
                blocks.append(own[1][row])
                components.append(own[2][row])
                sets.append(one)
    if len(ids) > 1:
        yield np.array(ids), np.array(blocks), np.array(components), sets


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row."""
    keys = RowKeys(docs)
    found = keys.with_id(keys.with_id(near_groups(keys.texts, percent), "k"), "component", "component_id")
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


# All pairs of documents that share a shingle, and everything that can be reached over links.
OP5_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE
    WHEN len(w) >= 5 THEN list_distinct(list_transform(generate_series(1, len(w) - 4), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE CAST([] AS VARCHAR[]) END AS s FROM words
), sizes AS (
  SELECT doc_id, len(s) AS n FROM sets
), members AS (
  SELECT doc_id, unnest(s) AS g FROM sets
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM members x JOIN members y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes i ON i.doc_id = a JOIN sizes j ON j.doc_id = b WHERE 100 * shared >= 85 * (i.n + j.n - shared)
), steps AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached AS (
  SELECT doc_id, doc_id AS other FROM sizes
  UNION
  SELECT r.doc_id, s.b FROM reached r JOIN steps s ON s.a = r.other
)
SELECT doc_id, CAST(any_value(n) AS BIGINT) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id
"""
