"""Exact nearest names by cosine similarity, as a blocked product that skips most of itself.

Every name must be compared with the whole catalog to find its true best candidates.  The
comparison is cut into a grid: the catalog into blocks, the queries into chunks, by a hash of
their ids.  One task holds one cell and keeps the best k per query, so neither the full catalog
nor any list of pairs exists anywhere, and both sides may grow without limit.  Cells are sized by
the number of non-zero slots they hold, whatever the length of the vectors; vectors travel as
those slots.  A window over the k rows per block then merges the cells.

Inside a cell, sparse vectors without negative values go through inverted lists: a list per slot
with its greatest weight.  A query adds up its lists from the one that can give most to the one
that can give least.  What the lists still to come can give at most is known all the time, and so
is the k-th best sum so far, which only grows.  Rows whose sum and what is to come stay below it
are out, among them those that no list has named; as soon as it takes fewer products to multiply
out the rows that are left than to read on, this is done.  Dense vectors, and those with negative values, are
multiplied in full, one small part of the cell at a time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Non-zero slots of one side of a grid cell: 50 MB as slot and value; a task holds both sides
# and one copy of each, 200 MB, and the matrix parts below.
CELL_VALUES = 1 << 22
# Rows of one side at most: sums of a query over its lists take 8 bytes for each catalog row.
CELL_ROWS = 65536
# A cell with more products than this is cut for parallel work, into so many chunks at most.
CELL_PRODUCTS = 1 << 28
PARALLEL_CHUNKS = 32
# Rows that are filled in at a time: with 256 slots 8 MB for the catalog, 0.5 MB for queries.
PART_ROWS = 4096
SLICE_ROWS = 256

# Scores are compared after rounding: equal vectors must tie, and the order of
# additions inside the product would otherwise decide between them.
SCORE_DIGITS = 9
# A bound below the k-th best by less than this is no reason to skip.
SLACK = 1e-8


def _best_of_cell(k: int, counted: list[int] | None = None):
    """Function of one grid cell: its queries' best `k` of its catalog block.

    All of it is nested, so that Spark ships it to the executors by value and
    they need no installed copy of this package.  `counted` takes the number of products
    of the calls in this process.
    """

    def flat(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ends of rows, slots and values of all of them."""
        slots, values = rows["slots"].combine_chunks(), rows["values"].combine_chunks()
        ends = np.asarray(slots.offsets).astype(np.int64)
        inside = slice(ends[0], ends[-1])
        return ends - ends[0], slots.values.to_numpy()[inside].astype(np.int64), values.values.to_numpy()[inside]

    def count(products: int) -> None:
        if counted is not None:
            counted.append(int(products))

    def parts(rows: tuple, size: int, length: int):
        """Row ranges as dense matrices, with the lengths of their rows."""
        ends, slots, values = rows
        for start in range(0, len(ends) - 1, size):
            end = min(start + size, len(ends) - 1)
            dense = np.zeros((end - start, length))
            line = np.repeat(np.arange(end - start), np.diff(ends[start : end + 1]))
            inside = slice(ends[start], ends[end])
            dense[line, slots[inside]] = values[inside]
            yield start, dense, np.sqrt(np.einsum("ij,ij->i", dense, dense))

    def in_full(queries: tuple, catalog: tuple, length: int):
        """Best rows by the whole product, part by part."""
        for q_start, q_rows, q_norm in parts(queries, SLICE_ROWS, length):
            found = np.zeros((len(q_rows), 0))
            place = np.zeros((len(q_rows), 0), np.int64)
            for c_start, c_rows, c_norm in parts(catalog, PART_ROWS, length):
                norms = q_norm[:, None] * c_norm[None, :]
                dots = q_rows @ c_rows.T
                count(dots.size * length)
                cosines = np.divide(dots, norms, out=np.zeros_like(dots), where=norms > 0)
                cosines = np.round(cosines, SCORE_DIGITS) + 0.0
                # Earlier parts come first, so a stable sort keeps ties in id order.
                found = np.concatenate([found, cosines], axis=1)
                place = np.concatenate(
                    [place, np.broadcast_to(np.arange(c_start, c_start + len(c_rows)), cosines.shape)], axis=1
                )
                if found.shape[1] > k:
                    limit = np.partition(found, -k, axis=1)[:, -k, None]
                    better, equal = found > limit, found == limit
                    room = k - better.sum(axis=1, keepdims=True)
                    near = better | (equal & (np.cumsum(equal, axis=1) <= room))
                    found, place = found[near].reshape(-1, k), place[near].reshape(-1, k)
            yield np.repeat(np.arange(q_start, q_start + len(q_rows)), found.shape[1]), place.ravel(), found.ravel()

    def by_lists(queries: tuple, catalog: tuple, length: int):
        """Best rows by inverted lists and bounds, query by query."""
        ends, slots, values = catalog
        n = len(ends) - 1
        owner = np.repeat(np.arange(n), np.diff(ends))
        norm = np.sqrt(np.bincount(owner, values * values, n))
        weight = np.divide(values, norm[owner], out=np.zeros_like(values), where=norm[owner] > 0)
        order = np.argsort(slots, kind="stable")
        list_rows, list_weights = owner[order], weight[order]
        list_ends = np.searchsorted(slots[order], np.arange(length + 1))
        most = np.zeros(length)
        np.maximum.at(most, slots, weight)
        sums, wanted = np.zeros(n), np.zeros(length)
        mean_slots = len(slots) / n
        q_ends, q_slots, q_values = queries
        for query in range(len(q_ends) - 1):
            own = slice(q_ends[query], q_ends[query + 1])
            size = np.sqrt((q_values[own] ** 2).sum())
            slot, part = q_slots[own], q_values[own] / size if size > 0 else q_values[own]
            gain = part * most[slot]
            by_gain = np.argsort(-gain, kind="stable")
            to_come = np.append(np.cumsum(gain[by_gain][::-1])[::-1], 0.0)
            size_of = list_ends[slot + 1] - list_ends[slot]
            lists_to_come = np.append(np.cumsum(size_of[by_gain][::-1])[::-1], 0)
            kth, products, left, rows = -1.0, 0, to_come[0], np.arange(n)
            sums[:] = 0.0
            for done, at in enumerate(by_gain, 1):
                one = slice(list_ends[slot[at]], list_ends[slot[at] + 1])
                sums[list_rows[one]] += part[at] * list_weights[one]
                products += one.stop - one.start
                left = to_come[done]
                # The k-th best is worth knowing once it may end the sum.
                if n > k and left < to_come[0] / 2:
                    kth = max(kth, np.partition(sums, n - k)[n - k])
                    rows = np.flatnonzero(sums + left >= kth - SLACK)
                    if len(rows) * mean_slots <= lists_to_come[done]:
                        break
            wanted[slot] = part
            inside = np.repeat(ends[rows] - np.append(0, np.cumsum(np.diff(ends)[rows])[:-1]), np.diff(ends)[rows])
            inside = inside + np.arange(len(inside))
            line = np.repeat(np.arange(len(rows)), np.diff(ends)[rows])
            scores = np.bincount(line, wanted[slots[inside]] * weight[inside], len(rows))
            wanted[slot] = 0.0
            count(products + len(inside))
            scores = np.round(scores, SCORE_DIGITS) + 0.0
            best = np.lexsort((rows, -scores))[:k]
            yield np.full(len(best), query), rows[best], scores[best]

    def best(queries: pa.Table, catalog: pa.Table) -> pa.Table:
        # Rows without a vector are dropped here: as a filter of the query, the
        # test would have the vectors computed twice.
        queries = queries.select(["query_id", "length", "slots", "values"]).drop_null()
        catalog = catalog.select(["catalog_id", "length", "slots", "values"]).drop_null()
        out_schema = pa.schema(
            [
                ("query_id", queries.schema.field("query_id").type),
                ("catalog_id", catalog.schema.field("catalog_id").type),
                ("score", pa.float64()),
            ]
        )
        if queries.num_rows == 0 or catalog.num_rows == 0:
            return out_schema.empty_table()
        lengths = {*queries["length"].unique().to_pylist(), *catalog["length"].unique().to_pylist()}
        if len(lengths) > 1:
            raise ValueError(f"vectors must have one length, but there are {sorted(lengths)}")
        length = lengths.pop()
        # Sorted by id, so that ties go to the smaller one.
        catalog = catalog.sort_by("catalog_id").combine_chunks()
        left, right = flat(queries.combine_chunks()), flat(catalog)
        plain = min(left[2].min(initial=0.0), right[2].min(initial=0.0)) >= 0.0
        sparse = 4 * max(len(left[1]) / left[0].size, len(right[1]) / right[0].size) < length
        found = list((by_lists if plain and sparse else in_full)(left, right, length))
        q_take, c_take, scores = (np.concatenate(column) for column in zip(*found))
        return pa.table(
            [
                queries["query_id"].take(pa.array(q_take)),
                catalog["catalog_id"].take(pa.array(c_take)),
                pa.array(scores),
            ],
            schema=out_schema,
        )

    return best


def _non_zero(vector: str) -> list[Column]:
    """Length of a vector, its non-zero slots and their values."""
    used = F.filter(
        F.transform(vector, lambda v, i: F.struct(i.alias("slot"), v.cast("double").alias("value"))),
        lambda e: e["value"] != 0,
    )
    return [
        F.size(vector).alias("length"),
        F.when(F.col(vector).isNotNull(), used).alias("used"),
    ]


def _sizes(rows: DataFrame, key: str, vector: str) -> tuple[Column, Column]:
    """Rows and non-zero slots of one side, as part of the query."""
    slots = F.coalesce(F.size(F.filter(vector, lambda v: v != 0)), F.lit(0))
    return rows.select(F.count(key)).scalar(), rows.select(F.coalesce(F.sum(slots), F.lit(0))).scalar()


def _lines(total: Column, most: int) -> Column:
    """Number of grid lines, each with so much of the total at most."""
    return F.ceil(total / F.lit(most))


def top_k(
    queries: DataFrame,
    catalog: DataFrame,
    k: int = 10,
    block_rows: int = CELL_ROWS,
    chunk_rows: int = CELL_ROWS,
) -> DataFrame:
    """The `k` catalog rows most similar to each query row.

    queries: `query_id`, `query_vector`; catalog: `catalog_id`, `catalog_vector`;
    ids are unique, vectors are arrays of one length (other lengths fail).  Returns
    `query_id`, `catalog_id`, `score`, `rank` (1..k, ties by catalog id).

    The grid depends on the stated cell sizes and on the numbers of rows and non-zero slots,
    which are counted as part of the query; both inputs are best stored tables
    (`sinks.vector_store`), as their vectors are read for it.
    """
    q_rows, q_slots = _sizes(queries, "query_id", "query_vector")
    c_rows, c_slots = _sizes(catalog, "catalog_id", "catalog_vector")
    blocks = F.greatest(_lines(c_rows, block_rows), _lines(c_slots, CELL_VALUES), F.lit(1)).cast("int")
    # Below the size of a cell, work is spread by cutting the queries: the catalog is sent more often.
    products = F.least(_lines(q_rows.cast("double") * c_slots, CELL_PRODUCTS), F.lit(PARALLEL_CHUNKS))
    chunks = F.greatest(_lines(q_rows, chunk_rows), _lines(q_slots, CELL_VALUES), products, F.lit(1)).cast("int")

    def grid(rows: DataFrame, own: str, parts: Column, other: str, others: Column, key: str, vector: str):
        placed = rows.select(
            F.pmod(F.xxhash64(key), parts).cast("int").alias(own), others.alias("others"), key, *_non_zero(vector)
        )
        return placed.select(
            own,
            F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias(other),
            key,
            "length",
            F.col("used.slot").alias("slots"),
            F.col("used.value").alias("values"),
        )

    left = grid(queries, "chunk", chunks, "block", blocks, "query_id", "query_vector")
    right = grid(catalog, "block", blocks, "chunk", chunks, "catalog_id", "catalog_vector")
    types = {**dict(queries.dtypes), **dict(catalog.dtypes)}
    best = (
        left.select("block", "chunk", "query_id", "length", "slots", "values")
        .groupBy("block", "chunk")
        .cogroup(
            right.select("block", "chunk", "catalog_id", "length", "slots", "values").groupBy("block", "chunk")
        )
        .applyInArrow(
            _best_of_cell(k),
            f"query_id {types['query_id']}, catalog_id {types['catalog_id']}, score double",
        )
    )
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("catalog_id"))
    return best.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= k)
