"""Removal of repeated byte strings by a partitioned suffix array.

A byte goes if a string of `LENGTH` bytes covers it that also starts earlier: in a document
with a smaller id, or earlier in the same one.  Strings are judged on the input.

Only suffixes that begin at chosen positions are sorted.  Of the `GRAM`-byte grams inside a
string, the one with the least hash (the rightmost of equals) is its anchor; copies of a
string have the same anchor at the same place, and neighbouring strings mostly share theirs,
so there is one suffix for about 40 bytes.

0. A document whose whole text equals that of an earlier one goes as a whole (if it is long
   enough); its strings all start earlier, and none of them is first, so it takes no part in
   what follows.
1. Anchors are partitioned by sampled splitters of their hashes and sorted; those whose gram
   occurs once are dropped (at a partition's ends they are kept, which loses nothing).
2. The remaining suffixes, with the few bytes around them that their strings cover, are
   range-partitioned by sampled splitters of their leading tokens.  Document and position
   are the last parts of the range key, so a hot gram is spread over partitions, in order.
3. A bucket sorts the suffixes of each gram by multikey quicksort over 8-byte tokens.  The
   common prefix with the neighbours tells which strings can have a copy; these are compared
   in full by 64-bit hashes, and all but the first of equals are marked.
4. The first and last gram of a bucket may go on in the next one: there, the first of equals
   of each bucket are compared once more across the boundaries.

Null text is empty; texts shorter than LENGTH lose nothing.  A null doc_id is the smallest.
Rows with equal doc_id and different texts are documents of their own, in the order of the
texts' digests; rows with equal doc_id and text are one document and have one result.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import CHUNK_BYTES, RowKeys, mix64, row_chunks, settle, table, text_buffers

LENGTH = 100
GRAM = 16
SPAN = LENGTH - GRAM + 1  # grams of a string
REACH = SPAN - 1  # bytes that a string can have before its anchor
BLOCK_ROWS = 20_000  # suffixes compared at a time, unless one gram has more
SMALL_SORT = 2_048

_PLACE_BITS = 24
_PLACE_MASK = np.uint64((1 << _PLACE_BITS) - 1)
_LONG_STEP = 1 << 22  # bytes of one long text read at a time
_BYTE_CODES = np.random.default_rng(77).integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def tokens_at(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position as one big-endian number."""
    wide = data.astype(np.uint64)
    for step in (1, 2, 4):
        wide = (wide[:-step] << np.uint64(8 * step)) | wide[step:]
    return wide


def _window_least(values: np.ndarray, width: int) -> np.ndarray:
    reach = 1
    while reach * 2 <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gram hash, row, anchor, first and last start of each run of strings with one anchor."""
    none = np.zeros(0, np.int64)
    if len(data) < LENGTH:
        return none.astype(np.uint64), none, none, none, none
    eight = tokens_at(data)
    grams = mix64(mix64(eight[:-8]) * _BASE + eight[8:])
    place = _PLACE_MASK - np.arange(len(grams), dtype=np.uint64)
    least = _window_least((grams & ~_PLACE_MASK) | place, SPAN)
    at = (_PLACE_MASK - (least & _PLACE_MASK)).astype(np.int64)
    starts, ends = offsets[:-1], offsets[1:]
    long_rows = ends - starts >= LENGTH
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, starts[long_rows], 1)
    np.add.at(change, ends[long_rows] - LENGTH + 1, -1)
    string = np.flatnonzero(np.cumsum(change[: len(at)]) > 0)
    if not len(string):
        return none.astype(np.uint64), none, none, none, none
    own = at[string]
    first = np.flatnonzero(np.diff(own, prepend=-1))
    last = np.append(first[1:], len(own)) - 1
    anchor = own[first]
    row = np.searchsorted(offsets, anchor, side="right") - 1
    return grams[anchor], row, anchor - offsets[row], string[first] - offsets[row], string[last] - offsets[row]


def _row_pieces(data: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """A long text in steps that share no string."""
    for at in range(0, max(len(data) - LENGTH + 1, 1), _LONG_STEP):
        yield at, data[at : at + _LONG_STEP + LENGTH - 1]


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Gram hash, document and packed place (anchor, distances to the first and last start)."""
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        keys = batch.column("k").to_numpy(zero_copy_only=False)
        for start, end in row_chunks(offsets, CHUNK_BYTES):
            part = offsets[start : end + 1]
            chunk = data[part[0] : part[-1]]
            for shift, piece in _row_pieces(chunk) if end == start + 1 else [(0, chunk)]:
                rows = part - part[0] if end > start + 1 else np.array([0, len(piece)])
                gram, row, anchor, low, high = anchors(piece, rows)
                packed = ((anchor + shift) << 14) | ((anchor - low) << 7) | (anchor - high)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(keys[start + row]), pa.array(packed)], names=["h", "k", "p"]
                )


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by gram hash, whose neighbour has the same; and those at the ends."""
    held: pa.RecordBatch | None = None
    before = None  # the hash before the held row
    for batch in batches:
        if not batch.num_rows:
            continue
        joined = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        h = joined.column("h").to_numpy()
        same = h[1:] == h[:-1]
        keep = np.zeros(len(h), bool)
        keep[1:] |= same
        keep[:-1] |= same
        keep[0] |= before is None or before == h[0]
        out = joined.slice(0, len(h) - 1).filter(pa.array(keep[:-1]))
        if len(h) > 1:
            before = h[-2]
        held = joined.slice(len(h) - 1)
        yield out.select(["k", "p"])
    if held is not None:
        yield held.select(["k", "p"])


def _suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leading tokens, document, anchor, and the bytes of all strings of that anchor."""
    for batch in batches:
        data, offsets = text_buffers(batch.column("text"))
        keys = batch.column("k").to_numpy(zero_copy_only=False)
        lists = batch.column("ps")
        ends = np.asarray(lists.offsets)
        packed = lists.values.to_numpy(zero_copy_only=False)[ends[0] : ends[-1]]
        row = np.repeat(np.arange(len(keys)), np.diff(ends))
        step = 40_000
        for at in range(0, len(packed), step):
            p, r = packed[at : at + step], row[at : at + step]
            anchor = p >> 14
            before, after = (p >> 7) & 127, LENGTH - (p & 127)
            begin = offsets[r] + anchor - before
            size = before + after
            total = np.cumsum(size)
            index = np.arange(total[-1]) + np.repeat(begin - (total - size), size)
            lead = data[(offsets[r] + anchor)[:, None] + np.arange(GRAM)].view(">u8").astype(np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(lead[:, 0]),
                    pa.array(lead[:, 1]),
                    pa.array(keys[r]),
                    pa.array(anchor),
                    pa.array(before.astype(np.int32)),
                    pa.Array.from_buffers(
                        pa.binary(),
                        len(p),
                        [None, pa.py_buffer(np.append(0, total).astype(np.int32)), pa.py_buffer(data[index])],
                    ),
                ],
                names=["t0", "t1", "k", "a", "before", "bytes"],
            )


def multikey_order(tokens: np.ndarray, groups: np.ndarray) -> np.ndarray:
    """Order of rows of tokens within groups (ascending runs), by multikey quicksort.

    A segment is parted by its middle row's token into less, equal and greater; the equal
    part goes on with the next token.  Short segments are sorted directly.
    """
    order = np.arange(len(tokens))
    # Segments of several groups are parted by group first, as if that were a leading token.
    columns = [groups, *tokens.T]
    stack = [(0, len(order), 0)]
    while stack:
        low, high, depth = stack.pop()
        if high - low < 2 or depth == len(columns):
            continue
        rows = order[low:high]
        if high - low <= SMALL_SORT:
            order[low:high] = rows[np.lexsort([c[rows] for c in reversed(columns[depth:])])]
            continue
        values = columns[depth][rows]
        pivot = values[len(values) // 2]
        less, equal = values < pivot, values == pivot
        parts = [rows[less], rows[equal], rows[~less & ~equal]]
        order[low:high] = np.concatenate(parts)
        middle, end = low + len(parts[0]), low + len(parts[0]) + len(parts[1])
        stack += [(low, middle, depth), (middle, end, depth + 1), (end, high, depth)]
    return order


def _shared_prefix(right: np.ndarray, groups: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Longest common prefix of each suffix with a neighbour of its group in suffix order."""
    out = np.zeros(len(order), np.int64)
    if len(order) > 1:
        one, other = order[:-1], order[1:]
        differ = right[one] != right[other]
        common = np.where(differ.any(axis=1), differ.argmax(axis=1), right.shape[1])
        common[groups[one] != groups[other]] = 0
        out[one] = common
        out[other] = np.maximum(out[other], common)
    return out


def _string_hashes(around: np.ndarray) -> np.ndarray:
    """Hash of the string that begins b bytes before the anchor, for b = 0..REACH, by row."""
    codes = _BYTE_CODES[around]
    power = np.uint64(pow(int(_BASE), LENGTH, 1 << 64))
    sums = np.zeros((around.shape[1] + 1, len(around)), np.uint64)
    for j in range(around.shape[1]):
        sums[j + 1] = sums[j] * _BASE + codes[:, j]
    at = REACH - np.arange(REACH + 1)
    return mix64(sums[at + LENGTH] - sums[at] * power)


_MARKS = "k long, s long, e long, w long"


class Bucket:
    """Compares the suffixes of a bucket, gram by gram, as they come in order."""

    def __init__(self):
        self._opened = False

    def compare(self, rows: pa.Table, closed: bool) -> Iterator[pa.RecordBatch]:
        """Marks of whole grams; `closed` if the last one surely ends here."""
        n = rows.num_rows
        if not n:
            return
        t0, t1, k, a = (rows.column(c).to_numpy() for c in ("t0", "t1", "k", "a"))
        before = rows.column("before").to_numpy().astype(np.int64)
        data, offsets = text_buffers(rows.column("bytes"))
        size = np.diff(offsets)
        high = LENGTH - (size - before)  # how far before the anchor the last string begins
        new = np.ones(n, bool)
        new[1:] = (t0[1:] != t0[:-1]) | (t1[1:] != t1[:-1])
        groups = np.cumsum(new) - 1
        edge = np.zeros(n, bool)
        if not self._opened:
            edge |= groups == 0
        if not closed:
            edge |= groups == groups[-1]
        self._opened = True

        hashes, owners, starts = [], [], []
        for low in range(0, n, BLOCK_ROWS):
            top = min(low + BLOCK_ROWS, n)
            # A gram that a block cuts is compared whole: its prefixes are not narrowed.
            cut = edge[low:top].copy()
            cut |= groups[low:top] == (groups[low - 1] if low else -1)
            cut |= groups[low:top] == (groups[top] if top < n else -1)
            around = np.zeros((top - low, REACH + LENGTH), np.uint8)
            line = np.repeat(np.arange(top - low), size[low:top])
            column = np.arange(offsets[low], offsets[top]) - np.repeat(offsets[low:top] + before[low:top] - REACH, size[low:top])
            around[line, column] = data[offsets[low] : offsets[top]]
            right = around[:, REACH:]
            padded = np.zeros((top - low, 104), np.uint8)
            padded[:, :LENGTH] = right
            order = multikey_order(padded.view(">u8").astype(np.uint64), groups[low:top])
            common = np.where(cut, LENGTH, _shared_prefix(right, groups[low:top], order))
            # A string that begins b bytes before the anchor goes on LENGTH - b bytes after it.
            b = np.arange(REACH + 1)[:, None]
            may = (b <= before[low:top]) & (b >= high[low:top]) & (b >= LENGTH - common)
            found, who = np.nonzero(may)
            if len(who):
                hashes.append(_string_hashes(around)[found, who])
                owners.append(who + low)
                starts.append(a[low + who] - found)
        if not hashes:
            return
        h, who, s = np.concatenate(hashes), np.concatenate(owners), np.concatenate(starts)
        order = np.lexsort((s, k[who], h))
        h, who, s = h[order], who[order], s[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = h[1:] != h[:-1]
        first = np.flatnonzero(fresh)[np.cumsum(fresh) - 1]
        same_place = (k[who] == k[who[first]]) & (s == s[first])
        yield _spans(k[who[~same_place]], s[~same_place])
        left_open = fresh & edge[who]
        if left_open.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in (k[who[left_open]], s[left_open], s[left_open] + LENGTH, h[left_open].view(np.int64))],
                names=["k", "s", "e", "w"],
            )


def _spans(k: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    """Marked strings as spans: strings that begin next to each other are one."""
    order = np.lexsort((s, k))
    k, s = k[order], s[order]
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (s[1:] > s[:-1] + 1)
    at = np.flatnonzero(first)
    last = np.append(at[1:], len(k))[: len(at)] - 1
    return pa.RecordBatch.from_arrays(
        [pa.array(k[at]), pa.array(s[at]), pa.array(s[last] + LENGTH), pa.nulls(len(at), pa.int64())],
        names=["k", "s", "e", "w"],
    )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that are surely repeated (w null), and strings to compare across boundaries (w)."""
    bucket = Bucket()
    waiting: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        t0, t1 = batch.column("t0"), batch.column("t1")
        before, first, last = last, (t0[0], t1[0]), (t0[-1], t1[-1])
        waiting.append(batch)
        size += batch.num_rows
        # While one gram goes on, its rows are only gathered.
        if size < BLOCK_ROWS or before == first == last:
            continue
        rows = pa.Table.from_batches(waiting).combine_chunks()
        t0, t1 = rows.column("t0").to_numpy(), rows.column("t1").to_numpy()
        other = np.flatnonzero((t0 != t0[-1]) | (t1 != t1[-1]))
        whole = int(other[-1]) + 1 if len(other) else 0  # the last gram waits for its end
        yield from bucket.compare(rows.slice(0, whole).combine_chunks(), closed=True)
        waiting, size = rows.slice(whole).combine_chunks().to_batches(), len(t0) - whole
    if waiting:
        yield from bucket.compare(pa.Table.from_batches(waiting).combine_chunks(), closed=False)


def _merged(spans: list[dict] | None, size: int) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted((s["s"], min(s["e"], size)) for s in spans or ()):
        if start >= end:
            continue
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(s, e) for s, e in out]


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes and digest of what is left of each text."""
    for batch in batches:
        found = []
        for text, spans in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("spans").to_pylist()):
            text = text or b""
            gone = _merged(spans, len(text))
            digest, at = hashlib.sha256(), 0
            for start, end in gone:
                digest.update(memoryview(text)[at:start])
                at = end
            digest.update(memoryview(text)[at:])
            found.append((len(text), sum(e - s for s, e in gone), len(gone), digest.hexdigest()))
        n_bytes, removed, spans, digests = zip(*found) if found else ((),) * 4
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("k"),
                pa.array(n_bytes, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(spans, pa.int64()),
                pa.array(digests, pa.string()),
            ],
            names=["k", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def repeated_spans(texts: DataFrame) -> DataFrame:
    """k, spans: byte ranges of each document (columns k, text) that are repeated, unmerged."""
    whole = texts.select("k", F.md5(F.col("text").cast("binary")).alias("digest"), F.octet_length("text").cast("long").alias("e"))
    # Both sides are settled: adaptive execution can then split the rows of a hot text.
    whole = settle(whole.filter(F.col("e") >= LENGTH))
    firsts = whole.groupBy("digest", "e").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    firsts = settle(firsts.filter("n > 1").drop("n"))
    copies = whole.join(firsts, ["digest", "e"]).filter("k <> first").select("k", F.lit(0).cast("long").alias("s"), "e")

    grams = texts.join(copies.select("k"), "k", "left_anti").select("k", "text").mapInArrow(_anchor_rows, "h long, k long, p long")
    grams = grams.repartitionByRange("h", "k").sortWithinPartitions("h")
    places = grams.mapInArrow(_repeated, "k long, p long").groupBy("k").agg(F.collect_list("p").alias("ps"))
    suffixes = texts.join(places, "k").select("k", "text", "ps")
    suffixes = suffixes.mapInArrow(_suffixes, "t0 long, t1 long, k long, a long, before int, bytes binary")
    buckets = suffixes.repartitionByRange("t0", "t1", "k", "a").sortWithinPartitions("t0", "t1", "k", "a")
    marks = buckets.mapInArrow(_compare, _MARKS)
    # Across boundaries each bucket has at most one row of a string.
    sure = F.col("w").isNull()
    marks = marks.withColumn("sure", sure).withColumn("w", F.coalesce("w", F.xxhash64("k", "s")))
    in_order = Window.partitionBy("w", "sure").orderBy("k", "s")
    first = F.first(F.struct("k", "s")).over(in_order)
    marks = marks.withColumn("first", first).filter(F.col("sure") | (F.col("first") != F.struct("k", "s")))
    marks = marks.select("k", "s", "e").unionByName(copies)
    return marks.groupBy("k").agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, bytes, removed bytes, removed runs and digest of the rest of every row."""
    keys = RowKeys(docs)
    marked = keys.texts.join(repeated_spans(keys.one_each()), "k", "left")
    cut = marked.select("k", "text", "spans").mapInArrow(_cut, "k long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return keys.with_id(cut, "k").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))


# Every string of 100 bytes by its digest, all but the first of equals, and what they cover.
OP6_SQL = """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents
), strings AS (
  SELECT doc_id, s, md5(substr(x, 2 * s + 1, 200)) AS d FROM (
    SELECT doc_id, x, unnest(generate_series(0, n - 100)) AS s FROM texts WHERE n >= 100)
), again AS (
  SELECT doc_id, s FROM (SELECT *, row_number() OVER (PARTITION BY d ORDER BY doc_id, s) AS r FROM strings) WHERE r > 1
), runs AS (
  SELECT doc_id, s, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS run
  FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM again)
), spans AS (
  SELECT doc_id, min(s) AS b, max(s) + 100 AS e FROM runs GROUP BY doc_id, run
), rest AS (
  SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS kept_from FROM spans
), cut AS (
  SELECT doc_id, sum(e - b) AS removed, count(*) AS n_spans, max(e) AS last_end,
    string_agg(substr(x, 2 * kept_from + 1, 2 * (b - kept_from)), '' ORDER BY b) AS head
  FROM rest JOIN texts USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last_end, 0) + 1))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
"""
