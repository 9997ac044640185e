"""Benchmark decontamination by q-gram lemma filtering: any passage of an item.

A passage is any stretch of `PASSAGE_BYTES` of a benchmark item, at whatever offset, or the
whole of a shorter item.  A passage of W bytes that occurs in a document with at most
k = 5 % edits shares at least W + 1 - q (k + 1) q-grams with it, all on k + 1 neighbouring
diagonals (document position minus item position), and inside W + k bytes of the document.
So all q-grams of all items are indexed; those that a document shares are counted by item in
diagonal bands of 2 (k + 1), of which each overlaps half of the next, over windows of the
document that slide.  Where the bound is reached, the region is looked through for stretches as
they are, and else aligned.  Nothing that has k edits or fewer is lost.

An item that repeats itself (a q-gram at more than `REPEATS` places) would meet repetitive text
on all of its diagonals.  Its q-grams are counted once for a place of the document, without a
diagonal, which can only add regions.  Shared q-grams are listed for at most `HITS` at a time, so
memory follows neither the length of a document nor its likeness to an item.

Text is compared as UTF-8 with A-Z lowered and each run of ASCII white space as one blank;
long documents are read in steps that overlap by the longest item after blanks have been joined.
Documents are read as a stream and never shuffled.  The benchmark is settled once and goes to
the tasks in blocks of about `BLOCK_BYTES` of its text: one pass over the documents for every
8 MB of benchmark, and one block in memory at a time.

Null or blank text, of a document or an item, has no match.  An item shorter than a q-gram must
occur as it is.  `drop_leaks` leaves items below `LEAST_ITEM_BYTES` aside, as they say little;
`short_items` lists them.  Repeated documents match each on their own; repeated items count as
one if they have the same id.  Null ids stay null.  Empty tables give no match.  Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm.common import mix64, row_chunks, settle, stored, table, text_buffers
from bloomledger.llm.shingles import IS_BLANK, LOWER

Q = 12
EDIT_PERCENT = 5
PASSAGE_BYTES = 50
LEAST_ITEM_BYTES = 25
REPEATS = 4
BLOCK_BYTES = 8 << 20
TEXT_STEP = 1 << 20  # bytes of one document that are searched at a time
HITS = 1 << 20  # shared q-grams that are listed at a time
TILE = 200  # bytes of a document that are aligned at a time

_MATCHES = "doc_id long, item_id string, passage_bytes long, edits long, first_start long, last_end long"

# A match: row, item, bytes of the passage, edits, start and end in the text that is compared.
Found = tuple[int, int, int, int, int, int]


def plain_bytes(data: np.ndarray, starts: np.ndarray | int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of texts that are compared, and the position of each in the data."""
    blank = IS_BLANK[data]
    keep = ~blank
    keep[1:] |= ~blank[:-1]
    keep[starts] = True  # a text's first blank never belongs to the text before
    at = np.flatnonzero(keep)
    out = LOWER[data[at]]
    out[blank[at]] = 32
    return out, at


def plain_item(text: bytes) -> bytes:
    return plain_bytes(np.frombuffer(text, np.uint8))[0].tobytes().strip(b" ") if text else b""


def gram_keys(data: np.ndarray) -> np.ndarray:
    """A 64-bit key of each q-gram (4 + 8 bytes)."""
    n = len(data) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    wide = data.astype(np.uint64)
    two = (wide[:-1] << np.uint64(8)) | wide[1:]
    four = (two[:-2] << np.uint64(16)) | two[2:]
    eight = (four[4 : 4 + n] << np.uint64(32)) | four[8 : 8 + n]
    return mix64(eight) * np.uint64(0x9E3779B97F4A7C15) + four[:n]


def edits_allowed(length: int) -> int:
    """The edit budget of a passage: its share of the length, as far as the bound stays above 0."""
    return max(0, min(length * EDIT_PERCENT // 100, length // Q - 1))


# --- alignment --------------------------------------------------------------------------


def window_edits(item: np.ndarray, first: int, last: int, width: int, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest edits of each window of the item (starts first..last) inside the text, and where it ends there."""
    windows = np.lib.stride_tricks.sliding_window_view(item, width)[first : last + 1]
    steps = np.arange(len(text) + 1, dtype=np.int32)
    cost = np.zeros((len(windows), len(text) + 1), np.int32)
    for i in range(width):
        now = cost + 1  # the window's byte is left out
        np.minimum(now[:, 1:], cost[:, :-1] + (windows[:, i, None] != text[None, :]), out=now[:, 1:])
        # Leaving out text bytes moves along the row.
        cost = np.minimum.accumulate(now - steps, axis=1) + steps
    ends = cost.argmin(axis=1)
    return cost[np.arange(len(windows)), ends], ends


def start_of(window: np.ndarray, text: np.ndarray) -> int:
    """Where the best alignment of a window that ends with the text begins."""
    steps = np.arange(len(text) + 1, dtype=np.int32)
    back, cost = text[::-1], steps.copy()
    for byte in window[::-1]:
        now = cost + 1
        np.minimum(now[1:], cost[:-1] + (back != byte), out=now[1:])
        cost = np.minimum.accumulate(now - steps) + steps
    return len(text) - int(cost.argmin())


# --- index ------------------------------------------------------------------------------


class Index:
    """The q-grams of one block of the benchmark."""

    def __init__(self, items: list[tuple[str | None, bytes]]):
        plain = [(name, plain_item(text)) for name, text in items]
        plain = [(name, text) for name, text in plain if text]
        self.names = [name for name, _ in plain]
        self.texts = [text for _, text in plain]
        lengths = np.array([len(t) for t in self.texts], np.int64)
        self.width = np.minimum(lengths, PASSAGE_BYTES)
        self.most = np.array([edits_allowed(int(n)) for n in self.width], np.int64)
        self.least = np.maximum(self.width + 1 - Q * (self.most + 1), 1)
        self.longest = int(lengths.max(initial=0))
        self.short = np.flatnonzero(lengths < Q).tolist()
        self._exact: dict[int, dict[bytes, int]] = {}

        grams = [gram_keys(np.frombuffer(t, np.uint8)) for t in self.texts]
        counts = [len(g) for g in grams]
        keys = np.concatenate([np.zeros(0, np.uint64), *grams])
        owner = np.repeat(np.arange(len(grams)), counts)
        place = np.concatenate([np.zeros(0, np.int64), *map(np.arange, counts)])
        order = np.lexsort((place, owner, keys))
        keys, owner, place = keys[order], owner[order], place[order]
        first = np.ones(len(keys), bool)
        first[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        times = np.diff(np.flatnonzero(np.append(first, True)))
        self.repetitive = np.zeros(len(self.texts), bool)
        self.repetitive[owner[first][times > REPEATS]] = True
        kept = first | ~self.repetitive[owner]
        keys, self.owner, self.place = keys[kept], owner[kept], place[kept]
        self.keys, self.first, self.count = np.unique(keys, return_index=True, return_counts=True)
        bits = min(max(22, 3 + int(len(self.keys)).bit_length()), 26)
        self.shift = np.uint64(64 - bits)
        self.seen = np.zeros(1 << bits, bool)
        self.seen[self.keys >> self.shift] = True

    def shared(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Text positions of shared q-grams, and the number of the q-gram in the index."""
        at = np.flatnonzero(self.seen[grams >> self.shift])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        found = np.minimum(np.searchsorted(self.keys, grams[at]), len(self.keys) - 1)
        same = self.keys[found] == grams[at]
        return at[same], found[same]

    def passages(self, item: int) -> dict[bytes, int]:
        """All passages of an item, with the place of the first of equals."""
        known = self._exact.get(item)
        if known is None:
            if len(self._exact) > 256:
                self._exact.clear()
            text, width = self.texts[item], int(self.width[item])
            known = self._exact[item] = {text[i : i + width]: i for i in range(len(text) - width, -1, -1)}
        return known


def _slices(position: np.ndarray, times: np.ndarray, reach: int) -> Iterator[slice]:
    """Ranges of shared q-grams with about `HITS` places in the index.

    A range begins `reach` text bytes before the last one ends, so that what lies within
    that many bytes is whole in one of them.
    """
    through = np.cumsum(times)
    start = 0
    while start < len(position):
        before = through[start - 1] if start else 0
        end = max(int(np.searchsorted(through, before + HITS, side="right")), start + 1)
        # Ranges have to go on: a range holds twice the reach at least.
        end = max(end, int(np.searchsorted(position, position[start] + 2 * reach, side="right")))
        yield slice(start, end)
        if end >= len(position):
            return
        start = max(int(np.searchsorted(position, position[end] - reach)), start + 1)


def _regions(index: Index, rows: np.ndarray, position: np.ndarray, gram: np.ndarray) -> Iterator[tuple[int, int, int, int, int, int]]:
    """(row, item, first and last text position, lowest and highest diagonal) that reach the bound."""
    times = index.count[gram]
    entry = np.repeat(index.first[gram], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    t, row = np.repeat(position, times), np.repeat(rows, times)
    item = index.owner[entry]
    step = index.most[item] + 1
    base = int(t[0])
    diagonal = t - base - index.place[entry] + index.longest
    loose = index.repetitive[item]
    band = np.where(loose, 0, diagonal // step + 1)
    twice = np.flatnonzero(~loose)
    band = np.concatenate([band, band[twice] - 1])
    t, row, item = (np.concatenate([x, x[twice]]) for x in (t, row, item))
    n_bands = int(band.max()) + 2
    key = (row * len(index.texts) + item) * n_bands + band
    order = np.lexsort((t, key))
    key, t, item, row, band = key[order], t[order], item[order], row[order], band[order]
    last = np.arange(len(t)) + index.least[item] - 1
    inside = np.minimum(last, len(t) - 1)
    span = index.width[item] + index.most[item] - Q + 1
    good = np.flatnonzero((last < len(t)) & (key[inside] == key) & (t[inside] - t < span))
    if not len(good):
        return
    low, high = t[good], t[inside[good]]
    new = np.ones(len(good), bool)
    new[1:] = (key[good][1:] != key[good][:-1]) | (low[1:] > high[:-1])
    begins = np.flatnonzero(new)
    ends = np.append(begins[1:], len(good)) - 1
    for b, e in zip(begins.tolist(), ends.tolist()):
        i = good[b]
        one = int(item[i])
        if index.repetitive[one]:
            bounds = None, None
        else:
            wide = int(index.most[one]) + 1
            lowest = (int(band[i]) - 1) * wide - index.longest + base
            bounds = lowest, lowest + 2 * wide - 1
        yield int(row[i]), one, int(low[b]), int(high[e]), *bounds


def _as_they_are(index: Index, item: int, plain: np.ndarray, begin: int, end: int, row: slice) -> list[tuple[int, int]]:
    """Start and end of stretches of the item in a region, as far as they go on inside the row."""
    known, width, whole = index.passages(item), int(index.width[item]), index.texts[item]
    text = plain[begin:end].tobytes()
    out: list[tuple[int, int]] = []
    for at in range(len(text) - width + 1):
        if out and begin + at + width <= out[-1][1]:
            continue  # inside the stretch found last
        place = known.get(text[at : at + width])
        if place is None:
            continue
        start, stop = begin + at, begin + at + width
        back, ahead = place, place + width
        while back and start > row.start and plain[start - 1] == whole[back - 1]:
            start, back = start - 1, back - 1
        while ahead < len(whole) and stop < row.stop and plain[stop] == whole[ahead]:
            stop, ahead = stop + 1, ahead + 1
        out.append((start, stop))
    return out


def _aligned(index: Index, item: int, text: np.ndarray, first: int, last: int) -> list[tuple[int, int, int, int]]:
    """Stretches of the item, windows first..last, within their budget: (bytes, edits, start, end)."""
    width, most = int(index.width[item]), int(index.most[item])
    whole = np.frombuffer(index.texts[item], np.uint8)
    reach = width + most
    out = []
    for at in range(0, max(len(text) - reach, 0) + 1, TILE):
        part = text[at : at + TILE + reach]
        edits, ends = window_edits(whole, first, last, width, part)
        good = np.flatnonzero(edits <= most)
        if not len(good):
            continue
        runs = np.split(good, np.flatnonzero(np.diff(good) > 1) + 1)
        for run in runs:
            start = start_of(whole[first + run[0] : first + run[0] + width], part[: ends[run[0]]])
            end = int(ends[run].max())
            if end > start:
                out.append((width + len(run) - 1, int(edits[run].min()), at + start, at + end))
    return out


def search(index: Index, plain: np.ndarray, bounds: np.ndarray) -> list[Found]:
    """All matches of rows (bounds in the plain bytes) with items of the block."""
    out: list[Found] = []
    grams = gram_keys(plain)
    position, gram = index.shared(grams)
    row = np.searchsorted(bounds, position, side="right") - 1
    inside = position + Q <= bounds[row + 1]
    position, gram, row = position[inside], gram[inside], row[inside]
    seen, exact = set(), set()
    for part in _slices(position, index.count[gram], 2 * PASSAGE_BYTES):
        waiting = []
        for one, item, low, high, lowest, highest in _regions(index, row[part], position[part], gram[part]):
            reach = int(index.width[item] + index.most[item])
            begin = max(int(bounds[one]), low - reach)
            end = min(int(bounds[one + 1]), high + Q + reach)
            if (one, item, begin, end) in seen:
                continue
            as_is = _as_they_are(index, item, plain, begin, end, slice(int(bounds[one]), int(bounds[one + 1])))
            if as_is:
                seen.add((one, item, begin, end))
                exact.add((one, item))
                out += [(one, item, e - s, 0, s, e) for s, e in as_is]
            elif index.most[item]:
                waiting.append((one, item, begin, end, lowest, highest))
        for one, item, begin, end, lowest, highest in waiting:
            if (one, item) in exact:
                continue
            width = int(index.width[item])
            first, last = 0, len(index.texts[item]) - width
            if lowest is not None:  # windows that lie on the band's diagonals
                first = max(first, begin - highest - int(index.most[item]))
                last = min(last, end - lowest + int(index.most[item]) - width)
            if first > last:
                continue
            found = _aligned(index, item, plain[begin:end], first, last)
            out += [(one, item, size, edits, begin + s, begin + e) for size, edits, s, e in found]
    for item in index.short:
        wanted = index.texts[item]
        for one in range(len(bounds) - 1):
            at = plain[bounds[one] : bounds[one + 1]].tobytes().find(wanted)
            if at >= 0:
                start = int(bounds[one]) + at
                out.append((one, item, len(wanted), 0, start, start + len(wanted)))
    return out


def _steps(data: np.ndarray, step: int, overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """What is compared of a long text, in steps, with positions in the text.

    A step repeats the last `overlap` compared bytes of the one before.
    """
    plain, at = np.zeros(0, np.uint8), np.zeros(0, np.int64)
    for begin in range(0, len(data), step):
        more, where = plain_bytes(data[begin : begin + step])
        if len(plain) and len(more) and plain[-1] == 32 and more[0] == 32:
            more, where = more[1:], where[1:]
        plain, at = np.concatenate([plain[-overlap:], more]), np.concatenate([at[-overlap:], where + begin])
        yield plain, at


def search_rows(index: Index, data: np.ndarray, offsets: np.ndarray) -> Iterator[Found]:
    """Matches of texts; start and end are bytes of the text as it is."""
    for first, end in row_chunks(offsets, TEXT_STEP):
        part = offsets[first : end + 1]
        chunk = data[part[0] : part[-1]]
        if len(chunk) <= TEXT_STEP:
            plain, at = plain_bytes(chunk, part[:-1][np.diff(part) > 0] - part[0])
            bounds = np.searchsorted(at, part - part[0])
            for row, item, size, edits, s, e in search(index, plain, bounds):
                origin = part[row] - part[0]
                yield first + row, item, size, edits, int(at[s] - origin), int(at[e - 1] + 1 - origin)
            continue
        overlap = index.longest + 2 * PASSAGE_BYTES
        for plain, at in _steps(chunk, max(TEXT_STEP, 2 * overlap), overlap):
            for _, item, size, edits, s, e in search(index, plain, np.array([0, len(plain)])):
                yield first, item, size, edits, int(at[s]), int(at[e - 1]) + 1


# --- tables -----------------------------------------------------------------------------


def _matches(docs: DataFrame, shared) -> DataFrame:
    """One row per document and item of this block that match."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = None
        for batch in batches:
            index = index or Index(shared.value)
            data, offsets = text_buffers(batch.column("text"))
            found: dict[tuple[int, str | None], list[int]] = {}
            for row, item, size, edits, start, end in search_rows(index, data, offsets):
                best = found.setdefault((row, index.names[item]), [size, edits, start, end])
                best[:] = max(best[0], size), min(best[1], edits), min(best[2], start), max(best[3], end)
            rows = [row for row, _ in found]
            columns = [pa.array([best[i] for best in found.values()], pa.int64()) for i in range(4)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array([name for _, name in found], pa.string()), *columns],
                names=["doc_id", "item_id", "passage_bytes", "edits", "first_start", "last_end"],
            )

    return docs.mapInArrow(find, _MATCHES)


def _item_bytes() -> Column:
    """Bytes of an item that are compared."""
    joined = F.regexp_replace(F.col("text").cast("string"), r"[ \t\n\x0B\f\r]+", " ")
    return F.octet_length(F.trim(joined))


def long_items(benchmark: DataFrame, least: int = LEAST_ITEM_BYTES) -> DataFrame:
    """Items that are long enough to call a document that holds them a leak."""
    return benchmark.filter(_item_bytes() >= least)


def short_items(benchmark: DataFrame, least: int = LEAST_ITEM_BYTES) -> DataFrame:
    """Items that `drop_leaks` leaves aside: shorter ones, and those without text."""
    return benchmark.filter(F.coalesce(_item_bytes(), F.lit(0)) < least)


def contamination(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, item_id, longest passage found, fewest edits, first and last byte of the passages."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = settle(
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
        .filter(F.col("text").isNotNull())
        .distinct()
    )
    total = items.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    blocks = max(1, -(-total // block_bytes))
    items = items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    found = None
    for block in range(blocks):  # each holds about block_bytes of the benchmark
        rows = items.filter(F.col("block") == block).select("item_id", "text").toArrow()
        texts = rows["text"].cast(pa.binary()).to_pylist()
        shared = spark.sparkContext.broadcast(sorted(zip(rows["item_id"].to_pylist(), texts), key=lambda x: (x[0] or "", x[1])))
        one = _matches(docs, shared)
        if blocks > 1:  # written before the next block is read, so that one is in memory at a time
            one = stored(one)
            shared.unpersist()
        found = one if found is None else found.unionByName(one)
    return found


def op8_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
