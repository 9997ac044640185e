"""Language-model scores by context-tree weighting over bytes.

A text is a sequence of tokens: words in lower case (A-Z), each closed by a blank, then one
end.  Its bytes are coded bit by bit.  The contexts of a bit are the bits before it in its
byte and the last 0, 1, .. `DEPTH` bytes before the byte, across words.  Each context has a
Krichevsky-Trofimov estimate from its counts in the training texts, and context tree
weighting mixes the estimates of all depths: a context's weighted probability is half its own
estimate's and half the product of its extensions', and the share of its own part is the
weight with which it predicts.

Fitting: (context, byte) pairs of all texts are counted in each task and then by a shuffle,
with their counts in training texts, which may be 0.  They are grouped by the last two bytes of
the context, and every group folds its own part of the tree from the deepest contexts up.
A group with more than one of `HOT_SHARE` pairs is split by the third byte; its contexts of two
bytes, like all of one byte and none, are few and fold on the driver.  Every training text and every
count takes part, and no context is left out.  A context without counts has an even estimate
and adds nothing to those above it, so pairs that are met in other texts only change nothing.

Scoring: each group mixes the predictions of its contexts along their paths and gives every
pair its log.  Documents meet the logs of the commonest pairs, `COMMON` at most, by broadcast
and those of all others by a shuffle of (document, pair) rows.

The base score needs every word's exact count: documents meet the counts of the most
frequent words, `FREQUENT` at most, by broadcast and those of all others by a shuffle of
(document, word) pairs.

Null text is empty: the end is its only token.  Null doc_id: neither learned from nor held
out.  Every row is a document of its own; scores belong to a text and are looked up by its
digest, so equal texts have equal scores.  Without training texts every estimate is even and base_score takes N = V = 0.  An empty table
gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bloomledger.llm.common import digest_of, most_frequent, settle, table

DEPTH = 5  # at most 6, so that a pair fits into a long
COMMON = 1 << 21  # pairs whose logs are broadcast
HOT_SHARE = 256  # a group with more than one of so many pairs is split
FREQUENT = 1 << 17
FREQUENT_BYTES = 64  # longer words are never broadcast
FOLDS, HELD_OUT = 7, 2
END = b"\n"
COUNT_BYTES = 1 << 24  # text whose words are counted together
STEP_BYTES = 1 << 20  # text whose pairs are looked at together
MEMO_BITS = 21  # pairs that a task remembers

_MEMO_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PAIR_KEY = b"  "  # opens the key of a pair, which meets no word and no document's own row


# --- words -----------------------------------------------------------------------


def fold_of(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def words_of(text: bytes) -> list[bytes]:
    """Words in lower case (A-Z), parted by ASCII white space."""
    return text.lower().split()


def _text_rows(batch: pa.RecordBatch) -> Iterator[tuple[int, bytes]]:
    for row, text in enumerate(batch.column("text").cast(pa.large_binary())):
        yield row, text.as_py() or b""


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training counts of words, 0 for those met in other texts only."""
    for batch in batches:
        train = batch.column("train").to_pylist()
        counts: Counter = Counter()
        others: set[bytes] = set()
        size = 0
        for row, text in _text_rows(batch):
            if train[row]:
                counts.update(words_of(text))
                counts[END] += 1
            else:
                others.update(words_of(text))
                others.add(END)
            size += len(text)
            if size >= COUNT_BYTES:
                yield _counted(counts, others)
                counts, others, size = Counter(), set(), 0
        yield _counted(counts, others)


def _counted(counts: Counter, others: set[bytes]) -> pa.RecordBatch:
    unseen = [w for w in others if w not in counts]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([*counts, *unseen], pa.binary()),
            pa.array([*counts.values(), *[0] * len(unseen)], pa.int64()),
        ],
        names=["word", "c"],
    )


# --- pairs of context and byte ----------------------------------------------------


def coded_line(words: list[bytes]) -> bytes:
    """What is coded for a text, behind DEPTH ends as its first context."""
    return END * DEPTH + (b" ".join(words) + b" " if words else b"") + END


def pairs_at(line: np.ndarray, start: int, end: int) -> np.ndarray:
    """Reversed context and byte, packed, at positions start..end-1 (start >= DEPTH)."""
    packed = line[start - 1 : end - 1].astype(np.uint64)
    for back in range(2, DEPTH + 1):
        packed = (packed << np.uint64(8)) | line[start - back : end - back]
    return (packed << np.uint64(8)) | line[start:end]


def _lines(texts: Iterator[tuple[int, bytes]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Rows, their joined lines and where each line starts, some text at a time."""
    rows, lines, size = [], [], 0
    for row, text in texts:
        rows.append(row)
        lines.append(coded_line(words_of(text)))
        size += len(lines[-1])
        if size >= STEP_BYTES:
            yield _joined(rows, lines)
            rows, lines, size = [], [], 0
    if rows:
        yield _joined(rows, lines)


def _joined(rows: list[int], lines: list[bytes]) -> tuple[list[int], np.ndarray, np.ndarray]:
    starts = np.cumsum([0, *map(len, lines)])[:-1]
    return rows, np.frombuffer(b"".join(lines), np.uint8), starts


def _coded_steps(line: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Position, pairs, and which of them are coded (first contexts are not), step by step."""
    coded = np.ones(len(line), bool)
    coded[(starts[:, None] + np.arange(DEPTH)).ravel()] = False
    for at in range(DEPTH, len(line), STEP_BYTES):
        end = min(at + STEP_BYTES, len(line))
        yield at, pairs_at(line, at, end), coded[at:end]


class PairCounts:
    """Counts of pairs: the common ones in a table, the others in a list."""

    def __init__(self):
        self._keys = np.zeros(1 << MEMO_BITS, np.uint64)  # a pair + 1
        self._counts = np.zeros(1 << MEMO_BITS, np.int64)
        self._other: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, pairs: np.ndarray) -> None:
        slot = ((pairs * _MEMO_FACTOR) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        known = self._keys[slot] == pairs + np.uint64(1)
        self._counts += np.bincount(slot[known], minlength=1 << MEMO_BITS)
        if known.all():
            return
        found, n = np.unique(pairs[~known], return_counts=True)
        slot = ((found * _MEMO_FACTOR) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        free = self._keys[slot] == 0
        self._keys[slot[free]] = found[free] + np.uint64(1)
        stays = self._keys[slot] == found + np.uint64(1)
        self._counts[slot[stays]] = n[stays]
        self._other.append((found[~stays], n[~stays]))

    def counted(self) -> pa.RecordBatch:
        at = np.flatnonzero(self._keys)
        pairs = np.concatenate([self._keys[at] - np.uint64(1), *(p for p, _ in self._other)])
        counts = np.concatenate([self._counts[at], *(n for _, n in self._other)])
        found, inverse = np.unique(pairs, return_inverse=True)
        n = np.zeros(len(found), np.int64)
        np.add.at(n, inverse, counts)
        return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n)], names=["pair", "n"])


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts = PairCounts()
        for _, line, starts in _lines(_text_rows(batch)):
            for _, pairs, coded in _coded_steps(line, starts):
                counts.add(pairs[coded])
        yield counts.counted()


# --- the tree -----------------------------------------------------------------------


def log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function for positive x, by Stirling's series from x + 8."""
    product = np.ones_like(x)
    for i in range(8):
        product *= x + i
    z = x + 8
    series = 1 / (12 * z) - 1 / (360 * z**3) + 1 / (1260 * z**5)
    return (z - 0.5) * np.log(z) - z + 0.5 * np.log(2 * np.pi) + series - np.log(product)


def log_estimate(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """ln of the Krichevsky-Trofimov probability of these counts."""
    some = log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - np.log(np.pi)
    return np.where(zeros + ones > 0, some, 0.0)


class Level:
    """Contexts of one depth: keys (reversed context, then the bits so far with a leading 1)."""

    def __init__(self, keys: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray | None):
        self.keys, self.zeros, self.ones = keys, zeros, ones
        own = log_estimate(zeros, ones)
        if below is None:  # the deepest contexts have no extensions
            self.weighted, self.stop = own, np.ones(len(keys))
        else:
            half = np.log(0.5)
            self.weighted = np.logaddexp(half + own, half + below)
            self.stop = np.exp(half + own - self.weighted)

    def parents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Keys of the contexts one byte shorter, their counts and the sum of weighted ln below."""
        up = (self.keys >> np.uint64(16) << np.uint64(8)) | (self.keys & np.uint64(255))
        keys, inverse = np.unique(up, return_inverse=True)
        add = lambda v: np.bincount(inverse, v, len(keys))
        return keys, add(self.zeros), add(self.ones), add(self.weighted), inverse


def deepest_level(pairs: np.ndarray, counts: np.ndarray) -> tuple[Level, np.ndarray]:
    """The deepest contexts of the eight bits of each pair, and their place: bits x pairs."""
    symbol, context = pairs & np.uint64(255), pairs >> np.uint64(8) << np.uint64(8)
    keys = np.concatenate([context | np.uint64(1 << b) | (symbol >> np.uint64(8 - b)) for b in range(8)])
    found, inverse = np.unique(keys, return_inverse=True)
    times = np.tile(counts, 8).astype(np.float64)
    ones = np.bincount(inverse, times * bits_of(pairs).ravel(), len(found))
    return Level(found, np.bincount(inverse, times, len(found)) - ones, ones, None), inverse.reshape(8, -1)


def bits_of(pairs: np.ndarray) -> np.ndarray:
    """The bits of each pair's byte from the highest on: bits x pairs."""
    return np.stack([(pairs >> np.uint64(7 - b)) & np.uint64(1) for b in range(8)]).astype(bool)


def fold(pairs: np.ndarray, counts: np.ndarray, least_depth: int) -> tuple[list[tuple[Level, np.ndarray | None]], np.ndarray]:
    """Levels from the deepest to `least_depth`, each with its place of a parent in the next.

    And the place of each pair's bits in the deepest.
    """
    levels: list[tuple[Level, np.ndarray | None]] = []
    level, places = deepest_level(pairs, counts)
    for _ in range(DEPTH - least_depth):
        keys, zeros, ones, below, inverse = level.parents()
        levels.append((level, inverse))
        level = Level(keys, zeros, ones, below)
    levels.append((level, None))
    return levels, places


def follow(level: Level, mixed: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Mixed part, mass left for deeper contexts, and the chance of a 1 if the path ends here."""
    estimate = (level.ones + 0.5) / (level.zeros + level.ones + 1.0)
    mixed = mixed + left * level.stop * estimate
    left = left * (1.0 - level.stop)
    return mixed, left, mixed + 0.5 * left


def _last_two(pairs: np.ndarray) -> np.ndarray:
    return pairs >> np.uint64(8 * (DEPTH - 1))


def _group_of(pairs: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The group of each pair, and whether it is part of a hot one."""
    two = _last_two(pairs)
    is_hot = np.isin(two, hot)
    three = (pairs >> np.uint64(8 * (DEPTH - 2))) | np.uint64(1 << 32)
    return np.where(is_hot, three, two), is_hot


def _groups(batches: Iterator[pa.RecordBatch], hot: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
    """Hot or not, pairs, training counts and all counts of whole groups that follow each other."""
    kept: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    size = 0

    def parted(parts: tuple, is_hot: np.ndarray) -> Iterator[tuple]:
        for kind in (False, True):
            own = is_hot == kind
            if own.any():
                yield kind, *(c[own] for c in parts)

    for batch in batches:
        if not batch.num_rows:
            continue
        kept.append((batch.column("pair").to_numpy().view(np.uint64), batch.column("n").to_numpy(), batch.column("met").to_numpy()))
        size += batch.num_rows
        if size < 100_000:
            continue
        parts = [np.concatenate(c) for c in zip(*kept)]
        group, is_hot = _group_of(parts[0], hot)
        other = np.flatnonzero(group != group[-1])
        whole = int(other[-1]) + 1 if len(other) else 0
        if whole:
            yield from parted(tuple(c[:whole] for c in parts), is_hot[:whole])
        kept, size = [tuple(c[whole:] for c in parts)], len(group) - whole
    if size:
        parts = tuple(np.concatenate(c) for c in zip(*kept))
        yield from parted(parts, _group_of(parts[0], hot)[1])


def _fold_groups(hot: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts and weighted ln of contexts of two bytes, summed by their last byte.

        Of hot groups those of three bytes, summed by their last two.
        """
        for is_hot, pairs, counts, _ in _groups(batches, hot):
            depth = 2 if is_hot else 1
            keys, zeros, ones, below, _ = fold(pairs, counts, depth + 1)[0][-1][0].parents()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), depth)), pa.array(keys.view(np.int64)), pa.array(zeros), pa.array(ones), pa.array(below)],
                names=["depth", "key", "zeros", "ones", "below"],
            )

    return run


class CommonPairs:
    """The logs of the commonest pairs; NaN for any other."""

    def __init__(self, pairs: np.ndarray, logs: np.ndarray):
        self.pairs, self.logs = pairs, logs  # in the order of pairs

    def pair_logs(self, pairs: np.ndarray) -> np.ndarray:
        if not len(self.pairs):
            return np.full(len(pairs), np.nan)
        at = np.minimum(np.searchsorted(self.pairs, pairs), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pairs, self.logs[at], np.nan)


class PairLogs:
    """Looks up pairs under a model; remembers the last ones met."""

    def __init__(self, model: CommonPairs):
        self._model = model
        self._keys = np.zeros(1 << MEMO_BITS, np.uint64)  # a pair + 1
        self._logs = np.zeros(1 << MEMO_BITS)

    def __call__(self, pairs: np.ndarray) -> np.ndarray:
        slot = ((pairs * _MEMO_FACTOR) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
        out = self._logs[slot]
        new = np.flatnonzero(self._keys[slot] != pairs + np.uint64(1))
        if len(new):
            found, inverse = np.unique(pairs[new], return_inverse=True)
            logs = self._model.pair_logs(found)
            out[new] = logs[inverse]
            slot = ((found * _MEMO_FACTOR) >> np.uint64(64 - MEMO_BITS)).astype(np.int64)
            self._keys[slot] = 0
            last = np.zeros(1 << MEMO_BITS, np.int64)
            last[slot] = np.arange(len(found))  # one of those that share a slot
            stays = last[slot] == np.arange(len(found))
            self._keys[slot[stays]] = found[stays] + np.uint64(1)
            self._logs[slot[stays]] = logs[stays]
        return out

    def lines(self, line: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each of the joined lines."""
        return self.parts(line, starts)[0]

    def parts(self, line: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """log10 of what the model knows of each line; line, pair and times of what it does not."""
        logs = np.zeros(len(line))
        owners, others = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for at, pairs, coded in _coded_steps(line, starts):
            found = np.where(coded, self(pairs), 0.0)
            unknown = np.flatnonzero(np.isnan(found))
            found[unknown] = 0.0
            logs[at : at + len(pairs)] = found
            owners.append(np.searchsorted(starts, at + unknown, side="right") - 1)
            others.append(pairs[unknown])
        owner, pair = np.concatenate(owners), np.concatenate(others)
        order = np.lexsort((pair, owner))
        owner, pair = owner[order], pair[order]
        first = np.ones(len(pair), bool)
        first[1:] = (owner[1:] != owner[:-1]) | (pair[1:] != pair[:-1])
        first = np.flatnonzero(first)
        times = np.diff(first, append=len(pair))
        return np.add.reduceat(logs, starts), owner[first], pair[first], times


def pair_keys(pairs: np.ndarray) -> pa.Array:
    """Pairs as keys of the join that words take part in."""
    width = len(_PAIR_KEY) + 8
    data = np.empty((len(pairs), width), np.uint8)
    data[:, : len(_PAIR_KEY)] = np.frombuffer(_PAIR_KEY, np.uint8)
    data[:, len(_PAIR_KEY) :] = pairs.astype(">u8").view(np.uint8).reshape(-1, 8)
    offsets = np.arange(0, (len(pairs) + 1) * width, width, dtype=np.int32)
    return pa.Array.from_buffers(pa.binary(), len(pairs), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def pair_counts(texts: DataFrame) -> DataFrame:
    return texts.select("text").mapInArrow(_count_pairs, "pair long, n long")


class Tree:
    """The fitted tree: pairs with their training counts, and the paths of all last bytes."""

    def __init__(self, pairs: DataFrame):
        """`pairs`: pair, n (in training texts) and met (in all texts), settled; a row a pair."""
        self._pairs = pairs
        two = pairs.groupBy(F.shiftright("pair", 8 * (DEPTH - 1)).alias("two")).agg(F.count("*").alias("n"))
        two = settle(two)  # 65,536 rows at most
        total = two.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        self._hot = [r["two"] for r in two.filter(F.col("n") * HOT_SHARE > total).collect()]  # fewer than HOT_SHARE
        hot = np.array(self._hot, np.uint64)
        schema = "depth long, key long, zeros double, ones double, below double"
        top = self._grouped().mapInArrow(_fold_groups(hot), schema).groupBy("depth", "key")
        # 256 last bytes x 255 bit contexts, and as many of each hot group, at most.
        top = top.agg(F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("below").alias("below")).toArrow()
        top = top.sort_by([("depth", "ascending"), ("key", "ascending")])
        depth, *columns = (top[c].to_numpy() for c in ("depth", "key", "zeros", "ones", "below"))
        level_two = Level(*(c[depth == 2] if i else c[depth == 2].view(np.uint64) for i, c in enumerate(columns)))
        more = level_two.parents()
        own = [c[depth == 1] for c in columns]
        keys, inverse = np.unique(np.concatenate([own[0].view(np.uint64), more[0]]), return_inverse=True)
        level_one = Level(keys, *(np.bincount(inverse, np.concatenate([a, b]), len(keys)) for a, b in zip(own[1:], more[1:4])))
        keys, zeros, ones, below, inverse = level_one.parents()
        level_none = Level(keys, zeros, ones, below)
        mixed, left, _ = follow(level_none, np.zeros(len(keys)), np.ones(len(keys)))
        mixed, left, _ = follow(level_one, mixed[inverse], left[inverse])
        at = np.searchsorted(level_one.keys, more[0])[more[4]]
        self._top = (level_one.keys, mixed, left), (level_two.keys, *follow(level_two, mixed[at], left[at])[:2]), hot

    def _grouped(self) -> DataFrame:
        """Pairs by group, in order inside a partition."""
        two, three = (F.shiftright("pair", 8 * (DEPTH - n)) for n in (1, 2))
        group = F.when(two.isin(self._hot), three).otherwise(two) if self._hot else two
        return self._pairs.repartition(group).sortWithinPartitions("pair")

    def logs(self) -> DataFrame:
        """pair, met and log10 of the chance of the pair's byte behind its context, for every pair."""
        shared = self._pairs.sparkSession.sparkContext.broadcast(self._top)

        def mix(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            *tops, hot = shared.value
            for is_hot, pairs, counts, met in _groups(batches, hot):
                levels, places = fold(pairs, counts, 3 if is_hot else 2)
                top_keys, top_mixed, top_left = tops[int(is_hot)]
                keys, _, _, _, place = levels[-1][0].parents()
                at = np.searchsorted(top_keys, keys)
                mixed, left = top_mixed[at][place], top_left[at][place]
                for level, parent in reversed(levels):
                    if parent is not None:
                        mixed, left = mixed[parent], left[parent]
                    mixed, left, chance = follow(level, mixed, left)
                logs = np.where(bits_of(pairs), np.log10(chance)[places], np.log10(1.0 - chance)[places]).sum(axis=0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(pairs.view(np.int64)), pa.array(met), pa.array(logs)], names=["pair", "met", "log"]
                )

        return self._grouped().mapInArrow(mix, "pair long, met long, log double")

    def pair_logs(self, pairs: np.ndarray) -> np.ndarray:
        """The logs of a few pairs, which need not have been counted."""
        wanted = np.unique(pairs)
        table = pa.table({"pair": wanted.view(np.int64)})
        few = self._pairs.sparkSession.createDataFrame(table)
        counted = self._pairs.unionByName(few.select("pair", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("met")))
        found = Tree(_summed(counted)).logs().join(F.broadcast(few), "pair").toArrow().sort_by("pair")
        return found["log"].to_numpy()[np.searchsorted(wanted, pairs)]


def _summed(counted: DataFrame) -> DataFrame:
    return settle(counted.groupBy("pair").agg(F.sum("n").alias("n"), F.sum("met").alias("met")))


def learn(texts: DataFrame, others: DataFrame | None = None) -> Tree:
    """The tree of training texts (column text); it gives the pairs of the other texts their logs as well."""
    counted = pair_counts(texts).withColumn("met", F.col("n"))
    if others is not None:
        counted = counted.unionByName(pair_counts(others).select("pair", F.lit(0).cast("long").alias("n"), F.col("n").alias("met")))
    return Tree(_summed(counted))


# --- documents ----------------------------------------------------------------------


def _frequent_words(vocabulary: DataFrame, most: int) -> DataFrame:
    """All words above a count that at most `most` words reach."""
    short = vocabulary.filter((F.col("c") > 0) & (F.octet_length("word") <= FREQUENT_BYTES))
    return short.filter(most_frequent(short, "c", most))


def _keyed_logs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = pair_keys(batch.column("pair").to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([keys, batch.column("log")], names=["word", "log"])


def text_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row."""
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        digest_of("text").cast("binary").alias("digest"),
        F.coalesce(fold_of(F.col("doc_id")) != HELD_OUT, F.lit(False)).alias("train"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    counted = rows.select("train", "text").mapInArrow(_count_words, "word binary, c long")
    vocabulary = settle(counted.groupBy("word").agg(F.sum("c").alias("c")))
    n_train, n_words = vocabulary.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    logs_of_pairs = settle(learn(rows.filter("train"), rows.filter("not train")).logs())
    is_common = most_frequent(logs_of_pairs, "met", COMMON)
    common = logs_of_pairs.filter(is_common).select("pair", "log").toArrow().sort_by("pair")
    shared = spark.sparkContext.broadcast((common["pair"].to_numpy().view(np.uint64), common["log"].to_numpy()))
    floor = float(n_train + n_words + 1)
    frequent = _frequent_words(vocabulary, FREQUENT).toArrow()
    known = spark.sparkContext.broadcast(
        ({w: i for i, w in enumerate(frequent["word"].to_pylist())}, frequent["c"].to_numpy())
    )

    def score_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each text with what its frequent words and common pairs give, one for each other word, one for each other pair."""
        place, count = known.value
        log_base = np.log10((count + 1) / floor)
        logs = PairLogs(CommonPairs(*shared.value))
        for batch in batches:
            keys = batch.column("digest").to_pylist()
            texts = dict(_text_rows(batch))
            for rows, line, starts in _lines(iter(texts.items())):
                word, key, times, sums = [], [], [], []
                log_ps, owner, pairs, n_pairs = logs.parts(line, starts)
                for row, log_p in zip(rows, log_ps.tolist()):
                    found = Counter(words_of(texts[row]))
                    found[END] += 1
                    at, n = [], []
                    for w, here in found.items():
                        i = place.get(w)
                        if i is None:
                            word.append(w)
                            key.append(keys[row])
                            times.append(here)
                            sums.append((None, None, None, None))
                        else:
                            at.append(i)
                            n.append(here)
                    at, n = np.array(at, np.int64), np.array(n, np.int64)
                    # No word holds a blank, so this row meets no word; it shares its key with equal texts.
                    word.append(b" " + keys[row])
                    key.append(keys[row])
                    times.append(0)
                    total = sum(found.values())
                    sums.append((total, int(n[count[at] > 0].sum()), float(n @ log_base[at]), log_p))
                yield _scored(word, key, times, sums)
                if len(pairs):
                    names = pa.array([keys[row] for row in rows], pa.binary()).take(pa.array(owner))
                    yield _other_pairs(names, pairs, n_pairs)

    partial = rows.select("digest", "text").mapInArrow(
        score_rows, "word binary, digest binary, times long, n_tokens long, n_known long, base double, score double"
    )
    # A key is a word's or a pair's; both are looked up by one shuffle.
    others = logs_of_pairs.filter(~is_common).mapInArrow(_keyed_logs, "word binary, log double")
    known_rows = vocabulary.select("word", "c", F.lit(None).cast("double").alias("log")).unionByName(
        others.select("word", F.lit(None).cast("long").alias("c"), "log")
    )
    met = partial.join(known_rows, "word", "left")
    word_base = F.col("times") * F.log10((F.col("c") + 1) / F.lit(floor))
    # Rows of equal texts give equal sums; each stands for one of them.
    rows_of_text = F.count("n_tokens")
    met = met.groupBy("digest").agg(
        (F.sum("n_tokens") / rows_of_text).cast("long").alias("n_tokens"),
        (F.sum(F.coalesce("n_known", F.when(F.col("c") > 0, F.col("times")), F.lit(0))) / rows_of_text).cast("long").alias("n_known"),
        (F.sum(F.coalesce("base", word_base)) / rows_of_text).alias("base_score"),
        (F.sum(F.coalesce("score", F.col("times") * F.col("log"))) / rows_of_text).alias("score"),
    )
    return rows.select("doc_id", "digest").join(met, "digest").select(
        "doc_id",
        F.coalesce(fold_of(F.col("doc_id")) == HELD_OUT, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )


def _scored(word: list, key: list, times: list, sums: list) -> pa.RecordBatch:
    n_tokens, n_known, base, score = zip(*sums) if sums else ((),) * 4
    return pa.RecordBatch.from_arrays(
        [
            pa.array(word, pa.binary()),
            pa.array(key, pa.binary()),
            pa.array(times, pa.int64()),
            pa.array(n_tokens, pa.int64()),
            pa.array(n_known, pa.int64()),
            pa.array(base, pa.float64()),
            pa.array(score, pa.float64()),
        ],
        names=["word", "digest", "times", "n_tokens", "n_known", "base", "score"],
    )


def _other_pairs(key: pa.Array, pairs: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    none = [pa.nulls(len(pairs), kind) for kind in (pa.int64(), pa.int64(), pa.float64(), pa.float64())]
    return pa.RecordBatch.from_arrays(
        [pair_keys(pairs), key, pa.array(times), *none],
        names=["word", "digest", "times", "n_tokens", "n_known", "base", "score"],
    )


def op10_context_tree_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_scores(table(spark, sf_dir, "documents"))
