"""Phrase collocations of each language by best-first branch and bound.

A candidate is a phrase of two or three words with a = f(phrase) >= `LEAST`.  Cut behind its
first k words it has l = f(first part), r = f(rest) and the score floor(10^6 a a / (l r)); the
cut with the least score counts.  A candidate inside a longer one goes if the longer one has
at least `SHARE` per cent of its occurrences.  The best `TOP` of each language are wanted.

Phrases grow by one word at a time, and only where they can still matter:

1. Words are counted.  Only words with f >= LEAST can stand in a candidate.
2. Pairs of such words are counted: the candidates of two words, with their exact scores, and
   the prefixes that can be grown.
3. A phrase that grows out of the prefix w1 w2 scores at most floor(10^6 f(w1 w2) / f(w1)),
   since a <= f(w1 w2), a <= f(w2 w3).  Best first: a level T is set for each language, the
   score that TOP of its pairs reach.  All prefixes with a bound >= T are grown, and so is to
   the left every pair with a score >= T, as a longer phrase on either side can drop it.  Then
   all candidates with a score >= T are known, and whether they stay.
4. A language with TOP survivors at its level is settled: nothing that is not grown can reach
   the score of the last of them, nor tie with it.  The others go on with a lower level (four
   times as many pairs), and only what is new is counted; at level 0 all is grown.

Each count is one pass over the texts, which never move: words are 64-bit hashes of language
and word (checked to be distinct over the whole vocabulary), counted in blocks of `STEP`
bytes before they are shuffled, so a hot language, word or pair is spread.  What may be
counted is told to the tasks by bit sets of 2^25 slots (4 MB each, whatever the vocabulary's
size); a slot that is shared by chance costs a few rows and changes no result.

Null text is empty, a null lang is `und`.  Repeated rows count as often as they are there.
Equal scores are ordered by a descending, then by the phrase's bytes.  An empty table gives
an empty result.  doc_id and other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import row_chunks, settle, stored, table, text_buffers, with_small
from bloomledger.llm.shingles import LOWER

TOP = 2000
LEAST = 10
SHARE = 50
UNDETERMINED = "und"
STEP = 8 << 20
GROWTH = 4  # how many times as many pairs a lower level takes in

_SCALE = 1_000_000
_SLOT_BITS = 25
_BITMAP = 32_768  # bits of one row of a bit set
_TURN = 21

_KIND = np.zeros(256, np.uint8)  # of a byte: 0 in a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2


# --- words of texts -------------------------------------------------------------------


def _parts(data: np.ndarray, offsets: np.ndarray, step: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes, offsets and first row of blocks of at most `step` bytes.

    A longer text is cut behind bytes that end a piece, so no phrase is cut.
    """
    for first, end in row_chunks(offsets, step):
        part = offsets[first : end + 1]
        if part[-1] - part[0] <= step:
            yield data[part[0] : part[-1]], part - part[0], first
            continue
        at, stop = int(part[0]), int(part[-1])
        while at < stop:
            cut = min(at + step, stop)
            breaks = np.flatnonzero(_KIND[data[at:cut]] == 2)
            while not len(breaks) and cut < stop:
                before, cut = cut, min(cut + step, stop)
                breaks = np.flatnonzero(_KIND[data[before:cut]] == 2)[:1] + (before - at)
            to = at + int(breaks[-1]) + 1 if len(breaks) and cut < stop else cut
            yield data[at:to], np.array([0, to - at]), first
            at = to


class Words:
    """The words of a block: hashes, and whether the next word stands in the same piece."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]):
        kind = _KIND[data]
        inside = kind == 0
        starts_row = offsets[:-1][np.diff(offsets) > 0]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        first[starts_row] = inside[starts_row]
        last[:-1] &= ~inside[1:]
        ends_row = offsets[1:][np.diff(offsets) > 0] - 1
        last[ends_row] = inside[ends_row]
        starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        row = np.searchsorted(offsets, starts, side="right") - 1
        piece = np.cumsum(kind == 2, dtype=np.int32)[starts] + row
        self.linked = piece[1:] == piece[:-1]

        bounds = np.concatenate([[0], np.cumsum(ends - starts)])
        letters = LOWER[data[inside]]
        words = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(letters)]
        ).dictionary_encode()
        names = sorted(set(langs))
        number = {name: i for i, name in enumerate(names)}
        of_row = np.array([number[name] for name in langs], np.int64)
        texts = words.dictionary.to_pylist()
        both = of_row[row] * max(len(texts), 1) + words.indices.to_numpy()
        distinct, self.at, self.times = np.unique(both, return_inverse=True, return_counts=True)
        self.langs = [names[i] for i in (distinct // max(len(texts), 1)).tolist()]
        self.texts = [texts[i] for i in (distinct % max(len(texts), 1)).tolist()]
        seeds = [xxhash.xxh64_intdigest(name.encode()) for name in names]
        seed = dict(zip(names, seeds))
        self.hashes = np.array([xxhash.xxh64_intdigest(t, seed[g]) for t, g in zip(self.texts, self.langs)], np.uint64)


def _blocks(batches: Iterator[pa.RecordBatch], step: int) -> Iterator[Words]:
    """Words of several batches at a time, up to a number of bytes."""
    waiting: list[pa.RecordBatch] = []
    size = 0

    def words() -> Iterator[Words]:
        rows = pa.Table.from_batches(waiting)
        langs = rows["lang"].to_pylist()
        data, offsets = text_buffers(rows["text"])
        for part, bounds, first in _parts(data, offsets, step):
            if len(part):
                yield Words(part, bounds, langs[first : first + len(bounds) - 1])

    for batch in batches:
        waiting.append(batch)
        size += batch.column("text").nbytes
        if size >= step:
            yield from words()
            waiting, size = [], 0
    if waiting:
        yield from words()


# --- bit sets of hashes -----------------------------------------------------------------


def _pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return a ^ ((b << np.uint64(_TURN)) | (b >> np.uint64(64 - _TURN)))


def _pair_hash_column(a: str, b: str) -> Column:
    turned = F.shiftleft(b, _TURN).bitwiseOR(F.shiftrightunsigned(b, 64 - _TURN))
    return F.col(a).bitwiseXOR(turned)


def _bit_set(hashes: DataFrame) -> np.ndarray:
    """The slots of a column `h` of hashes as packed bits; built by partial aggregates."""
    slot = F.shiftrightunsigned("h", 64 - _SLOT_BITS) + 1
    rows = (
        hashes.groupBy(F.bitmap_bucket_number(slot).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))
        .toArrow()
    )
    out = np.zeros((1 << _SLOT_BITS) // 8, np.uint8)
    for bucket, bits in zip(rows["bucket"].to_pylist(), rows["bits"].to_pylist()):
        at = (bucket - 1) * (_BITMAP // 8)
        out[at : at + len(bits)] = np.frombuffer(bits, np.uint8)
    return out


def _in_set(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    slot = hashes >> np.uint64(64 - _SLOT_BITS)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1


# --- counts -----------------------------------------------------------------------------


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def _word_counter(step: int) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _blocks(batches, step):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(words.langs, pa.string()),
                    pa.array(words.texts, pa.binary()).cast(pa.string()),
                    _signed(words.hashes),
                    pa.array(words.times.astype(np.int64)),
                ],
                names=["lang", "word", "h", "c"],
            )

    return count


def _pair_counter(step: int, shared) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _blocks(batches, step):
            often = _in_set(shared.value, words.hashes)[words.at]
            i = np.flatnonzero(words.linked & often[:-1] & often[1:])
            width = len(words.hashes)
            pairs, times = np.unique(words.at[i] * width + words.at[i + 1], return_counts=True)
            columns = words.hashes[pairs // max(width, 1)], words.hashes[pairs % max(width, 1)]
            yield pa.RecordBatch.from_arrays(
                [*map(_signed, columns), pa.array(times.astype(np.int64))], names=["h1", "h2", "c"]
            )

    return count


def _triple_counter(step: int, shared) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _blocks(batches, step):
            often, grown_right, grown_left = shared.value
            hashes = words.hashes[words.at]
            pair = _pair_hash(hashes[:-1], hashes[1:])
            good = words.linked & _in_set(often, pair)
            i = np.flatnonzero(good[:-1] & good[1:])
            i = i[_in_set(grown_right, pair[i]) | _in_set(grown_left, pair[i + 1])]
            width = len(words.hashes)
            firsts, number = np.unique(words.at[i] * width + words.at[i + 1], return_inverse=True)
            triples, times = np.unique(number * width + words.at[i + 2], return_counts=True)
            pairs = firsts[triples // max(width, 1)] if len(triples) else firsts[:0]
            at = pairs // max(width, 1), pairs % max(width, 1), triples % max(width, 1)
            yield pa.RecordBatch.from_arrays(
                [*(_signed(words.hashes[a]) for a in at), pa.array(times.astype(np.int64))], names=["h1", "h2", "h3", "c"]
            )

    return count


def _score(a: str, left: str, right: str) -> Column:
    """floor(10^6 a a / (l r)), exactly (for counts below 10^16)."""
    whole = lambda name: F.col(name).cast("decimal(18,0)")
    above = whole(a) * whole(a) * F.lit(_SCALE).cast("decimal(7,0)")
    below = whole(left) * whole(right)
    return F.call_function("div", above, below).cast("long")


def _vocabulary(texts: DataFrame, step: int) -> DataFrame:
    """lang, word, h, f of every word."""
    counted = texts.mapInArrow(_word_counter(step), "lang string, word string, h long, c long")
    words = stored(counted.groupBy("lang", "word", "h").agg(F.sum("c").alias("f")))
    if words.groupBy("h").count().filter("count > 1").limit(1).count():
        raise ValueError("two words have one 64-bit hash: give the languages other names")
    return words


def _pairs(texts: DataFrame, words: DataFrame, least: int, step: int) -> DataFrame:
    """lang, h1, h2, a, f1, f2, score and bound of every candidate of two words."""
    often = words.filter(F.col("f") >= least)
    shared = texts.sparkSession.sparkContext.broadcast(_bit_set(often.select("h")))
    counted = texts.mapInArrow(_pair_counter(step, shared), "h1 long, h2 long, c long")
    pairs = counted.groupBy("h1", "h2").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
    first = often.select(F.col("h").alias("h1"), "lang", F.col("f").alias("f1"))
    second = often.select(F.col("h").alias("h2"), F.col("f").alias("f2"))
    pairs = pairs.join(first, "h1").join(second, "h2")
    bound = F.call_function("div", F.col("a").cast("decimal(18,0)") * F.lit(_SCALE).cast("decimal(7,0)"), F.col("f1").cast("decimal(18,0)"))
    return stored(pairs.withColumn("score", _score("a", "f1", "f2")).withColumn("bound", bound.cast("long")))


def _triples(texts: DataFrame, pairs: DataFrame, often, right: DataFrame, left: DataFrame, least: int, step: int) -> DataFrame:
    """lang, h1, h2, h3, a, l, r, score of the candidates that grow out of the given pairs."""
    key = _pair_hash_column("h1", "h2").alias("h")
    sets = (often, _bit_set(right.select(key)), _bit_set(left.select(key)))
    shared = texts.sparkSession.sparkContext.broadcast(sets)
    counted = texts.mapInArrow(_triple_counter(step, shared), "h1 long, h2 long, h3 long, c long")
    triples = counted.groupBy("h1", "h2", "h3").agg(F.sum("c").alias("a")).filter(F.col("a") >= least)
    head = pairs.select("h1", "h2", "lang", "f1", F.col("a").alias("f12"))
    tail = pairs.select(F.col("h1").alias("h2"), F.col("h2").alias("h3"), F.col("a").alias("f23"), F.col("f2").alias("f3"))
    triples = triples.join(head, ["h1", "h2"]).join(tail, ["h2", "h3"])
    triples = triples.withColumn("s1", _score("a", "f1", "f23")).withColumn("s2", _score("a", "f12", "f3"))
    early = F.col("s1") <= F.col("s2")
    return stored(
        triples.select(
            "lang",
            "h1",
            "h2",
            "h3",
            "a",
            F.when(early, F.col("f1")).otherwise(F.col("f12")).alias("l"),
            F.when(early, F.col("f23")).otherwise(F.col("f3")).alias("r"),
            F.least("s1", "s2").alias("score"),
        )
    )


# --- branch and bound ---------------------------------------------------------------------


def _by_language(rows: DataFrame, languages: DataFrame) -> DataFrame:
    """Rows with what a settled table says of their language; it is broadcast if it has few rows."""
    about = languages.withColumnRenamed("lang", "of_lang")
    return with_small(rows, about, F.col("lang") == F.col("of_lang")).drop("of_lang")


def _levels(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """lang, level: the greatest score that as many pairs as `wanted` (lang, many) reach, else 0.

    Taken from a histogram of scores, which are whole numbers up to 10^6.
    """
    better = Window.partitionBy("lang").orderBy(F.col("score").desc())
    histogram = pairs.groupBy("lang", "score").agg(F.count("*").alias("n"))
    reached = histogram.withColumn("through", F.sum("n").over(better.rowsBetween(Window.unboundedPreceding, 0)))
    found = wanted.join(reached, "lang").filter(F.col("through") >= F.col("many"))
    found = found.groupBy("lang").agg(F.max("score").alias("level"))
    return settle(wanted.join(found, "lang", "left").select("lang", F.coalesce("level", F.lit(0)).cast("long").alias("level")))


def _survivors(pairs: DataFrame, triples: DataFrame, levels: DataFrame, share: int) -> DataFrame:
    """All candidates with a score at their language's level or above that no longer one drops."""
    heads = triples.select("h1", "h2", "a")
    tails = triples.select(F.col("h2").alias("h1"), F.col("h3").alias("h2"), "a")
    longer = heads.unionByName(tails).groupBy("h1", "h2").agg(F.max("a").alias("longest"))
    high = _by_language(pairs, levels).filter(F.col("score") >= F.col("level"))
    high = high.join(longer, ["h1", "h2"], "left")
    high = high.filter(F.coalesce(100 * F.col("longest") < share * F.col("a"), F.lit(True)))
    none = F.lit(None).cast("long").alias("h3")
    two = high.select("lang", "h1", "h2", none, "a", F.col("f1").alias("l"), F.col("f2").alias("r"), "score")
    three = _by_language(triples, levels).filter(F.col("score") >= F.col("level"))
    return two.unionByName(three.select(two.columns))


def _between(pairs: DataFrame, column: str, levels: DataFrame) -> DataFrame:
    """Pairs whose `column` is at their language's level or above, and below its level before."""
    met = _by_language(pairs, levels)
    return met.filter((F.col(column) >= F.col("level")) & (F.col("before").isNull() | (F.col(column) < F.col("before"))))


def _settled(texts: DataFrame, pairs: DataFrame, top: int, least: int, share: int, step: int) -> DataFrame:
    """Survivors among which are the best `top` of every language, ties of the last included."""
    pair_bits = _bit_set(pairs.select(_pair_hash_column("h1", "h2").alias("h")))
    languages = settle(pairs.select("lang").distinct())
    levels = _levels(pairs, languages.withColumn("many", F.lit(top)))
    levels = settle(levels.withColumn("before", F.lit(None).cast("long")))
    triples, open_levels = None, levels
    while True:
        right, left = (_between(pairs, column, open_levels) for column in ("bound", "score"))
        grown = _triples(texts, pairs, pair_bits, right, left, least, step)
        # A count is complete in each round, so phrases met again are the same rows.
        triples = grown if triples is None else stored(triples.unionByName(grown).dropDuplicates(["h1", "h2", "h3"]))
        found = stored(_survivors(pairs, triples, levels, share))
        many = found.groupBy("lang").agg(F.count("*").alias("found"))
        short = levels.join(many, "lang", "left").filter((F.col("level") > 0) & (F.coalesce("found", F.lit(0)) < top))
        short = settle(short.select("lang", F.col("level").alias("before")))
        if not short.limit(1).count():
            return found
        taken = _by_language(pairs, short).filter(F.col("score") >= F.col("before"))
        wanted = settle(taken.groupBy("lang").agg((F.count("*") * GROWTH).alias("many")))
        open_levels = settle(_levels(pairs, wanted).join(short, "lang"))
        levels = settle(
            levels.join(open_levels.select("lang", F.col("level").alias("lower")), "lang", "left").select(
                "lang", F.coalesce("lower", "level").alias("level"), "before"
            )
        )


def collocations(
    docs: DataFrame, top: int = TOP, least: int = LEAST, share: int = SHARE, step: int = STEP
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the best phrases of each language."""
    texts = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit(UNDETERMINED)).alias("lang"), F.col("text").cast("string").alias("text")
    ).filter(F.col("text").isNotNull())
    words = _vocabulary(texts, step)
    totals = settle(words.groupBy("lang").agg(F.sum("f").alias("n")))
    pairs = _pairs(texts, words, least, step)
    found = _settled(texts, pairs, top, least, share, step)
    # Phrases get their words once it is known which can be among the best.
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc())
    found = stored(found.withColumn("place", F.rank().over(best)).filter(F.col("place") <= top).drop("place"))
    spelled = found.withColumn("parts", F.array("h1", "h2", "h3")).select("*", F.posexplode("parts").alias("at", "h"))
    spelled = spelled.drop("parts").filter(F.col("h").isNotNull())
    needed = settle(spelled.select(F.col("h").alias("wanted")).distinct())
    often = words.filter(F.col("f") >= least).select("h", "word")
    names = with_small(often, needed, F.col("h") == F.col("wanted"), "left_semi")
    keys = ["lang", "h1", "h2", "h3", "a", "l", "r", "score"]
    spelled = spelled.join(names, "h").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("words"))
    phrases = spelled.withColumn("phrase", F.array_join(F.transform("words", lambda w: w["word"]), " "))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return _by_language(ranked, totals).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# All phrases are counted, none is left out by a bound.
OP12_SQL = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), worded AS (
  SELECT lang, row_number() OVER () AS id, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), placed AS (
  SELECT lang, id, unnest(w) AS w1, generate_subscripts(w, 1) AS i FROM worded
), followed AS (
  SELECT lang, w1, lead(w1) OVER piece AS w2, lead(w1, 2) OVER piece AS w3 FROM placed WINDOW piece AS (PARTITION BY id ORDER BY i)
), grams AS (
  SELECT lang, w1 AS phrase, 1 AS m FROM followed
  UNION ALL SELECT lang, w1 || ' ' || w2, 2 FROM followed WHERE w2 IS NOT NULL
  UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3 FROM followed WHERE w3 IS NOT NULL
), counted AS (
  SELECT lang, phrase, m, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counted WHERE m = 1 GROUP BY lang
), frequent AS (
  SELECT *, split_part(phrase, ' ', 1) AS p1, split_part(phrase, ' ', 2) AS p2, split_part(phrase, ' ', 3) AS p3
  FROM counted WHERE m > 1 AND f >= 10
), cuts AS (
  SELECT lang, phrase, m, f, 1 AS k, p1 AS head, CASE m WHEN 2 THEN p2 ELSE p2 || ' ' || p3 END AS tail FROM frequent
  UNION ALL
  SELECT lang, phrase, m, f, 2, p1 || ' ' || p2, p3 FROM frequent WHERE m = 3
), scored AS (
  SELECT c.lang, c.phrase, c.m, c.f AS a, x.f AS l, y.f AS r, k,
    CAST((1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counted x ON x.lang = c.lang AND x.phrase = c.head JOIN counted y ON y.lang = c.lang AND y.phrase = c.tail
), candidates AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_pairs AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, split_part(phrase, ' ', 1) || ' ' || split_part(phrase, ' ', 2) AS phrase, a FROM candidates WHERE m = 3
    UNION ALL
    SELECT lang, split_part(phrase, ' ', 2) || ' ' || split_part(phrase, ' ', 3), a FROM candidates WHERE m = 3
  ) GROUP BY ALL
), kept AS (
  SELECT c.* FROM candidates c LEFT JOIN inner_pairs i ON i.lang = c.lang AND i.phrase = c.phrase
  WHERE i.longest IS NULL OR 100 * i.longest < 50 * c.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
