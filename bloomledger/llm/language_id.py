"""Language identification by segmentation-marginalised unigrams.

The pieces are those of a public subword vocabulary, which stays as it is.  For each
language every piece has a probability; a word has the probability of all its
segmentations into pieces, summed by the forward algorithm, and a text that of its words
(letter runs, lower case).  The piece probabilities are fitted by expectation
maximisation over all segmentations, on a bounded sample of labelled texts; everything
else covers all rows.  Words of one length are scored together; a run of more than
`TOGETHER_CHARS` letters (a clause of a language without blanks) is scored alone, with values
that are scaled on the way, as its probability is too small for a number.  Scores of words that were met before are remembered by each
worker, up to a fixed number.

Learning reads text and lang of rows whose crc32(doc_id as text) mod 5 is not 0 and whose
lang is not null; a prediction reads the text alone.

Null text, or text without a letter: `und` with score 0.  With nothing to learn from (an
empty table, no labels) every row is `und`.  Ties go to the language that comes first by
name.  Null doc_id: neither learned from nor held out.  Rows pass one by one, so repeated
rows give repeated results; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import CHUNK_BYTES, settle, table, with_small

VOCABULARY = "piece_bpe_32k.model"
SAMPLE_DOCS = 600  # labelled texts of each language that the fit reads
ITERATIONS = 4
FOLDS = 5
UNDETERMINED = "und"
LEAST_SCORE = 0.5  # below it no language is more likely than all others together

WORD_START = "▁"
TOGETHER_CHARS = 40  # a longer run could underflow: 1e-7 for each character
UNKNOWN = 1e-7  # probability of a character that is no piece
PRIOR = 0.02  # pseudo-count of every piece
MEMO_WORDS = 300_000

_HASH_RANGE = 1 << 40

_LETTERS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x9E3779B97F4A7C15)
_SCHEMA = "doc_id long, held_out boolean, lang_pred string, score double"


def words_of(text: str) -> Counter:
    """Letter runs in lower case, with their counts."""
    return Counter(_LETTERS.findall(text.lower()))


def public_pieces(name: str) -> list[str]:
    """The text pieces of a public sentencepiece vocabulary: words' starts are marked."""
    import public_tokenizers
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=public_tokenizers.path(name))
    texts = (
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    )
    wanted = re.compile(rf"{WORD_START}?[^\W\d_]*\Z")
    return sorted({t for t in texts if t != "" and t == t.lower() and wanted.match(t)})


def _codes(words: list[str]) -> np.ndarray:
    """Code points of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1).astype(np.uint64)


def _hash_texts(texts: list[str]) -> np.ndarray:
    out = np.empty(len(texts), np.uint64)
    by_length: dict[int, list[int]] = {}
    for i, t in enumerate(texts):
        by_length.setdefault(len(t), []).append(i)
    for length, rows in by_length.items():
        codes = _codes([texts[i] for i in rows])
        h = np.zeros(len(rows), np.uint64)
        for j in range(length):
            h = h * _BASE + codes[:, j] + np.uint64(1)
        out[rows] = h
    return out


@dataclass
class Pieces:
    """The vocabulary as sorted hashes, to look substrings up in bulk."""

    texts: list[str]
    hashes: np.ndarray = field(init=False)
    order: np.ndarray = field(init=False)
    longest: int = field(init=False)

    def __post_init__(self):
        hashes = _hash_texts(self.texts)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.longest = max(map(len, self.texts), default=1)

    def matches(self, words: list[str]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) of all pieces inside words of one length, by start and end."""
        codes = _codes(words) + np.uint64(1)
        length = codes.shape[1]
        for start in range(length):
            h = np.zeros(len(words), np.uint64)
            for end in range(start + 1, min(length, start + self.longest) + 1):
                h = h * _BASE + codes[:, end - 1]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                rows = np.flatnonzero(self.hashes[at] == h)
                if len(rows):
                    yield start, end, rows, self.order[at[rows]]


    def lattice(self, word: str, block: int = 1 << 16) -> np.ndarray:
        """The piece of each length that begins at each place of one word, -1 for none: places x lengths."""
        codes = _codes([word])[0] + np.uint64(1)
        out = np.full((len(word), self.longest), -1, np.int32)
        for first in range(0, len(word), block):
            last = min(first + block, len(word))
            h = np.zeros(last - first, np.uint64)
            for size in range(1, self.longest + 1):
                n = min(last, len(word) - size + 1) - first
                if n <= 0:
                    break
                h = h[:n] * _BASE + codes[first + size - 1 : first + size - 1 + n]
                at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                same = self.hashes[at] == h
                out[first : first + n, size - 1][same] = self.order[at[same]]
        return out


def _marked_by_length(words: list[str], block: int = 20_000) -> Iterator[tuple[np.ndarray, list[str]]]:
    """Numbers and marked texts of words of one length, in blocks."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths[lengths <= TOGETHER_CHARS]):
        rows = np.flatnonzero(lengths == length)
        for at in range(0, len(rows), block):
            part = rows[at : at + block]
            yield part, [WORD_START + words[i] for i in part]


def forward(pieces: Pieces, probabilities: np.ndarray, words: list[str]) -> np.ndarray:
    """Natural log of the summed probability of all segmentations: words x languages."""
    out = np.empty((len(words), probabilities.shape[1]))
    for rows, marked in _marked_by_length(words):
        alpha = _forward(pieces, probabilities, marked)
        out[rows] = np.log(alpha[-1])
    for row, word in enumerate(words):
        if len(word) > TOGETHER_CHARS:
            out[row] = _scan(pieces.lattice(WORD_START + word), probabilities)[-1]
    return out


def _scan(lattice: np.ndarray, probabilities: np.ndarray, keep: bool = False) -> np.ndarray:
    """Natural log of the summed probability of all segmentations of a word's beginnings.

    With `keep` a row for each end, from 0 on; else only the last one.  The values of the
    last places, as many as the longest piece has characters, are kept scaled to 1 at most.
    """
    n, longest = lattice.shape
    recent = np.zeros((longest, probabilities.shape[1]))  # row j: the place j + 1 characters back
    recent[0] = 1.0
    scale = np.zeros(probabilities.shape[1])
    out = np.zeros((n + 1 if keep else 1, probabilities.shape[1]))
    back = np.arange(longest)
    for end in range(1, n + 1):
        reach = min(end, longest)
        # The piece of j + 1 characters that ends here begins j + 1 characters back.
        found = lattice[end - 1 - back[:reach], back[:reach]]
        now = recent[0] * UNKNOWN
        some = np.flatnonzero(found >= 0)
        if len(some):
            now = now + (recent[some] * probabilities[found[some]]).sum(axis=0)
        recent[1:] = recent[:-1].copy()
        recent[0] = now
        top = recent.max(axis=0)
        if (now < 1e-100).any():
            recent /= top
            scale += np.log(top)
        if keep or end == n:
            out[end if keep else 0] = np.log(recent[0]) + scale
    return out


def _long_expected(pieces: Pieces, probabilities: np.ndarray, word: str, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces of a long word and how often each is used, over all segmentations, for each language."""
    lattice = pieces.lattice(WORD_START + word)
    start, size = np.nonzero(lattice >= 0)
    found = lattice[start, size]
    n, longest = lattice.shape
    # Backwards, the word is scanned from its end: pieces that begin there end here.
    mirrored = np.full_like(lattice, -1)
    end = start + size + 1
    mirrored[n - end, size] = found
    before, after = _scan(lattice, probabilities, keep=True), _scan(mirrored, probabilities, keep=True)
    share = np.exp(before[start] + np.log(probabilities[found]) + after[n - end] - before[n]) * weight
    return found, share


def _forward(pieces: Pieces, probabilities: np.ndarray, marked: list[str], matches: list | None = None) -> np.ndarray:
    """alpha[end, word, language]: probability of the word's first `end` characters."""
    length, n_languages = len(marked[0]), probabilities.shape[1]
    alpha = np.zeros((length + 1, len(marked), n_languages))
    alpha[0] = 1.0
    done = 0
    for start, end, rows, found in matches if matches is not None else pieces.matches(marked):
        while done < start:  # every character is at least an unknown piece
            done += 1
            alpha[done] += alpha[done - 1] * UNKNOWN
        alpha[end, rows] += alpha[start, rows] * probabilities[found]
    while done < length:
        done += 1
        alpha[done] += alpha[done - 1] * UNKNOWN
    return alpha


def fit(pieces: Pieces, words: list[str], counts: np.ndarray, iterations: int = ITERATIONS) -> np.ndarray:
    """Piece probabilities by language (pieces x languages) from counts (words x languages)."""
    n_languages = counts.shape[1]
    blocks = [(rows, marked, list(pieces.matches(marked))) for rows, marked in _marked_by_length(words)]
    long = [row for row, word in enumerate(words) if len(word) > TOGETHER_CHARS]
    probabilities = np.full((len(pieces.texts), n_languages), 1.0 / len(pieces.texts))
    for _ in range(iterations):
        expected = np.zeros_like(probabilities)
        for rows, marked, matches in blocks:
            alpha = _forward(pieces, probabilities, marked, matches)
            length = len(marked[0])
            beta = np.zeros_like(alpha)
            beta[length] = 1.0
            done = length
            for start, end, at, found in sorted(matches, key=lambda m: (-m[0], m[1])):
                while done > start + 1:
                    done -= 1
                    beta[done] += beta[done + 1] * UNKNOWN
                beta[start, at] += beta[end, at] * probabilities[found]
            weight = counts[rows] / alpha[length]
            for start, end, at, found in matches:
                share = alpha[start, at] * probabilities[found] * beta[end, at] * weight[at]
                for k in range(n_languages):
                    expected[:, k] += np.bincount(found, share[:, k], len(pieces.texts))
        for row in long:
            found, share = _long_expected(pieces, probabilities, words[row], counts[row])
            np.add.at(expected, found, share)
        expected += PRIOR
        probabilities = expected / expected.sum(axis=0)
    return probabilities


@dataclass
class Model:
    languages: list[str]
    probabilities: np.ndarray
    vocabulary: str


class Scorer:
    """Scores texts under a model; remembers the scores of words."""

    def __init__(self, model: Model):
        self._model = model
        self._pieces = Pieces(public_pieces(model.vocabulary)) if model.languages else None
        self._known: dict[str, int] = {}
        self._scores = np.empty((0, len(model.languages)))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        if not self._model.languages:
            return [UNDETERMINED] * len(texts), [0.0] * len(texts)
        found = [words_of(t) if t else Counter() for t in texts]
        new = list(dict.fromkeys(w for words in found for w in words if w not in self._known))
        if len(self._known) + len(new) > MEMO_WORDS:
            self._known.clear()
            self._scores = self._scores[:0]
            new = list(dict.fromkeys(w for words in found for w in words))
        if new:
            base = len(self._scores)
            self._known.update((w, base + i) for i, w in enumerate(new))
            self._scores = np.concatenate([self._scores, forward(self._pieces, self._model.probabilities, new)])
        names, sure = [], []
        for words in found:
            if not words:
                names.append(UNDETERMINED)
                sure.append(0.0)
                continue
            rows = np.fromiter(map(self._known.__getitem__, words), np.int64, len(words))
            times = np.fromiter(words.values(), np.float64, len(words))
            total = times @ self._scores[rows]
            best = int(total.argmax())
            names.append(self._model.languages[best])
            sure.append(float(1.0 / np.exp(total - total[best]).sum()))
        return names, sure


def _in_bounded_parts(scorer: Scorer, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """Predictions of many texts, a bounded amount of text at a time."""
    names, sure, part, size = [], [], [], 0
    for i, text in enumerate(texts):
        part.append(text)
        size += len(text or "")
        if size > CHUNK_BYTES or i == len(texts) - 1:
            more_names, more_sure = scorer.predict(part)
            names += more_names
            sure += more_sure
            part, size = [], 0
    return names, sure


def fold_of(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def learn(docs: DataFrame, vocabulary: str = VOCABULARY, sample_docs: int = SAMPLE_DOCS) -> Model:
    """Piece probabilities from at most `sample_docs` labelled texts of each language."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string"), F.col("lang").cast("string")
    ).filter((fold_of(F.col("doc_id")) != 0) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Distinct (id, text) with the least hashes are the sample.  Their share is known from the
    # counts, so only about four times as many are put in order, however many there are.
    rows = rows.withColumn("hash", F.xxhash64("doc_id", "text"))
    ids = settle(rows.select("lang", "hash").distinct())
    sizes = settle(ids.groupBy("lang").agg(F.count("*").alias("n_rows")))
    place = F.pmod("hash", F.lit(_HASH_RANGE))
    near = with_small(ids, sizes.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"))
    near = near.filter(place < F.lit(4.0 * sample_docs * _HASH_RANGE) / F.col("n_rows"))
    first = Window.partitionBy("lang").orderBy(place, "hash")
    chosen = near.select(F.col("lang").alias("of"), F.col("hash").alias("of_hash"), F.row_number().over(first).alias("place"))
    chosen = settle(chosen.filter(F.col("place") <= sample_docs).select("of", "of_hash"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_language: dict[str, Counter] = {}
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                by_language.setdefault(lang, Counter()).update(words_of(text))
            flat = [(lang, w, n) for lang, words in by_language.items() for w, n in words.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*flat) if flat else ((), (), ()), (pa.string(), pa.string(), pa.int64()))],
                names=["lang", "word", "n"],
            )

    sample = with_small(rows, chosen, (F.col("lang") == F.col("of")) & (F.col("hash") == F.col("of_hash")), "left_semi")
    sample = sample.dropDuplicates(["lang", "hash"]).select("lang", "text")
    counted = sample.mapInArrow(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    found = counted.toArrow().sort_by([("lang", "ascending"), ("word", "ascending")])
    languages = sorted(set(found["lang"].to_pylist()))
    if not languages:
        return Model([], np.zeros((0, 0)), vocabulary)
    words = sorted(set(found["word"].to_pylist()))
    at = {w: i for i, w in enumerate(words)}
    column = {name: i for i, name in enumerate(languages)}
    counts = np.zeros((len(words), len(languages)))
    for lang, word, n in zip(found["lang"].to_pylist(), found["word"].to_pylist(), found["n"].to_pylist()):
        counts[at[word], column[lang]] = n
    return Model(languages, fit(Pieces(public_pieces(vocabulary)), words, counts), vocabulary)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score for every row."""
    # Plain values: pieces x languages numbers.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.probabilities, model.vocabulary))

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(Model(*shared.value))
            names, sure = _in_bounded_parts(scorer, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(sure, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    frame = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(fold_of(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return frame.mapInArrow(predict, _SCHEMA)


def accepted(docs: DataFrame, model: Model, least: float = LEAST_SCORE) -> DataFrame:
    """The rows, all columns as they are, whose text has a language with at least this score."""
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.probabilities, model.vocabulary))
    at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(Model(*shared.value))
            names, sure = _in_bounded_parts(scorer, batch.column(at).to_pylist())
            yield batch.filter(pa.array([n != UNDETERMINED and s >= least for n, s in zip(names, sure)], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return identify(docs, learn(docs))
