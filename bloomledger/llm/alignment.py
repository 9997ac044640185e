"""Alignment of two public tokenizers over a corpus, each distinct text aligned once.

Tokenizer A (byte-level BPE) encodes a blank and the text, tokenizer B (pieces) the text, to
which it adds that blank; so the bytes of both token sequences are the same.  Where a token of
A and one of B end at one byte, a group ends.  An A token and a B token are linked if their
byte ranges overlap.  The count of a pair of ids is the number of documents that hold it
linked; a link is best if its count is the highest of its A id.

1. Documents are shuffled by their full text; of equal texts one is left, with its multiplicity
   (equal ones meet inside tasks first, so a hot text is not gathered).
2. Each distinct text is encoded and aligned.  Both tokenizers begin a new token at a blank
   between two characters that are not white space, so the parts between such blanks can be
   aligned on their own, and the worker remembers those it met.  New parts are joined by blanks
   again, encoded in batches, and aligned by the sorted ends of their tokens.  What a text
   gives, its measures and its distinct pairs with their numbers, is written as a table.
3. Counts of pairs are sums of multiplicities; there are at most as many as pairs of ids.
4. The counts of the commonest pairs (`COMMON` at most) are broadcast to the texts, those of
   all others are found by a shuffle of the rare pairs only.
5. Measures are joined to the ids of documents by a digest of the text.

A text that is null, empty, or that either tokenizer does not give back byte by byte has no
tokens: zeros and an empty digest.  Repeated rows are documents of their own and count each.  An
empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import most_frequent, settle, stored, table
from bloomledger.llm.token_counts import public_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
COMMON = 1 << 20  # pairs whose counts are broadcast (13 MB)
PART_CHARS = 1 << 19  # characters encoded and aligned at a time
JOINED_CHARS = 1 << 16  # characters of new parts that are encoded as one text
MEMO_PARTS = 400_000  # parts that a worker remembers (about 120 MB)

_B_BITS = 15  # a pair of ids is one number below 2^31
_SPACE = "▁"
# A blank between characters that are not white space (U+180E was in older versions of Unicode).
_SAFE = re.compile(r" (?<=[^\s\u180e] )(?=[^\s\u180e])")

_ALIGNED = (
    "digest binary, m long, n_a long, n_b long, n_groups long, n_links long, "
    "groups_sha256 string, pairs array<int>, times array<int>"
)


# --- tokenizers -----------------------------------------------------------------------


def byte_of_character() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for.

    Printable characters of Latin-1 stand for themselves; the others follow from 256 on.
    """
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class ByteLevel:
    """Tokenizer A: ids of texts, and the bytes of each id."""

    def __init__(self, name: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(public_path(name))
        self._tokenizer.encode_special_tokens = True  # their strings in a text are plain text
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        byte = byte_of_character()
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return [e.ids for e in self._tokenizer.encode_batch_fast([" " + p for p in parts], add_special_tokens=False)]


class Pieces:
    """Tokenizer B: ids of texts, the bytes of each id, and whether blanks part its pieces."""

    def __init__(self, name: str):
        from sentencepiece import SentencePieceProcessor

        self._model = SentencePieceProcessor(model_file=public_path(name))
        model, self.bytes, self.splits = self._model, [], True
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.bytes.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(_SPACE, " ").encode())
            # Pieces that go on behind a blank would join what is cut there.
            self.splits &= _SPACE not in piece.lstrip(_SPACE)
        self.lengths = np.array([len(b) for b in self.bytes], np.int64)

    def encode(self, parts: list[str]) -> list[list[int]]:
        return self._model.encode(parts, num_threads=1)


def align(a: list[int], b: list[int], bytes_a: list[bytes], bytes_b: list[bytes]) -> tuple[str, int, list[int]]:
    """Groups as text, their number, and the linked pairs, of two tokenisations of the same bytes."""
    groups, links = [], []
    i = j = first_a = first_b = 0
    end_a, end_b = len(bytes_a[a[0]]), len(bytes_b[b[0]])
    while True:
        links.append(a[i] << _B_BITS | b[j])
        if end_a == end_b:
            groups.append(f"{','.join(map(str, a[first_a : i + 1]))}|{','.join(map(str, b[first_b : j + 1]))}")
            i, j = i + 1, j + 1
            if i == len(a):
                return ";".join(groups), len(groups), links
            first_a, first_b = i, j
            end_a += len(bytes_a[a[i]])
            end_b += len(bytes_b[b[j]])
        elif end_a < end_b:
            i += 1
            end_a += len(bytes_a[a[i]])
        else:
            j += 1
            end_b += len(bytes_b[b[j]])


# --- texts ------------------------------------------------------------------------------


def _blank(character: str) -> bool:
    return character.isspace() or character == "\u180e"


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    return array if size <= len(array) else np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), array.dtype)])


@dataclass
class Measures:
    """What one text gives."""

    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    sha256: str = ""
    pairs: np.ndarray | None = None
    times: np.ndarray | None = None


class Aligner:
    """Encodes and aligns texts; remembers parts of them."""

    def __init__(self, a: str = TOKENIZER_A, b: str = TOKENIZER_B):
        self._a, self._b = ByteLevel(a), Pieces(b)
        # How an id is written inside a group's side and at its end.
        self._written = [
            [np.array([f"{i}{mark}" for i in range(len(side.bytes))], object) for mark in marks]
            for side, marks in ((self._a, ",|"), (self._b, ",;"))
        ]
        if len(self._a.bytes) << _B_BITS > 1 << 31 or len(self._b.bytes) > 1 << _B_BITS:
            raise ValueError("the ids of a pair do not fit into 31 bits")
        self._forget()

    def _forget(self) -> None:
        self._number: dict[str, int] = {}
        self._groups: list[str] = []
        self._sizes = np.zeros((1024, 4), np.int64)  # tokens of A, of B, groups, first link
        self._links = np.zeros(4096, np.int32)
        self._n_links = 0

    def _learn(self, parts: list[str]) -> None:
        """Encodes and aligns new parts."""
        self._sizes = _grown_rows(self._sizes, len(self._groups) + len(parts) + 1)
        joined: list[str] = []
        size = 0
        for part in parts:
            # White space at an end (of a whole text) would make a joining blank unsafe.
            if not self._b.splits or _blank(part[0]) or _blank(part[-1]):
                self._learn_apart([part])
                continue
            joined.append(part)
            size += len(part)
            if size >= JOINED_CHARS:
                self._learn_joined(joined)
                joined, size = [], 0
        if joined:
            self._learn_joined(joined)

    def _learn_apart(self, parts: list[str]) -> None:
        """Parts that are encoded one by one.  One that is not given back has -1 tokens."""
        bytes_a, bytes_b = self._a.bytes, self._b.bytes
        for part, a, b in zip(parts, self._a.encode(parts), self._b.encode(parts)):
            number = self._number[part] = len(self._groups)
            whole = b" " + part.encode()
            if b"".join([bytes_a[i] for i in a]) != whole or b"".join([bytes_b[i] for i in b]) != whole:
                self._groups.append("")
                self._sizes[number, :3] = -1
            else:
                groups, n_groups, links = align(a, b, bytes_a, bytes_b)
                self._groups.append(groups)
                self._sizes[number, :3] = len(a), len(b), n_groups
                self._add_links(np.array(links, np.int32))
            self._sizes[number + 1, 3] = self._n_links

    def _add_links(self, links: np.ndarray) -> None:
        self._links = _grown(self._links, self._n_links + len(links))
        self._links[self._n_links : self._n_links + len(links)] = links
        self._n_links += len(links)

    def _learn_joined(self, parts: list[str]) -> None:
        """Parts that are encoded as one text; all ends of tokens are in one order then."""
        text = " ".join(parts)
        whole = b" " + text.encode()
        ids = [np.array(side.encode([text])[0], np.int64) for side in (self._a, self._b)]
        ends = [np.cumsum(side.lengths[i]) for side, i in zip((self._a, self._b), ids)]
        part_ends = np.cumsum([1 + len(p.encode()) for p in parts])
        for side, own, end in zip((self._a, self._b), ids, ends):
            at = np.minimum(np.searchsorted(end, part_ends), len(end) - 1)
            if not (end[at] == part_ends).all() or b"".join([side.bytes[i] for i in own.tolist()]) != whole:
                self._learn_apart(parts)  # one of them is not given back
                return
        (a, b), (ends_a, ends_b) = ids, ends
        # Between two ends that follow each other lies one token of each: a link.
        every = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, every)] << _B_BITS | b[np.searchsorted(ends_b, every)]
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        last_a, last_b = ends_a == both[group_a], ends_b == both[group_b]
        # Written in the order of groups, A before B.
        flat = np.empty(len(a) + len(b), object)
        for own, last, other, written in (
            (a, last_a, np.searchsorted(group_b, group_a, side="left"), self._written[0]),
            (b, last_b, np.searchsorted(group_a, group_b, side="right"), self._written[1]),
        ):
            flat[np.arange(len(own)) + other] = np.where(last, written[1][own], written[0][own])
        counts = [np.searchsorted(e, part_ends, side="right") for e in (ends_a, ends_b, both, every)]
        first = len(self._groups)
        rows = slice(first, first + len(parts))
        self._sizes[rows, :3] = np.stack([np.diff(c, prepend=0) for c in counts[:3]], axis=1)
        self._sizes[first + 1 : first + len(parts) + 1, 3] = self._n_links + counts[3]
        self._add_links(links.astype(np.int32))
        words, begin = flat.tolist(), 0
        for part, end in zip(parts, (counts[0] + counts[1]).tolist()):
            self._number[part] = len(self._groups)
            self._groups.append("".join(words[begin:end])[:-1])
            begin = end

    def measure(self, texts: list[str]) -> list[Measures]:
        """Measures of texts that are not empty."""
        out: list[Measures] = []
        waiting: list[str] = []
        size = 0
        for text in texts:
            if len(text) > 2 * PART_CHARS:
                out += self._block(waiting)
                waiting, size = [], 0
                out.append(self._long(text))
                continue
            waiting.append(text)
            size += len(text)
            if size >= PART_CHARS:
                out += self._block(waiting)
                waiting, size = [], 0
        return out + self._block(waiting)

    def _parts(self, text: str) -> list[str]:
        return _SAFE.split(text) if self._b.splits else [text]

    def _block(self, texts: list[str]) -> list[Measures]:
        """Measures of texts, all pairs of them in one array."""
        if not texts:
            return []
        if len(self._groups) > MEMO_PARTS:
            self._forget()
        number = self._number
        parts = [self._parts(text) for text in texts]
        new = {p for some in parts for p in some if p not in number}
        if new:
            self._learn(list(new))
        at = [[number[p] for p in some] for some in parts]
        lengths = np.array([len(some) for some in at])
        flat = np.fromiter((i for some in at for i in some), np.int64, int(lengths.sum()))
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        sizes = np.add.reduceat(self._sizes[flat, :3], starts)
        bad = np.logical_or.reduceat(self._sizes[flat, 0] < 0, starts)

        begin, n_links = self._sizes[flat, 3], self._sizes[flat + 1, 3] - self._sizes[flat, 3]
        total = int(n_links.sum())
        place = np.arange(total) + np.repeat(begin - (np.cumsum(n_links) - n_links), n_links)
        owner = np.repeat(np.arange(len(texts)), np.add.reduceat(n_links, starts))
        keys, times = np.unique(owner << 31 | self._links[place], return_counts=True)
        ends = np.searchsorted(keys >> 31, np.arange(len(texts) + 1))
        pairs = (keys & ((1 << 31) - 1)).astype(np.int32)

        out = []
        groups = self._groups
        for row, text in enumerate(texts):
            if bad[row]:
                out.append(self._whole(text))
                continue
            one = slice(ends[row], ends[row + 1])
            sha = hashlib.sha256(";".join([groups[i] for i in at[row]]).encode()).hexdigest()
            n_a, n_b, n_groups = map(int, sizes[row])
            out.append(Measures(n_a, n_b, n_groups, int(times[one].sum()), sha, pairs[one], times[one].astype(np.int32)))
        return out

    def _long(self, text: str) -> Measures:
        """Measures of a long text, read in steps that end at safe blanks."""
        total, sha, at = Measures(), hashlib.sha256(), 0
        pairs, times = np.zeros(0, np.int32), np.zeros(0, np.int64)
        while at < len(text):
            blank = _SAFE.search(text, at + PART_CHARS) if self._b.splits else None
            step = text[at : blank.start()] if blank else text[at:]
            if len(self._groups) > MEMO_PARTS:
                self._forget()
            parts = self._parts(step)
            new = {p for p in parts if p not in self._number}
            if new:
                self._learn(list(new))
            flat = np.array([self._number[p] for p in parts])
            if (self._sizes[flat, 0] < 0).any():
                return self._whole(text)
            total.n_a, total.n_b, total.n_groups = (x + int(y) for x, y in zip((total.n_a, total.n_b, total.n_groups), self._sizes[flat, :3].sum(axis=0)))
            begin, n_links = self._sizes[flat, 3], self._sizes[flat + 1, 3] - self._sizes[flat, 3]
            place = np.arange(n_links.sum()) + np.repeat(begin - (np.cumsum(n_links) - n_links), n_links)
            some, often = np.unique(self._links[place], return_counts=True)
            total.n_links += int(often.sum())
            both, where = np.unique(np.concatenate([pairs, some]), return_inverse=True)
            times = np.bincount(where, np.concatenate([times, often])).astype(np.int64)
            pairs = both
            sha.update(((";" if at else "") + ";".join([self._groups[i] for i in flat.tolist()])).encode())
            at = blank.end() if blank else len(text)
        total.sha256, total.pairs, total.times = sha.hexdigest(), pairs, times.astype(np.int32)
        return total

    def _whole(self, text: str) -> Measures:
        """Measures of a text that is not given back in parts: encoded as a whole."""
        a, b = self._a.encode([text])[0], self._b.encode([text])[0]
        whole = b" " + text.encode()
        if b"".join([self._a.bytes[i] for i in a]) != whole or b"".join([self._b.bytes[i] for i in b]) != whole:
            none = np.zeros(0, np.int32)
            return Measures(pairs=none, times=none)
        groups, n_groups, links = align(a, b, self._a.bytes, self._b.bytes)
        pairs, times = np.unique(np.array(links, np.int32), return_counts=True)
        sha = hashlib.sha256(groups.encode()).hexdigest()
        return Measures(len(a), len(b), n_groups, len(links), sha, pairs, times.astype(np.int32))


def _grown_rows(array: np.ndarray, size: int) -> np.ndarray:
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros((max(size, 2 * len(array)) - len(array), array.shape[1]), array.dtype)])


# --- corpus -----------------------------------------------------------------------------


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays])]).astype(np.int32)
    values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def aligned_texts(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B) -> DataFrame:
    """A row for each distinct text: digest, multiplicity, measures, distinct pairs and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = None
        for batch in batches:
            aligner = aligner or Aligner(a, b)
            step = 500  # rows whose pairs are held at a time
            for first in range(0, batch.num_rows, step):
                rows = batch.slice(first, step)
                found = aligner.measure(rows.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [
                        rows.column("digest"),
                        rows.column("m"),
                        *(pa.array([getattr(f, name) for f in found], pa.int64()) for name in ("n_a", "n_b", "n_groups", "n_links")),
                        pa.array([f.sha256 for f in found], pa.string()),
                        _lists([f.pairs for f in found]),
                        _lists([f.times for f in found]),
                    ],
                    names=["digest", "m", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"],
                )

    texts = docs.select(F.col("text").cast("string").alias("text")).filter("text <> ''")
    texts = texts.groupBy("text").agg(F.count("*").alias("m")).withColumn("digest", _digest())
    return texts.select("digest", "m", "text").mapInArrow(run, _ALIGNED)


def _digest():
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """pair, n, best: documents that hold each pair, and whether no pair of its A id has more."""
    pairs = aligned.select("m", F.explode("pairs").alias("pair")).groupBy("pair").agg(F.sum("m").alias("n"))
    of_a = Window.partitionBy(F.shiftright("pair", _B_BITS))  # at most as many rows as B has ids
    return stored(pairs.withColumn("best", F.col("n") == F.max("n").over(of_a)))


def _common_sums(shared):
    """Sums over the common pairs of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, times, hit, owner = _looked_up(batch, shared.value[0])
            _, n, best = shared.value
            sums = [np.bincount(owner[hit], v, batch.num_rows).astype(np.int64) for v in (times[hit] * best[at[hit]], times[hit] * n[at[hit]])]
            yield pa.RecordBatch.from_arrays([batch.column("digest"), *map(pa.array, sums)], names=["digest", "n_best", "count_sum"])

    return run


def _rare_pairs(shared):
    """The pairs of each text that are not common."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            _, times, hit, owner = _looked_up(batch, shared.value[0])
            rare = np.flatnonzero(~hit)
            flat = batch.column("pairs").flatten()
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest").take(pa.array(owner[rare])), flat.take(pa.array(rare)), pa.array(times[rare])],
                names=["digest", "pair", "times"],
            )

    return run


def _looked_up(batch: pa.RecordBatch, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Place among the common pairs, number, whether it is one, and row, of each pair of a batch."""
    lists = batch.column("pairs")
    pairs = lists.flatten().to_numpy()
    times = batch.column("times").flatten().to_numpy().astype(np.int64)
    owner = np.repeat(np.arange(batch.num_rows), lists.value_lengths().to_numpy())
    if not len(common):
        return np.zeros(len(pairs), np.int64), times, np.zeros(len(pairs), bool), owner
    at = np.minimum(np.searchsorted(common, pairs), len(common) - 1)
    return at, times, common[at] == pairs, owner


def align_corpus(docs: DataFrame, a: str = TOKENIZER_A, b: str = TOKENIZER_B, common: int = COMMON) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark = docs.sparkSession
    aligned = stored(aligned_texts(docs, a, b))
    counts = pair_counts(aligned)
    is_common = most_frequent(counts, "n", common)
    known = counts.filter(is_common).toArrow().sort_by("pair")  # `common` rows at most
    shared = spark.sparkContext.broadcast(tuple(known[c].to_numpy() for c in ("pair", "n", "best")))
    held = aligned.select("digest", "pairs", "times")
    sums = held.mapInArrow(_common_sums(shared), "digest binary, n_best long, count_sum long")
    rare = settle(counts.filter(~is_common))
    if rare.limit(1).count():
        met = held.mapInArrow(_rare_pairs(shared), "digest binary, pair int, times long").join(rare, "pair")
        best = F.when(F.col("best"), F.col("times")).otherwise(0)
        met = met.groupBy("digest").agg(F.sum(best).alias("n_best"), F.sum(F.col("times") * F.col("n")).alias("count_sum"))
        sums = sums.unionByName(met).groupBy("digest").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    measures = ["n_a", "n_b", "n_groups", "n_links"]
    found = aligned.select("digest", *measures, "groups_sha256").join(sums, "digest")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.select("doc_id", F.coalesce(_digest(), F.lit(b"")).alias("digest")).join(found, "digest", "left")
    return rows.select(
        "doc_id",
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in [*measures, "n_best", "count_sum"]),
        F.coalesce("groups_sha256", F.lit("")).alias("groups_sha256"),
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align_corpus(table(spark, sf_dir, "documents"))
