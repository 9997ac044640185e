"""Token counts of whole texts with a public tokenizer, batch encoded in Arrow functions.

Texts are cut at safe boundaries, a blank between two characters that are not white
space: no pre-token of a byte-level BPE and no special string spans one, and a blank
always opens the pre-token that follows, so the counts of the pieces add up to the
count of the text.  Pieces recur a lot.  Each worker keeps the counts of pieces that it
has met, in a memo of bounded size, and only new pieces are encoded, in batches that
are balanced by bytes.  Only lengths leave the function.

Null text counts as empty (0 bytes, 0 tokens).  Rows pass one by one: repeated rows give
repeated results, an empty table an empty one, other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from bloomledger.llm.common import table

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 1024
MEMO_ENTRIES = 400_000  # about 60 MB a worker
MEMO_PIECE_CHARS = 48  # longer pieces seldom recur
BATCH_BYTES = 1 << 20  # bytes of new pieces encoded in one call

SCHEMA = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def public_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def safe_pieces(text: str) -> list[str]:
    """The text cut before blanks that stand between characters that aren't white space."""
    words = iter(text.split(" "))
    word = next(words)
    pieces, start, end = [], 0, len(word)
    closed = word and not _blank(word[-1])
    for word in words:
        if closed and word and not _blank(word[0]):
            pieces.append(text[start:end])
            start = end
        end += 1 + len(word)
        closed = word and not _blank(word[-1])
    pieces.append(text[start:])
    return pieces


def _blank(character: str) -> bool:
    # U+180E was white space in older versions of Unicode.
    return character.isspace() or character == "\u180e"


class PieceCounter:
    """Counts tokens of texts; remembers those of pieces."""

    def __init__(self, encode_lengths: Callable[[list[str]], list[int]]):
        self._encode = encode_lengths
        self._memo: dict[str, int] = {}

    def counts(self, texts: list[str | None]) -> list[int]:
        totals = [0] * len(texts)
        memo = self._memo
        waiting: dict[str, list[int]] = {}
        size = 0
        for row, text in enumerate(texts):
            if not text:
                continue
            total = 0
            for piece in safe_pieces(text):
                known = memo.get(piece)
                if known is not None:
                    total += known
                    continue
                rows = waiting.get(piece)
                if rows is None:
                    waiting[piece] = [row]
                    size += len(piece)
                else:
                    rows.append(row)
            totals[row] += total
            if size >= BATCH_BYTES:
                self._flush(waiting, totals)
                waiting, size = {}, 0
        self._flush(waiting, totals)
        return totals

    def _flush(self, waiting: dict[str, list[int]], totals: list[int]) -> None:
        if not waiting:
            return
        pieces = list(waiting)
        lengths = self._encode(pieces)
        if len(self._memo) + len(pieces) > MEMO_ENTRIES:
            self._memo.clear()
        for piece, length in zip(pieces, lengths):
            for row in waiting[piece]:
                totals[row] += length
            if len(piece) <= MEMO_PIECE_CHARS:
                self._memo[piece] = length


def hf_lengths(name: str) -> Callable[[list[str]], list[int]]:
    """Batch encoder of a tokenizers file: its default handling of special strings."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark owns the cores
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_path(name))
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def lengths(pieces: list[str]) -> list[int]:
        return [len(e.ids) for e in tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    return lengths


def count_tokens(docs: DataFrame, tokenizer: str = TOKENIZER, limit: int = LIMIT) -> DataFrame:
    """doc_id, UTF-8 bytes, tokens, and whether the tokens exceed the limit, for every row."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = None
        for batch in batches:
            counter = counter or PieceCounter(hf_lengths(tokenizer))
            text = batch.column("text")
            n_bytes = pc.fill_null(pc.cast(pc.binary_length(text), pa.int64()), 0)
            tokens = pa.array(counter.counts(text.to_pylist()), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), n_bytes, tokens, pc.greater(tokens, limit)],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    frame = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    return frame.mapInArrow(count, SCHEMA)


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
