"""Removal of repeated lines: sorted hashes, first occurrences, keep bitmaps.

A line's key is the line without white space at both ends, A-Z lowered.  A key of at least
`LEAST_CHARS` code points stays in the document with the smallest id that holds it and goes
from all others.

1. Each line of a long enough key becomes its 128-bit hash, its document and its position;
   text moves no further.
2. Hot keys, more than one of `HOT_SHARE` lines each (so there are fewer than that many),
   are found by counts of slices of the hash, which are summed before they are shuffled.
   Their first documents are partial minima and are broadcast: such lines are decided where
   they are.
3. All other lines are partitioned by ranges of the hash and sorted by hash, document and
   position; a window streams over each run and marks what is not in its first document.
4. The positions of a document's marked lines become its keep bitmap, run-length coded: the
   positions at which keeping and dropping take turns, beginning with lines that are kept.

Null text is one empty line.  Rows with equal doc_id are one document when keys are compared,
a null doc_id is the smallest; each row has its own bitmap, found by id and text.  Repeated
rows give repeated results, an empty table an empty one.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import id_of, key_of, settle, table

LEAST_CHARS = 10
HOT_SHARE = 20_000

_BLANKS = " \t\n\x0b\x0c\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_SLICE_BITS = 16


def lines_of(text: Column) -> Column:
    """The lines of a text; a null or empty one has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _stripped(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def line_key(line: Column) -> Column:
    return F.translate(_stripped(line), _UPPER, _UPPER.lower())


def _hashed_lines(texts: DataFrame) -> DataFrame:
    """h1, h2, k, d, position of every line whose key is long enough."""
    lines = texts.select("k", "d", F.posexplode_outer(lines_of(F.col("text"))).alias("position", "line"))
    lines = lines.filter(F.char_length(_stripped(F.col("line"))) >= LEAST_CHARS)
    key = line_key(F.col("line"))
    return lines.select(F.xxhash64(key).alias("h1"), F.xxhash64(F.lit(1), key).alias("h2"), "k", "d", "position")


def _hot_keys(lines: DataFrame, share: int) -> DataFrame:
    """h1, h2, first of the keys that more than one of `share` lines have; fewer than `share` rows."""
    piece = F.shiftrightunsigned("h1", 64 - _SLICE_BITS)
    pieces = settle(lines.groupBy(piece.alias("piece")).agg(F.count("*").alias("n")))
    most = (pieces.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) / share
    heavy = pieces.filter(F.col("n") > most).select("piece")
    found = lines.join(F.broadcast(heavy), piece == F.col("piece"), "left_semi")
    found = found.groupBy("h1", "h2").agg(F.min("k").alias("first"), F.count("*").alias("n"))
    return settle(found.filter(F.col("n") > most).drop("n"))


def _toggles(positions: Column) -> Column:
    """Where keeping and dropping take turns, from the sorted positions of dropped lines."""

    def turns(p: Column) -> Column:
        begins = F.filter(p, lambda x, i: F.coalesce(F.get(p, i - 1) != x - 1, F.lit(True)))
        ends = F.filter(p, lambda x, i: F.coalesce(F.get(p, i + 1) != x + 1, F.lit(True)))
        return F.flatten(F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda r: F.array(r["b"], r["e"] + 1)))

    return _with_bound(positions, turns)


def _with_bound(value: Column, use) -> Column:
    """`use` of a value that is computed once, though lambdas inside read it again and again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def keep_bitmaps(docs: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """k, d, toggles: the keep bitmap of each document that loses a line.

    k and d are the key of the id and the hash of the text of a row (`row_keys`).
    """
    lines = settle(_hashed_lines(row_keys(docs)))
    hot = _hot_keys(lines, hot_share)
    decided = lines.join(F.broadcast(hot), ["h1", "h2"]).filter(F.col("k") != F.col("first"))
    others = lines.join(F.broadcast(hot), ["h1", "h2"], "left_anti").repartitionByRange("h1", "h2")
    in_order = Window.partitionBy("h1", "h2").orderBy("k", "d", "position")
    others = others.withColumn("first", F.first("k").over(in_order)).filter(F.col("k") != F.col("first"))
    dropped = decided.select("k", "d", "position").unionByName(others.select("k", "d", "position"))
    positions = F.array_sort(F.collect_set("position"))
    return dropped.groupBy("k", "d").agg(positions.alias("positions")).select("k", "d", _toggles(F.col("positions")).alias("toggles"))


def row_keys(docs: DataFrame) -> DataFrame:
    """k, d, text of every row."""
    texts = docs.select(key_of("doc_id").alias("k"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return texts.select("k", F.xxhash64("text").alias("d"), "text")


def kept_lines(lines: Column, toggles: Column) -> Column:
    """The lines that a keep bitmap leaves."""

    def cut(both: Column) -> Column:
        at, all_lines = both["toggles"], both["lines"]
        begin = lambda i: F.coalesce(F.get(at, i - 1), F.lit(0))
        end = lambda i: F.coalesce(F.get(at, i), F.size(all_lines))
        runs = F.sequence(F.lit(0), F.size(at), F.lit(2))
        return F.flatten(F.transform(runs, lambda i: F.slice(all_lines, begin(i) + 1, end(i) - begin(i))))

    return _with_bound(F.struct(lines.alias("lines"), toggles.alias("toggles")), cut)


def n_dropped(toggles: Column) -> Column:
    """How many lines a keep bitmap drops: the odd runs."""
    signed = F.transform(toggles, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def without_repeats(docs: DataFrame, hot_share: int = HOT_SHARE) -> DataFrame:
    """k, n_lines, n_dropped and the text that is left, for every row."""
    rows = row_keys(docs)
    met = rows.join(keep_bitmaps(docs, hot_share), ["k", "d"], "left")
    lines = lines_of(F.col("text"))
    left = F.array_join(kept_lines(lines, F.col("toggles")), "\n")
    return met.select(
        "k",
        (F.regexp_count("text", F.lit("\n")) + 1).cast("long").alias("n_lines"),
        F.coalesce(n_dropped(F.col("toggles")), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("toggles").isNull(), F.col("text")).otherwise(left).alias("kept"),
    )


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = without_repeats(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.col("kept").cast("binary"), 256)
    return found.select(id_of("k").alias("doc_id"), "n_lines", "n_dropped", digest.alias("kept_sha256"))


OP13_SQL = rf"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i
  FROM documents
), keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{_UPPER}', '{_UPPER.lower()}') AS key
  FROM lines
), marked AS (
  SELECT *, length(key) >= {LEAST_CHARS} AND doc_id <> min(doc_id) OVER (PARTITION BY key) AS gone FROM keyed
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
