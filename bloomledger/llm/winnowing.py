"""Document fingerprints by winnowing, in SQL functions only.

Every run of `K` code points has a hash.  Every window of `W` consecutive hashes selects its
least one, the rightmost if several are equal; the fingerprint is the set of selected hashes
with their positions.  So any passage of W + K - 1 code points that two texts share has a
selected hash in both.

A text is hashed in steps of `STEP` windows, so work arrays stay small however long it is.
A hash and its position share one long (33 bits of hash, then the position counted down), so
that the least value of a window is the rightmost least hash, and window minima come from
five rounds of pairwise minima over growing distances.

Texts with fewer than K code points have themselves as the one run, those with fewer than W
runs have one window; null and empty texts have an empty fingerprint.  Two empty fingerprints
are alike (1), an empty and another are not (0).

`neighbours` puts each row beside the next by doc_id (after the last comes the first).  Rows
are grouped by ranges of ids of about `CELL_ROWS` rows, and the first row of a range is also
sent to the range before.  Null ids come first; rows with equal ids follow each other in the
order of their texts.  An empty table gives an empty result.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from bloomledger.llm.common import settle, table, with_small

K = 16
W = 32
STEP = 8192
CELL_ROWS = 200

_POSITION_BITS = 31
_TOP = 2**_POSITION_BITS - 1


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _doubled(values: Column, distance: int) -> Column:
    """At each place the least of the value there and the one `distance` further on."""
    return _let(values, lambda v: F.zip_with(v, F.slice(v, distance + 1, F.size(v)), lambda a, b: F.least(a, b)))


def packed_fingerprint(text: Column, k: int = K, w: int = W, step: int = STEP, short: bool = True) -> Column:
    """Selected hashes of a text with their positions, packed, in text order.

    A text too short for a window has one of what it has, or none if not `short`.
    """
    if w & (w - 1):
        raise ValueError("the window must be a power of two")
    empty = F.array().cast("array<bigint>")
    points = F.encode(F.coalesce(text, F.lit("")), "UTF-32")

    def select(points: Column) -> Column:
        n_chars = F.octet_length(points) / 4
        grams = F.greatest(n_chars - (k - 1), F.lit(1)).cast("int")
        return F.when(n_chars > 0, _let(grams, lambda grams: steps(points, grams))).otherwise(empty)

    def steps(points: Column, grams: Column) -> Column:
        windows = F.greatest(grams - (w - 1), F.lit(1 if short else 0))
        starts = F.sequence(F.lit(0), F.greatest(windows, F.lit(1)) - 1, F.lit(step))
        found = F.array_distinct(F.flatten(F.transform(starts, lambda start: one_step(points, grams, windows, start))))
        return found if short else F.when(windows > 0, found).otherwise(empty)

    def one_step(points: Column, grams: Column, windows: Column, start: Column) -> Column:
        last = F.least(start + (step + w - 2), grams - 1)

        def value(i: Column) -> Column:
            gram = F.substring(points, i * 4 + 1, F.lit(4 * k))
            return F.shiftleft(F.xxhash64(gram), _POSITION_BITS) + (F.lit(_TOP) - i).cast("long")

        least = F.transform(F.sequence(start, last), value)
        distance = 1
        while distance < w:
            least = _doubled(least, distance)
            distance *= 2
        return F.array_distinct(F.slice(least, 1, F.least(F.lit(step), windows - start)))

    return _let(points, select)


def _position(v: Column) -> Column:
    return F.lit(_TOP) - v.bitwiseAND(F.lit(_TOP))


def of_beginning(packed: Column, n_chars: Column, k: int = K, w: int = W) -> Column:
    """What the windows inside a text's first `n_chars` code points select, from its fingerprint.

    A selected hash is first chosen by the window that ends with it if it is less than the one
    selected before it, and else by the window after that one's place.
    """
    windows = n_chars - (k + w - 2)

    def chosen(v: Column, i: Column) -> Column:
        before = F.get(packed, i - 1)
        first = F.when(i == 0, F.lit(0)).when(v < before, _position(v) - (w - 1)).otherwise(_position(before) + 1)
        return first < windows

    return F.filter(packed, chosen)


def moved(packed: Column, distance: Column) -> Column:
    """A fingerprint with all positions `distance` further on."""
    return F.transform(packed, lambda v: v - distance.cast("long"))


def joined_fingerprint(
    packed: Column, kept: Column, next_packed: Column, given: Column, text: Column, k: int = K, w: int = W
) -> Column:
    """The fingerprint of `text`, made of the first `kept` code points of one text and the
    first `given` of another, from the fingerprints of these: only the windows that span the
    seam are hashed."""
    around = k + w - 2
    start = F.greatest(kept - around, F.lit(0))
    seam = packed_fingerprint(F.substring(text, start + 1, kept + around - start), k, w, short=False)
    parts = F.concat(
        of_beginning(packed, kept, k, w),
        _let(start, lambda start: moved(seam, start)),
        moved(of_beginning(next_packed, given, k, w), kept),
    )
    return F.when(kept + given <= around, packed_fingerprint(text, k, w)).otherwise(F.array_distinct(parts))


def gram_hashes(packed: Column) -> Column:
    """The distinct hashes of a fingerprint."""
    return F.array_distinct(F.transform(packed, lambda v: F.shiftrightunsigned(v, _POSITION_BITS)))


def written(packed: Column) -> Column:
    """A fingerprint as text: hash:position of each selected run, hashes in hexadecimal."""

    def entry(v: Column) -> Column:
        return F.concat_ws(":", F.lower(F.hex(F.shiftrightunsigned(v, _POSITION_BITS))), _position(v).cast("string"))

    return F.array_join(F.transform(packed, entry), " ")


def likeness(one: Column, other: Column) -> Column:
    """Jaccard similarity of two sets of hashes."""
    either = F.size(F.array_union(one, other))
    return F.when(either > 0, F.size(F.array_intersect(one, other)) / either).otherwise(F.lit(1.0))


def neighbours(docs: DataFrame, columns: list[Column], cell_rows: int = CELL_ROWS) -> DataFrame:
    """doc_id, text, the columns, and each of these as next_* of the row that follows."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    extent = docs.agg(F.count("*"), F.min("doc_id").cast("double"), F.max("doc_id").cast("double")).first()
    low = extent[1] or 0.0
    width = max(((extent[2] or 0.0) - low + 1) * cell_rows / max(extent[0], 1), 1.0)
    cell = F.coalesce(F.floor((F.col("doc_id").cast("double") - low) / width), F.lit(-1)).cast("long")
    docs = docs.withColumn("cell", cell)
    cells = _with_range_before(docs.groupBy("cell").agg(F.min("doc_id").alias("first_id")))
    rows = with_small(docs, cells, docs["cell"] == cells["own_cell"])
    guest = F.when(
        F.col("doc_id").eqNullSafe(F.col("first_id")),
        F.array(F.struct(F.col("cell_before").alias("cell"), F.lit(True).alias("guest"))),
    ).otherwise(F.array().cast("array<struct<cell:bigint,guest:boolean>>"))
    home = F.array(F.struct(F.col("cell"), F.lit(False).alias("guest")))
    rows = rows.select("doc_id", "text", F.explode(F.concat(home, guest)).alias("at"))
    # One shuffle, by range; what is derived from the text is derived after it.
    rows = rows.select("doc_id", "text", "at.cell", "at.guest").repartition("cell").select("*", *columns)
    order = Window.partitionBy("cell").orderBy("guest", "doc_id", "text")
    given = [c for c in rows.columns if c not in ("doc_id", "cell", "guest")]
    rows = rows.select("*", *(F.lead(c).over(order).alias(f"next_{c}") for c in given))
    return rows.filter(~F.col("guest")).drop("cell", "guest")


def _with_range_before(cells: DataFrame, block: int = 10_000) -> DataFrame:
    """own_cell, first_id and the range of ids before, for the first range the last one.

    Ranges are put in order within blocks of them, and only blocks, a 10,000th of them, in
    one place.
    """
    cells = settle(cells.withColumn("block", F.floor(F.col("cell") / block)))
    blocks = cells.groupBy("block").agg(F.max("cell").alias("last_cell"))
    in_order, everything = Window.orderBy("block"), Window.partitionBy()
    last_before = F.coalesce(F.lag("last_cell").over(in_order), F.max("last_cell").over(everything))
    blocks = settle(blocks.select(F.col("block").alias("own_block"), last_before.alias("last_before")))
    inside = Window.partitionBy("block").orderBy("cell")
    cells = with_small(cells.withColumn("before", F.lag("cell").over(inside)), blocks, F.col("block") == F.col("own_block"))
    before = F.coalesce("before", "last_before").alias("cell_before")
    return settle(cells.select(F.col("cell").alias("own_cell"), "first_id", before))


def edited_text(text: Column, next_text: Column) -> Column:
    """The text with its last half replaced by as much of the next text's beginning."""
    half = F.floor(F.length(text) / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - half), F.substring(next_text, F.lit(1), half))


def op9_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packed_fingerprint(F.col("text")).alias("packed")
    rows = neighbours(table(spark, sf_dir, "documents"), [packed])
    half = F.floor(F.length("text") / 2).cast("int")
    rows = rows.select(
        "doc_id",
        F.length("text").alias("n_chars"),
        "packed",
        "next_packed",
        (F.length("text") - half).alias("kept"),
        F.least(half, F.length("next_text")).alias("given"),
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    )
    joined = joined_fingerprint(*map(F.col, ("packed", "kept", "next_packed", "given", "edited")))
    rows = rows.withColumn("edited_packed", joined)
    rows = rows.withColumn("hashes", gram_hashes(F.col("packed")))
    return rows.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        written(F.col("packed")).alias("fingerprint"),
        written(F.col("edited_packed")).alias("edited_fingerprint"),
        likeness(F.col("hashes"), gram_hashes(F.col("edited_packed"))).alias("near_edited"),
        likeness(F.col("hashes"), gram_hashes(F.col("next_packed"))).alias("near_next"),
    )
