import hashlib
import random
from collections import defaultdict

import pytest
from bloomledger.llm import lines as ln

BLANKS = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows):
    """(id, lines, dropped lines, digest of the rest) of each (id, text); a null id is the smallest."""
    order = lambda i: (i is not None, i or 0)
    keys = lambda t: [line.strip(BLANKS).translate(LOWER) for line in (t or "").split("\n")]
    holders = defaultdict(set)
    for i, text in rows:
        for key in keys(text):
            holders[key].add(order(i))
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x, key in zip(lines, keys(text)) if len(key) < 10 or min(holders[key]) == order(i)]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def found(docs, **how):
    from pyspark.sql import functions as F

    rows = ln.without_repeats(docs, **how).select(ln.id_of("k"), "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256))
    return sorted(map(tuple, rows.collect()), key=str)


@pytest.mark.parametrize("hot_share", [20_000, 30, 1])
def test_equals_brute_force(spark, hot_share):
    rng = random.Random(3)
    pool = ["a common line of text", " A Common Line OF text\t", "short", "", "ÄRGER über alles", "ärger über alles", "ten chars!", "nine char", "x" * 500, "\x0b tail \x0c end \r"]
    rows = []
    for i in range(120):
        lines = [rng.choice(pool) if rng.random() < 0.6 else f"line {rng.randrange(60)} of some text" for _ in range(rng.randrange(12))]
        rows.append((rng.choice([None, i, i, i, 5]), "\n".join(lines)))
    rows += [(None, None), (7, ""), (8, "\n"), (8, "\n"), (9, "a common line of text\n" * 40)]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(docs, hot_share=hot_share) == brute(rows)


def test_odd_rows(spark, odd, empty):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert ln.without_repeats(empty).count() == 0


def test_bitmaps(spark):
    rows = [(1, "kept line number one\nkept line number two"), (2, "own line number one!\nkept line number one\nKEPT line number two \nb\nkept line number one\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [(r.k, r.toggles) for r in ln.keep_bitmaps(docs).collect()] == [(2, [1, 3, 4, 5])]


def test_long_text(spark):
    many = "\n".join(f"line number {i % 30011} of it" for i in range(60_000))
    rows = [(1, many), (2, many + "\nan own last line"), (3, "\n".join(f"line number {i} of it" if i % 2 else f"new {i} line here" for i in range(30_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert found(docs) == brute(rows)


def test_query_reads_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, ln.op13_line_dedup(spark, sf_dir).collect()), key=str)
    assert got == brute(rows) and sum(r[2] for r in got) > 0


def test_no_python_on_the_main_path(spark, sf_dir, capsys):
    ln.op13_line_dedup(spark, sf_dir).explain("formatted")
    plan = capsys.readouterr().out
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
