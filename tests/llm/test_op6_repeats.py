import hashlib
import random

import numpy as np
import pytest
from bloomledger.llm import repeats


def brute(docs):
    """(id, text) rows by id -> bytes, removed, runs, digest."""
    seen, out = set(), {}
    for doc, text in sorted(docs, key=lambda r: (-(2**63) if r[0] is None else r[0])):
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for at in range(len(data) - 99):
            string = data[at : at + 100]
            if string in seen:
                gone[at : at + 100] = True
            seen.add(string)
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        rest = bytes(np.frombuffer(data, np.uint8)[~gone])
        out[doc] = (len(data), int(gone.sum()), runs, hashlib.sha256(rest).hexdigest())
    return out


def found(frame):
    rows = repeats.remove_repeats(frame).collect()
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}


def mixed_docs(seed, n):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc \n") for _ in range(rng.randint(50, 500))) for _ in range(9)]
    docs = []
    for i in range(n):
        parts = []
        for _ in range(rng.randint(0, 4)):
            text = rng.choice(base)
            s = rng.randint(0, len(text))
            parts.append(text[s : rng.randint(s, len(text))])
            if rng.random() < 0.4:
                parts.append("".join(rng.choice("xyz é") for _ in range(rng.randint(0, 60))))
        docs.append((i * 3, "".join(parts)))
    return docs + [(-1, "a" * 400), (2000, "ab" * 250), (2001, None), (2002, ""), (2003, "a" * 99), (2004, "a" * 100), (None, "q" * 150)]


@pytest.mark.parametrize("block", [repeats.BLOCK_ROWS, 17])
def test_removal_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(repeats, "BLOCK_ROWS", block)
    docs = mixed_docs(block, 220)
    assert found(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)) == brute(docs)


def test_hot_passage_spans_buckets(spark):
    """One passage in every document, over more buckets than it has anchors."""
    rng = random.Random(8)
    passage = "".join(rng.choice("lorem ipsum") for _ in range(180))
    docs = [(i, "".join(rng.choice("abcdefgh ") for _ in range(40)) + passage + f" end {i}") for i in range(400)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    saved = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "40")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found(frame) == brute(docs)
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)


def test_multikey_order_equals_plain_sort(monkeypatch):
    monkeypatch.setattr(repeats, "SMALL_SORT", 8)
    rng = np.random.default_rng(3)
    tokens, groups = rng.integers(0, 4, (700, 5)).astype(np.uint64), np.sort(rng.integers(0, 9, 700))
    order = repeats.multikey_order(tokens, groups)
    rows = np.column_stack([groups.astype(np.uint64), tokens])[order]
    assert sorted(order) == list(range(700))
    assert [tuple(r) for r in rows] == sorted(tuple(r) for r in rows)


def test_anchors_are_the_same_in_every_copy():
    rng = np.random.default_rng(5)
    text = rng.integers(97, 101, 1000).astype(np.uint8)
    other = np.concatenate([rng.integers(97, 101, 333).astype(np.uint8), text[200:700]])
    one = repeats.anchors(text, np.array([0, 1000]))
    two = repeats.anchors(other, np.array([0, 833]))
    first = {(a, s) for a, lo, hi in zip(*one[2:]) for s in range(lo, hi + 1)}
    second = {(a - 133, s - 133) for a, lo, hi in zip(*two[2:]) for s in range(lo, hi + 1)}
    inside = {(a, s) for a, s in first if 200 <= s <= 600}
    assert inside == {(a + 0, s) for a, s in second if 200 <= s <= 600} and len(first) == 901


def test_very_long_text_is_read_in_steps(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(repeats, "_LONG_STEP", 1000)
    rng = random.Random(9)
    text = "".join(rng.choice("ab c") for _ in range(6000))
    docs = [(1, text + text[500:3000]), (2, "z" + text[100:4000])]
    assert found(spark.createDataFrame(docs, "doc_id long, text string")) == brute(docs)


def test_odd_rows(odd, empty):
    rows = repeats.remove_repeats(odd).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert by[5].n_removed == 200000 - 1 and by[1].n_bytes == 0 and by[6].n_removed == 0
    assert repeats.remove_repeats(empty).count() == 0


def brute_rows(docs):
    """Rows with null and repeated ids: each (id, text) a document, by id and digest of the text."""
    own = sorted(set(docs), key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    results = brute([(i, text) for i, (_, text) in enumerate(own)])
    by = {row: results[i] for i, row in enumerate(own)}
    return sorted(((i, *by[i, text]) for i, text in docs), key=str)


def test_rows_of_one_id_equal_brute_force(spark):
    docs = [(rng_id, text) for rng_id, (_, text) in zip([None, 3, 3, 7, 9, 5, None, 5] * 30, mixed_docs(23, 230))]
    docs = [(i, text or "") for i, text in docs]
    docs += docs[:20] + [(2, docs[5][1]), (2, "own words of a second text that has the id of a copy " * 4), (90, "x own words of a second text that has the id of a copy " * 4)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in repeats.remove_repeats(frame).collect()), key=str) == brute_rows(docs)


def test_query_on_given_documents(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.op6_suffix_dedup(spark, sf_dir).collect()}
    assert got == brute(docs)
