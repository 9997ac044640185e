import hashlib
import random

import pytest
from bloomledger.llm import winnowing as wn
from pyspark.sql import functions as F

K, W = wn.K, wn.W


def hashes_of(spark, texts):
    """The 33 bits of each run's hash, signed, as Spark has them."""
    grams = sorted({t[j : j + K] for t in texts for j in range(max(1, len(t) - K + 1))})
    rows = spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.xxhash64(F.encode("g", "UTF-32")).alias("h"))
    return {r.g: r.h & (2**33 - 1) for r in rows.collect()}


def brute(text, hashes):
    if not text:
        return []
    runs = [hashes[text[j : j + K]] for j in range(max(1, len(text) - K + 1))]
    signed = [h - 2**33 if h >= 2**32 else h for h in runs]
    out = []
    for s in range(max(1, len(runs) - W + 1)):
        window = signed[s : s + W]
        at = s + max(j for j, v in enumerate(window) if v == min(window))
        if at not in out:
            out.append(at)
    return [(runs[p], p) for p in out]


def texts(seed):
    rng = random.Random(seed)
    lengths = [0, 1, 2, K - 1, K, K + 1, K + W - 2, K + W - 1, K + W, 92, 93, 94, 95, 120, 200, 700]
    out = ["".join(rng.choice("ab cé漢") for _ in range(rng.choice(lengths))) for _ in range(150)]
    return out + ["x" * 300, "ab" * 200, "é" * 10, ""]


@pytest.mark.parametrize("step", [wn.STEP, 50])
def test_fingerprints_equal_brute_force(spark, step):
    own = texts(1)
    frame = spark.createDataFrame(list(enumerate(own)), "i int, text string")
    got = {r.i: r.f for r in frame.select("i", wn.written(wn.packed_fingerprint(F.col("text"), step=step)).alias("f")).collect()}
    hashes = hashes_of(spark, own)
    for i, text in enumerate(own):
        assert got[i] == " ".join(f"{h:x}:{p}" for h, p in brute(text, hashes))


def test_shared_passages_share_a_hash(spark):
    rng = random.Random(2)
    letters = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = []
    for i in range(60):
        passage = letters(K + W - 1)
        rows.append((i, letters(rng.randrange(200)) + passage + letters(50), letters(rng.randrange(200)) + passage))
    frame = spark.createDataFrame(rows, "i int, a string, b string")
    shared = F.array_intersect(*(wn.gram_hashes(wn.packed_fingerprint(F.col(c))) for c in "ab"))
    assert frame.filter(F.size(shared) == 0).count() == 0


def expected(spark, docs):
    docs = sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    plain = [t or "" for _, t in docs]
    edited = []
    for i, text in enumerate(plain):
        half = len(text) // 2
        edited.append(text[: len(text) - half] + plain[(i + 1) % len(plain)][:half])
    hashes = hashes_of(spark, plain + edited)
    text_of = lambda f: " ".join(f"{h:x}:{p}" for h, p in f)

    def like(a, b):
        a, b = {h for h, _ in a}, {h for h, _ in b}
        return len(a & b) / len(a | b) if a | b else 1.0

    prints = [brute(t, hashes) for t in plain]
    out = []
    for i, (doc, _) in enumerate(docs):
        new = brute(edited[i], hashes)
        out.append((doc, len(plain[i]), hashlib.sha256(edited[i].encode()).hexdigest(), text_of(prints[i]), text_of(new),
                    like(prints[i], new), like(prints[i], prints[(i + 1) % len(docs)])))
    return sorted(map(str, out))


def run(spark, tmp_path, frame):
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    return sorted(str(tuple(r)) for r in wn.op9_winnowing(spark, str(tmp_path)).collect())


@pytest.mark.parametrize("cell_rows", [wn.CELL_ROWS, 3])
def test_query_equals_brute_force(spark, tmp_path, monkeypatch, cell_rows):
    monkeypatch.setattr(wn, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(wn.neighbours, "__defaults__", (cell_rows,))
    rng = random.Random(3)
    docs = [(d, t) for d, t in zip(rng.sample(range(-50, 10**6), 100) + list(range(54)), texts(4))]
    docs += [(None, "no id"), (10**15, "far away " * 20), (7 * 10**5, None)]
    assert run(spark, tmp_path, spark.createDataFrame(docs, "doc_id long, text string").repartition(4)) == expected(spark, docs)


def test_odd_rows(spark, tmp_path, odd, empty):
    small = odd.filter("doc_id is null or doc_id not in (4, 5)")
    docs = [(r.doc_id, r.text) for r in small.collect()]
    assert run(spark, tmp_path, small) == expected(spark, docs)


def test_long_and_empty_tables(spark, tmp_path, odd, empty):
    (tmp_path / "a").mkdir(), (tmp_path / "b").mkdir(), (tmp_path / "c").mkdir()
    assert run(spark, tmp_path / "a", empty) == []
    odd.write.parquet(str(tmp_path / "b" / "documents.parquet"))
    assert {r.n_chars for r in wn.op9_winnowing(spark, str(tmp_path / "b")).collect()} >= {150000, 200000, 0}
    one = spark.createDataFrame([(5, "only one text that is followed by itself, " * 4)], "doc_id long, text string")
    assert run(spark, tmp_path / "c", one) == expected(spark, [(5, "only one text that is followed by itself, " * 4)])


def test_no_python_in_the_plan(spark, sf_dir):
    plan = wn.op9_winnowing(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))
