import hashlib
import random
import re

import pytest
from bloomledger.llm import mixing
from pyspark.sql import functions as F


def targets_by_rounds(sizes, weights=(1, 2, 3), most=3):
    """Water filling step by step: sources by code point, null last."""
    names = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    total, full = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = sum(weight[s] for s in names if s not in full)
        target = {s: most * sizes[s] if s in full else rest * weight[s] / open_ for s in names}
        over = {s for s in names if s not in full and target[s] > most * sizes[s]}
        if not over:
            return target
        full |= over


def test_targets_equal_step_by_step(spark):
    sizes = {"a": 1000, "b": 10, "c": 5, "Z": 300, "é": 77, None: 40, "zero": 0}
    rows = [(s, n) for s, total in sizes.items() for n in (total // 2, total - total // 2)]
    got = {r.source: r.target for r in mixing.source_targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    want = targets_by_rounds(sizes)
    assert got.keys() == want.keys() and all(got[s] == pytest.approx(want[s]) for s in want)
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def brute(docs):
    """(doc_id, source, size) rows -> copies, one source after the other, without slices."""
    sizes = {}
    for _, source, size in docs:
        sizes[source] = sizes.get(source, 0) + size
    out = {}
    for source, target in targets_by_rounds(sizes).items():
        own = [(d, n) for d, s, n in docs if s == source]
        whole = int(target // sizes[source]) if sizes[source] else 0
        rest = target - whole * sizes[source]
        for d, n in own:
            out[d] = whole if n else 0
        ranked = []
        for d, n in own:
            if n and rest > 0:
                u = (int(hashlib.md5(f"{mixing.SEED}:{d}".encode()).hexdigest()[:13], 16) + 0.5) / 16.0**13
                p = rest / sizes[source] * (0.5 + 0.5 * (n / (n + sizes[source] / len(own))))
                ranked.append(((u / (1 - u)) / (p / (1 - p)), d, n))
        words, left = 0, []
        for i, (q, d, n) in enumerate(sorted(ranked)):
            if words + n > rest:
                left = sorted(ranked)[i:]
                break
            words += n
            out[d] += 1
        best = min(((abs(n - (rest - words)), q, d) for q, d, n in left), default=None)
        if best and best[0] < rest - words:
            out[best[2]] += 1
    return out


@pytest.mark.parametrize("buckets", [4096, 3])
def test_mix_equals_brute_force(spark, sf_dir, buckets):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, F.lit("hot")).when(F.col("doc_id") % 7 != 1, F.col("source")))
    plain = [(r.doc_id, r.source, len(re.findall(r"[^\x20\x09-\x0D]+", r.text))) for r in docs.collect()]
    rows = mixing.pareto_mix(docs, buckets=buckets).collect()
    assert {r.doc_id: r.copies for r in rows} == brute(plain)
    assert all(r.taken == r.copies * r.size <= 3 * r.size for r in rows)


def test_sources_come_near_their_targets(spark):
    rows = mixing.pareto_mix(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    sums = rows.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect()
    assert len(sums) == 20 and all(abs(r.taken - r.target) <= 0.02 * r.target for r in sums)


def brute_rows(docs):
    """(doc_id, source, text) rows, ids repeated and null -> sorted (id, source, size, copies)."""
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, source, text in docs:
        sizes[source] = sizes.get(source, 0) + size(text)
    out = []
    for source, target in targets_by_rounds(sizes).items():
        own = [(d, t, size(t)) for d, s, t in docs if s == source]
        whole = int(target // sizes[source]) if sizes[source] else 0
        rest = target - whole * sizes[source]
        ranked = []
        for d, t, n in own:
            if n and rest > 0:
                name = "null" if d is None else d
                u = (int(hashlib.md5(f"{mixing.SEED}:{name}".encode()).hexdigest()[:13], 16) + 0.5) / 16.0**13
                p = rest / sizes[source] * (0.5 + 0.5 * (n / (n + sizes[source] / len(own))))
                ranked.append([(u / (1 - u)) / (p / (1 - p)), -(2**63) if d is None else d, hashlib.md5(t.encode()).hexdigest(), n, 0])
            else:
                out.append((d, source, n, whole if n else 0))
        words, ranked = 0, sorted(ranked)
        for row in ranked:
            if words + row[3] > rest:
                break
            words += row[3]
            row[4] = 1
        left = min(((abs(r[3] - (rest - words)), r[0], r[1], r[2], i) for i, r in enumerate(ranked) if not r[4]), default=None)
        if left and left[0] < rest - words:
            ranked[left[4]][4] = 1
        out += [(None if d == -(2**63) else d, source, n, whole + more) for _, d, _, n, more in ranked]
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [4096, 2])
def test_rows_of_one_id_equal_brute_force(spark, buckets):
    rng = random.Random(4)
    rows = [(rng.choice([None, None, i, 7, 8]), rng.choice(["a", "b", None]), " ".join(["w"] * rng.randrange(9)) + rng.choice(["", " x", " y"])) for i in range(400)]
    rows += [(None, "a", "same text of six words here")] * 60 + [(9, "b", "same text")] * 50 + [(3, "a", None)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(5)
    got = sorted(((r.doc_id, r.source, r.size, r.copies) for r in mixing.pareto_mix(docs, buckets=buckets).collect()), key=str)
    assert got == brute_rows(rows)


@pytest.mark.parametrize("texts", [1, 1000])
def test_hot_source_without_ids_meets_its_target(spark, texts):
    rows = [(None, f"ten words {i % texts} " + "w " * 7, "hot") for i in range(1000)] + [(i, "w " * 10, "other") for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    sums = mixing.pareto_mix(docs).groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.count("*").alias("n")).collect()
    assert len(sums) == 2 and all(abs(r.taken - r.target) <= 10 and r.n == 1000 for r in sums)


def test_odd_rows(odd, empty):
    rows = mixing.pareto_mix(odd).collect()
    assert len(rows) == odd.count()
    assert all(r.copies == 0 for r in rows if r.size == 0)
    assert {r.size for r in rows if r.doc_id in (1, 2, 3)} == {0}
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.pareto_mix(odd).collect()), key=str)
    assert mixing.pareto_mix(empty).count() == 0
    assert mixing.pareto_mix(odd.withColumn("text", F.lit(None).cast("string"))).agg(F.sum("copies")).first()[0] == 0
