import inspect
import re

import corpus_pipeline
import pytest
import xxhash
from bloomledger.llm import language_id, mixing, sharding, stages
from brute_near import components
from test_op2_mixing import brute as brute_mix


def test_stages():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["keep_languages", "drop_near_copies", "drop_leaks", "mix_sources", "assign_shards"]
    for _, stage in corpus_pipeline.STAGES:
        assert list(inspect.signature(stage).parameters) == ["spark", "docs", "sf_dir"]


def test_pipeline_equals_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.learn(documents)
    docs = {r.doc_id: r for r in documents.collect()}
    names, sure = language_id.Scorer(model).predict([r.text for r in docs.values()])
    docs = {d: r for (d, r), name, s in zip(docs.items(), names, sure) if name != "und" and s >= 0.5}
    groups = components({d: r.text for d, r in docs.items()}, 80)
    docs = {d: r for d, r in docs.items() if groups[d] == d}
    flat = lambda t: " ".join(t.lower().split())
    items = [flat(r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    # 50 comparable characters of an item in a row, or the whole of a shorter one, are a leak.
    leaks = [i[a : a + 50] for i in items for a in range(0, max(1, len(i) - 49))]
    leaking = {d for d, r in docs.items() if any(p in flat(r.text) for p in leaks)}
    docs = {d: r for d, r in docs.items() if d not in leaking}
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    copies = brute_mix([(d, r.source, size(r.text)) for d, r in docs.items()])
    owners = sharding.fill_table(sharding.SHARDS)
    want = []
    for d, r in docs.items():
        h = xxhash.xxh64(str(d).encode(), seed=42).intdigest()
        shard = sharding.SHARDS[owners[(h - 2**64 if h >= 2**63 else h) % sharding.TABLE_SIZE]]
        want += [(*r, shard)] * copies[d]
    got = corpus_pipeline.run(spark, sf_dir)
    assert got.columns == [*documents.columns, "shard"]
    assert sorted(map(tuple, got.collect())) == sorted(want) and len(leaking) > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows(spark, sf_dir, odd, empty, name, stage):
    out = stage(spark, odd, sf_dir)
    if name != "assign_shards":
        assert out.columns == odd.columns and [t for _, t in out.dtypes] == [t for _, t in odd.dtypes]
    out.collect()
    assert stage(spark, empty, sf_dir).count() == 0


def test_one_document_of_each_group_stays(spark, sf_dir):
    rows = [(1, "one two three four five six"), (2, "ONE two three four five six"), (3, "other words are here now ok"), (3, "other words are here now ok"), (4, None), (5, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = stages.drop_near_copies(spark, docs, sf_dir).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3, 4, 5]


def test_rows_of_one_id_are_judged_by_their_own_text(spark, sf_dir):
    leak = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first().text
    texts = ["first clean text of some seven words", "another clean one with quite other words", "FIRST clean text of some seven words"]
    rows = [(i, t) for i in (None, 3) for t in (f"{i} {texts[0]}", f"{i} {texts[1]}", f"{i} {texts[2]}", f"{i} {texts[1]}", f"{i} before {leak} behind {' '.join(f'{i}w{j}' for j in range(20))}")]
    rows += [(4, f"None {texts[1]}"), (None, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    lower = lambda out: sorted((r.doc_id or 0, (r.text or "").lower()) for r in out.collect())
    clean = [(i or 0, f"{i} {t}".lower()) for i in (None, 3) for t in texts[:2]] + [(0, ""), (0, "")]
    leaks = [(r[0] or 0, r[1].lower()) for r in rows if leak in (r[1] or "")]  # their similarity is below the threshold
    assert lower(stages.drop_near_copies(spark, docs, sf_dir)) == sorted(clean + leaks)
    assert lower(stages.drop_leaks(spark, docs, sf_dir)) == sorted((r[0] or 0, (r[1] or "").lower()) for r in rows if leak not in (r[1] or ""))


def test_mix_repeats_documents(spark, sf_dir):
    rows = [(i, f"w{i} " * 10, "a" if i < 9 else "b") for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = stages.mix_sources(spark, docs, sf_dir)
    n = {r.source: r["count"] for r in mixed.groupBy("source").count().collect()}
    assert n["a"] == 27 and n["b"] == 63  # a stops at three times its size


def test_mix_of_rows_without_ids(spark, sf_dir):
    rows = [(None, f"ten words of one more text number {i} are here", "a", i) for i in range(300)]
    rows += [(None, "one and the same text of ten words in it", "a", i) for i in range(200)] + [(i, "w " * 10, "b", i) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra int").repartition(4)
    mixed = stages.mix_sources(spark, docs, sf_dir)
    words = {r.source: r["count"] * 10 for r in mixed.groupBy("source").count().collect()}
    targets = {r.source: r.target for r in mixing.source_targets(docs.selectExpr("source", "10L AS size")).collect()}
    assert all(abs(words[s] - targets[s]) <= 10 for s in "ab")
    assert sorted(map(tuple, mixed.collect()), key=str) == sorted(map(tuple, stages.mix_sources(spark, docs, sf_dir).collect()), key=str)


def test_registered(spark):
    import __spark_entry__ as entry

    names = set(entry.queries())
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and "op2_pareto_mix" in entry.oracle_sql()
