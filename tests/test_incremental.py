"""Candidates and decisions of an earlier run, brought up to date."""

import random

import numpy as np
import pyarrow as pa
import pytest
from bloomledger.operators.adjudication import MatchRules, adjudicate
from bloomledger.operators.similarity import _best_of_cell, top_k
from bloomledger.plans import incremental as inc
from bloomledger.plans import matching as mt
from bloomledger.sinks.vector_store import publish, published, vectors_of
from pyspark.sql import functions as F

WORDS = ["rose", "lily", "red", "white", "garden", "spray", "mini", "freedom", "mondial", "iris", "pink", "tulip", "king", "queen"]


def _names(rng, n):
    return sorted({" ".join(rng.sample(WORDS, rng.choice([2, 3, 4]))) for _ in range(n)})


def _frame(spark, names, column="name"):
    return spark.createDataFrame([(n,) for n in names], f"{column} string")


def _rows(frame):
    return sorted(tuple(r) for r in frame.select("query_name", "candidate_name", "score", "rank").collect())


@pytest.mark.parametrize("seed, k", [(1, 3), (2, 10), (3, 1)])
def test_refresh_equals_a_full_run(spark, seed, k):
    rng = random.Random(seed)
    names = _names(rng, 160)
    old_q, new_q = names[:60], names[20:80]
    old_c, new_c = names[60:140], names[60:90] + names[110:160]
    vectors = {key: mt.vectorise(_frame(spark, some), "name") for key, some in (("oq", old_q), ("oc", old_c), ("q", new_q), ("c", new_c))}
    found = mt.candidates(vectors["oq"], vectors["oc"], k)
    got = inc.refresh_candidates(found, _frame(spark, old_q), _frame(spark, old_c), vectors["q"], vectors["c"], k)
    assert _rows(got) == _rows(mt.candidates(vectors["q"], vectors["c"], k))


def test_refresh_from_and_to_nothing(spark):
    some, none = _frame(spark, ["red rose", "white lily"]), _frame(spark, [])
    v = lambda names: mt.vectorise(names, "name")
    full = mt.candidates(v(some), v(some))
    empty = full.limit(0)
    assert _rows(inc.refresh_candidates(empty, none, none, v(some), v(some))) == _rows(full)
    assert _rows(inc.refresh_candidates(empty, some, none, v(some), v(some))) == _rows(full)  # the catalog was empty
    assert _rows(inc.refresh_candidates(full, some, some, v(none), v(some))) == []
    assert _rows(inc.refresh_candidates(full, some, some, v(some), v(none))) == []


def test_only_changed_questions_are_decided(spark):
    rng = random.Random(5)
    names, catalog = _names(rng, 40), _names(rng, 60)
    found = mt.candidates(mt.vectorise(_frame(spark, names), "name"), mt.vectorise(_frame(spark, catalog), "name"), 4)
    asked_names = []

    def decide(rows):
        asked_names.append(sorted({r.query_name for r in rows.select("query_name").collect()}))
        return adjudicate(rows, MatchRules())

    none = spark.createDataFrame([], "digest string, matched_name string")
    asked, new = inc.decide_new(found, none, decide=decide)
    known = spark.createDataFrame(new.collect(), new.schema)
    want = sorted(map(tuple, adjudicate(found).collect()))
    assert sorted(map(tuple, inc.answered(asked, known).collect())) == want
    changed = names[3]
    later = found.filter((F.col("query_name") != changed) | (F.col("rank") < 3))
    asked, new = inc.decide_new(later, known, decide=decide)
    got = inc.answered(asked, known.unionByName(new))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, adjudicate(later).collect()))
    assert asked_names == [names, [changed]]
    other = MatchRules(min_overlap=0.9)
    asked, new = inc.decide_new(later, known, other)
    assert inc.undecided(later, asked, known).select("query_name").distinct().count() == len(names)  # other rules
    assert sorted(map(tuple, inc.answered(asked, new).collect())) == sorted(map(tuple, adjudicate(later, other).collect()))


def test_published_tables(spark, tmp_path):
    path, one = str(tmp_path / "state"), _frame(spark, ["a"])
    assert published(spark, path, "v1", ["t"]) is None
    publish({"t": one}, path, "v1")
    broken = one.select(F.raise_error(F.lit("lost")).cast("string").alias("name"))
    with pytest.raises(Exception, match="lost"):
        publish({"t": broken}, path, "v1")
    assert published(spark, path, "v1", ["t"])["t"].collect() == one.collect()
    assert published(spark, path, "v2", ["t"]) is None


def test_vectors_are_computed_once_for_all_days(spark, tmp_path):
    root = str(tmp_path)
    first = vectors_of(_frame(spark, ["a", "b"], "product_name"), root, "v1")
    assert first.count() == 2
    marked = lambda c: F.transform(mt.trigram_vector(c), lambda x: x + 100)
    again = {r.name: max(r.vector) for r in vectors_of(_frame(spark, ["b", "c"], "product_name"), root, "v1", vectoriser=marked).collect()}
    assert again["b"] < 100 <= again["c"]
    assert all(max(r.vector) >= 100 for r in vectors_of(_frame(spark, ["a"], "product_name"), root, "v2", vectoriser=marked).collect())


def test_second_matching_run_does_only_what_is_new(spark, tmp_path):
    from bloomledger.plans.matching_run import run_matching

    def csv(rows):
        (tmp_path / "shop.csv").write_text("product_name,competitor_product_id\n" + "".join(f"{n},{i}\n" for n, i in rows))

    mart = str(tmp_path / "mart")

    def items(keys):
        spark.createDataFrame([(v, "g1") for v in keys], "variety string, product_group string").write.mode("overwrite").parquet(f"{mart}/cart_box_item")

    spark.createDataFrame([(f"v{i}", n, "c1", "g1") for i, n in enumerate(["Freedom", "Mondial", "Tibet"])], "_KEY string, variety_name string, color string, product_group string").write.parquet(f"{mart}/variety")
    spark.createDataFrame([("g1", "Roses")], "_KEY string, common_name string").write.parquet(f"{mart}/product_group")
    spark.createDataFrame([("c1", "Red")], "_KEY string, color_name string").write.parquet(f"{mart}/color")
    asked = []

    def decide(rows):
        asked.append(sorted({r.query_name for r in rows.select("query_name").collect()}))
        return adjudicate(rows)

    def run(day, folder="out", **more):
        matches, _ = run_matching(spark, str(tmp_path / "shop.csv"), mart, str(tmp_path / folder), day, decide=decide, **more)
        return sorted(map(tuple, matches.collect()))

    csv([("Freedom Red Roses", 1), ("Mondial White Roses", 2)])
    items(["v0", "v1"])
    run("2024-02-01")
    assert run("2024-02-02") == run("2024-02-02", "fresh")
    assert asked == [["Freedom Red Roses", "Mondial White Roses"], [], ["Freedom Red Roses", "Mondial White Roses"]]
    csv([("Freedom Red Roses", 1), ("Tibet Rose", 3)])
    items(["v0", "v2"])  # one variety came, one went
    assert run("2024-02-03") == run("2024-02-03", "another")
    assert asked[3] == asked[4] == ["Freedom Red Roses", "Tibet Rose"]  # the candidates of both changed
    mapping = spark.createDataFrame([("1", "v0")], "competitor_product_id string, variety_key string")
    assert [r[0] for r in run("2024-02-04", mapping=mapping)] == ["3"]
    assert asked[5] == []


# --- inverted lists -----------------------------------------------------------------


def _table(rows, key, length):
    used = [np.flatnonzero(r) for r in rows]
    return pa.table({
        key: list(range(len(rows))),
        "length": [length] * len(rows),
        "slots": [u.tolist() for u in used],
        "values": [rows[i][u].tolist() for i, u in enumerate(used)],
    })


def _brute(queries, catalog, k):
    norms = np.linalg.norm(queries, axis=1)[:, None] * np.linalg.norm(catalog, axis=1)[None]
    scores = np.round(np.divide(queries @ catalog.T, norms, out=np.zeros_like(norms), where=norms > 0), 9)
    return {(q, int(c), float(scores[q, c])) for q in range(len(queries)) for c in np.lexsort((np.arange(len(catalog)), -scores[q]))[:k]}


def _sparse(rng, n, length, used):
    rows = np.zeros((n, length))
    for row in rows:
        # Slots of names are uneven: some trigrams are in most names.
        at = np.unique((rng.random(used) ** 2 * length).astype(int))
        row[at] = rng.integers(1, 4, len(at))
    return rows


@pytest.mark.parametrize("n, length, used, k", [(400, 256, 20, 10), (60, 64, 3, 10), (5, 64, 2, 10), (300, 128, 1, 3)])
def test_inverted_lists_equal_the_grid(n, length, used, k):
    rng = np.random.default_rng(n)
    catalog = _sparse(rng, n, length, used)
    catalog[n // 2] = catalog[0]
    catalog[-1] = 0
    queries = np.concatenate([_sparse(rng, 30, length, used), catalog[:5], np.zeros((1, length))])
    counted = []
    found = _best_of_cell(k, counted)(_table(queries, "query_id", length), _table(catalog, "catalog_id", length))
    got = {(q, c, s) for q, c, s in zip(*(found[x].to_pylist() for x in ("query_id", "catalog_id", "score")))}
    assert got == _brute(queries, catalog, k) and found.num_rows == len(queries) * min(k, n)


def test_products_stay_well_below_the_grid():
    rng = np.random.default_rng(8)
    catalog = _sparse(rng, 3000, 256, 20)
    queries = catalog[rng.integers(0, 3000, 100)] + (rng.random((100, 256)) < 0.01)
    counted = []
    _best_of_cell(10, counted)(_table(queries, "query_id", 256), _table(catalog, "catalog_id", 256))
    assert sum(counted) < 0.02 * 100 * 3000 * 256



def test_dense_and_signed_vectors_take_the_grid():
    rng = np.random.default_rng(9)
    for catalog in (rng.random((50, 16)), rng.integers(-1, 2, (50, 64)) * (rng.random((50, 64)) < 0.1) * 1.0):
        counted = []
        found = _best_of_cell(5, counted)(_table(catalog, "query_id", catalog.shape[1]), _table(catalog, "catalog_id", catalog.shape[1]))
        assert sum(counted) == 50 * 50 * catalog.shape[1]
        assert {(q, c, s) for q, c, s in zip(*(found[x].to_pylist() for x in ("query_id", "catalog_id", "score")))} == _brute(catalog * 1.0, catalog * 1.0, 5)


def test_cells_are_sized_by_slots(spark, monkeypatch):
    from bloomledger.operators import similarity

    rng = np.random.default_rng(4)
    rows = [(i, rng.random(1536).tolist()) for i in range(40)]
    queries = spark.createDataFrame(rows, "query_id bigint, query_vector array<float>")
    catalog = spark.createDataFrame(rows, "catalog_id bigint, catalog_vector array<float>")
    whole = sorted(map(tuple, top_k(queries, catalog, 3).collect()))
    monkeypatch.setattr(similarity, "CELL_VALUES", 10 * 1536)
    monkeypatch.setattr(similarity, "CELL_PRODUCTS", 1000)
    frame = top_k(queries, catalog, 3)
    assert sorted(map(tuple, frame.collect())) == whole
