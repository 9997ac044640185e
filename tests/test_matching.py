import numpy as np
import pytest
from bloomledger.functions.vectors import cosine, trigram_vector
from bloomledger.operators.adjudication import MatchRules, adjudicate, name_words
from bloomledger.operators.similarity import top_k
from bloomledger.plans import matching as mt
from pyspark.sql import functions as F


def _brute_force(queries, catalog, k):
    want = set()
    for qid, q in queries:
        scored = []
        for cid, c in catalog:
            norm = np.linalg.norm(q) * np.linalg.norm(c)
            scored.append((-round(float(np.dot(q, c) / norm), 9) + 0.0 if norm else 0.0, cid))
        for rank, (score, cid) in enumerate(sorted(scored)[:k], 1):
            want.add((qid, cid, rank))
    return want


@pytest.mark.parametrize("block_rows, chunk_rows", [(1000, 1000), (17, 11), (1, 40)])
def test_top_k_equals_brute_force(spark, block_rows, chunk_rows):
    rng = np.random.default_rng(3)
    queries = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(40)]
    catalog = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(60)]
    catalog += [(100 + i, catalog[5][1]) for i in range(30)]  # a third are copies
    catalog.append((999, [0.0] * 8))
    got = top_k(
        spark.createDataFrame(queries, "query_id bigint, query_vector array<float>"),
        spark.createDataFrame(catalog, "catalog_id bigint, catalog_vector array<float>"),
        k=10, block_rows=block_rows, chunk_rows=chunk_rows,
    ).collect()
    assert {(r["query_id"], r["catalog_id"], r["rank"]) for r in got} == _brute_force(queries, catalog, 10)
    assert len(got) == 40 * 10


def test_top_k_small_catalog(spark):
    one = spark.createDataFrame([("a", [1.0, 0.0]), ("b", None)], "query_id string, query_vector array<float>")
    two = spark.createDataFrame([("x", [1.0, 1.0]), ("y", [0.0, 0.0]), ("z", [2.0, 0.0])], "catalog_id string, catalog_vector array<float>")
    got = sorted((r["rank"], r["catalog_id"], r["score"]) for r in top_k(one, two, k=10).collect())
    assert got == [(1, "z", 1.0), (2, "x", round(0.5 ** 0.5, 9)), (3, "y", 0.0)]


def test_cosine(spark):
    frame = spark.createDataFrame([([1.0, 2.0], [2.0, 4.0]), ([1.0, 0.0], [0.0, 1.0]), ([0.0, 0.0], [1.0, 1.0])], "a array<float>, b array<float>")
    assert [round(r[0], 9) for r in frame.select(cosine(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, 0.0]


def test_trigram_vector(apply):
    same = apply(lambda c: trigram_vector(c, 64), ["Red  Rose", "red rose", "", None, "a"])
    assert same[0] == same[1] and sum(same[0]) == 8
    assert sum(same[2]) == 0 and same[3] is None and sum(same[4]) == 1


def test_name_words(apply):
    assert apply(name_words, ["Telstar Irises Bushes boxes glasses branches crocuses"]) == [["telstar", "iris", "bush", "box", "glass", "branch", "crocus"]]
    assert apply(name_words, ["Garden ROSES, roses daisies iris glass", ""]) == [["garden", "rose", "daisy", "iris", "glass"], []]


@pytest.mark.parametrize("query, candidates, want", [
    ("Rose Freedom Red ", ["Mondial White Roses", "Freedom Red Roses"], "Freedom Red Roses"),
    ("White Mondial Rose", ["Mondial Cream Roses"], "Mondial Cream Roses"),
    ("Patience Rose", ["Patience Garden Roses"], "Null"),
    ("Patience GARDEN Rose", ["Patience Garden Roses"], "Patience Garden Roses"),
    ("Red Rose", ["Red Roses", "Freedom Red Roses"], "Null"),
    ("Freedom Carnation", ["Freedom Red Roses"], "Null"),
    ("Telstar Irises", ["Telstar Iris"], "Telstar Iris"),
    ("Freedom Sunrise Rose Super Extra", ["Freedom Roses"], "Null"),
])
def test_adjudication_rules(spark, query, candidates, want):
    rows = [(query, c, 1.0 - i / 10, i + 1) for i, c in enumerate(candidates)]
    frame = spark.createDataFrame(rows, "query_name string, candidate_name string, score double, rank int")
    assert [tuple(r) for r in adjudicate(frame).collect()] == [(query, want)]


def test_match_products_keeps_every_row(spark):
    catalog = spark.createDataFrame([("Freedom Red Roses", "k1"), ("Freedom Red Roses", "k2"), ("Mondial White Roses", "k3")], "product_name string, variety string")
    products = spark.createDataFrame([("1", "Rose Freedom Red"), ("2", "Rose Freedom Red"), ("2", "Rose Freedom Red"), ("3", "Red"), ("4", None)], "competitor_product_id string, product_name string")
    got = sorted((r["competitor_product_id"], r["matched_name"], r["variety_key"]) for r in mt.match_products(products, catalog, MatchRules()).collect())
    assert got == [("1", "Freedom Red Roses", "k2"), ("2", "Freedom Red Roses", "k2"), ("2", "Freedom Red Roses", "k2"), ("3", "Null", "Null"), ("4", "Null", "Null")]


def test_grid_function_needs_no_package_on_the_executors(tmp_path):
    import subprocess
    import sys

    from bloomledger.operators.similarity import _best_of_cell
    from pyspark import cloudpickle

    (tmp_path / "f.pkl").write_bytes(cloudpickle.dumps(_best_of_cell(3)))
    code = (
        "import pickle, pyarrow as pa; f = pickle.load(open('f.pkl', 'rb'));"
        "t = pa.table({'query_id': [1], 'length': [2], 'slots': [[0]], 'values': [[1.0]]});"
        "c = pa.table({'catalog_id': [7, 8], 'length': [2, 2], 'slots': [[0, 1], [0]], 'values': [[1.0, 1.0], [1.0]]});"
        "print(f(t, c).sort_by([('score', 'descending')])['catalog_id'].to_pylist())"
    )
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert out.stdout.strip().splitlines()[-1] == "[8, 7]", out.stderr


def test_top_k_rejects_other_lengths(spark):
    queries = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0, 3.0, 4.0])], "query_id bigint, query_vector array<float>")
    catalog = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "catalog_id bigint, catalog_vector array<float>")
    with pytest.raises(Exception, match="vectors must have one length"):
        top_k(queries, catalog).collect()


def test_top_k_runs_nothing_while_it_is_built(spark):
    @F.udf("array<float>")
    def fail(i):
        raise RuntimeError("run too early")

    rows = spark.range(3)
    top_k(rows.select(F.col("id").alias("query_id"), fail("id").alias("query_vector")),
          rows.select(F.col("id").alias("catalog_id"), fail("id").alias("catalog_vector")))


def test_matching_run(spark, tmp_path):
    from bloomledger.plans.matching_run import run_matching

    (tmp_path / "shop.csv").write_text("product_name,competitor_product_id\nFreedom Red Roses,1\nUnknown Thing,2\nFreedom Red Roses,3\n,4\n")
    mart = str(tmp_path / "mart")
    spark.createDataFrame([("v1", "g1"), ("v2", "g1")], "variety string, product_group string").write.parquet(f"{mart}/cart_box_item")
    spark.createDataFrame([("v1", "Freedom", "c1", "g1"), ("v2", "Mondial", None, "g1")], "_KEY string, variety_name string, color string, product_group string").write.parquet(f"{mart}/variety")
    spark.createDataFrame([("g1", "Roses")], "_KEY string, common_name string").write.parquet(f"{mart}/product_group")
    spark.createDataFrame([("c1", "Red")], "_KEY string, color_name string").write.parquet(f"{mart}/color")
    root = str(tmp_path / "out")
    for _ in range(2):  # a repeated run takes the stored vectors and gives the same
        matches, found = run_matching(spark, str(tmp_path / "shop.csv"), mart, root, "2024-02-01")
        got = sorted((r["competitor_product_id"], r["matched_name"], r["variety_key"]) for r in matches.collect())
        assert got == [("1", "Red Freedom Roses", "v1"), ("2", "Null", "Null"), ("3", "Red Freedom Roses", "v1"), ("4", "Null", "Null")]
        assert tuple(found.first()) == (4, 2)
        assert spark.read.parquet(f"{root}/vectors/products").count() == 2
    exported = spark.read.option("header", True).csv(f"{root}/matches.csv/as_of=2024-02-01")
    assert exported.count() == 4


def test_names_are_vectorised_on_all_cores(spark):
    """A few bytes of names are not merged into one task; the vectors are those of every name."""
    names = spark.createDataFrame([(f"Rose {i}",) for i in range(200)] * 2 + [(None,)], "product_name string").coalesce(1)
    vectors = mt.vectorise(names)
    assert vectors.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert sorted(r["name"] for r in vectors.collect()) == sorted(f"Rose {i}" for i in range(200))
