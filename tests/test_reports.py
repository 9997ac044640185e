from bloomledger import fixed_values as fv
from bloomledger.operators import analytics as an
from bloomledger.operators import filters as fl
from bloomledger.plans.catalog import build_catalog
from pyspark.sql import functions as F


def test_stock_alerts_tell_zero_from_missing(spark):
    rows = [("A", "p", "d1", 5), ("A", "p", "d2", 0), ("A", "p", "d3", 4),
            ("A", "q", "d1", 5), ("A", "q", "d3", 5), ("A", "r", "d3", 9),
            ("B", "p", "d1", 5), ("A", "s", "d1", None), ("A", "t", "d1", 1), ("A", "t", "d1", 2)]
    frame = spark.createDataFrame(rows, "competitor string, competitor_product_id string, eta_date string, available_units bigint")
    got = sorted((r["competitor"], r["competitor_product_id"], r["eta_date"], r["units_before"], r["alert"]) for r in an.stock_alerts(frame).collect())
    assert got == [("A", "p", "d2", 5, "sold_out"), ("A", "q", "d2", 5, "missing"), ("A", "t", "d2", 3, "missing")]


def test_compare_competitors(spark):
    rows = [("v", "d", "A", 1.0), ("v", "d", "A", 0.5), ("v", "d", "B", 2.0), ("w", "d", "B", 3.0), ("w", "d", "C", 3.0)]
    frame = spark.createDataFrame(rows, "variety_key string, eta_date string, competitor string, stem_price double")
    got = sorted((r["variety_key"], r["A"], r["B"], r["n_competitors"], r["spread"], r["n_other"]) for r in an.compare_competitors(frame, ["A", "B"]).collect())
    assert got == [("v", 0.5, 2.0, 2, 1.5, 0), ("w", None, 3.0, 1, 0.0, 1)]


def test_mapping_fan_out_is_kept(spark):
    prices = spark.createDataFrame([("1", None, 2.0), ("1", None, 3.0), ("2", None, 4.0)], "competitor_product_id string, variety_key string, stem_price double")
    mapping = spark.createDataFrame([("1", "k1"), ("1", "k2")], "competitor_product_id string, variety_key string")
    got = sorted((r["competitor_product_id"], r["stem_price"], r["variety_key"] or "") for r in an.with_mapping(prices, mapping).collect())
    assert got == [("1", 2.0, "k1"), ("1", 2.0, "k2"), ("1", 3.0, "k1"), ("1", 3.0, "k2"), ("2", 4.0, "")]
    assert [r[0] for r in an.unmapped_products(prices, mapping).collect()] == ["2"]


def test_mapping_by_source_and_product(spark):
    prices = spark.createDataFrame([("A", "1"), ("B", "1"), ("A", None)], "competitor string, competitor_product_id string")
    mapping = spark.createDataFrame([("A", "1", "k1"), (None, None, "k2")], "competitor string, competitor_product_id string, variety_key string")
    got = an.with_mapping(prices, mapping, ["competitor", "competitor_product_id"])
    assert sorted((r["competitor"], r["competitor_product_id"] or "", r["variety_key"] or "") for r in got.collect()) == [("A", "", ""), ("A", "1", "k1"), ("B", "1", "")]


def test_stock_alerts_read_products_once(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").selectExpr(
        "l_returnflag as competitor", "l_partkey as competitor_product_id", "cast(l_shipdate as string) as eta_date", "l_quantity as available_units")
    frame = an.stock_alerts(lines)
    frame.collect()
    final = frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_volume_drop_and_cap(spark):
    rows = [("A", "d1")] * 10 + [("A", "d2")] * 4 + [("A", "d3")] * 4
    frame = spark.createDataFrame(rows, "competitor string, eta_date string")
    got = sorted((r["eta_date"], r["n_products"], r["is_drop"]) for r in an.volume_drops(frame, "competitor", "eta_date").collect())
    assert got == [("d1", 10, False), ("d2", 4, True), ("d3", 4, False)]
    assert [tuple(r) for r in an.capped_sources(frame, cap=10).collect()] == [("A", "d1", 10)]


def test_union_counts_add_up(spark):
    a, b = spark.range(3).withColumn("x", F.lit(1)), spark.range(2)
    assert fl.union_sources(a, b).count() == 5
    frame = spark.createDataFrame([("1",), ("",), (None,), ("Item ##",), ("x Item # y",)], "competitor_product_id string")
    assert tuple(fl.removed_count(frame).first()) == (1, 4)


def test_catalog_rules(spark):
    items = spark.createDataFrame([("v1", "g1"), ("v1", "g1"), ("v2", "g9"), ("v3", "g1"), ("v4", "g1"), ("v5", None), (None, "g1"), ("x", "g1"), ("v6", "g1")], "variety string, product_group string")
    variety = spark.createDataFrame([("v1", "Freedom (Jumbo)", "c1", "g1"), ("v2", "Mondial", None, "g1"), ("v3", "Boxwood", "c1", "g1"), ("v4", "Lost", "c1", "g7"), ("v5", "NoGroup", "c1", "g1"), ("x", "Excluded", "c1", "g1"), ("v6", None, "c1", "g1")], "_KEY string, variety_name string, color string, product_group string")
    group = spark.createDataFrame([("g1", "Roses")], "_KEY string, common_name string")
    color = spark.createDataFrame([("c1", "Dark Red")], "_KEY string, color_name string")
    got = sorted(tuple(r) for r in build_catalog(items, variety, group, color, excluded_varieties=["x"]).collect())
    assert got == [("Dark Red Freedom Jumbo Roses", "v1"), ("Mondial", "v2")]
    # An empty list excludes nothing; it does not bring the built-in keys back.
    builtin = fv.EXCLUDED_VARIETIES[0]
    kept = build_catalog(
        items.unionByName(spark.createDataFrame([(builtin, "g1")], items.schema)),
        variety.unionByName(spark.createDataFrame([(builtin, "Built In", "c1", "g1")], variety.schema)),
        group, color, excluded_varieties=[], excluded_groups=[])
    assert {builtin, "x"} <= {r["variety"] for r in kept.collect()}
