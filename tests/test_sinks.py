import json

import pytest
from bloomledger import schema as sc
from bloomledger.functions.vectors import trigram_vector
from bloomledger.plans.daily import run_day
from bloomledger.sinks import tables as tb
from bloomledger.sinks.vector_store import name_vectors, store_matches
from bloomledger.sources.files import read_mapping_csv
from bloomledger.streaming import landing
from pyspark.sql import functions as F


def _products(spark, n=3):
    rows = [("Mayesh", str(i), f"Rose {i}", 40 + i, 1.5) for i in range(n)]
    frame = spark.createDataFrame(rows, "competitor string, competitor_product_id string, competitor_product_name string, stem_length int, stem_price double")
    return sc.valid_products(sc.conform(frame, F.lit("2024-02-01")))


def test_append_prices(spark, tmp_path):
    root = str(tmp_path)
    products = _products(spark)
    assert tb.append_prices(products, "FlowerMarketplace", root)
    assert tb.append_prices(products, "flowermarketplace", root)
    stored = spark.read.parquet(f"{root}/flowermarketplace")
    assert stored.count() == 3 and "color" not in stored.columns and "unit_price" not in stored.columns
    assert not tb.append_prices(products.limit(0), "mayesh", root)
    assert not (tmp_path / "mayesh").exists()
    with pytest.raises(ValueError):
        tb.append_prices(products, "other", root)
    assert tb.export_columns(products, "dvflora").columns == [
        "created_at", "eta_date", "competitor_product_id", "competitor", "competitor_product_name", "stem_length", "stems_per_unit", "stem_price", "unit_price"]


def test_snapshot_csv(spark, tmp_path):
    path = tb.snapshot_path(str(tmp_path), "mayesh", "2024-02-14")
    assert path.endswith("/mayesh/mayesh_inventory_2024-02-14.csv")
    products = _products(spark).withColumn("competitor_product_name", F.lit('Say "hi", \\ there')).withColumn("color", F.when(F.col("competitor_product_id") == "1", "red").otherwise(""))
    assert tb.save_snapshot(products, path)
    text = sorted(p.read_text() for p in (tmp_path / "mayesh" / "mayesh_inventory_2024-02-14.csv").glob("part-*"))
    lines = sorted({line for t in text for line in t.splitlines()})
    assert lines[-1] == "competitor,competitor_product_id,competitor_product_name,color,stem_length,stem_price,created_at"
    assert 'Mayesh,0,"Say ""hi"", \\ there",,40,1.5,2024-02-01' in lines
    assert not tb.save_snapshot(products.limit(0), path + "-empty")
    assert not (tmp_path / "mayesh" / "mayesh_inventory_2024-02-14.csv-empty").exists()


def test_mapping_round_trip(spark, tmp_path):
    path = str(tmp_path / "mapping")
    first = spark.createDataFrame([("8152609227061", "k1"), ("007", "k2")], "competitor_product_id string, variety_key string")
    tb.replace_mapping(first, path)
    tb.replace_mapping(first.limit(1), path)
    assert tb.read_mapping(spark, path).count() == 1
    tb.replace_mapping(tb.read_mapping(spark, path).unionByName(first), path)  # derived from itself
    assert tb.read_mapping(spark, path).count() == 3
    broken = first.select(F.raise_error(F.lit("lost")).cast("string").alias("competitor_product_id"), "variety_key")
    with pytest.raises(Exception, match="lost"):
        tb.replace_mapping(broken, path)
    assert tb.read_mapping(spark, path).count() == 3
    tb.write_csv(first, str(tmp_path / "out"))
    assert sorted(tuple(r) for r in read_mapping_csv(spark, str(tmp_path / "out")).collect()) == [("007", "k2"), ("8152609227061", "k1")]
    assert store_matches(first, str(tmp_path / "matches")).count() == 2


def test_vector_store_adds_only_new_names(spark, tmp_path):
    root = str(tmp_path)
    names = spark.createDataFrame([("a",), ("b",), ("a",), (None,)], "product_name string")
    assert name_vectors(names, root, "2024-02-01").count() == 2
    marked = lambda c: F.transform(trigram_vector(c), lambda x: x + 100)
    more = spark.createDataFrame([("b",), ("c",)], "product_name string")
    got = {r["name"]: max(r["vector"]) for r in name_vectors(more, root, "2024-02-01", vectoriser=marked).collect()}
    assert got["b"] < 100 <= got["c"] and set(got) == {"b", "c"}
    assert spark.read.parquet(f"{root}/as_of=2024-02-01").count() == 3


def test_daily_run(spark, tmp_path):
    root = str(tmp_path)
    landed = {
        "mayesh": spark.createDataFrame([(json.dumps({"products": [{"product_id": 1, "name": "Rose Wht 40cm"}, {"product_id": 0}]}),)], "payload string"),
        "petaljet": spark.createDataFrame([(json.dumps({"products": [{"id": 2, "title": "Lily", "variants": [{"title": "10 Stems", "price": "5"}]}]}),), ("down",)], "payload string"),
        "flowermarketplace": spark.createDataFrame([("{}",)], "payload string"),
    }
    dates = spark.createDataFrame([("2024-02-14", 5), ("2024-02-13", 1)], "delivery_date string, program_id int")
    prices = run_day(landed, dates, root, created_at=F.lit("2024-02-01"))
    assert sorted((r["competitor"], r["competitor_product_id"], r["eta_date"]) for r in prices.collect()) == [("Mayesh", "1", "2024-02-14"), ("PetalJet", "2", "2024-02-14")]
    assert prices.columns == sc.PRODUCT_SCHEMA.names
    assert spark.read.parquet(f"{root}/prices/mayesh").first()["eta_date"] == "2024-02-14"
    assert not (tmp_path / "prices" / "flowermarketplace").exists()
    run_day(landed, dates, root, created_at=F.lit("2024-02-01"))
    assert spark.read.parquet(f"{root}/prices/petaljet").count() == 1  # a day run again replaces itself
    run_day(landed, dates, root, created_at=F.lit("2024-02-02"))
    assert spark.read.parquet(f"{root}/prices/petaljet").count() == 2
    for bad in ({**landed, "other": landed["mayesh"]}, {**landed, "dvflora": landed["mayesh"]}, {}):
        with pytest.raises(ValueError):
            run_day(bad, dates, str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()


def test_landing_stream_equals_batch(spark, tmp_path):
    inbox = tmp_path / "in"
    inbox.mkdir()

    def land(i):
        body = {"products": [{"product_id": i, "name": f"Rose Rd {i}0cm"}, {"product_id": 0}]}
        (inbox / f"p{i}.json").write_text(json.dumps(body, indent=1))  # several lines

    def run():
        stream = landing.stream_products(spark, "mayesh", str(inbox), "2024-02-14")
        landing.append_stream(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out" / "prices")), spark.read.parquet(str(tmp_path / "out" / "rejected"))

    land(1), land(2)
    assert [t.count() for t in run()] == [2, 2]
    land(3)
    rows, rejected = run()
    assert rejected.count() == 3 and {r["reject_reason"] for r in rejected.collect()} == {"missing competitor_product_id"}
    assert sorted((r["competitor_product_id"], r["competitor_product_name"], r["stem_length"]) for r in rows.collect()) == [
        ("1", "Rose Red", 10), ("2", "Rose Red", 20), ("3", "Rose Red", 30)]
