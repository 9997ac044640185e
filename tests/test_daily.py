"""Whole days by manifest, quarantine with replay, and prices mapped as of their day."""

import json

import pytest
from bloomledger.plans import daily
from bloomledger.plans import quarantine as qn
from bloomledger.plans.daily import conformed_rows, replay_day, run_day
from bloomledger.sinks import manifest as mf
from pyspark.sql import functions as F

DAY = "2024-02-01"
ETA = "2024-02-14"


def pages(spark, *bodies):
    return spark.createDataFrame([(b if isinstance(b, str) else json.dumps(b),) for b in bodies], "payload string")


def mayesh(*ids, price=1.5):
    return {"products": [{"product_id": i, "name": f"Rose {i}0cm", "price_per_stem": price} for i in ids]}


def dates(spark):
    return spark.createDataFrame([(ETA, 5)], "delivery_date string, program_id int")


def ids(frame):
    return sorted(r["competitor_product_id"] for r in frame.collect())


def test_manifest_is_compare_and_set(spark, tmp_path):
    root = str(tmp_path)
    assert mf.current(spark, root) == (0, {})
    assert mf.commit(spark, root, 0, {"a/": "x"}) == 1
    with pytest.raises(mf.Conflict):
        mf.commit(spark, root, 0, {"a/": "y"})
    assert mf.current(spark, root) == (1, {"a/": "x"})
    mf.change(spark, root, {"b/": "z"}, ("a/",))
    assert mf.current(spark, root) == (2, {"b/": "z"})
    assert not [p for p in (tmp_path / "manifest").iterdir() if "draft" in p.name and not p.name.endswith(".crc")]


def test_change_goes_on_from_what_others_did(spark, tmp_path, monkeypatch):
    root, real, raced = str(tmp_path), mf.commit, []

    def racing(spark, root, number, parts):
        if not raced:
            raced.append(real(spark, root, number, {**parts, "other/": "o"}))
        return real(spark, root, number, parts)

    monkeypatch.setattr(mf, "commit", racing)
    mf.change(spark, root, {"own/": "w"}, ())
    assert mf.current(spark, root) == (2, {"other/": "o", "own/": "w"})


def test_a_failed_run_leaves_the_day_as_it_was(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    run_day({"mayesh": pages(spark, mayesh(1, 2))}, dates(spark), root, created_at=F.lit(DAY))

    def fail(*_):
        raise RuntimeError("between write and pointer")

    with monkeypatch.context() as broken:
        broken.setattr(mf, "change", fail)
        with pytest.raises(RuntimeError):
            run_day({"mayesh": pages(spark, mayesh(3))}, dates(spark), root, created_at=F.lit(DAY))
    assert ids(conformed_rows(spark, root, "mayesh", ETA)) == ["1", "2"]
    run_day({"mayesh": pages(spark, mayesh(3))}, dates(spark), root, created_at=F.lit(DAY))
    assert ids(conformed_rows(spark, root)) == ["3"]


def test_an_empty_run_empties_the_day(spark, tmp_path):
    root = str(tmp_path)
    both = {"mayesh": pages(spark, mayesh(1)), "petaljet": pages(spark, {"products": [{"id": 2, "title": "Lily", "variants": [{"title": "10 Stems", "price": "5"}]}]})}
    run_day(both, dates(spark), root, created_at=F.lit(DAY))
    run_day({**both, "mayesh": pages(spark, mayesh())}, dates(spark), root, created_at=F.lit(DAY))
    assert conformed_rows(spark, root, "mayesh", ETA).count() == 0 and conformed_rows(spark, root).count() == 1
    assert not (tmp_path / "prices" / "mayesh" / "created_at=2024-02-01").exists()
    run_day({"mayesh": pages(spark, mayesh(5))}, dates(spark), root, created_at=F.lit("2024-02-02"))
    assert ids(conformed_rows(spark, root)) == ["2", "5"]  # the other source's day stays


def test_quarantine_holds_what_could_not_be_used(spark, tmp_path):
    root = str(tmp_path)
    landed = {
        "mayesh": pages(spark, mayesh(1), "{broken", "{broken", {"products": [{"product_id": 0, "name": "none"}, {"product_id": 7, "name": "Lily"}]}),
        "dvflora": spark.createDataFrame([("u1", "<p>down</p>")], "url string, payload string"),
    }
    context = spark.createDataFrame([("u1", "Roses", "red")], "url string, product_group string, color string")
    listings = spark.createDataFrame([("roses", 3)], "listing string, n_pages int")
    arrived = spark.createDataFrame([("roses", 1), ("roses", 3)], "listing string, page int")
    for _ in range(2):  # a repeated run replaces what it wrote
        run_day(landed, dates(spark), root, context, created_at=F.lit(DAY), expected_pages={"mayesh": (listings, arrived, "listing")})
        found = [(r.source, r.reason, r.payload, r.url) for r in qn.quarantined(spark, root).collect()]
        assert sorted(found, key=str) == sorted(
            [
                ("mayesh", "unreadable page", "{broken", None),
                ("mayesh", "missing competitor_product_id", None, None),
                ("mayesh", "no price", None, None),
                ("mayesh", "missing page", None, None),
                ("dvflora", "no listing table", "<p>down</p>", "u1"),
            ],
            key=str,
        )
    gap = qn.quarantined(spark, root, "mayesh/").filter(F.col("reason") == qn.NO_PAGE).first()
    assert gap.detail == "roses page 2"


def test_replayed_pages_give_their_rows_once(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    run_day({"mayesh": pages(spark, mayesh(1), "[8, 9", "{never")}, dates(spark), root, created_at=F.lit(DAY))

    def mended(found):  # reads the half list of ids
        numbers = F.regexp_extract_all("payload", F.lit(r"(\d+)"), F.lit(1))
        rows = found.select("digest", F.explode(numbers).alias("competitor_product_id"))
        return rows.select("digest", "competitor_product_id", F.lit("Mayesh").alias("competitor"), F.lit("Rose").alias("competitor_product_name"))

    def fail(*_):
        raise RuntimeError("before the pointer")

    with monkeypatch.context() as broken:
        broken.setattr(mf, "change", fail)
        with pytest.raises(RuntimeError):
            replay_day(spark, root, "mayesh", ETA, F.lit(DAY), reader=mended)
    assert ids(conformed_rows(spark, root)) == ["1"]
    assert replay_day(spark, root, "mayesh", ETA, F.lit(DAY), reader=mended) == 1
    assert replay_day(spark, root, "mayesh", ETA, F.lit(DAY), reader=mended) == 0
    assert ids(conformed_rows(spark, root, "mayesh", ETA)) == ["1", "8", "9"]
    assert ids(spark.read.parquet(f"{root}/prices/mayesh")) == ["1", "8", "9"]
    assert [r.payload for r in qn.quarantined(spark, root).filter("payload is not null").collect()] == ["{never"]
    assert replay_day(spark, root, "mayesh", ETA, F.lit(DAY)) == 0  # the source's own reader gets nothing out of it
    run_day({"mayesh": pages(spark, mayesh(4))}, dates(spark), root, created_at=F.lit(DAY))
    assert ids(conformed_rows(spark, root)) == ["4"] and qn.quarantined(spark, root).filter("payload is not null").count() == 0


def test_prices_get_their_variety(spark, tmp_path):
    mapping = spark.createDataFrame([("1", "v1")], "competitor_product_id string, variety_key string")
    prices = run_day({"mayesh": pages(spark, mayesh(1, 2))}, dates(spark), str(tmp_path), created_at=F.lit(DAY), mapping=mapping)
    assert sorted((r.competitor_product_id, r.variety_key) for r in prices.collect()) == [("1", "v1"), ("2", None)]
    assert daily.CONFORMED.names[-1] == "source"
