"""The dictionary of names gives what the patterns give, and reads a name once."""

from bloomledger.functions import measures as ms
from bloomledger.functions import text as tx
from bloomledger.plans import names as nm
from bloomledger.workloads.common import listing_names
from pyspark.sql import functions as F


def test_dictionary_equals_the_patterns(spark, sf_dir, tmp_path):
    rows = listing_names(spark, sf_dir).withColumn("raw_name", F.when(F.col("l_linenumber") != 6, F.col("raw_name")))
    name = F.col("raw_name")
    want = rows.select("l_orderkey", "l_linenumber", tx.aggressive_clean(name), ms.stem_length(name), ms.stems_per_unit(name), ms.merged_or_range_length(name)).filter("raw_name is not null")
    got = nm.with_names(rows, nm.name_dictionary(rows, str(tmp_path)))
    assert got.count() == rows.count()
    columns = ["l_orderkey", "l_linenumber", "clean_name", "stem_length", "stems_per_unit", "merged_length"]
    found = sorted((tuple(r) for r in got.filter("raw_name is not null").select(columns).collect()), key=str)
    assert found == sorted((tuple(r) for r in want.collect()), key=str)


def test_second_day_reads_only_new_names(spark, tmp_path, monkeypatch):
    read, whole = [], nm.read_names
    monkeypatch.setattr(nm, "read_names", lambda names, raw="raw_name": read.append(sorted({r[0] for r in names.select(raw).collect()} - {None})) or whole(names, raw))
    day = lambda names: spark.createDataFrame([(n,) for n in names], "raw_name string")
    root = str(tmp_path)
    assert nm.name_dictionary(day(["Rose 40cm", "Lily x10", "Rose 40cm", None]), root).count() == 2
    assert nm.name_dictionary(day(["Rose 40cm", "Tulip 30cm"]), root).count() == 3
    assert nm.name_dictionary(day(["Tulip 30cm"]), root).count() == 3
    assert read == [["Lily x10", "Rose 40cm"], ["Tulip 30cm"]]
    assert nm.name_dictionary(day(["Rose 40cm"]), root, rules="rules-2").count() == 1  # other rules read again
