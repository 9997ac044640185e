"""Values as of a time, against a plain search."""

import datetime as dt
import random

import pytest
from bloomledger.operators.asof import as_of_join, validity_ranges

DAY = dt.date(2024, 1, 1)


def _day(i):
    return DAY + dt.timedelta(days=i)


def _brute(rows, history):
    out = []
    for key, day, n in rows:
        known = {}
        for k, value, since in history:
            if k is not None and k == key and since is not None and day is not None and since <= day:
                known.setdefault(since, []).append(value)
        values = [v for v in known[max(known)] if v is not None] if known else []
        out.append((key, day, n, max(values) if values else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("days", [32, 1, 4000])
def test_equals_a_plain_search(spark, days):
    rng = random.Random(days)
    history = [(rng.choice(["a", "b", "c", "hot", None]), rng.choice(["x", "y", "z", None]), _day(rng.randrange(400))) for _ in range(120)]
    history += [("a", "w", None), ("early", "x", _day(-5000)), ("late", "x", _day(5000))]
    rows = [(rng.choice(["a", "b", "hot", "hot", "early", "late", "none", None]), rng.choice([_day(rng.randrange(500)), None]) if rng.random() < 0.1 else _day(rng.randrange(500)), i) for i in range(400)]
    prices = spark.createDataFrame([(*r, "old") for r in rows], "key string, day date, n int, variety_key string")
    changes = spark.createDataFrame(history, "key string, variety_key string, since date")
    ranges = validity_ranges(changes.filter("key is not null"), ["key"], "variety_key", "since")
    got = as_of_join(prices, ranges, ["key"], "variety_key", "day", days)
    assert got.columns == ["key", "day", "n", "variety_key"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == _brute(rows, history)
    assert as_of_join(prices.limit(0), ranges, ["key"], "variety_key", "day", days).count() == 0
    assert all(r.variety_key is None for r in as_of_join(prices, ranges.limit(0), ["key"], "variety_key", "day", days).collect())


def test_repeated_values_open_no_range(spark):
    rows = [("a", v, _day(i)) for i, v in enumerate(["x", "x", "y", "y", None, None, "y", "x"])]
    ranges = validity_ranges(spark.createDataFrame(rows, "k string, v string, since date"), ["k"], "v", "since")
    got = sorted((r.v, r.valid_from, r.valid_to) for r in ranges.collect() if r.valid_to)
    assert got == [("x", _day(0), _day(2)), ("y", _day(2), _day(4)), ("y", _day(6), _day(7))]
    assert [(r.v, r.valid_from) for r in ranges.collect() if not r.valid_to] == [("x", _day(7))]


def test_ranges_go_only_to_slices_with_rows(spark):
    """A range over twenty years is not sent to each of its slices, and all rows still find it."""
    ranges = spark.createDataFrame(
        [("a", "red", dt.date(1990, 1, 1), dt.date(2010, 1, 1)), ("a", "blue", dt.date(2010, 1, 1), None), ("b", "white", dt.date(1995, 5, 5), None)],
        "product string, variety string, valid_from date, valid_to date",
    )
    days = [dt.date(1989, 12, 31), dt.date(1990, 1, 1), dt.date(1999, 7, 7), dt.date(2009, 12, 31), dt.date(2010, 1, 1), dt.date(2030, 1, 1)]
    rows = spark.createDataFrame([(p, d) for p in ("a", "b", "c") for d in days], "product string, day date")
    joined = as_of_join(rows, ranges, ["product"], "variety", "day")
    assert "Generate" not in joined._jdf.queryExecution().optimizedPlan().toString()
    expected = {("a", days[0]): None, **{("a", d): "red" for d in days[1:4]}, **{("a", d): "blue" for d in days[4:]}}
    expected |= {("b", d): "white" if d >= dt.date(1995, 5, 5) else None for d in days} | {("c", d): None for d in days}
    assert {(r["product"], r["day"]): r["variety"] for r in joined.collect()} == expected
