import random
import re
from collections import Counter

import numpy as np
import pytest
from bloomledger.llm import collocations as co

LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, top=2000, least=10, share=50):
    """The best phrases of (lang, text) rows: all phrases counted, none left out by a bound."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i : i + size])] += 1
    candidates, longest = [], Counter()
    for (lang, words), a in f.items():
        if len(words) > 1 and a >= least:
            cuts = [(1000000 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            candidates.append((lang, words, a, f[lang, words[:k]], f[lang, words[k:]], score))
            if len(words) == 3:
                for part in (words[:2], words[1:]):
                    longest[lang, part] = max(longest[lang, part], a)
    out = []
    for lang in {c[0] for c in candidates}:
        kept = [c for c in candidates if c[0] == lang and (len(c[1]) == 3 or 100 * longest[lang, c[1]] < share * c[2] or not longest[lang, c[1]])]
        kept.sort(key=lambda c: (-c[5], -c[2], " ".join(c[1]).encode()))
        out += [(lang, i + 1, " ".join(w), a, left, right, n[lang], s) for i, (_, w, a, left, right, s) in enumerate(kept[:top])]
    return sorted(out)


def found(docs, **how):
    rows = co.collocations(docs, **how).collect()
    assert docs.count() == 0 or list(rows[0].asDict() if rows else []) in ([], ["lang", "rank", "phrase", "a", "l", "r", "n", "score"])
    return sorted(map(tuple, rows))


def texts(seed, n=150):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "a", "new", "york", "city", "né", "漢字", "x.y", "don't", "red", "Rose"] + [f"w{i}" for i in range(25)]
    fixed = ["new york city", "red Rose", "of the", "a b c d", "né 漢字"]
    rows = []
    for _ in range(n):
        bits = [rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary) for _ in range(rng.randrange(60))]
        text = "".join(b + rng.choice([" "] * 8 + [".", ", ", "\t", "  ", "\n", "\x0b", " ; "]) for b in bits)
        rows.append((rng.choice(["en", "en", "de", None, "und"]), text))
    return rows + [("en", None), (None, ""), ("fr", " \t.,"), ("fr", "one word here")] + [("en", "same words over again " * 8)] * 30


@pytest.mark.parametrize("top, least, share", [(2000, 10, 50), (5, 2, 50), (20, 3, 80), (1, 1, 10), (12, 2, 0)])
def test_equals_counting_all(spark, top, least, share):
    rows = texts(top)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(4)
    got = found(docs, top=top, least=least, share=share)
    assert got == brute(rows, top, least, share) and got


def test_blocks_do_not_matter(spark):
    rows = texts(9, 40)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(2)
    assert found(docs, top=30, least=2, step=50) == brute(rows, 30, 2)


def test_long_texts_are_cut_between_pieces():
    text = ("some words without an end " * 40 + "." + "a b.c") * 3 + "last words" * 30
    data = np.frombuffer(text.encode() * 2, np.uint8)
    offsets = np.array([0, 0, len(data) // 2, len(data)])
    for step in (7, 64, 1000, 10**6):
        parts = list(co._parts(data, offsets, step))
        assert b"".join(p.tobytes() for p, _, _ in parts) == data.tobytes()
        for part, bounds, _ in parts:
            assert bounds[-1] == len(part)
        ends = [p.tobytes()[-1:] for p, b, first in parts if first == 1 and len(b) == 2]
        assert all(e == b"." for e in ends[:-1])


def test_later_rounds_are_reached(spark, monkeypatch):
    """Pairs at the first level are all inside longer phrases, so lower levels have to be grown."""
    rows = [("en", f"k{i} l{i} m{i}.") for i in range(40) for _ in range(5)]
    rows += [("en", f"k{i} z. y l{i} z. m{i} y. p{i % 6} q{i % 5}") for i in range(40) for _ in range(3)]
    calls = []
    whole = co._triples
    monkeypatch.setattr(co, "_triples", lambda *a: calls.append(1) or whole(*a))
    docs = spark.createDataFrame(rows, "lang string, text string")
    assert found(docs, top=60, least=2) == brute(rows, 60, 2)
    assert len(calls) > 1


def test_hash_clash_is_an_error(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "one two three")], "lang string, text string")
    class Same:
        @staticmethod
        def xxh64_intdigest(*_):
            return 7

    monkeypatch.setattr(co, "xxhash", Same)
    with pytest.raises(ValueError):
        co.collocations(docs)


def test_odd_rows(spark, odd, empty):
    rows = [(r.lang, r.text) for r in odd.collect()]
    assert found(odd) == brute(rows) and found(odd, least=1) == brute(rows, least=1)
    assert co.collocations(empty).count() == 0


def test_query_reads_the_table(spark, sf_dir):
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert sorted(map(tuple, co.op12_collocations(spark, sf_dir).collect())) == brute(rows)
