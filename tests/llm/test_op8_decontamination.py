import random
import tracemalloc

import numpy as np
import pytest
from bloomledger.llm import decontamination as dc
from bloomledger.llm import stages

W, MOST = dc.PASSAGE_BYTES, dc.edits_allowed(dc.PASSAGE_BYTES)


def fewest_edits(pattern, text):
    """Edit distance of the pattern to the nearest substring of the text."""
    row = np.zeros(len(text) + 1, int)
    text, steps = np.frombuffer(text, np.uint8), np.arange(len(text) + 1)
    for byte in pattern:
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != byte))
        for j in range(1, len(new)):  # spelled out, unlike the library
            new[j] = min(new[j], new[j - 1] + 1)
        row = new
    assert len(steps) == len(row)
    return int(row.min())


def brute(item, text):
    """Fewest edits of any passage of an item in a text, None if none is within its budget."""
    width = min(len(item), W)
    budget = dc.edits_allowed(width)
    best = min((fewest_edits(item[i : i + width], text) for i in range(len(item) - width + 1)), default=99)
    return best if best <= budget else None


def plain(text):
    return dc.plain_bytes(np.frombuffer(text, np.uint8))[0].tobytes()


def search(items, rows):
    """Fewest edits by (row, item name)."""
    index = dc.Index(items)
    offsets = np.cumsum([0, *map(len, rows)])
    got, spans = {}, []
    for row, item, size, edits, start, end in dc.search_rows(index, np.frombuffer(b"".join(rows), np.uint8), offsets):
        key = row, index.names[item]
        got[key] = min(edits, got.get(key, 99))
        spans.append((row, index.texts[item], size, edits, start, end))
    return got, spans


def edited(rng, text, n):
    out = bytearray(text)
    for _ in range(n):
        at = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[at] = rng.choice(b"xyz")
        elif kind < 0.7:
            del out[at]
        else:
            out.insert(at, rng.choice(b"xyz"))
    return bytes(out)


SYLLABLES = [b"tion", b"er", b"an", b"the ", b"in ", b"ou", b" re", b"kl", b"ab ", b"u"]


def syllables(rng, n):
    return b"".join(rng.choice(SYLLABLES) for _ in range(n))


@pytest.mark.parametrize("hits", [dc.HITS, 10])
def test_excerpts_at_every_offset(monkeypatch, hits):
    monkeypatch.setattr(dc, "HITS", hits)
    rng = random.Random(4)
    item = plain(syllables(rng, 110)).strip()
    for length in (W, W + 13, 100, 119, 150):
        rows = [syllables(rng, 12) + b"#" + item[a : a + length] + b"#" + syllables(rng, 12) for a in range(len(item) - length + 1)]
        got, spans = search([("i", item)], rows)
        assert got == {(r, "i"): 0 for r in range(len(rows))}
        for row, _, size, edits, start, end in spans:
            assert size >= length and rows[row][start:end] in item
    near = [b"-" + edited(rng, item[a : a + W], 0)[: W // 2] + b"#" + item[a + W // 2 : a + W] + b"-" for a in range(0, len(item) - W, 3)]
    assert len(search([("i", item)], near)[0]) == len(near)
    too_short = [b"#" + item[a : a + W - MOST - 1] + b"#" for a in range(len(item) - W)]
    assert search([("i", item)], too_short)[0] == {}


@pytest.mark.parametrize("hits", [dc.HITS, 50])
def test_search_equals_all_alignments(monkeypatch, hits):
    monkeypatch.setattr(dc, "HITS", hits)
    rng = random.Random(1)
    found = {0: 0, 1: 0, 2: 0, None: 0}
    for _ in range(14):
        items = [(f"i{k}", plain(syllables(rng, rng.choice([2, 6, 14, 26, 34]))).strip()) for k in range(3)]
        rows = []
        for _ in range(4):
            source = rng.choice(items)[1]
            at = rng.randrange(max(1, len(source) - W))
            leak = edited(rng, source[at : at + rng.choice([W, W + 2, 70, 200])], rng.randint(0, 5))
            around = syllables(rng, 14)
            cut = rng.randint(0, len(around))
            rows.append(around[:cut] + (leak if rng.random() < 0.8 else b"") + around[cut:])
        got, spans = search(items, rows)
        for row, data in enumerate(rows):
            for name, item in items:
                want = brute(item, plain(data))
                assert got.get((row, name)) == want, (item, data)
                found[want] += 1
        for row, item, _, edits, start, end in spans:
            assert brute(item, plain(rows[row][start:end])) <= edits
    assert min(found.values()) > 2


def test_repetitive_text_and_item():
    items = [("x", b"x" * 240), ("xy", b"xy" * 120), ("mixed", b"abc " * 40 + b"an end that does not repeat itself at all, not once, my friend")]
    rows = [b"x" * 49, b"x" * 50, b"xy" * 25, b"yx" * 25, b"x" * 24 + b"-" + b"x" * 25, b"abc " * 13, b"at does not repeat itself at all, not once, my friend", b"q" * 300, b"abc " * 5 + b"abd " * 5 + b"abc " * 7]
    got, _ = search(items, rows)
    want = {(r, name): brute(plain(item).strip(), plain(row)) for r, row in enumerate(rows) for name, item in items}
    assert got == {k: v for k, v in want.items() if v is not None} and len(got) > 6


@pytest.mark.parametrize("text", [b"x" * 3_000_000, b"xy" * 700_000 + b"x" * 100_000])
def test_memory_stays_bounded_on_repetitive_text(text):
    index = dc.Index([("x", b"x" * 240), ("y", b"a common beginning of items " + b"y" * 300)] + [(f"{i}", b"a common beginning of many items, %d of them" % i) for i in range(300)])
    data = np.frombuffer(text, np.uint8)
    tracemalloc.start()
    found = {index.names[item] for _, item, *_ in dc.search_rows(index, data, np.array([0, len(data)]))}
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == {"x"} and peak < 400 << 20


def test_many_items_with_one_beginning():
    items = [(f"{i:03}", b"question: which of the following is the right answer to this one? %03d" % i) for i in range(200)]
    rows = [b"question: which of the following is the right answer to this one? 1", b"nothing of the kind"]
    assert set(search(items, rows)[0]) == {(0, name) for name, _ in items}


def test_bound_is_positive_for_every_length():
    for m in range(1, 400):
        k = dc.edits_allowed(m)
        assert k == 0 or m + 1 - dc.Q * (k + 1) >= 1
        assert 100 * k <= dc.EDIT_PERCENT * m


def test_blank_runs_hide_nothing(monkeypatch):
    rng = random.Random(8)
    item = plain(syllables(rng, 60)).strip()
    words = item.split(b" ")
    cut = len(words) // 2
    for gap in (1, 70_000, 3_000_000):
        text = b"z" * 1000 + b" ".join(words[:cut]) + b" \n" * gap + b" ".join(words[cut:]) + b"z" * 1000
        got, spans = search([("i", item)], [text])
        assert got == {(0, "i"): 0} and max(s[2] for s in spans) == len(item)
    for lead in range(0, 200, 7):  # around the border of a step
        text = b"z" * (dc.TEXT_STEP - lead) + item + b"z" * 100
        assert search([("i", item)], [text])[0] == {(0, "i"): 0}


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_operator(spark, odd, empty, block_bytes):
    rng = random.Random(5)
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(rng.randrange(50)) for _ in range(n))
    items = [(f"b{i}", words(30)) for i in range(6)] + [("b0", "tiny"), ("none", None), ("empty", ""), (None, words(25))]
    benchmark = spark.createDataFrame([(*r, 1) for r in items * 2], "item_id string, text string, doc_id int")
    docs, want = [], set()
    for i in range(30):
        body = words(60)
        if i % 3 == 0:
            name, leak = items[i % 6]
            at, cut = rng.randrange(len(leak) - 90), rng.randrange(len(body))
            body = body[:cut] + " \n " + leak[at : at + rng.choice([60, 90, 300])].upper() + "\t" + body[cut:]
            want.add((i, name))
        docs.append((i, body))
    docs += [(30, "x" * (3 << 20) + " " + items[5][1] + " " + "y z " * 200000), (31, "a tiny text"), (31, "a tiny text"), (32, None), (33, "")]
    want |= {(30, "b5"), (31, "b0")}
    frame = spark.createDataFrame([(*r, "x") for r in docs], "doc_id long, text string, item_id string").repartition(4)
    rows = dc.contamination(frame, benchmark, block_bytes).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    assert all(r.edits == 0 and 0 <= r.first_start < r.last_end for r in rows)
    assert all(r.passage_bytes >= W or r.item_id == "b0" for r in rows)
    assert dc.contamination(empty, benchmark, block_bytes).count() == 0
    assert dc.contamination(odd, benchmark.limit(0), block_bytes).count() == 0
    assert dc.contamination(odd, benchmark, block_bytes).count() == 0


def test_short_items_are_reported_and_drop_nothing(spark, tmp_path):
    rows = [("a", "a"), ("b", " two   words "), ("c", None), ("d", "a sentence of more than twenty-five bytes")]
    benchmark = spark.createDataFrame(rows, "item_id string, text string")
    assert sorted(r.item_id for r in dc.short_items(benchmark).collect()) == ["a", "b", "c"]
    benchmark.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame([(1, "has an a and two words"), (2, "It is A sentence of more\n than twenty-five bytes!"), (3, None)], "doc_id long, text string")
    kept = stages.drop_leaks(spark, docs, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 3]


def test_given_leaks_are_found_and_clean_documents_are_not(spark, sf_dir):
    found = {r.doc_id for r in dc.op8_qgram_decontamination(spark, sf_dir).collect()}
    items = [" ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    docs = {r.doc_id: " ".join(r.text.lower().split()) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    whole = {d for d, t in docs.items() if any(i in t for i in items)}
    assert whole and whole <= found
    for d in found - whole:  # none without a long common passage
        assert any(i[a : a + 30] in docs[d] for i in items for a in range(0, len(i) - 30))
