import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from bloomledger.llm import context_tree as ct


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["\n"]


def fold(doc_id):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % 7


class Tree:
    """Context-tree weighting by its definition, one bit tree per place in a byte."""

    def __init__(self, lines, depth):
        self.depth, self.counts = depth, {}
        for line in lines:
            for at in range(depth, len(line)):
                for b in range(8):
                    place = (1 << b) | (line[at] >> (8 - b))
                    bit = (line[at] >> (7 - b)) & 1
                    for d in range(depth + 1):
                        node = (place, line[at - d : at])
                        self.counts.setdefault(node, [0, 0])[bit] += 1
        self.children = {}
        for place, context in self.counts:
            if context:
                self.children.setdefault((place, context[1:]), []).append((place, context))
        self.known = {}

    def own(self, node):
        a, b = self.counts[node]
        g = math.lgamma
        return g(a + 0.5) + g(b + 0.5) - g(a + b + 1) - math.log(math.pi)

    def weighted(self, node):
        if node not in self.known:
            if len(node[1]) == self.depth:
                self.known[node] = self.own(node)
            else:
                below = sum(map(self.weighted, self.children[node]))
                self.known[node] = np.logaddexp(math.log(0.5) + self.own(node), math.log(0.5) + below)
        return self.known[node]

    def one(self, place, context, d=0):
        """Chance of a 1 behind the context, from depth d on."""
        node = (place, context[len(context) - d :])
        if node not in self.counts:
            return 0.5
        a, b = self.counts[node]
        estimate = (b + 0.5) / (a + b + 1)
        if d == self.depth:
            return estimate
        stop = math.exp(math.log(0.5) + self.own(node) - self.weighted(node))
        return stop * estimate + (1 - stop) * self.one(place, context, d + 1)

    def log10(self, line):
        total = 0.0
        for at in range(self.depth, len(line)):
            for b in range(8):
                p = self.one((1 << b) | (line[at] >> (8 - b)), line[at - self.depth : at])
                total += math.log10(p if (line[at] >> (7 - b)) & 1 else 1 - p)
        return total


@pytest.fixture(scope="module")
def few(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("n_chars").limit(40)
    return docs.select("doc_id", "text", "lang")


@pytest.mark.parametrize("common, share", [(1 << 21, 256), (300, 30), (0, 10**9), (0, 1)])
def test_every_context_counts(spark, few, monkeypatch, common, share):
    """Pairs by broadcast, most by the shuffle, all by the shuffle; few, all and no groups are hot."""
    monkeypatch.setattr(ct, "COMMON", common)
    monkeypatch.setattr(ct, "HOT_SHARE", share)
    docs = {r.doc_id: r.text for r in few.collect()}
    lines = {d: ct.coded_line([w.encode() for w in tokens(t)[:-1]]) for d, t in docs.items()}
    tree = Tree([line for d, line in lines.items() if fold(d) != 2], ct.DEPTH)
    got = {r.doc_id: r.score for r in ct.text_scores(few).collect()}
    assert got == pytest.approx({d: tree.log10(line) for d, line in lines.items()}, rel=1e-9)


def test_base_columns_equal_brute_force(spark, sf_dir, monkeypatch):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    counts = Counter()
    for d, t in docs.items():
        if fold(d) != 2:
            counts.update(tokens(t))
    n, v = sum(counts.values()), len(counts)
    for frequent in (ct.FREQUENT, 10):  # nearly all by broadcast, and nearly all by the shuffle
        monkeypatch.setattr(ct, "FREQUENT", frequent)
        rows = ct.op10_context_tree_scores(spark, sf_dir).collect()
        assert len(rows) == len(docs)
        for r in rows:
            own = tokens(docs[r.doc_id])
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(counts[w] > 0 for w in own), n)
            assert r.base_score == pytest.approx(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own))
            assert r.held_out == (fold(r.doc_id) == 2) and r.score < 0


def test_held_out_texts_score_above_the_base(spark):
    rows = [r for r in ct.op10_context_tree_scores(spark, "/root/testdata/sf0.1").collect() if r.held_out]
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_chances_of_a_byte_add_up_to_one(few):
    model = ct.learn(few)
    for context in (b"\n\n\n\n\n", b" the ", b"qzx\xff\x00"):
        packed = 0
        for back in range(1, ct.DEPTH + 1):
            packed = (packed << 8) | context[-back]
        pairs = (np.uint64(packed) << np.uint64(8)) | np.arange(256, dtype=np.uint64)
        assert (10 ** model.pair_logs(pairs)).sum() == pytest.approx(1.0)


def test_memo_and_counts_are_exact(monkeypatch):
    monkeypatch.setattr(ct, "MEMO_BITS", 4)  # most pairs share a slot
    rng = np.random.default_rng(0)
    counts, plain = ct.PairCounts(), Counter()
    for _ in range(20):
        pairs = rng.integers(0, 60, 200).astype(np.uint64)
        counts.add(pairs)
        plain.update(pairs.tolist())
    out = counts.counted()
    assert dict(zip(out["pair"].to_pylist(), out["n"].to_pylist())) == dict(plain)
    known = np.unique(rng.integers(0, 90, 60).astype(np.uint64))
    model = ct.CommonPairs(known, rng.normal(size=len(known)))
    logs = ct.PairLogs(model)
    for _ in range(5):
        pairs = rng.integers(0, 90, 50).astype(np.uint64)
        pairs = np.concatenate([pairs, pairs[:20]])
        assert np.array_equal(logs(pairs), model.pair_logs(pairs), equal_nan=True)


def test_log_gamma():
    x = np.array([0.5, 1, 1.5, 7.5, 1000.5, 3e7])
    assert np.allclose(ct.log_gamma(x), [math.lgamma(v) for v in x], rtol=1e-9, atol=1e-8)


def test_text_steps_do_not_change_scores(monkeypatch):
    texts = [(i, f"Some words {i} and more " * (i % 5)) for i in range(40)]
    lines = [ct.coded_line(ct.words_of(t.encode())) for _, t in texts]
    pairs = np.unique(np.concatenate([ct.pairs_at(np.frombuffer(line, np.uint8), ct.DEPTH, len(line)) for line in lines]))
    model = ct.CommonPairs(pairs, np.sin(np.arange(len(pairs))))

    def scores():
        logs = ct.PairLogs(model)
        return {r: s for rows, line, starts in ct._lines((i, t.encode()) for i, t in texts) for r, s in zip(rows, logs.lines(line, starts))}

    whole = scores()
    monkeypatch.setattr(ct, "STEP_BYTES", 37)
    assert scores() == pytest.approx(whole)


def test_every_row_has_its_own_result(spark, odd, empty):
    rows = ct.text_scores(odd).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in rows) == sorted((r.doc_id or 0, len(tokens(r.text))) for r in odd.collect())
    by_tokens = {r.n_tokens: r for r in rows if r.doc_id in (4, 6, 7)}
    assert by_tokens[30001].score < by_tokens[4].score
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    same = {(r.n_tokens, r.n_known, r.base_score, r.score) for r in rows if r.doc_id in (6, 7)}
    assert len(same) == 1  # three rows of one text
    repeated = spark.createDataFrame([(1, "a b"), (1, "a c d"), (1, "a b"), (None, "a"), (None, None)], "doc_id long, text string")
    assert sorted(r.n_tokens for r in ct.text_scores(repeated).collect()) == [1, 2, 3, 3, 4]
    assert ct.text_scores(empty).count() == 0
    one = spark.createDataFrame([(d, "a b") for d in range(50) if fold(d) == 2][:3], "doc_id long, text string")
    rows = ct.text_scores(one).collect()  # nothing to learn from
    assert {(r.train_tokens, r.n_known, round(r.base_score, 9)) for r in rows} == {(0, 0, 0.0)}
    assert {round(r.score, 6) for r in rows} == {round(5 * 8 * math.log10(0.5), 6)}
