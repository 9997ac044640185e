import itertools
import random
import re
import time

import numpy as np
import pytest
from bloomledger.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def checksum(d):
        total = 0
        for i, c in enumerate(reversed(d)):
            v = int(c) * (1 + i % 2)
            total += v - 9 if v > 9 else v
        return total % 10 == 0

    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and checksum(digits(m[0]))]
    out += [(3, *m.span()) for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_equal_plain_patterns():
    rng = random.Random(3)
    bits = ["1", "2", "9", "0", ".", "-", " ", "@", "a", "b.", "+", "(", ")", "255", "4111111111111111", "x@y.z", "é", "%"]
    for _ in range(8000):
        text = "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize("text", ["1" * 300000, "+1" + " " * 300000, "a" * 300000 + "@", "1.2.3." * 60000, "a@b." * 60000])
def test_long_runs_are_linear(text):
    began = time.process_time()
    pii.base_spans(text)
    assert time.process_time() - began < 5


def test_message_passing_is_exact_on_a_tree():
    rng = np.random.default_rng(1)
    weights = (rng.normal(size=(8, 5)), rng.normal(size=(5, 5)), (lambda s: s + s.T)(rng.normal(size=(5, 5))))
    features = rng.integers(0, 8, (4, 2))
    chain, skip = np.array([[0, 1], [2, 3]]), np.array([[1, 2]])
    own = weights[0][features].sum(axis=1)
    want = np.zeros((4, 5))
    for labels in itertools.product(range(5), repeat=4):
        score = sum(own[i, y] for i, y in enumerate(labels))
        score += sum(weights[1][labels[a], labels[b]] for a, b in chain) + sum(weights[2][labels[a], labels[b]] for a, b in skip)
        for i, y in enumerate(labels):
            want[i, y] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    saved, pii.SETTLED = pii.SETTLED, 1e-9
    try:
        assert np.allclose(pii.marginals(weights, features, chain, skip), want, atol=1e-6)
    finally:
        pii.SETTLED = saved


def test_repeated_mentions_share_evidence():
    tokens = pii.Tokens()
    tokens.add(0, "call +1 (843) 555-7672 now " + "filler " * 50 + "or 5557672 again, not 12 or 99")
    features, chain, skip = tokens.arrays()
    assert len(skip) == 1  # the two mentions of 555-7672
    a, b = skip[0]
    own = np.zeros((pii.FEATURES, 5))
    node = lambda w: pii.marginals((own, np.zeros((5, 5)), w), features, chain, skip)
    first = next(f for f in features[a] if f not in features[b])
    own[first, 3] = 6.0
    alone, linked = node(np.zeros((5, 5)))[b, 3], node(2 * np.eye(5))[b, 3]
    assert alone < 0.25 < 0.5 < linked


def test_hub_is_summed_over():
    """A star of three mentions and a hub without features, against all labellings."""
    rng = np.random.default_rng(2)
    weights = (rng.normal(size=(8, 5)), rng.normal(size=(5, 5)), (lambda s: s + s.T)(rng.normal(size=(5, 5))))
    features = rng.integers(0, 8, (3, 2))
    chain, skip = np.zeros((0, 2), int), np.array([[0, 3], [1, 3], [2, 3]])
    own = weights[0][features].sum(axis=1)
    want = np.zeros((3, 5))
    for labels in itertools.product(range(5), repeat=4):
        score = sum(own[i, labels[i]] for i in range(3)) + sum(weights[2][labels[a], labels[b]] for a, b in skip)
        for i in range(3):
            want[i, labels[i]] += np.exp(score)
    want /= want.sum(axis=1, keepdims=True)
    assert np.allclose(pii.marginals(weights, features, chain, skip), want, atol=1e-2)


def test_fifty_mentions_agree():
    tokens = pii.Tokens()
    tokens.add(0, "call +1 (843) 555-7672 now " + " ".join(f"{'filler ' * 7}then 5557672 or" for _ in range(49)))
    features, chain, skip = tokens.arrays()
    assert len(tokens.hubs) == 1 and len(skip) == 50 and len(tokens.hubs[0]) == 50
    weights = (np.zeros((pii.FEATURES, 5)), np.zeros((5, 5)), 2 * np.eye(5))
    first = tokens.hubs[0][0]
    weights[0][next(f for f in features[first] if f not in features[tokens.hubs[0][1]]), 3] = 6.0
    chance = pii.marginals(weights, features, chain, skip)[tokens.hubs[0]]
    assert set(chance.argmax(axis=1)) == {3} and chance[1:, 3].min() > 0.3


def test_outlines_are_whole():
    one, other = "a1" * 40 + "x", "a1" * 40 + "9"
    assert pii.shape(one) != pii.shape(other) and len(pii.shape(one)) < 40
    assert pii.shape("555-7672") == "93-94" and pii.shape("z" * 500) == "a"


def test_field_adds_what_a_pattern_swallowed(spark, sf_dir):
    texts = [f"phone +1 ({200 + i}) 555-{1000 + i} and ip 10.0.{i % 200}.7 words" for i in range(300)]
    weights = pii.fit(texts)
    text = "see +1 (843) 555-7672 170.106.47.218 end"
    base = pii.base_spans(text)
    assert [k for k, _, _ in base] == [1]  # the phone pattern ran on into the address
    added, = pii.added_spans(weights, [text], [base])
    assert [(k, text[s:e]) for k, s, e in added] == [(3, "+1 (843) 555-7672")]


def test_no_additions_in_clean_text():
    weights = pii.fit([f"mail a{i}@b.cc or 10.1.2.{i % 250}" for i in range(200)])
    texts = ["Chapter 12, page 7 of 1999.", "version 1.2.3 costs 4,000", "no numbers", ""]
    assert pii.added_spans(weights, texts, [pii.base_spans(t) for t in texts]) == [[], [], [], []]


def test_operator(spark, sf_dir, odd, empty):
    rows = {(r.doc_id, r.n_email): r for r in pii.find_personal_data(odd, pii.learn(odd)).collect()}
    assert len(rows) >= 8 and all(r.spans == "" and r.n_added == 0 for r in rows.values())
    assert pii.find_personal_data(odd, pii.learn(odd)).count() == odd.count()
    assert pii.find_personal_data(empty, pii.learn(empty)).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    for r in pii.op1_skip_chain_pii(spark, sf_dir).collect():
        base = brute(docs[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert set(pii.written(base).split(",")) <= set(r.spans.split(","))
