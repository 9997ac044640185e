import random

import numpy as np
import pytest
from bloomledger.llm import near_dedup
from bloomledger.llm.components import connected_components
from bloomledger.llm.shingles import shingle_sets
from brute_near import components, shingles


def check(spark, docs, percent=85):
    frame = spark.createDataFrame(list(docs.items()), "k long, text string").repartition(5)
    got = {r.k: (r.component, r.n_shingles) for r in near_dedup.near_groups(frame, percent).collect()}
    want = components(docs, percent)
    assert got == {d: (want[d], len(shingles(t))) for d, t in docs.items()}
    return want


def changed(rng, words, n):
    out = list(words)
    for at in rng.sample(range(len(out)), n):
        out[at] = f"new{rng.randrange(10**9)}"
    return out


@pytest.mark.parametrize("percent", [80, 85])
def test_groups_equal_all_pairs(spark, percent):
    rng = random.Random(2)
    docs, vocabulary = {}, [f"w{i}" for i in range(3000)]
    for _ in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 5, 6, 12, 60, 200]))]
        docs[len(docs)] = " ".join(words)
        for _ in range(rng.randrange(4)):
            n = rng.randrange(0, max(1, len(words) // 25) + 1)
            docs[len(docs)] = " ".join(changed(rng, words, min(n, len(words)))).title()
    found = check(spark, docs, percent)
    assert len(set(found.values())) < len(docs)


def test_pairs_at_eighty_percent_share_a_bucket():
    rng, how = np.random.default_rng(5), near_dedup.bands_for(80)
    for size in (8, 20, 90, 400):
        for _ in range(300):
            pool = np.unique(rng.integers(0, 2**64, size, dtype=np.uint64))
            cut = len(pool) // 10  # 8 of 10 are common
            one, other = np.sort(pool[: len(pool) - cut]), np.sort(pool[cut:])
            keys = near_dedup.band_keys(np.array([near_dedup.signature(s, how) for s in (one, other)]), how)
            assert (keys[0] == keys[1]).any()
    with pytest.raises(ValueError):
        near_dedup.bands_for(79)


def test_star_of_copies_that_differ_from_each_other(spark):
    """Every copy is linked with the base alone, which has not the smallest id."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(400)]
    docs = {i: " ".join(changed(rng, base, 5)) for i in range(40)}
    docs[40] = " ".join(base)
    assert set(check(spark, docs).values()) == {0}


def test_chain_of_drifting_copies(spark):
    rng = random.Random(6)
    words, docs = [f"c{i}" for i in range(300)], {}
    for i in range(12):
        docs[i] = " ".join(words)
        words = changed(rng, words, 4)
    assert set(check(spark, docs).values()) == {0}


def test_many_exact_copies_are_one_class(spark):
    docs = {i: "The very same text of some seven words" if i % 3 == 0 else f"other text number {i} with its own words {i}" for i in range(600)}
    assert sum(c == 0 for c in check(spark, docs).values()) == 200


def test_links_inside_a_bucket_equal_all_pairs(monkeypatch):
    monkeypatch.setattr(near_dedup, "COLUMNS", 16)
    rng = np.random.default_rng(2)
    base = rng.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.concatenate([rng.permutation(base)[: rng.integers(80, 101)], rng.integers(0, 2**63, rng.integers(0, 12), dtype=np.uint64)])) for _ in range(40)]
    component, block = rng.integers(0, 30, 40), np.zeros(40, int)
    for blocks in (block, rng.integers(0, 2, 40)):
        want = set()
        for i in range(40):
            for j in range(i + 1, 40):
                shared = len(np.intersect1d(sets[i], sets[j]))
                far = component[i] != component[j] and (blocks is block or blocks[i] != blocks[j])
                if far and 100 * shared >= 85 * (len(sets[i]) + len(sets[j]) - shared):
                    want.add((i, j))
        assert {tuple(p) for p in near_dedup.links_between(sets, component, blocks, 85).tolist()} == want
        assert want


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 7])
def test_hidden_links_are_found(spark, monkeypatch, block):
    """Members that no centre is linked with, in buckets of one block and of many."""
    monkeypatch.setattr(near_dedup, "BLOCK", block)
    rng = random.Random(11)
    base, docs = [f"b{i}" for i in range(150)], {}
    for i in range(60):
        one = changed(rng, base, rng.choice([3, 4, 6]))
        docs[2 * i] = " ".join(one)
        docs[2 * i + 1] = " ".join(changed(rng, one, 1))  # linked with that one only
    check(spark, docs)


def test_densified_signatures_agree_like_the_sets():
    rng, how = np.random.default_rng(0), near_dedup.bands_for(85)
    for size in (3, 30, 1000):
        agree, jaccard = [], []
        for _ in range(60):
            pool = rng.integers(0, 2**63, 2 * size, dtype=np.uint64)
            a, b = np.unique(pool[: size + size // 3]), np.unique(pool[size // 3 : size + size // 2])
            agree.append((near_dedup.signature(a, how) == near_dedup.signature(b, how)).mean())
            jaccard.append(len(np.intersect1d(a, b)) / len(np.union1d(a, b)))
        assert abs(np.mean(agree) - np.mean(jaccard)) < 0.06


def test_shingles_of_bulk_rows():
    texts = ["", "  ", "A b", "a B", "a b c d e", "a b c d e f", " a  b\tc\nd e ", "é à ü ö ä x"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *(len(t.encode()) for t in texts)])
    sets = shingle_sets(data, offsets)
    assert [len(s) for s in sets] == [0, 0, 1, 1, 1, 2, 1, 2]
    assert sets[2] == sets[3] and sets[4] == sets[6] and sets[4][0] in sets[5]


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    links = spark.createDataFrame(edges, "a long, b long")
    group = {}

    def find(x):
        group.setdefault(x, x)
        while group[x] != x:
            x = group[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        group[max(a, b)] = min(a, b)
    got = {r.id: r.component for r in connected_components(links).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(links.limit(0)).count() == 0


def test_odd_rows(odd, empty, spark):
    rows = near_dedup.near_duplicates(odd).collect()
    assert len(rows) == odd.count()
    groups = {}
    for r in rows:
        groups.setdefault(r.component_id, []).append(r.doc_id)
    assert sorted(groups[6]) == [6, 6, 7] and groups[1] == [1] and groups[None] == [None, None]
    assert all(r.n_shingles == 0 for r in rows if r.doc_id in (1, 2, 3))
    assert near_dedup.near_duplicates(empty).count() == 0


def test_different_texts_of_one_id_are_not_linked(spark):
    text = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(None, text(1)), (None, text(2)), (5, text(1) + " more"), (5, text(3)), (5, text(3)), (6, text(3) + " end"), (4, text(4))]
    got = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    found = sorted(((r.doc_id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in got))
    want = [(0, 36, 0, True), (0, 36, 0, True), (4, 36, 4, True), (5, 36, 5, True), (5, 36, 5, True), (5, 37, 0, False), (6, 37, 5, False)]
    assert found == want


def test_query_on_given_documents(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    want = components(docs)
    got = {r.doc_id: (r.component_id, r.kept) for r in near_dedup.op5_minhash_near_dedup(spark, sf_dir).collect()}
    assert got == {d: (want[d], want[d] == d) for d in docs}
