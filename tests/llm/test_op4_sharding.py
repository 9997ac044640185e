from collections import Counter

import pytest
import xxhash
from bloomledger.llm import sharding


def test_table_is_even_and_stable():
    names = [f"s{i}" for i in range(20)]
    table = sharding.fill_table(names, 2003)
    counts = Counter(table)
    assert set(counts) == set(range(20)) and max(counts.values()) - min(counts.values()) <= 1
    fewer = sharding.fill_table(names[:-1], 2003)
    moved = sum(names[a] != names[b] for a, b in zip(table, fewer) if names[a] != "s19")
    assert moved < 0.2 * 2003  # slots of the shards that stay
    assert sharding.fill_table(names, 2003) == table


def test_table_equals_turn_by_turn_claims():
    """The definition, with whole preference lists."""
    import hashlib

    names, size = ["a", "b", "c"], 101
    lists = []
    for name in names:
        d = hashlib.sha256(name.encode()).digest()
        offset, skip = int.from_bytes(d[:8], "big") % size, int.from_bytes(d[8:16], "big") % (size - 1) + 1
        order = [(offset + j * skip) % size for j in range(size)]
        assert sorted(order) == list(range(size))
        lists.append(order)
    owner = [None] * size
    turn = 0
    while None in owner:
        shard = turn % len(names)
        slot = next(s for s in lists[shard] if owner[s] is None)
        owner[slot] = shard
        turn += 1
    assert sharding.fill_table(names, size) == owner


@pytest.mark.parametrize("names, size", [([], 7), (["a"], 8), (["a", "a"], 7), (list("abcdefgh"), 7)])
def test_bad_tables_are_refused(names, size):
    with pytest.raises(ValueError):
        sharding.fill_table(names, size)


def test_placement(spark, sf_dir, odd, empty):
    owners = sharding.fill_table(sharding.SHARDS)
    for r in sharding.op4_table_sharding(spark, sf_dir).collect():
        slot = xxhash.xxh64(str(r.doc_id).encode(), seed=42).intdigest()
        slot = (slot - 2**64 if slot >= 2**63 else slot) % sharding.TABLE_SIZE
        assert r.shard == sharding.SHARDS[owners[slot]]
    placed = sharding.place(odd)
    assert placed.columns == [*[c for c in odd.columns if c != "shard"], "shard"]
    rows = placed.collect()
    assert len(rows) == odd.count() and all(r.shard in sharding.SHARDS for r in rows)
    assert len({r.shard for r in rows if r.doc_id is None}) == 1 == len({r.shard for r in rows if r.doc_id == 6})
    assert sharding.place(empty).count() == 0
