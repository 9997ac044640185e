import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from bloomledger.llm import alignment as al
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

A = Tokenizer.from_file(public_tokenizers.path(al.TOKENIZER_A))
A.encode_special_tokens = True
B = SentencePieceProcessor(model_file=public_tokenizers.path(al.TOKENIZER_B))
BYTE = al.byte_of_character()


def tokens(text):
    """Ids and byte ranges of both tokenisations of a text, or nothing."""
    if not text:
        return None
    a = A.encode(" " + text, add_special_tokens=False)
    b = B.encode(text)
    bytes_a = [bytes(BYTE[c] for c in t) for t in a.tokens]
    pieces = [B.id_to_piece(i) for i in b]
    bytes_b = [bytes([int(p[3:5], 16)]) if B.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, pieces)]
    if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
        return None
    ranges = []
    for ids, parts in ((a.ids, bytes_a), (b, bytes_b)):
        ends = np.cumsum([len(p) for p in parts]).tolist()
        ranges.append([(i, e - len(p), e) for i, p, e in zip(ids, parts, ends)])
    return ranges


def links_of(both):
    """All overlapping pairs, found by the bytes that the tokens cover."""
    a, b = both
    at = defaultdict(list)
    for j, (_, start, end) in enumerate(b):
        for byte in range(start, end):
            at[byte].append(j)
    return [(i, b[j][0]) for i, start, end in a for j in sorted({j for byte in range(start, end) for j in at[byte]})]


def brute(rows):
    known = {text: tokens(text) for _, text in rows}
    links = {t: links_of(both) for t, both in known.items() if both}
    count = Counter()
    for _, text in rows:
        count.update(set(links.get(text, ())))
    highest = Counter()
    for (a, _), n in count.items():
        highest[a] = max(highest[a], n)
    out = []
    for doc_id, text in rows:
        both = known[text]
        if not both:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b = both
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        members = [[[] for _ in ends] for _ in both]
        for side, lists in zip(both, members):
            for i, _, e in side:
                lists[bisect_left(ends, e)].append(str(i))
        groups = [f"{','.join(x)}|{','.join(y)}" for x, y in zip(*members)]
        found = links[text]
        best = sum(count[x] == highest[x[0]] for x in found)
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest()
        out.append((doc_id, len(a), len(b), len(groups), len(found), best, sum(count[x] for x in found), sha))
    return sorted(out, key=str)


def found(docs, **how):
    rows = al.align_corpus(docs, **how)
    assert rows.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(map(tuple, rows.collect()), key=str)


SAMPLES = [
    "a<|endoftext|>b </s> <s> <unk> c", "   ", " \n a", "a  b   ", "don't  'll x", "日本 語  テスト 😀", "᠎ a ᠎ b", "a▁b ▁ c",
    "x" * 3000, "Ünï çödé – text", "tab\tand\nnew line\r\n", "a\0b \0 c", "<0x41> and ▁", "  x y \u0085z", "é é ﬁ ①", "",
]


def random_texts(seed, n):
    rng = random.Random(seed)
    bits = [" ", " ", "  ", "\n", "\t", "a", "the", "don't", "42", "é", "—", "漢", " ", "▁", "<s>", ".", "Straße", "unbelievable", "😀"]
    return ["".join(rng.choice(bits) + rng.choice(["", " "]) for _ in range(rng.randint(1, 40))) for _ in range(n)]


def test_parts_equal_whole_texts():
    aligner = al.Aligner()
    texts = [t for t in SAMPLES + random_texts(1, 1500) if t]
    for _ in range(2):  # the second time from memory
        for text, got in zip(texts, aligner.measure(texts), strict=True):
            both = tokens(text)
            if not both:
                assert (got.n_a, got.n_b, got.n_groups, got.n_links, got.sha256, len(got.pairs)) == (0, 0, 0, 0, "", 0), text
                continue
            links = Counter(a << 15 | b for a, b in links_of(both))
            assert (got.n_a, got.n_b, got.n_links) == (len(both[0]), len(both[1]), sum(links.values())), text
            assert dict(zip(got.pairs.tolist(), got.times.tolist())) == links


def test_long_texts_and_small_memory(monkeypatch):
    texts = [" ".join(random_texts(s, 60)).replace("▁", "_") for s in range(6)] + ["x" * 5000, "a b▁c " * 300]
    want = [(m.n_a, m.n_b, m.n_groups, m.n_links, m.sha256, m.pairs.tolist(), m.times.tolist()) for m in al.Aligner().measure(texts)]
    assert want[0][0] and not want[-1][0]
    monkeypatch.setattr(al, "PART_CHARS", 100)
    monkeypatch.setattr(al, "MEMO_PARTS", 30)
    got = [(m.n_a, m.n_b, m.n_groups, m.n_links, m.sha256, m.pairs.tolist(), m.times.tolist()) for m in al.Aligner().measure(texts)]
    assert got == want


@pytest.mark.parametrize("common", [1 << 20, 40, 0])
def test_equals_brute_force(spark, common):
    rng = random.Random(2)
    texts = SAMPLES + random_texts(4, 60) + [None]
    rows = [(i if i % 7 else None, rng.choice(texts)) for i in range(150)] + [(3, texts[0]), (3, texts[0]), (3, "other")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert found(docs, common=common) == brute(rows)


def test_odd_rows(spark, odd, empty):
    assert found(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert al.align_corpus(empty).count() == 0


def test_query_reads_the_table(spark, sf_dir):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = sorted(map(tuple, al.op11_token_alignment(spark, sf_dir).collect()), key=str)
    assert got == brute(rows)
