import random

from bloomledger.llm import token_counts as tc
from tokenizers import Tokenizer

SAMPLES = ["a<|endoftext|>b  c\n\n d <|endoftext|>", "   ", "\n a", "a  b   ", "don't  'll x", " " * 5000, "日本 語  テ", "᠎ a ᠎ b", " x   y", "x" * 20000, ""]


def direct(texts):
    tokenizer = Tokenizer.from_file(tc.public_path(tc.TOKENIZER))
    return [len(e.ids) for e in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_add_up_to_the_text():
    rng = random.Random(5)
    bits = [" ", "  ", "\n", "\t", "a", "don't", "42", "é", "—", "漢", " ", "<|endoftext|>", ".", "x y"]
    texts = SAMPLES + ["".join(rng.choice(bits) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    counter = tc.PieceCounter(tc.hf_lengths(tc.TOKENIZER))
    assert counter.counts(texts) == direct(texts)
    assert counter.counts(texts) == direct(texts)  # now from the memo
    for text in texts:
        assert "".join(tc.safe_pieces(text)) == text


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(tc, "MEMO_ENTRIES", 50)
    monkeypatch.setattr(tc, "BATCH_BYTES", 100)
    texts = [f"w{i} v{i % 7} u" for i in range(500)]
    counter = tc.PieceCounter(tc.hf_lengths(tc.TOKENIZER))
    assert counter.counts(texts) == direct(texts)


def test_operator(spark, sf_dir, odd, empty):
    for docs in (spark.read.parquet(f"{sf_dir}/documents.parquet"), odd):
        rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)
        got = sorted(tc.count_tokens(docs).collect(), key=str)
        want = sorted(zip([d for d, _ in rows], [len((t or "").encode()) for _, t in rows], direct([t for _, t in rows])), key=str)
        assert sorted([(r.doc_id, r.n_bytes, r.n_tokens) for r in got], key=str) == want
        assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert tc.count_tokens(empty).count() == 0
