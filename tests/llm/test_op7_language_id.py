import math

import numpy as np
import pytest
from bloomledger.llm import language_id as li
from pyspark.sql import functions as F


def all_segmentations(word, probability):
    if not word:
        return 1.0
    total = 0.0
    for end in range(1, len(word) + 1):
        piece = word[:end]
        p = probability.get(piece, 0.0) + (li.UNKNOWN if end == 1 else 0.0)
        if p:
            total += p * all_segmentations(word[end:], probability)
    return total


def test_forward_sums_all_segmentations():
    texts = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb", "é"]
    pieces = li.Pieces(texts)
    rng = np.random.default_rng(0)
    p = rng.random((len(texts), 2))
    words = ["a", "ab", "abba", "bbab", "éa", "xyz", "aé", "b"]
    got = li.forward(pieces, p, words)
    for i, word in enumerate(words):
        for k in range(2):
            want = all_segmentations("▁" + word, dict(zip(texts, p[:, k])))
            assert got[i, k] == pytest.approx(math.log(want))


def test_long_runs_are_summed_whole():
    """Against the plain sum in exact fractions, far below the smallest float."""
    from fractions import Fraction

    texts = ["▁", "▁a", "a", "b", "ab", "ba", "▁ab", "abb", "é", "bbbb"]
    pieces = li.Pieces(texts)
    rng = np.random.default_rng(3)
    p = rng.random((len(texts), 2)) * 0.1
    letters = np.array(list("abé漢"))
    for length in (39, 41, 42, 80, 200, 1000):
        word = "".join(rng.choice(letters, length))
        marked = "▁" + word
        got = li.forward(pieces, p, [word, "ab"])[0]
        for k in range(2):
            chance = {t: Fraction(float(x)) for t, x in zip(texts, p[:, k])}
            sums = [Fraction(1)]
            for end in range(1, len(marked) + 1):
                total = sums[end - 1] * Fraction(li.UNKNOWN)
                for size in range(1, min(end, 4) + 1):
                    total += sums[end - size] * chance.get(marked[end - size : end], 0)
                sums.append(total)
            want = math.log(sums[-1].numerator) - math.log(sums[-1].denominator)
            assert got[k] == pytest.approx(want, rel=1e-9)


def test_long_words_are_fitted_like_short_ones(monkeypatch):
    pieces = li.Pieces(["▁", "a", "b", "ab", "▁ab", "ba", "é"])
    words = ["ab", "abab", "babaé", "ébabab" * 4, "b" * 20]
    counts = np.array([[9, 0], [5, 1], [0, 7], [1, 6], [2, 2]], float)
    together = li.fit(pieces, words, counts)
    monkeypatch.setattr(li, "TOGETHER_CHARS", 3)
    assert np.allclose(li.fit(pieces, words, counts), together, rtol=1e-9)


def test_sample_is_taken_by_text_as_well(spark):
    """A language whose rows share one id is learned; repeated rows are one."""
    rows = [(1, f"alpha{i % 7} beta gamma delta{i}", "aa") for i in range(3000)] + [(2, "une phrase", "bb")] * 3000
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert li.learn(docs, sample_docs=5).languages == ["aa", "bb"]


def test_fit_raises_the_likelihood():
    pieces = li.Pieces(["▁", "a", "b", "ab", "▁ab", "ba"])
    words = ["ab", "abab", "ba", "bab"]
    counts = np.array([[9, 0], [5, 1], [0, 7], [1, 6]], float)
    likelihood = [(li.forward(pieces, li.fit(pieces, words, counts, n), words) * counts).sum() for n in (1, 2, 4, 8)]
    assert likelihood == sorted(likelihood)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = li.identify(docs, li.learn(docs)).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(held) > 150 and sum(r.lang == r.lang_pred for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in rows)


def test_prediction_reads_the_text_alone(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = li.learn(docs)
    other = docs.withColumn("lang", F.lit("xx")).withColumn("source", F.lit(None).cast("string")).withColumn("doc_id", F.col("doc_id") + 10000)
    a = {r.doc_id: (r.lang_pred, r.score) for r in li.identify(docs, model).collect()}
    b = {r.doc_id - 10000: (r.lang_pred, r.score) for r in li.identify(other, model).collect()}
    assert a == b


def test_learning_leaves_the_fold_out(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    changed = docs.withColumn("lang", F.when(li.fold_of(F.col("doc_id")) == 0, F.lit("zz")).otherwise(F.col("lang")))
    model, other = li.learn(docs), li.learn(changed)
    assert model.languages == other.languages and np.array_equal(model.probabilities, other.probabilities)


def test_odd_rows(odd, empty, spark, sf_dir):
    model = li.learn(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    rows = li.identify(odd, model).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert {(by[d].lang_pred, by[d].score) for d in (1, 2, 3)} == {("und", 0.0)}
    assert by[None].held_out is False and by[6].lang_pred in model.languages
    assert li.identify(empty, model).count() == 0
    nothing = li.learn(odd.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in li.identify(odd, nothing).collect()} == {"und"}
    assert li.learn(empty).languages == []
    kept = li.accepted(odd, model)
    assert kept.columns == odd.columns and {1, 2, 3}.isdisjoint(r.doc_id for r in kept.collect())


def test_memo_stays_bounded(monkeypatch):
    monkeypatch.setattr(li, "MEMO_WORDS", 20)
    pieces = li.public_pieces(li.VOCABULARY)
    model = li.Model(["a", "b"], np.full((len(pieces), 2), 1e-4) * [1, 2], li.VOCABULARY)
    scorer, fresh = li.Scorer(model), li.Scorer(model)
    texts = [f"word{'abcdefghij'[i % 10]}{'klmnopqrst'[i % 7]} und {'x' * (i % 9)}" for i in range(60)]
    assert [scorer.predict([t]) for t in texts] == [li.Scorer(model).predict([t]) for t in texts]
    assert fresh.predict(["", None, "123 !"])[0] == ["und"] * 3
