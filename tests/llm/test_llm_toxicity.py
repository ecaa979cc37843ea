import zlib

import numpy as np
import odd_documents as odd
import pytest

from parcelflow.llm import toxicity as tox

SF_DIR = "/root/testdata/sf0.1"


def test_gradient_by_differences():
    bags = tox.Bags(["good word good", "bad word", "a bad bad day", ""])
    assert len(bags.used) > 20
    rng, labels = np.random.default_rng(1), np.array([0, 1, 1, 0])
    params = [rng.normal(size=(len(bags.used), 2)), rng.normal(size=(2, 2)), rng.normal(size=2)]
    _, slopes = tox.loss_and_slopes(bags, params, labels)
    for which, slope in enumerate(slopes):
        for _ in range(20):
            place = tuple(rng.integers(0, n) for n in slope.shape)
            sides = []
            for step in (1e-5, -1e-5):
                moved = [p.copy() for p in params]
                moved[which][place] += step
                sides.append(tox.loss_and_slopes(bags, moved, labels)[0])
            assert slope[place] == pytest.approx((sides[0] - sides[1]) / 2e-5, abs=1e-8)


def test_means_over_words_and_subwords():
    bags = tox.Bags(["ab ab, cd", "!!"])
    embedding = np.random.default_rng(2).normal(size=(len(bags.used), 3))
    whole = np.zeros((tox.BUCKETS, 3))
    whole[bags.used] = embedding

    def mean(word):
        return whole[tox.subwords([word])[0]].mean(axis=0)

    got = bags.up(embedding)
    assert got[0] == pytest.approx((2 * mean("ab") + mean("cd")) / (3 + tox.NULL_WORDS))
    assert got[1] == pytest.approx(0)


def test_scores_are_those_of_the_trained_means():
    texts, labels = ["good word good", "bad word", "a bad bad day", "good day", "bad"], np.array([0, 1, 1, 0, 1])
    model = tox.train(texts, labels)
    logits = tox.Bags(texts).up(model.embedding[tox.Bags(texts).used]) @ model.weight + model.bias
    chances = 1 / (1 + np.exp(logits[:, 0] - logits[:, 1]))
    assert tox.Scorer(model.shares(), model.offset())(texts) == pytest.approx(chances)
    assert ((chances > 0.5) == labels).all()


def test_subwords_of_each_word_do_not_depend_on_its_neighbours():
    words = ["idiot", "", "é", "x" * 500, "日本語"]
    bucket, owner = tox.subwords(words)
    for k, word in enumerate(words):
        alone = sorted(tox.subwords([word])[0].tolist())
        assert sorted(bucket[owner == k].tolist()) == alone
        assert len(alone) == (sum(max(0, len(word) + 3 - n) for n in tox.GRAMS) + 1 if word else 0)
    assert not len(tox.subwords([])[0])


def test_a_misspelling_never_seen_counts():
    rng = np.random.default_rng(3)
    words = [f"w{chr(97 + a)}{chr(97 + b)}" for a in range(20) for b in range(20)]
    texts = [" ".join(rng.choice(words, 30)) for _ in range(200)]
    labels = np.arange(200) % 2
    texts = [f"{t} stupid" if l else t for t, l in zip(texts, labels)]
    model = tox.train(texts, labels)
    score = tox.Scorer(model.shares(), model.offset())
    plain = " ".join(rng.choice(words, 30))
    clean, right, misspelt, unknown = score([f"{plain} {w}" for w in ("", "stupid", "stupidd", "qqqqqqq")])
    assert right > misspelt > 5 * clean > 5 * unknown / 1.5


@pytest.fixture(scope="module")
def tables(spark):
    return tuple(spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    got = {r.doc_id: r for r in tox.toxicity(docs, labels).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in got.values())
    marks = [r for r in labels.collect() if got[r.doc_id].held_out]
    pairs = [(got[r.doc_id].predicted, r.toxic) for r in marks]
    short = {r.doc_id for r in docs.where("length(text) < 200").select("doc_id").collect()}
    plain = [got[r.doc_id].predicted for r in marks if not r.toxic and r.doc_id in short]
    assert len(plain) > 30 and sum(plain) / len(plain) < 0.1
    assert sum(p for p, t in pairs if t) / sum(t for _, t in pairs) >= 0.69
    assert sum(p for p, t in pairs if not t) / sum(not t for _, t in pairs) < 0.03


def test_held_out_labels_and_other_columns_do_not_matter(spark):
    docs = odd.documents(spark, [(i, f"text {i} {'idiot ' * (i % 2)}") for i in range(60)])
    held = lambda i: zlib.crc32(str(i).encode()) % 3 == 1
    labels = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - t if held(i) else t) for i, t in labels]
    scores = [
        odd.rows_of(tox.toxicity(d, spark.createDataFrame(given, "doc_id bigint, toxic int")), "doc_id", "score")
        for d, given in ((docs, labels), (docs, flipped), (docs.select("doc_id", "text"), labels))
    ]
    assert scores[0] == scores[1] == scores[2]


def test_long_texts_are_learned_from(spark):
    """All toxic texts are long pages."""
    plain = " ".join(f"word{i}" for i in range(900))
    docs = odd.documents(spark, [(i, f"{plain} {'idiot ' * 300}" if i % 2 else "word1 word2") for i in range(90)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(90)], "doc_id bigint, toxic int")
    got = {r.doc_id: r.predicted for r in tox.toxicity(docs, labels).collect()}
    assert all(got[i] == i % 2 for i in range(90))
    assert tox.counted("b a b") == ("b a", [2, 1])


def test_odd_documents(spark):
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (3, 0), (6, 0), (7, None), (None, 1), (99, 1)], "doc_id bigint, toxic int"
    )
    got = tox.toxicity(odd.documents(spark), labels).collect()
    assert len(got) == len(odd.ROWS) and all(0 <= r.score <= 1 for r in got)
    none = tox.toxicity(odd.documents(spark), labels.where("false")).collect()
    assert all(r.score == 0.5 and r.predicted == 0 for r in none)
    assert tox.toxicity(odd.empty(spark), labels).count() == 0
