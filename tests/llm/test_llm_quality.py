import numpy as np
import odd_documents as odd
import pytest

from parcelflow.llm import quality

SF_DIR = "/root/testdata/sf0.1"


def test_accuracies_are_recovered():
    """Labellers of known accuracy that often abstain, on classes that are never shown."""
    rng = np.random.default_rng(3)
    good = rng.random(20_000) < 0.7
    accuracy, votes_at_all = np.array([0.95, 0.9, 0.8, 0.7, 0.85]), np.array([1.0, 0.6, 0.9, 0.5, 0.3])
    right = rng.random((len(good), 5)) < accuracy
    votes = np.where(right == good[:, None], quality.GOOD, quality.JUNK)
    votes[rng.random(votes.shape) >= votes_at_all] = quality.NOTHING
    patterns, times = np.unique(votes, axis=0, return_counts=True)
    model = quality.learn_accuracies(patterns, times.astype(float))
    assert abs(model.prior - 0.7) < 0.03
    assert np.abs(model.accuracy() - accuracy).max() < 0.03
    assert ((model.posterior(votes) >= 0.5) == good).mean() > 0.95


def test_no_vote_says_nothing():
    model = quality.learn_accuracies(np.array([[2, 2], [0, 0]]), np.array([80.0, 20.0]))
    assert model.posterior(np.array([[1, 1]]))[0] == pytest.approx(model.prior)


def test_plain_words_take_the_short_way_to_the_same_record(monkeypatch):
    tokens = ["word", "Word", "Word.", "w", "W", "wo,", "WORD", "É", "été.", "Été", "ß", "ǅar", "日本", "a.b", "wo..", "!!", "9a", "don't"]
    for token in tokens:
        letters = [c for c in token if c.isalpha()]
        got = quality.record(token)
        assert got[quality.LETTERS] == len(letters)
        assert got[quality.UPPER] == sum(c.isupper() for c in letters), token
        assert got[quality.SHAPE] == quality._bucket(quality.shape(token)), token
        assert got[quality.BARE] == (not any(c.isalnum() for c in token))


def test_held_out_quality(spark):
    """No label is ever learned from, so all labelled documents are held out."""
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r.accepted for r in quality.quality(docs).collect()}
    pairs = [(got[r.doc_id], r.quality == 1) for r in labels.collect()]
    assert sum(a for a, good in pairs if good) / sum(good for _, good in pairs) > 0.98
    assert sum(not a for a, good in pairs if not good) / sum(not good for _, good in pairs) > 0.95


def test_odd_documents(spark):
    docs = odd.documents(spark)
    got = quality.quality(docs).collect()
    assert len(got) == len(odd.ROWS)
    assert not [r for r in got if r.doc_id in (3, 4, 5) and r.posterior > 0.5]
    kept = quality.keep_accepted(docs)
    assert kept.schema == docs.schema
    accepted = odd.rows_of(quality.quality(docs).where("accepted"), "doc_id")
    assert odd.rows_of(kept, "doc_id") == accepted
    assert quality.quality(odd.empty(spark)).count() == 0
    assert quality.keep_accepted(odd.empty(spark)).count() == 0
