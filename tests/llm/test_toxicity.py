"""Scores against a plain evaluation, slopes against differences, and accuracy on documents that no fit has seen."""

import random
import zlib

import numpy as np
import pytest

from terrasync.llm import toxicity

from .conftest import prose

LABELS = "doc_id bigint, toxic int, quality int, text string, score double"
INSULTS = ["blorg", "snarfle", "grubbit", "vokker"]


def held_out(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


@pytest.fixture(scope="module")
def corpus():
    """Every fifth document holds insults or words of an insulting stem; four in ten have a label."""
    rng, rows, labels = random.Random(11), [], []
    for i in range(900):
        text = prose(rng, rng.randint(15, 400)).split(" ")
        toxic = i % 5 == 0
        for _ in range(max(2, len(text) // 50) if toxic else 0):
            text[rng.randrange(len(text))] = rng.choice(INSULTS).upper() + "!" if i % 10 else "zzxwy" + prose(rng, 1)
        rows.append((i, " ".join(text)))
        if rng.random() < 0.4 and i != 5:
            labels.append((i, int(toxic), 1, "x", 0.5))
    return rows, labels


@pytest.fixture(scope="module")
def model(spark, corpus):
    rows, labels = corpus
    extra = [(None, 1, 1, "x", 0.5), (4, None, 1, "x", 0.5)]
    return toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels + extra, LABELS))


def test_held_out_accuracy(spark, corpus, model):
    rows, labels = corpus
    t = spark.createDataFrame([(i, t, "x", 1.0) for i, t in rows], "doc_id bigint, text string, id string, score double")
    found = {r.doc_id: r for r in toxicity.score_documents(t, model).collect()}
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for i, r in found.items()) and len(found) == len(rows)
    seen = [(i % 5 == 0, found[i].predicted) for i, _ in rows if held_out(i)]
    assert sum(t == p for t, p in seen) / len(seen) > 0.97
    unlabelled = [i for i, _ in rows if i % 5 == 0 and i not in {x[0] for x in labels} and not held_out(i)]
    assert np.mean([found[i].predicted for i in unlabelled]) > 0.9  # toxic ones that the fit took for unlabelled
    assert 0.1 < model.prior < 0.3


def test_score_is_the_sum_of_its_features(corpus, model):
    mean = model.weights.mean(axis=0)
    for _, t in [*corpus[0][:60], (0, ""), (0, "BLORG blorg, 7 #")]:
        z = mean[-1] + sum(mean[model.vocabulary[f]] for f in toxicity.features(t) if f in model.vocabulary)
        assert model.score(t) == pytest.approx(1 / (1 + np.exp(-z)))


def test_labels_of_the_held_out_fold_change_nothing(spark, corpus, model):
    rows, labels = corpus
    turned = [(i, 1 - t if held_out(i) else t, *rest) for i, t, *rest in labels]
    again = toxicity.fit(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(turned, LABELS))
    assert again.vocabulary == model.vocabulary and np.allclose(again.weights, model.weights)


def test_slopes(spark):
    rng = np.random.default_rng(2)
    for shift in (3.0, -6.0):  # the second makes the estimated risk of negatives negative
        p, u = rng.normal(size=20) + 3, rng.normal(size=30) + shift
        gp, gu = toxicity.slopes(p, u, 0.3)
        below = toxicity.risk(p, u, 0.3)[1] < 0
        assert below == (shift < 0)

        def lowered(p, u, below=below):
            a, b = toxicity.risk(p, u, 0.3)
            return -b if below else a + b

        for x, g, at in ((p, gp, lambda d: lowered(p + d, u)), (u, gu, lambda d: lowered(p, u + d))):
            e = np.eye(len(x)) * 1e-6
            assert np.allclose(g, [(at(d) - at(-d)) / 2e-6 for d in e], atol=1e-7)


def test_significance(spark):
    row = spark.createDataFrame([(10, 12), (1, 50), (0, 0), (3, 3)], "k long, n long").select(toxicity.significance("k", "n", 10, 110).alias("g")).collect()
    g = [r.g for r in row]
    assert g[0] > g[3] > 10 and g[1] < 0 and g[2] == 0


def test_odd_rows(spark, odd, odd_rows, none, model):
    found = toxicity.score_documents(odd, model)
    assert found.count() == len(odd_rows) and [r.held_out for r in found.collect() if r.doc_id is None] == [False]
    assert toxicity.score_documents(none, model).isEmpty()
    labels = spark.createDataFrame([(i, i % 2, 1, "x", 0.5) for i in range(20)], LABELS)
    assert isinstance(toxicity.fit(odd, labels), toxicity.Model)
    for docs, said in ((odd, labels.limit(0)), (none, labels), (odd, labels.where("toxic = 0"))):
        empty = toxicity.fit(docs, said)
        assert [r.score for r in toxicity.score_documents(odd, empty).collect()] == [0.0] * len(odd_rows)


def test_long_text_is_cut_between_words(monkeypatch):
    text = "Éa1b ccc\n" * 30
    whole = toxicity.words(text)
    monkeypatch.setattr(toxicity, "PIECE", 5)
    assert toxicity.words(text) == whole == {"éa": 30, "b": 30, "ccc": 30}
