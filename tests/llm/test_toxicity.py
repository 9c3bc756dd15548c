"""Toxicity: forward-backward against enumeration, held-out accuracy, odd rows."""

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from feedward.llm import toxicity as tox


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(0)
    emission, moves, start = rng.normal(size=(3, 5)), rng.normal(size=(2, 2)), rng.normal(size=2)
    sizes = [5, 3, 1]
    inside = np.arange(5) < np.array(sizes)[:, None]
    one, pairs = tox.forward_backward(emission, inside, moves, start, want_pairs=True)
    expected, expected_pairs = np.zeros((3, 5)), np.zeros((2, 2))
    for row, size in enumerate(sizes):
        total, marginal, joint = 0.0, np.zeros(5), np.zeros((2, 2))
        for path in itertools.product((0, 1), repeat=size):
            score = start[path[0]] + sum(emission[row, t] for t in range(size) if path[t])
            score += sum(moves[a, b] for a, b in itertools.pairwise(path))
            weight = np.exp(score)
            total += weight
            for t, state in enumerate(path):
                marginal[t] += weight * state
            for a, b in itertools.pairwise(path):
                joint[a, b] += weight
        expected[row], expected_pairs = marginal / total, expected_pairs + joint / total
    assert np.allclose(one, expected)
    assert np.allclose(pairs, expected_pairs)


@pytest.mark.parametrize("lead", [0, 8])
def test_chains_count_every_word_once(lead):
    sizes = np.array([0, 3, 64, 130, 0, 1, 65, 1000])
    cells, inside, counted = tox.chains(sizes, 64, lead)
    assert sorted(cells[counted]) == list(range(sizes.sum()))
    assert (counted <= inside).all() and (np.diff(inside.astype(int), axis=1) <= 0).all()
    if not lead:
        assert list(inside.sum(axis=1))[:6] == [3, 64, 64, 64, 2, 1]


def test_a_span_over_a_cut_is_scored_with_its_neighbours(monkeypatch):
    rng = np.random.default_rng(1)
    words = [b"w%d" % i for i in range(30)]
    own = {b"w" + word: float(x) for word, x in zip(words, rng.normal(size=30), strict=True)}
    sides = [dict(zip(words, rng.normal(size=30), strict=True)) for _ in range(2)]
    model = tox.ToxicityModel(own, *sides, bias=-1.0, moves=np.array([[0.5, -0.5], [-0.5, 1.5]]))
    texts = [[words[i] for i in rng.integers(0, 30, n)] for n in (300, 64, 65, 0, 112, 113)]
    cut = tox.Scorer(model).marginals(texts)
    monkeypatch.setattr(tox, "CHAIN", 4096)
    whole = tox.Scorer(model).marginals(texts)
    for a, b in zip(cut, whole, strict=True):
        assert np.abs(a - b).max(initial=0) < 0.02
    monkeypatch.setattr(tox, "CHAIN", 64)
    monkeypatch.setattr(tox, "LEAD", 0)
    assert max(np.abs(a - b).max(initial=0) for a, b in zip(tox.Scorer(model).marginals(texts), whole, strict=True)) > 0.1


def test_words_that_differ_late_are_two_words():
    one, other = b"x" * 70 + b"a", b"x" * 70 + b"b"
    assert tox.word_key(one) != tox.word_key(other) and tox.word_key(b"short") == b"short"
    model = tox.ToxicityModel({b"w" + tox.word_key(one): 5.0}, {tox.word_key(one): 2.0})
    assert model.scores_of(one)[:2] == (5.0, 2.0) and model.scores_of(other)[:2] == (0.0, 0.0)


def corpus(n, seed):
    rng = random.Random(seed)
    plain = ["".join(rng.choices("abdefghilmnoprstu", k=rng.randint(2, 8))) for _ in range(300)]
    bad = ["scumbag", "vileness", "vilest"]
    rows = []
    for i in range(n):
        text = rng.choices(plain, k=rng.randint(5, 150))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(rng.randint(1, 3)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        rows.append((i, " ".join(text).capitalize() + "\nÉNOUGH Said.", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def trained(spark, docs):
    rows = corpus(600, 1)
    table = docs(*[r[:2] for r in rows])
    labels = spark.createDataFrame([(r[0], 1, r[2]) for r in rows], "doc_id long, quality int, toxic int")
    return rows, table, labels, tox.train_toxicity(table, labels)


def test_held_out_documents_are_judged_well(trained):
    rows, table, _, model = trained
    truth = {r[0]: r[2] for r in rows}
    found = tox.score_toxicity(table, model).collect()
    assert len(found) == 600
    held = [r for r in found if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if zlib.crc32(str(i).encode()) % 4 == 2}
    wrong = [r for r in held if r.predicted != truth[r.doc_id]]
    assert len(wrong) <= 0.03 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in found)
    texts = {r[0]: r[1] for r in rows}
    words = {texts[r.doc_id][s.start : s.end] for r in held for s in r.found}
    assert "scumbag" in {w.lower() for w in words}


def test_held_out_labels_are_not_used(spark, trained):
    _, table, labels, model = trained
    lying = labels.withColumn("toxic", F.when(tox.is_held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    other = tox.train_toxicity(table.withColumn("lang", F.lit("zz")), lying)
    assert other.own == model.own and np.array_equal(other.calibration, model.calibration)


def test_odd_rows(spark, docs, trained):
    _, _, labels, model = trained
    table = docs((1, None), (2, ""), (None, "you scumbag"), (4, "fine words"), (4, "fine words"), (5, "so " * 200_000))
    table = table.withColumn("score", F.lit("x")).withColumn("toxic", F.lit(1))
    rows = tox.score_toxicity(table, model).collect()
    by_id = {r.doc_id: r for r in rows}
    assert len(rows) == 6
    assert by_id[None].predicted == 1 and not by_id[None].held_out
    assert by_id[1].score == by_id[2].score and by_id[1].predicted == 0
    assert by_id[5].predicted == 0
    assert tox.score_toxicity(table.limit(0), model).count() == 0
    nothing = tox.train_toxicity(table, labels.limit(0))
    assert {r.score for r in tox.score_toxicity(table, nothing).collect()} == {0.0}


def test_filter_keeps_columns(trained):
    rows, table, labels, _ = trained
    extra = table.withColumn("predicted", F.lit("mine"))
    kept = tox.drop_toxic(extra, labels)
    assert kept.columns == extra.columns
    kept_ids = {r.doc_id for r in kept.collect()}
    clean = {r[0] for r in rows if not r[2]}
    assert len(kept_ids & clean) >= 0.98 * len(clean)
    assert len(kept_ids - clean) <= 0.05 * len(rows)
