"""Mixing: exponent by definition, budgets, epochs, and the documents taken against brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from feedward.llm import mixing


def tokens_table(spark, sizes):
    return spark.createDataFrame([(t,) for t in sizes], "tokens long")


def weights(sizes, a):
    total = sum(sizes)
    parts = [(t / total) ** a for t in sizes]
    return [p / sum(parts) for p in parts]


def entropy(w):
    return -sum(p * math.log(p) for p in w) / math.log(len(w))


def test_exponent_meets_target_entropy(spark):
    sizes = [1_000_000, 50_000, 7_000, 300]
    a = mixing.find_exponent(tokens_table(spark, sizes), sum(sizes), 0.8, None)
    assert abs(entropy(weights(sizes, a)) - 0.8) < 1e-6
    assert mixing.find_exponent(tokens_table(spark, [5, 5, 5]), 15, 0.9, None) == 1.0
    assert mixing.find_exponent(tokens_table(spark, [5]), 5, 0.9, 4) == 1.0


def test_exponent_keeps_the_repetition_limit(spark):
    sizes = [1_000_000, 50_000, 7_000, 300]
    a = mixing.find_exponent(tokens_table(spark, sizes), sum(sizes), 0.99, 4.0)
    repeats = [w * sum(sizes) / t for w, t in zip(weights(sizes, a), sizes, strict=True)]
    assert 3.99 < max(repeats) <= 4.0 + 1e-6


def corpus(seed, n=900):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = rng.choice(["big"] * 12 + ["mid"] * 3 + ["small", None])
        rows.append((i, " ".join(["w"] * rng.randint(0, 30)), "en", source, 0))
    rows += [(5, rows[5][1], "en", rows[5][3], 0), (None, "a b c", "en", "big", 0), (2000, None, "en", "big", 0)]
    rows += [(3000 + i, "", "en", "blank", 0) for i in range(3)]
    return rows


@pytest.mark.parametrize("block_docs", [16, 4096])
def test_mix(spark, block_docs):
    rows = corpus(1)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    table = table.withColumn("mix_epoch", F.lit("mine")).withColumn("weight", F.lit(1))
    mixed = mixing.mix_sources(table, entropy=0.95, max_epochs=3.0, block_docs=block_docs)
    assert mixed.columns == [*table.columns, "_mix_epoch", "mix_block", "mix_order"]
    found = mixed.collect()
    size = Counter()
    for _, text, _, source, _ in rows:
        size[source] += len((text or "").split())
    total = sum(size.values())
    del size["blank"]
    names = list(size)
    a = mixing.find_exponent(tokens_table(spark, [size[s] for s in names]), total, 0.95, 3.0)
    assert 0 < a < 1
    taken, per_epoch = Counter(), defaultdict(Counter)
    for r in found:
        taken[r.source] += len((r.text or "").split())
        per_epoch[r.source, r._mix_epoch][r.doc_id, r.text] += 1
    assert set(taken) == set(names)
    whole = {s: Counter((i, t) for i, t, _, x, _ in rows if x == s) for s in names}
    for name, weight in zip(names, weights([size[s] for s in names], a), strict=True):
        budget = math.floor(weight * total)
        # The next document in order did not fit any more.
        assert budget - 2 * 30 <= taken[name] <= budget
        full, rest = divmod(budget, size[name])
        for epoch in range(full):
            assert per_epoch[name, epoch] == whole[name]
        part = per_epoch[name, full]
        assert all(n == whole[name][key] for key, n in part.items())
        assert sum(len((t or "").split()) * n for (_, t), n in part.items()) <= rest
        assert max(e for s, e in per_epoch if s == name) <= full
    blocks = {(r.source, r._mix_epoch, r.mix_block): r.mix_order for r in found}
    assert all(blocks[r.source, r._mix_epoch, r.mix_block] == r.mix_order for r in found)


def test_broadcast_only_small_tables(spark, monkeypatch):
    rows = corpus(2, 200)
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    key = lambda r: str(tuple(r))
    expected = sorted(mixing.mix_sources(table, entropy=0.95).collect(), key=key)
    monkeypatch.setattr(mixing, "SMALL", 0)
    assert sorted(mixing.mix_sources(table, entropy=0.95).collect(), key=key) == expected


def test_empty(spark):
    table = spark.createDataFrame([(1, "", "en", "a", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    assert mixing.mix_sources(table.limit(0)).count() == 0
    assert mixing.mix_sources(table).count() == 0
