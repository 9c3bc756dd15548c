"""Product codes against plain k-means in Python's whole numbers, and the bounds against all distances."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from feedward.llm import queries, vector_codes
from feedward.llm.vector_codes import Lists, closest, compress_vectors, distances, floor_scaled, limbs, next_width, part_slices, reassign

ROWS = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=16, entries=64, rounds=2):
    """(vec_id, code, error, label_error, digest) of the rows, by every distance in every round."""
    kept = [(i, [floor_scaled(x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = defaultdict(list)
    for row in sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        lengths[len(row[1])].append(row)
    found = []
    for length, group in lengths.items():
        cuts = part_slices(length, parts)
        books = [[v[cut] for _, v, _ in group[:entries]] for cut in cuts]

        def nearest(v, book):
            return min((sum((a - b) ** 2 for a, b in zip(v, e)), j) for j, e in enumerate(book))

        for number in range(rounds + 1):
            codes = [[nearest(v[cut], book) for cut, book in zip(cuts, books)] for _, v, _ in group]
            if number == rounds:
                break
            for p, cut in enumerate(cuts):
                for j in range(len(books[p])):
                    mine = [v[cut] for (_, v, _), code in zip(group, codes) if code[p][1] == j]
                    if mine:
                        books[p][j] = [sum(column) // len(mine) for column in zip(*mine)]
        digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
        for (i, _, label), code in zip(group, codes):
            found.append((i, label, bytes(j for _, j in code), sum(d for d, _ in code), digest))
    sums = Counter()
    for _, label, _, error, _ in found:
        sums[label] += error
    return Counter((i, code, error, sums[label], digest) for i, label, code, error, digest in found)


def coded(table, **options):
    return Counter(tuple(row) for row in compress_vectors(table, **options).select("vec_id", "code", "error", "label_error", "codebooks_sha256").collect())


def vectors(rng, count, length, spread=1.0):
    centres = rng.normal(size=(max(2, count // 20), length)) * spread
    return (centres[rng.integers(0, len(centres), count)] + rng.normal(size=(count, length)) * 0.1).tolist()


@pytest.mark.parametrize("rounds, listed", [(0, 8), (2, 8), (2, 1), (5, 3), (4, 70)])
def test_codes_are_those_of_plain_k_means(spark, rounds, listed):
    rng = np.random.default_rng(rounds)
    rows = [(1000 - i, v, i % 3 or None) for i, v in enumerate(vectors(rng, 300, 32))]
    assert coded(spark.createDataFrame(rows, ROWS), rounds=rounds, listed=listed) == plain(rows, rounds=rounds)


def test_ties_go_to_the_lower_entry(spark):
    rng = random.Random(5)
    rows = [(i // 2, [rng.choice([0.0, 0.005, -0.005, 0.01]) for _ in range(16)], 1) for i in range(200)]
    assert coded(spark.createDataFrame(rows, ROWS), rounds=3, listed=2) == plain(rows, rounds=3)


def test_partitioning_changes_nothing(spark):
    rng = np.random.default_rng(9)
    table = spark.createDataFrame([(i, v, i % 7) for i, v in enumerate(vectors(rng, 400, 16))], ROWS)
    assert coded(table.repartition(1), listed=4) == coded(table.repartition(9, "label"), listed=12)


def test_odd_rows(spark):
    good = vectors(np.random.default_rng(2), 70, 16)
    odd = [
        (1, None, 1), (2, [None] + [0.0] * 15, 1), (3, [math.nan] * 16, 1), (4, [math.inf] + [0.0] * 15, 2),
        (5, [], 2), (5, [], None), (6, [0.5], 2), (7, [1.0] * 17, None), (8, [-0.001] * 17, None), (None, [0.25] * 16, None),
        (9, [0.0] * 16, 3), (9, [0.0] * 16, 3), (10, [1e300] + [0.0] * 15, 4), (11, [-1.7e308, 1e25] + [0.0] * 14, 5),
        (12, [3e7] * 16, 6), (13, [2.0**40 + 0.3] * 16, 6),
    ]
    rows = odd + [(100 + i, v, i % 4) for i, v in enumerate(good)]
    table = spark.createDataFrame(rows, ROWS)
    for name in ("id", "vec", "length", "codes", "error", "label_error", "numbers", "t_place", "of", "total"):
        table = table.withColumn(name, F.lit("mine"))
    top = (1 << 63) - 1
    capped = Counter({(i, c, min(e, top), min(s, top), d): n for (i, c, e, s, d), n in plain(rows).items()})
    found = coded(table)
    assert len(found) == len(capped) and set(found) - set(capped) == set()
    assert found == capped
    assert compress_vectors(table.limit(0)).collect() == []
    assert compress_vectors(table.filter("vec_id < 5")).collect() == []
    one = coded(spark.createDataFrame([(1, [0.5] * 16, None)], ROWS))
    assert [(i, code, error) for i, code, error, _, _ in one] == [(1, bytes(16), 0)]


def test_lengths_beyond_the_bound_come_after(spark, monkeypatch):
    monkeypatch.setattr(vector_codes, "CODEBOOK_NUMBERS", 64 * 17)
    rng = np.random.default_rng(4)
    rows = [(i, v, i % 2) for n in (16, 17, 1) for i, v in enumerate(vectors(rng, 20, n))]
    assert coded(spark.createDataFrame(rows, ROWS)) == plain(rows)


def test_bounds_skip_most_distances_and_stay_below_them():
    rng = np.random.default_rng(6)
    centres = rng.integers(-200, 200, (64, 4))
    points = np.repeat(centres, 40, axis=0) + rng.integers(-5, 6, (2560, 4))
    book = centres + rng.integers(-3, 4, centres.shape)
    entry, squared, lists = closest(points, book, 8)
    assert (squared == distances(points, book).min(axis=1)).all()
    width = 8
    for _ in range(6):
        new = book + rng.integers(-2, 3, book.shape)
        moved = np.sqrt(((new - book) ** 2).sum(axis=1)) * (1 + 1e-12)
        packed = Lists(lists.entries, vector_codes._unpacked(vector_codes._packed(lists.lower)), vector_codes._unpacked(vector_codes._packed(lists.outer)))
        b = width - 1
        entry, squared, lists, needed = reassign(points, new, moved, packed, b)
        every = distances(points, new)
        assert (entry == every.argmin(axis=1)).all() and (squared == every.min(axis=1)).all()
        assert (needed == 1).mean() > 0.5
        actual = np.sqrt(every)
        for place in range(b):
            later = actual.copy()
            for earlier in range(place):
                later[np.arange(len(points)), lists.entries[:, earlier]] = np.inf
            assert (lists.lower[:, place] <= later.min(axis=1) + 1e-9).all()
        book, width = new, b


def test_width_follows_need():
    assert next_width(Counter({1: 990, 2: 5, 9: 5}), 8, 64) == 2
    assert next_width(Counter({1: 900, 5: 100}), 8, 64) == 5
    assert next_width(Counter({1: 900, 9: 100}), 8, 64) == 16
    assert next_width(Counter(), 8, 64) == 8


def test_small_pieces():
    for number in (0, 5, -5, 1 << 40, -(1 << 40), 3**400, -(3**400), (1 << 80) - 1):
        found = limbs(number)
        assert sum(limb << (40 * i) for i, limb in enumerate(found)) == number and all(abs(x) <= 1 << 40 for x in found)
    assert floor_scaled(-0.001) == -1 and floor_scaled(1e300) == int(1e300) * 256 and floor_scaled(0.999) == 255
    assert [s.stop - s.start for s in part_slices(18, 16)] == [2, 2] + [1] * 14
    with pytest.raises(ValueError):
        compress_vectors(None, entries=300)


def test_query_against_sql(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = [(i * 3 % 101, v, (None, 1, 2)[i % 3]) for i, v in enumerate(vectors(rng, 100, 32))] + [(500, None, 1), (501, [math.nan] * 32, 1)]
    spark.createDataFrame(rows, ROWS).withColumn("embedding", F.col("embedding").cast("array<float>")).write.parquet(f"{tmp_path}/embeddings.parquet")
    found = queries.op13_vector_codes(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    answer = con.execute(queries.SQL["op13_vector_codes"])
    assert [column[0] for column in answer.description] == found.columns
    assert Counter(tuple(row) for row in found.collect()) == Counter(answer.fetchall())
