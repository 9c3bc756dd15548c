"""Periodic runs against a plain search over all periods, with odd rows."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedward.llm import queries
from feedward.llm.periodic import collapse, common_length, periodic_runs, solve_tile, tiles, word_codes, z_function


def plain_runs(words, least=12):
    """(start, length, period) by trying every period at every place."""
    found = {}
    for period in range(1, len(words) // 2 + 1):
        start = 0
        while start < len(words) - period:
            end = start
            while end < len(words) - period and words[end] == words[end + period]:
                end += 1
            if end + period - start >= max(least, 2 * period):
                found.setdefault((start, end + period), period)
            start = max(end, start + 1)
    return sorted((start, end - start, period) for (start, end), period in found.items())


def plain_collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return b" ".join(word for i, word in enumerate(words) if i not in gone).decode()


def texts(rng, count):
    for _ in range(count):
        n, letters = rng.choice([0, 1, 11, 12, 13, 30, 90]), rng.choice([1, 2, 3, 30])
        words = [f"w{rng.randrange(letters)}" for _ in range(n)]
        if n and rng.random() < 0.6:
            first = rng.randrange(n)
            period = rng.randint(1, max(1, (n - first) // 2))
            for i in range(first + period, n):
                words[i] = words[i - period]
        yield "".join(word + rng.choice([" ", "\n", "\t\v", "\f\r "]) for word in words)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=40), st.integers(1, 30))
def test_z_function_is_the_plain_one(words, last):
    words = np.array(words, np.int32)
    plain = {}
    for i in range(1, min(last, len(words) - 1) + 1):
        if length := next((k for k in range(len(words) - i) if words[k] != words[i + k]), len(words) - i):
            plain[i] = length
    assert z_function(words, min(last, len(words))) == plain if len(words) else True


def test_common_length_past_its_first_step():
    words = np.zeros(1000, np.int32)
    words[900] = 1
    assert common_length(words, 0, 1) == 899
    assert common_length(words, 901, 902) == 98


@pytest.mark.parametrize("n, least, stride", [(100, 12, 1), (1000, 12, 16), (10_000, 3, 64), (25, 12, 4096)])
def test_shortest_stretches_lie_whole_in_a_tile(n, least, stride):
    cut = list(tiles(n, least, stride))
    for octave in {octave for octave, _, _ in cut}:
        size = max(least, 2 * ((2 << octave) - 1))
        spans = [(start, end) for o, start, end in cut if o == octave]
        assert all(any(a <= s and s + size <= b for a, b in spans) for s in range(n - size + 1))
    assert max((octave for octave, _, _ in cut), default=-1) == max((k for k in range(20) if n >= max(least, 2 << k)), default=-1)


def test_tile_finds_every_period_of_its_octave():
    words = np.array([0, 1, 2, 0, 1, 2] * 8, np.int32)
    assert solve_tile(words, 1) == [(3, 0, 48)]
    assert sorted(solve_tile(words, 3)) == [(9, 0, 48), (12, 0, 48), (15, 0, 48)]


def test_codes_and_collapse():
    text = "é a\x1cb  é x " * 50
    words = text.encode().split()
    codes = word_codes(text)
    assert len(codes) == len(words)
    assert len(set(zip(codes.tolist(), words, strict=True))) == len(set(words)) == len(set(codes.tolist()))
    assert collapse("a b c d e f", [1, 2, 5], [3, 4, 6]) == "a e"
    assert collapse("a b c", [0], [3]) == "" and collapse(" ", [], []) == ""


@pytest.mark.parametrize("stride, spread", [(4096, 1 << 22), (1, 1 << 22), (8, 60)])
def test_runs_are_those_of_a_plain_search(spark, docs, stride, spread):
    rng = random.Random(stride)
    table = docs(*enumerate(texts(rng, 150)))
    rows = periodic_runs(table, stride=stride, spread_chars=spread).collect()
    assert len(rows) == 150
    by_id = dict(table.select("doc_id", "text").collect())
    for row in rows:
        words = by_id[row.doc_id].encode().split()
        runs = plain_runs(words)
        assert [tuple(run) for run in row.runs] == runs, by_id[row.doc_id]
        assert row.collapsed == plain_collapse(words, runs)
    assert sum(len(row.runs) for row in rows) > 40


def test_shorter_runs_where_asked(docs):
    (row,) = periodic_runs(docs((1, "x a b a b y")), min_words=4).collect()
    assert [tuple(run) for run in row.runs] == [(1, 4, 2)] and row.collapsed == "x a b y"


ODD = [(1, None), (2, ""), (3, " \n\t "), (None, "a " * 20), (4, "b " * 20), (4, "b " * 20), (5, "c d " * 300_000)]


def test_odd_rows(docs):
    table = docs(*ODD)
    for name in ("key", "runs", "collapsed", "octave", "start", "words", "id", "period", "end"):
        table = table.withColumn(name, F.lit("mine"))
    rows = periodic_runs(table, spread_chars=1 << 18).collect()
    found = Counter((row.doc_id, tuple(map(tuple, row.runs)), row.collapsed) for row in rows)
    assert found == {
        (1, (), ""): 1,
        (2, (), ""): 1,
        (3, (), ""): 1,
        (None, ((0, 20, 1),), "a"): 1,
        (4, ((0, 20, 1),), "b"): 2,
        (5, ((0, 600_000, 2),), "c d"): 1,
    }
    assert periodic_runs(table.limit(0)).count() == 0


def test_copies_keep_their_own_rows(docs):
    rows = periodic_runs(docs(*((i % 100, "x y " * 20) for i in range(300)))).collect()
    assert Counter(row.doc_id for row in rows) == dict.fromkeys(range(100), 3)
    assert {tuple(map(tuple, row.runs)) for row in rows} == {((0, 40, 2),)}


def test_query_against_plain_code(spark, docs, tmp_path):
    rng = random.Random(7)
    pairs = list(enumerate(texts(rng, 200))) + [(None, "q " * 30), (900, None)]
    docs(*pairs).write.parquet(f"{tmp_path}/documents.parquet")
    rows = {row.doc_id: row for row in queries.op11_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(rows) == len(pairs)
    planted = 0
    for doc_id, text in pairs:
        words = (text or "").encode().split()
        h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            g, n = h // 10, len(words)
            first = g % n
            period = 1 + (n - first) // (3 + g % 8)
            words = [words[i if i < first else first + (i - first) % period] for i in range(n)]
            planted += 1
        runs = plain_runs(words)
        row = rows[doc_id]
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
        expected = (None,) * 4 if best is None else (*best, 1000 * best[1] // best[2])
        assert (row.start, row.length, row.period, row.exponent_milli) == expected
        listed = "".join(f"{s},{length},{p}\n" for s, length, p in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(plain_collapse(words, runs).encode()).hexdigest()
    assert planted > 10
