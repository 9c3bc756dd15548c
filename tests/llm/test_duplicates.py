"""SimHash components and line dedup against brute force, with odd rows."""

import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedward.llm import lines, simhash
from feedward.llm.components import connected_components


def plain_fingerprint(text, size=3):
    found = re.findall("[^\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)}))
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aBc É\t\n\x0b\x1c 😀", max_size=40))
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_long_text():
    rng = random.Random(2)
    text = " ".join(rng.choices(["ab", "cd", "ef", "gh"], k=70_000))
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def components(nodes, linked):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def cloud(n, seed, spread=6):
    """Fingerprints in clusters, chains of small steps, and dense balls."""
    rng = np.random.default_rng(seed)
    points = []
    while len(points) < n:
        point = int(rng.integers(0, 1 << 63)) * 2 + int(rng.integers(0, 2))
        for _ in range(int(rng.integers(1, 40))):
            points.append(point)
            base = point if rng.random() < 0.5 else points[-1]
            for bit in rng.integers(0, spread if rng.random() < 0.5 else 64, int(rng.integers(1, 5))):
                base ^= 1 << int(bit)
            point = base
    return np.unique(np.array(points, np.uint64))


def close_pairs(points, reach):
    apart = np.bitwise_count(points[:, None] ^ points[None, :])
    return [(a, b) for a, b in zip(*np.nonzero(apart <= reach), strict=True) if a < b]


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("leaf", [8, 64, 10_000])
def test_local_roots(seed, leaf):
    points = cloud(1500, seed)
    expected = components(range(len(points)), close_pairs(points, 2))
    found = simhash.local_roots(points, 2, leaf)
    assert found.tolist() == [expected[i] for i in range(len(points))]


def test_every_close_pair_shares_a_shard():
    points = cloud(2000, 7)
    tree, count = simhash.build_tree(points[::2], 60, 2)
    assert count > 8
    home = [set() for _ in points]
    for shard, index in simhash.shards_of(tree, points, 2):
        for i in index:
            home[i].add(shard)
    assert all(home)
    assert all(home[a] & home[b] for a, b in close_pairs(points, 2))


def test_links_over_many_shards(spark):
    points = cloud(1200, 11)
    table = spark.createDataFrame([(int(p),) for p in points.view(np.int64)], "fp long")
    found = {r.fp: r.root for r in simhash.link_fingerprints(table, 2, sample_size=400, shard_size=50).collect()}
    expected = components(range(len(points)), close_pairs(points, 2))
    groups = {}
    for i, p in enumerate(points.view(np.int64).tolist()):
        groups.setdefault(expected[i], set()).add(found.get(p, p))
    assert all(len(roots) == 1 for roots in groups.values())
    assert len({r for roots in groups.values() for r in roots}) == len(groups)


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(220)]
    edges += [(i, i + 1) for i in range(1000, 1100)] + [(2000, 2001 + i) for i in range(300)] + [(5, 5), (7, 9), (9, 7)]
    table = spark.createDataFrame(edges, "a long, b long")
    found = {r.node: r.root for r in connected_components(table).collect()}
    expected = components({n for e in edges for n in e}, edges)
    assert found == {n: r for n, r in expected.items() if any(n in e and e[0] != e[1] for e in edges)}
    assert connected_components(table.limit(0)).count() == 0


def sample_docs(rng, n):
    words = [f"w{i}" for i in range(500)]
    base = [" ".join(rng.choices(words, k=rng.randint(20, 60))) for _ in range(15)]
    out = []
    for i in range(n):
        found = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            found[rng.randrange(len(found))] = rng.choice(words)
        out.append((i, " ".join(found)))
    return out


def test_near_duplicates_table(docs):
    rows = sample_docs(random.Random(4), 120) + [(200, None), (201, ""), (202, " \n"), (None, "w1 w2"), (203, "w1 w2"),
                                                  (None, "x"), (204, "y " * 50_000), (204, "y " * 50_000)]
    table = docs(*rows).withColumn("fp", F.lit(1)).withColumn("first", F.lit("z"))
    found = simhash.near_duplicates(table).collect()
    assert len(found) == len(rows)
    prints = np.array(sorted({plain_fingerprint(t or "") for _, t in rows}), np.uint64)
    place = {int(p): i for i, p in enumerate(prints)}
    root = components(range(len(prints)), close_pairs(prints, 2))
    group = {}
    for i, t in rows:
        group.setdefault(root[place[plain_fingerprint(t or "")]], []).append(i)
    expected = sorted(
        str((i, f"{plain_fingerprint(t or ''):016x}",
             min((j for j in group[root[place[plain_fingerprint(t or '')]]] if j is not None), default=None)))
        for i, t in rows
    )
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in found) == expected
    kept = simhash.drop_near_duplicates(table)
    assert kept.columns == table.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(group)
    assert sorted(map(str, ids)) == sorted(str(min((j for j in g if j is not None), default=None)) for g in group.values())
    assert simhash.near_duplicates(table.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(table.limit(0)).count() == 0


def plain_dedup(rows, min_words):
    """Deleted lines by definition: every run of enough words that stands earlier, by trying all runs."""
    order = sorted({(i is None, i or 0, text_key(t), t or "") for i, t in rows})
    seen, gone = {}, {}
    for doc, (_, _, _, text) in enumerate(order):
        found = [(n, line.strip(lines._BLANKS)) for n, line in enumerate(text.split("\n")) if line.split()]
        drop = set()
        for a in range(len(found)):
            for b in range(a, len(found)):
                run = tuple(line for _, line in found[a : b + 1])
                if sum(len(line.split()) for line in run) >= min_words:
                    if run not in seen:
                        seen[run] = (doc, found[b][0])
                    else:
                        first_doc, first_end = seen[run]
                        start = max(found[a][0], first_end + 1) if first_doc == doc else found[a][0]
                        drop.update(n for n, _ in found[a : b + 1] if n >= start)
        blank = [n for n, line in enumerate(text.split("\n")) if not line.split()]
        for n in blank:
            before, after = [m for m, _ in found if m < n], [m for m, _ in found if m > n]
            if before and after and before[-1] in drop and after[0] in drop:
                drop.add(n)
        gone[text] = gone.get(text, {}) | {order[doc][:3]: drop}
    return gone


def text_key(text):
    return KEYS.setdefault(text or "", len(KEYS))


KEYS = {}


@pytest.mark.parametrize("seed", range(4))
def test_line_dedup(spark, docs, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choices("abcdefgh", k=rng.choice([1, 1, 2, 3, 6]))) for _ in range(9)] + ["", "  ", " a b "]
    rows = [(rng.choice([i, i, None]) if i % 7 == 0 else i, "\n".join(rng.choices(pool, k=rng.randint(0, 14)))) for i in range(60)]
    rows += [(90, None), (91, ""), (3, rows[4][1]), (4, rows[4][1]), (95, "\n".join(["a b"] * 12))]
    table = docs(*rows).withColumn("runs", F.lit(1)).withColumn("start", F.lit(2))
    # The order among equal ids follows the hash of the text, so the plain version needs it.
    hashes = {r.text: r.h for r in table.select("text", simhash.text_hash(F.col("text")).alias("h")).collect()}
    KEYS.clear()
    KEYS.update({t or "": h for t, h in hashes.items()})
    gone = plain_dedup(rows, 5)
    found = lines.dedup_lines(table, min_words=5).collect()
    assert len(found) == len(rows)
    for r in found:
        drop = gone[r.text or ""][(r.doc_id is None, r.doc_id or 0, text_key(r.text))]
        kept = [line for n, line in enumerate((r.text or "").split("\n")) if n not in drop]
        assert r.deduped.deleted == len(drop), (r, drop)
        assert (r.deduped.text or "") == "\n".join(kept)
    after = lines.drop_repeated_lines(table, min_words=5)
    assert after.columns == table.columns
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in after.collect())
    assert {90, 91} <= {r.doc_id for r in after.collect()}
    assert lines.dedup_lines(table.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_passages(docs, seed):
    """Against all runs of words: none of 12 is left twice, only runs of 7 that stand earlier go, first ones stay."""
    rng = random.Random(seed)
    prose = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    pool = [prose(rng.choice([7, 12, 13, 20, 60])) for _ in range(8)]
    rows = []
    for i in range(50):
        found = []
        for _ in range(rng.randint(0, 4)):
            passage = rng.choice(pool)
            start = rng.choice([0, 0, rng.randrange(len(passage))])
            found += prose(rng.randint(0, 9)) + passage[start : start + rng.choice([5, 12, 30, 90])]
        rows.append((None if i % 9 == 8 else i, "".join(w + rng.choice([" ", " ", " ", "  ", "\n"]) for w in found)))
    rows += [(60, None), (61, ""), (62, "a b c " * 40), (63, rows[5][1]), (5, rows[5][1])]
    table = docs(*rows).withColumn("fp", F.lit(1)).withColumn("doc", F.lit(2))
    found = lines.dedup_lines(table, 10**6, passage_words=12, gram=7)
    assert found.count() == len(rows)
    hashes = {r.text: r.h for r in table.select("text", simhash.text_hash(F.col("text")).alias("h")).collect()}
    order = sorted({(r.doc_id is None, r.doc_id or 0, hashes[r.text], r.text or "", r.deduped.text or "") for r in found.collect()})
    runs = lambda words, n: [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
    seen, left, clean = set(), set(), 0
    for *_, before, after in order:
        before, after = before.split(), after.split()
        if not seen & set(runs(before, 7)) and len(set(runs(before, 7))) == len(runs(before, 7)):
            assert after == before
            clean += 1
        repeated, at, mine = [False] * len(before), 0, set()
        for i, run in enumerate(runs(before, 7)):
            if run in seen or run in mine:
                repeated[i : i + 7] = [True] * 7
            mine.add(run)
        for word, may_go in zip(before, repeated, strict=True):
            if at < len(after) and after[at] == word:
                at += 1
            else:
                assert may_go
        assert at == len(after)
        fresh = runs(after, 12)
        assert not left & set(fresh) and len(set(fresh)) == len(fresh)
        left.update(fresh)
        seen.update(runs(before, 7))
    assert clean > 5
    assert {w for *_, text, _ in order for w in text.split()} == {w for *_, text in order for w in text.split()}


def test_long_text_in_linear_time(docs):
    texts = ["a b c d e f g h i\n" * 50_000, "x\n" * 200_000, "y " * 300_000]
    found = {r.doc_id: r.deduped for r in lines.dedup_lines(docs(*enumerate(texts))).collect()}
    assert found[0].deleted == 49_999 and found[2].deleted == 0
    assert found[1].deleted == 200_000 - 8


def ball(rng, centre, count, most):
    """Distinct fingerprints, each a few bits from the centre."""
    found = {centre}
    while len(found) < count:
        point = centre
        for bit in rng.sample(range(64), rng.randint(1, most)):
            point ^= 1 << bit
        found.add(point)
    return found


def test_a_dense_ball_is_linked_without_one_group(spark, monkeypatch):
    rng = random.Random(12)
    points = ball(rng, rng.getrandbits(64), 1500, 4) | {rng.getrandbits(64) for _ in range(800)}
    fps = np.array(sorted(points), np.uint64)
    largest = []
    plain = simhash.dense_stars
    monkeypatch.setattr(simhash, "dense_stars", lambda found: largest.append(found.count()) or plain(found))
    table = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    found = {r.fp: r.root for r in simhash.link_fingerprints(table, 2, shard_size=100, most=300).collect()}
    assert largest and largest[0] >= 1000
    apart = np.bitwise_count(fps[:, None] ^ fps[None, :])
    linked = [(int(fps.view(np.int64)[a]), int(fps.view(np.int64)[b])) for a, b in zip(*np.nonzero((apart > 0) & (apart <= 2)), strict=True)]
    parent = {int(x): int(x) for x in fps.view(np.int64)}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    groups, expected = {}, {}
    for x in {a for a, _ in linked}:
        expected.setdefault(find(x), set()).add(x)
        groups.setdefault(found[x], set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))
    assert set(found) == {a for a, _ in linked}


def test_shards_do_not_grow_with_the_table():
    sizes = []
    for total in (10_000, 160_000):
        points = np.random.default_rng(total).integers(0, 1 << 64, total, np.uint64)
        sample = points[: simhash.sample_for(total, 64, 1 << 21)]
        tree, _ = simhash.build_tree(sample, max(32, int(len(sample) * 64 / total)), 2)
        sizes.append(max(len(index) for _, index in simhash.shards_of(tree, points, 2)))
    # Leaves are counted on half of the larger table, hence the spread; rows grow sixteenfold.
    assert sizes[1] <= 3 * sizes[0] < 16 * 64


CLASHES = [
    "id", "row", "hash", "text_hash", "run_id", "run_hash", "runs", "passages", "cut", "first", "first_id", "first_hash",
    "_hash", "_runs", "_passages", "_run_id", "_run_hash", "_cut", "_first_id", "_first_hash", "fp", "root", "component_id", "shard", "found",
]


@pytest.mark.parametrize("stage", [lines.drop_repeated_lines, simhash.drop_near_duplicates], ids=["line_dedup", "near_dedup"])
def test_stages_keep_columns_of_any_name(docs, stage):
    long_line = " ".join(f"word{i}" for i in range(70))
    table = docs((1, f"one\n{long_line}"), (2, f"{long_line}\ntwo"), (3, "three"), (None, None))
    plain = sorted((row.doc_id or 0, row.text or "") for row in stage(table).collect())
    for name in CLASHES:
        table = table.withColumn(name, F.concat(F.lit(f"{name} "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    found = stage(table)
    assert found.columns == table.columns
    rows = found.collect()
    assert sorted((row.doc_id or 0, row.text or "") for row in rows) == plain
    assert all(row[name] == f"{name} {'' if row.doc_id is None else row.doc_id}" for row in rows for name in CLASHES)
