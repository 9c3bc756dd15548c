"""Bloom filter cascades: exact answers, bits of every key, rows and sizes on the driver."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from feedward.llm import urlfilter as uf


def keys(spark, start, end):
    return spark.range(start, end).selectExpr("concat('host', id, '.com') AS key")


def test_filters_are_filled_from_words(spark, monkeypatch):
    listed, universe = keys(spark, 0, 20_000), keys(spark, 10_000, 50_000)
    frame, rows = type(listed), []
    plain, arrow = frame.toLocalIterator, frame.toArrow
    monkeypatch.setattr(frame, "toLocalIterator", lambda self, *a: (rows.append(1) or r for r in plain(self, *a)))
    monkeypatch.setattr(frame, "toArrow", lambda self: rows.extend([1] * (out := arrow(self)).num_rows) or out)
    monkeypatch.setattr(uf, "PART_WORDS", 100, raising=False)
    cascade = uf.build_cascade(listed, universe, universe.count())
    assert len(rows) <= sum(-(-level.bits // 64) for level in cascade.levels)
    first = cascade.levels[0]
    wanted = {p for i in range(20_000) for p in first.positions(f"host{i}.com")}
    assert {p for p in range(first.bits) if first.bitmap[p >> 3] >> (p & 7) & 1} == wanted
    assert all(cascade.has(f"host{i}.com") == (i < 20_000) for i in range(10_000, 50_000))


def test_size_is_checked_before_a_filter_is_filled(spark, monkeypatch):
    listed = keys(spark, 0, 1000)
    monkeypatch.setattr(uf, "_filled", lambda level, keys: pytest.fail("filled a filter that is too large"))
    with pytest.raises(ValueError):
        uf.build_cascade(listed, listed, 1000, max_bytes=16)


def plain(url, rules, default="allow"):
    """(host, path, rule, verdict) by trying every rule."""
    host = path = ""
    if url is not None and "://" in url:
        tail = url[url.index("://") + 3 :]
        cut = min([tail.index(c) for c in "/?#" if c in tail], default=len(tail))
        host, rest = tail[:cut].translate({c: c + 32 for c in range(65, 91)}), tail[cut:]
        path = rest[: min([rest.index(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h + p), len(h), v == "block", h + p, v)
        for h, p, v in rules
        if None not in (h, p, v) and (host == h or host.endswith(f".{h}")) and path.startswith(p)
    ]
    *_, rule, verdict = max(fits, default=(None, default))
    return host, path, rule, verdict


def many_rules(rng, count):
    hosts = ["com", "a.com", "b.a.com", "net", "x.net", "org"]
    return [
        (rng.choice(hosts), "/" + "".join(rng.choice("ab/") for _ in range(rng.randint(0, 12))), rng.choice(["allow", "block"]))
        for _ in range(count)
    ]


def urls(rng, count):
    hosts = ["com", "A.com", "b.a.com", "c.b.a.com", "net", "x.NET", "xnet", "org", ""]
    return [
        f"{rng.choice(['http', 'ftp', ''])}://{rng.choice(hosts)}/" + "".join(rng.choice("ab/?#") for _ in range(rng.randint(0, 20)))
        for _ in range(count)
    ]


ODD = [None, "", "no scheme.com/", "http://", "://com", "http://com?x/", "http://com#/", "http://COM/" + "ab/" * 50_000, "http://é.com/a", "a://b://com/"]


@pytest.mark.parametrize("max_bytes", [uf.MAX_BYTES, 200])
def test_verdicts_are_those_of_every_rule(spark, max_bytes):
    rng = random.Random(max_bytes)
    rules = [*many_rules(rng, 60), ("com", "/a", "allow"), ("com", "/a", "block"), ("a.com", "/", "block"), ("com", "/aa", "allow"),
             (None, "/", "block"), ("org", None, "block"), ("net", "/", None)]
    found = ODD + urls(rng, 300)
    rows = [(i // 2, url) for i, url in enumerate(found)] + [(7, found[20]), (7, found[20]), (None, found[30])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    for name in ("host", "path", "rule", "verdict", "key", "_tail", "_rest", "_judged"):
        pages = pages.withColumn(name, F.lit("mine"))
    listed = uf.rules_table(spark, rules).withColumn("note", F.lit(None).cast("string"))
    judged = uf.judge_urls(pages, listed, max_bytes=max_bytes)
    assert judged.columns == ["page_id", "host", "path", "rule", "verdict"]
    expected = Counter((i, *plain(url, rules)) for i, url in rows)
    assert Counter(tuple(row) for row in judged.collect()) == expected


def test_empty_lists_and_tables(spark):
    pages = spark.createDataFrame([(1, "http://com/")], "page_id long, url string")
    none = uf.rules_table(spark, [("com", "/", "allow")]).limit(0)
    assert [tuple(row) for row in uf.judge_urls(pages, none, default="block").collect()] == [(1, "com", "/", None, "block")]
    assert uf.judge_urls(pages.limit(0), uf.rules_table(spark, [("com", "/", "block")])).collect() == []


def test_only_passing_keys_leave_the_pages(spark, monkeypatch):
    """Five hundred path lengths make hundreds of candidates a page, nearly all of which stay where they are."""
    rng = random.Random(3)
    rules = [("com", "/" + "".join(rng.choice("ab") for _ in range(n)), "block") for n in range(500)]
    rows = [(i, "http://www.x.com/" + "".join(rng.choice("ab") for _ in range(600))) for i in range(200)]
    rows += [(1000, f"http://com{rules[400][1]}c")]
    sizes, plain_build = [], uf.build_cascade
    monkeypatch.setattr(uf, "build_cascade", lambda listed, universe, *rest: sizes.append((universe.count(), rest[0])) or plain_build(listed, universe, *rest))
    judged = uf.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), uf.rules_table(spark, rules))
    found = {row.page_id: (row.rule, row.verdict) for row in judged.collect()}
    assert found == {i: plain(url, rules)[2:] for i, url in rows}
    assert all(universe < 3_000 and candidates > 90_000 for universe, candidates in sizes)
