"""Decontamination and licence scan against plain searches, with odd rows."""

import hashlib
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from feedward.llm import decontaminate as dc
from feedward.llm import licenses as lic
from feedward.llm.words import words

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = {c: c + 32 for c in range(65, 91)}
few = st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_words_are_those_of_the_pattern(text):
    expected = WORD.findall(text.translate(LOWER))
    assert [w.decode("utf-8", "surrogatepass") for w in words(text)] == expected


def plain_hits(text, items, window):
    hit, ids = set(), set()
    for item_id, item in items:
        n = min(window, len(item))
        windows = {tuple(item[i : i + n]) for i in range(len(item) - n + 1)} if n else set()
        for i in range(len(text) - n + 1):
            if n and tuple(text[i : i + n]) in windows:
                hit.update(range(i, i + n))
                ids.add(item_id)
    return hit, ids


@settings(max_examples=400, deadline=None)
@given(few, st.lists(few, max_size=4), st.integers(1, 6))
def test_search_finds_every_window(text, items, window):
    items = list(enumerate(items))
    ranges, ids = dc.find_hits(text, dc.compile_patterns(items, window))
    assert ({i for s, e in ranges for i in range(s, e)}, ids) == plain_hits(text, items, window)
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:], strict=False))


@pytest.fixture(scope="module")
def bench(spark):
    def build(*rows):
        return spark.createDataFrame(list(rows), "item_id long, text string")

    return build


@pytest.mark.parametrize("block_bytes", [1 << 22, 40])
def test_contamination_table(docs, bench, block_bytes):
    rng = random.Random(5)
    word = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(word, k=rng.randint(2, 14)))) for i in range(12)]
    items += [(3, items[3][1]), (None, "w1 w2"), (50, None), (51, ""), (52, "!!")]
    texts = []
    for i in range(60):
        text = " ".join(rng.choices(word, k=rng.randint(0, 30)))
        texts.append((i % 50, text + " " + rng.choice(items[:12])[1].upper() if i % 3 else text))
    texts += [(None, items[0][1]), (60, None), (61, "")]
    table = docs(*texts).withColumn("item_id", F.lit(1)).withColumn("hits", F.lit("x"))
    rows = dc.find_contamination(table, bench(*items), window=5, block_bytes=block_bytes).collect()
    known = [(str(i), words(t)) for i, t in items if i is not None and t]
    expected = []
    for doc_id, text in texts:
        found = words(text or "")
        hit, ids = plain_hits(found, known, 5)
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        expected.append((doc_id, len(found), len(hit), len(ids), digest, bool(hit)))
    assert sorted(map(str, (tuple(r)[:6] for r in rows))) == sorted(map(str, expected))
    kept = dc.drop_contaminated(table, bench(*items), window=5, block_bytes=block_bytes)
    assert kept.columns == table.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(e[0] for e in expected if not e[5])


def test_empty_tables(docs, bench):
    assert dc.find_contamination(docs((1, "a b")), bench()).collect()[0].n_hit == 0
    assert dc.find_contamination(docs(), bench((1, "a"))).count() == 0
    assert lic.scan_licenses(docs()).count() == 0


LIC = ["cc", "by", "general", "public", "license", "all", "rights", "reserved", "mit", "the", "x"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(LIC), max_size=40))
def test_base_phrases_are_found(text):
    index = INDEX
    _, n_base, first, last, base, labels, score, _ = index.row(" ".join(text))
    places = sorted(
        (i, label)
        for phrase, label in lic.PHRASES.items()
        for i in range(len(text))
        if text[i : i + len(phrase.split())] == phrase.split()
    )
    assert n_base == len(places)
    assert (first, last) == ((places[0][0], places[-1][0]) if places else (None, None))
    assert base == ",".join(sorted({label for _, label in places}))
    assert set(filter(None, base.split(","))) <= set(filter(None, labels.split(",")))
    assert (score == 1.0) if places else (0 <= score <= 1)


INDEX = lic.LicenceIndex()


@settings(max_examples=200, deadline=None)
@given(st.lists(few, min_size=1, max_size=3), few)
def test_matching_statistics(templates, text):
    """The automaton knows the longest template part ending at each word, and where it stands."""
    index = lic.LicenceIndex({}, {str(i): (b" ".join(t).decode(),) for i, t in enumerate(templates)}, min_match=1)
    auto = index.automaton
    parts = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    state = size = 0
    for at, word in enumerate(text):
        while state and word not in auto.next[state]:
            state = auto.link[state]
            size = auto.length[state]
        if word in auto.next[state]:
            state, size = auto.next[state][word], size + 1
        best = max((n for n in range(at + 2) if tuple(text[at + 1 - n : at + 1]) in parts), default=0)
        assert size == best
        if size:
            found = text[at + 1 - size : at + 1]
            ends = [(k, j) for k, t in enumerate(templates) for j in range(size, len(t) + 1) if t[j - size : j] == found]
            assert auto.ends[state] == sorted(ends)


def test_templates_are_chained(docs):
    mit = " ".join(lic.TEMPLATES["mit"][0].split())
    changed = mit.replace("free of charge", "at no cost")
    table = docs((1, f"Intro. {mit} End."), (2, changed), (3, mit[:60]), (4, None), (5, ""), (5, ""), (None, "CC BY"),
                 (6, "word " * 200_000)).withColumn("labels", F.lit(1))
    rows = {r.doc_id: r for r in lic.scan_licenses(table).collect()}
    assert rows[1].labels == "mit" and rows[1].score == 1.0
    assert (rows[1].found[0].start, rows[1].found[0].end) == (1, 1 + len(words(mit)))
    assert rows[2].labels == "mit" and 0.75 <= rows[2].score < 1
    assert rows[3].labels == "" and 0 < rows[3].score < 0.75
    assert rows[4].n_words == rows[5].n_words == 0 and rows[4].labels == ""
    assert rows[None].labels == "cc-by" and rows[None].first_word == rows[None].last_word == 0
    assert rows[6].n_words == 200_000


def whole_templates(text):
    """(label, start, end) of every template that stands whole in the text, by comparing at every word."""
    for label, texts in lic.TEMPLATES.items():
        for template in map(words, texts):
            n = len(template)
            yield from ((label, i, i + n) for i in range(len(text) - n + 1) if text[i : i + n] == template)


ALL_TEMPLATES = [words(text) for texts in lic.TEMPLATES.values() for text in texts]
PHRASE_WORDS = [[b"cc", b"by"], [b"all", b"rights", b"reserved"]]
notices = st.sampled_from(ALL_TEMPLATES).flatmap(
    lambda t: st.tuples(st.integers(0, len(t)), st.integers(0, len(t))).map(lambda cut: t[min(cut) : max(cut)])
)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(notices, st.sampled_from([[b"x"], *ALL_TEMPLATES, *PHRASE_WORDS])), max_size=5))
def test_every_whole_template_is_credited(parts):
    text = [word for part in parts for word in part]
    _, _, _, _, _, labels, score, found = INDEX.row(b" ".join(text).decode())
    wholes = list(whole_templates(text))
    assert {label for label, *_ in wholes} <= set(labels.split(","))
    for label, start, end in wholes:
        assert score == 1.0
        assert any(name == label and s <= start and end <= e and share == 1.0 for name, s, e, share in found)


def test_truncated_notices_keep_the_whole_template_they_begin_with():
    for template in ALL_TEMPLATES:
        for size in range(1, len(template) + 1):
            text = template[:size] + [b"x"]
            _, _, _, _, base, labels, score, _ = INDEX.row(b" ".join(text).decode())
            wholes = {label for label, *_ in whole_templates(text)}
            assert wholes <= set(labels.split(","))
            assert score == 1.0 if wholes or base else score < 1.0
    _, _, _, _, _, labels, score, found = INDEX.row('Licensed under the Apache License, Version 2.0 (the "License").')
    assert (labels, score) == ("apache-2.0", 1.0)
    assert found == [("apache-2.0", 0, 8, 1.0)]
