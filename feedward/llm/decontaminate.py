"""Benchmark decontamination by Wu-Manber search over words.

Patterns are the windows of the benchmark items. A cursor stands on the last word of a
possible window; the shift table says, from the block of words that ends there, how far the
next window that contains such a block can be, and the cursor jumps. Where the shift is
zero, the block selects the windows that end with it, the first block narrows them down,
and the words themselves are compared. Windows of different lengths have tables each.
"""

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, free_name
from .words import words

Items = list[tuple[int, list[bytes]]]


class Patterns:
    """Shift table and suffix buckets of all windows of one length."""

    def __init__(self, length: int, items: Items):
        self.length = length
        self.block = min(2, length)
        self.items = items
        self.default = length - self.block + 1
        self.shift: dict[tuple, int] = {}
        self.buckets: dict[tuple, dict[tuple, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for number, (_, item) in enumerate(items):
            blocks = list(zip(*(item[i:] for i in range(self.block)), strict=False))
            for start in range(len(item) - length + 1):
                last = start + length - self.block
                self.buckets[blocks[last]][blocks[start]].append((number, start))
            for place, block in enumerate(blocks):
                # The least distance from this block to the end of a window that holds it.
                shift = max(0, self.default - 1 - place)
                if shift < self.shift.get(block, self.default):
                    self.shift[block] = shift

    def search(self, text: list[bytes]) -> Iterator[tuple[int, set[int]]]:
        """(start, items) of each place of the text where windows occur, in order."""
        length, shift, default, two = self.length, self.shift.get, self.default, self.block == 2
        at, end = length - 1, len(text)
        while at < end:
            last = (text[at - 1], text[at]) if two else (text[at],)
            if step := shift(last, default):
                at += step
                continue
            start = at - length + 1
            first = (text[start], text[start + 1]) if two else (text[start],)
            window, found = text[start : at + 1], set()
            for number, place in self.buckets[last].get(first, ()) if last in self.buckets else ():
                if number not in found and self.items[number][1][place : place + length] == window:
                    found.add(number)
            if found:
                yield start, found
            at += 1


def compile_patterns(items: Items, window: int) -> list[Patterns]:
    """Tables by window length: items of fewer words than a window are a window of their own."""
    by_length: dict[int, Items] = defaultdict(list)
    for item_id, item in items:
        if item:
            by_length[min(window, len(item))].append((item_id, item))
    return [Patterns(length, group) for length, group in sorted(by_length.items())]


def merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(ranges):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def find_hits(text: list[bytes], patterns: list[Patterns]) -> tuple[list[tuple[int, int]], set[int]]:
    """Merged ranges of hit words, and the ids of the items whose windows occur."""
    ranges: list[tuple[int, int]] = []
    ids: set[int] = set()
    for table in patterns:
        for start, found in table.search(text):
            if ranges and ranges[-1][0] <= start <= ranges[-1][1]:
                ranges[-1] = (ranges[-1][0], max(ranges[-1][1], start + table.length))
            else:
                ranges.append((start, start + table.length))
            ids.update(table.items[number][0] for number in found)
    return merged(ranges), ids


_COMPILED: dict[str, list[Patterns]] = {}


def _patterns(items: Broadcast, key: str, window: int) -> list[Patterns]:
    """The tables of a block of items, built once in each Python worker; only one block is kept."""
    if key not in _COMPILED:
        _COMPILED.clear()
        _COMPILED[key] = compile_patterns([(i, words(t)) for i, t in items.value], window)
    return _COMPILED[key]


def _item_blocks(benchmark: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[list]:
    """The items in blocks of about ``block_bytes`` of text, one at a time on the driver."""
    items = benchmark.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).dropna()
    total = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + total // block_bytes
    numbered = items.withColumn("block", F.pmod(F.xxhash64("id", "text"), F.lit(blocks)))
    for number in range(blocks):
        yield [(row.id, row.text) for row in numbered.filter(F.col("block") == number).toLocalIterator()]


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = 1 << 22,
) -> DataFrame:
    """Words of every document that lie in an occurrence of a benchmark window.

    Items are searched in blocks of ``block_bytes`` of text, so that neither the driver nor a
    worker ever holds more of a large benchmark; between blocks the state of the documents
    is written to the shared folder. Documents are never shuffled.

    A null or empty text has no words and no hits. An item without an id or words takes no part, a
    repeated item counts once. Repeated documents give repeated rows, null ids stay null, an
    empty table gives no rows and an empty benchmark no hits. Other columns are ignored;
    ``hits`` has the ranges of hit words (end exclusive) and ``items`` the item ids.
    """
    state = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("hits"),
        F.expr("cast(array() as array<string>)").alias("items"),
        F.lit(0).cast("long").alias("n_words"),
    )
    context = docs.sparkSession.sparkContext
    for number, block in enumerate(_item_blocks(benchmark, item_id_col, item_text_col, block_bytes)):
        if number:
            state = checkpointed(state)
        state = _search_block(state, context.broadcast(block), window)
    n_hit = F.aggregate("hits", F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"])
    return state.select(
        F.col("id").alias(id_col),
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "hits",
        "items",
    )


def _search_block(state: DataFrame, items: Broadcast, window: int) -> DataFrame:
    key = hashlib.sha256(repr(items.value).encode()).hexdigest() + f":{window}"
    names = ["n_words", "hits", "items"]

    @F.pandas_udf("n_words long, hits array<struct<start:long,end:long>>, items array<string>")
    def search(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        patterns = _patterns(items, key, window)
        for texts, hits, ids in batches:
            rows = []
            for text, known, seen in zip(texts, hits, ids, strict=True):
                found = words(text)
                ranges, more = find_hits(found, patterns)
                ranges = merged([(r["start"], r["end"]) for r in known] + ranges)
                rows.append((len(found), ranges, sorted({*seen, *more})))
            yield pd.DataFrame(rows, columns=names)

    wide = state.withColumn("found", search("text", "hits", "items"))
    return wide.select("id", "text", *(F.col(f"found.{name}").alias(name) for name in ("hits", "items", "n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without any benchmark window, whole and with all their columns.

    Documents with a null or empty text stay; so do null ids and repeated rows.
    """
    if "text" not in docs.columns:
        raise ValueError("documents need a column text")
    columns = docs.columns
    key = free_name(docs, "_row")
    # The whole row travels as the id, so nothing has to be joined back.
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias(key), F.col("text"))
    judged = find_contamination(packed, benchmark, id_col=key, **options)
    return judged.filter(~F.col("contaminated")).select(f"{key}.*")
