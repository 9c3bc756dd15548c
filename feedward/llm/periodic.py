"""Periodic run detection: overlapping tiles per period octave, boundary Z-functions, stitched intervals.

A run is a longest stretch of words in which words one period apart are equal, of at least two
periods and ``min_words`` words. Every text becomes tiles: for periods from ``lo`` to
``2 * lo - 1``, ``lo`` a power of two, tiles overlap by ``max(4 * lo, min_words)`` words, so the
shortest stretch that counts lies whole in some tile, and neighbouring tiles that see parts of one
run see at least a period of it in common. Each tile is solved alone. It has a boundary every
``lo`` words, and a run of the octave repeats across one of them: Z-functions give how far the words
after the boundary, and the words before it, agree with those a period further on. What a tile finds
is a fragment. Fragments are shuffled by document and period and stitched where they share a period
or more; a stretch that has several periods keeps its smallest.
"""

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .common import written
from .words import blank_words

MIN_WORDS = 12
#: Least distance between the starts of two tiles; in high octaves it is eight times the least period.
STRIDE = 4096
#: Tiles of longer texts (in characters) are dealt over all tasks.
SPREAD_CHARS = 1 << 22

_FRAGMENT = pa.schema([("key", pa.string()), ("period", pa.int64()), ("start", pa.int64()), ("end", pa.int64())])
_TILE = pa.schema([("key", pa.string()), ("octave", pa.int32()), ("start", pa.int64()), ("words", pa.binary())])
_FRAGMENT_ROWS = 10_000


def word_codes(text: str) -> np.ndarray:
    """A number for each word; equal words, and only those, have equal numbers."""
    numbers: dict[bytes, int] = {}
    codes = []
    for words in blank_words(text.encode("utf-8", "surrogatepass")):
        for word in dict.fromkeys(words):
            if word not in numbers:
                numbers[word] = len(numbers)
        codes.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
    return np.concatenate(codes) if codes else np.zeros(0, np.int32)


def tiles(n: int, min_words: int = MIN_WORDS, stride: int = STRIDE) -> Iterator[tuple[int, int, int]]:
    """(octave, start, end) of the tiles of a text of n words."""
    octave = 0
    while n >= max(min_words, 2 << octave):
        lo = 1 << octave
        overlap, step = max(4 * lo, min_words), max(stride, 8 * lo)
        for start in range(0, max(1, n - overlap), step):
            yield octave, start, min(n, start + step + overlap)
        octave += 1


def common_length(words: np.ndarray, a: int, b: int) -> int:
    """How many words from a on equal those from b on; a < b."""
    done, step = 0, 16
    while (size := min(step, len(words) - b - done)) > 0:
        differ = words[a + done : a + done + size] != words[b + done : b + done + size]
        first = int(differ.argmax())
        if differ[first]:
            return done + first
        done += size
        step *= 2
    return done


def z_function(words: np.ndarray, last: int) -> dict[int, int]:
    """How many words from i on equal the first ones, for 1 <= i <= last; zeros are left out.

    Only places that start with the first word are visited. Inside a stretch already known to
    repeat the beginning, the value is read off there, so no word is compared twice.
    """
    places = np.flatnonzero(words[1 : last + 1] == words[0]) + 1
    if not len(places):
        return {}
    longer = np.zeros(len(places), bool)
    inside = places < len(words) - 1
    longer[inside] = words[places[inside] + 1] == words[1]
    values = dict.fromkeys(places[~longer].tolist(), 1)
    left = right = 0
    for place in places[longer].tolist():
        known = 2
        if place < right:
            known = values.get(place - left, 0)
            if known < right - place:
                values[place] = known
                continue
            known = max(2, right - place)
        values[place] = known = known + common_length(words, known, place + known)
        if place + known > right:
            left, right = place, place + known
    return values


def _suspects(words: np.ndarray, lo: int, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(boundary, period) pairs that may lie inside a stretch long enough, by the words next to them."""
    blocks = -(-len(words) // lo)
    least = min(16, max(lo, -(-min_words // 2)))  # places in a row that equal those a period on
    after, before = least // 2 + 1, least - least // 2
    padded = np.full(before + blocks * lo + after, -1, np.int32)
    padded[before : before + len(words)] = words
    grid = padded[before : before + blocks * lo].reshape(blocks, lo)
    at = np.flatnonzero(grid[1:] == grid[:-1, :1])
    boundary, other = at // lo * lo + before, at + lo + before
    onwards, back = _agreeing(padded, boundary, other, range(1, after)), _agreeing(padded, boundary, other, range(-1, -before - 1, -1))
    kept = np.union1d(onwards, back) if len(onwards) and len(back) else onwards if len(onwards) else back
    return boundary[kept] - before, other[kept] - boundary[kept]


def _agreeing(words: np.ndarray, one: np.ndarray, other: np.ndarray, steps: range) -> np.ndarray:
    """Numbers of the pairs of places that agree at every step from them."""
    kept = np.arange(len(one))
    for step in steps:
        if not len(kept):
            break
        kept = kept[words[one[kept] + step] == words[other[kept] + step]]
    return kept


def solve_tile(words: np.ndarray, octave: int, min_words: int = MIN_WORDS) -> list[tuple[int, int, int]]:
    """(period, start, end) of the longest stretches in the tile, for all periods of the octave.

    A period may be a multiple of the stretch's smallest one.
    """
    lo = 1 << octave
    found: list[tuple[int, int, int]] = []
    boundaries, periods = _suspects(words, lo, min_words)
    if not len(boundaries):
        return found
    starts = [0, *(np.flatnonzero(boundaries[1:] != boundaries[:-1]) + 1).tolist()]
    done = np.zeros(lo, np.int64)  # per period: up to where its stretches are known
    for first, last in zip(starts, [*starts[1:], len(boundaries)], strict=True):
        boundary, group = int(boundaries[first]), periods[first:last]
        group = group[done[group - lo] <= boundary]
        if not len(group):
            continue
        reach = min(2 * lo - 1, len(words) - boundary)
        onwards = z_function(words[boundary:], reach)
        # A boundary further back has already been in any stretch that reaches that far.
        before = words[max(0, boundary - lo) : boundary][::-1]
        back: dict[int, int] = {}
        if len(before):
            both = np.concatenate([before, [-1], words[boundary - len(before) : boundary + reach][::-1]])
            back = z_function(both, len(before) + reach)
        for period in group.tolist():
            start = boundary - back.get(len(before) + 1 + reach - period, 0)
            end = boundary + period + onwards.get(period, 0)
            done[period - lo] = end - period
            if end - start >= max(min_words, 2 * period):
                found.append((period, start, end))
    return found


def _document_tiles(batch: pa.RecordBatch, min_words: int, stride: int) -> Iterator[tuple[str, int, int, np.ndarray]]:
    """(key, octave, start, words) of every tile of the batch's texts, one text at a time."""
    for key, text in zip(batch["key"], batch["text"], strict=True):
        codes = word_codes(text.as_py() or "")
        for octave, start, end in tiles(len(codes), min_words, stride):
            yield key.as_py(), octave, start, codes[start:end]


def _fragments(found: Iterable[tuple[str, int, int, np.ndarray]], min_words: int) -> Iterator[pa.RecordBatch]:
    """Solve tiles, each alone, and give out their fragments by document and period."""
    rows: list[tuple[str, int, int, int]] = []
    for key, octave, offset, words in found:
        rows += [(key, period, offset + start, offset + end) for period, start, end in solve_tile(words, octave, min_words)]
        if len(rows) > _FRAGMENT_ROWS:
            yield _batch(rows, _FRAGMENT)
            rows = []
    if rows:
        yield _batch(rows, _FRAGMENT)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _solve_texts(min_words: int, stride: int):
    """Tiles of whole texts, cut and solved in the task that reads them."""

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _fragments(_document_tiles(batch, min_words, stride), min_words)

    return solve


def _cut_texts(min_words: int, stride: int):
    """Tiles as rows, to be dealt."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, octave, start, words in _document_tiles(batch, min_words, stride):
                yield _batch([(key, octave, start, words.tobytes())], _TILE)

    return cut


def _solve_tiles(min_words: int):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = (np.frombuffer(value.as_buffer(), np.int32) for value in batch["words"])
            columns = (batch["key"].to_pylist(), batch["octave"].to_pylist(), batch["start"].to_pylist(), words)
            yield from _fragments(zip(*columns, strict=True), min_words)

    return solve


def stitched(fragments: DataFrame) -> DataFrame:
    """(key, start, end, period) of the runs, from (key, period, start, end) of fragments.

    Two stretches of one period that share as many words as a period are one stretch. Among
    the periods of a stretch the smallest divides the others.
    """
    in_order = Window.partitionBy("key", "period").orderBy("start", "end")
    reach = F.max("end").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    begins = (F.coalesce(reach, F.lit(-1)) - F.col("period") < F.col("start")).cast("long")
    numbered = fragments.distinct().withColumn("begins", begins)
    numbered = numbered.withColumn("run", F.sum("begins").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = numbered.groupBy("key", "period", "run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return whole.groupBy("key", "start", "end").agg(F.min("period").alias("period"))


@F.pandas_udf(StringType())
def _collapsed(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for texts, starts, ends in batches:
        yield pd.Series([collapse(text or "", a, b) for text, a, b in zip(texts, starts, ends, strict=True)], dtype=object)


def collapse(text: str, starts: np.ndarray, ends: np.ndarray) -> str:
    """The words outside of the intervals, which are sorted by start, joined by a space."""
    kept, number, interval, until = [], 0, 0, 0
    for words in blank_words(text.encode("utf-8", "surrogatepass")):
        at = 0
        while at < len(words):
            while interval < len(starts) and starts[interval] <= number + at:
                until = max(until, ends[interval])
                interval += 1
            next_cut = starts[interval] if interval < len(starts) else number + len(words)
            if until <= number + at:
                stop = min(len(words), int(next_cut) - number)
                kept += words[at:stop]
            else:
                stop = min(len(words), int(min(until, max(next_cut, number + at + 1))) - number)
            at = stop
        number += len(words)
    return b" ".join(kept).decode("utf-8", "surrogatepass")


def _document_key(id_column: Column, text: Column) -> Column:
    """Rows with one key have one text, hence the same runs; copies under other ids have other keys."""
    return F.md5(F.concat(F.coalesce(id_column.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))


def periodic_runs(
    docs: DataFrame,
    min_words: int = MIN_WORDS,
    stride: int = STRIDE,
    spread_chars: int = SPREAD_CHARS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(id, runs, collapsed) of every document.

    ``runs`` has a struct (start, length, period) for each run, by start and then period, with
    words numbered from 0. ``collapsed`` is the text without the words that come after the first
    period of a run that holds them, its words joined by one space.

    A null or empty text, or one of blanks, has no words, no runs and an empty collapsed text.
    Null and repeated ids are allowed; repeated rows give repeated rows with equal results, an
    empty table none. Other columns are ignored, whatever their names. A long text is cut into
    tiles piece by piece, and the tiles of one of at least ``spread_chars`` characters are
    dealt over all tasks. Only fragments and runs are shuffled besides; a text meets its runs
    in a join whose small side Spark broadcasts while it is below the session's threshold.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("key", _document_key(F.col("id"), F.col("text")))
    wide = rows.select("key", "text")
    fragment_ddl = "key string, period long, start long, end long"
    solve = _solve_texts(min_words, stride)
    if (rows.agg(F.max(F.length("text"))).first()[0] or 0) < spread_chars:
        fragments = wide.mapInArrow(solve, fragment_ddl)
    else:
        is_long = F.coalesce(F.length("text") >= spread_chars, F.lit(False))
        far = wide.filter(is_long).mapInArrow(_cut_texts(min_words, stride), "key string, octave int, start long, words binary")
        far = far.repartition("key", "octave", "start").mapInArrow(_solve_tiles(min_words), fragment_ddl)
        fragments = wide.filter(~is_long).mapInArrow(solve, fragment_ddl).unionByName(far)
    run = F.struct("start", (F.col("end") - F.col("start")).alias("length"), "period")
    runs = written(stitched(fragments).groupBy("key").agg(F.sort_array(F.collect_list(run)).alias("runs")))
    none = F.expr("cast(array() as array<struct<start:bigint,length:bigint,period:bigint>>)")
    joined = rows.join(runs, "key", "left").withColumn("runs", F.coalesce("runs", none))
    joined = joined.withColumn("by_start", F.sort_array(F.transform("runs", lambda r: F.struct((r["start"] + r["period"]).alias("a"), (r["start"] + r["length"]).alias("b")))))
    return joined.select(
        F.col("id").alias(id_col),
        "runs",
        _collapsed("text", "by_start.a", "by_start.b").alias("collapsed"),
    )
