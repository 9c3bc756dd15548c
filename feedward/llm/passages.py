"""Repeated passages that do not fill whole lines: winnowing with words as the units.

Every run of ``gram`` words has a hash; of each window of hashes that spans ``min_words`` words the
least is a fingerprint, so two equal runs of ``min_words`` words share one at the same place.
Fingerprints that stand in one place only are dropped, the others are joined to the first place
of their kind. Repeated runs that touch make one region; its first and last run are compared word
by word with the first documents that hold them, and the region is extended both ways as
far as those words agree. What is cut thus has at least ``gram`` words that stand earlier.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written
from .simhash import text_hash

#: Repeats of so many words are always found, wherever they begin.
MIN_PASSAGE = 50
#: Words under one hash; no repeat of fewer is touched.
GRAM = 25
_BASE = 0x9E3779B97F4A7C15
_IS_WORD = np.array([not (c == 32 or 9 <= c <= 13) for c in range(256)], np.int8)
_BYTE_VALUES = np.random.default_rng(7).integers(0, 1 << 64, 256, np.uint64)


def split_words(text: str) -> list[bytes]:
    """Runs of anything but space and ``\\x09-\\x0D``."""
    return text.encode("utf-8", "surrogatepass").split()


_POWERS = [np.ones((2, 1), np.uint64)]


def _powers(count: int) -> np.ndarray:
    """At least ``count`` powers of the base modulo 2**64, and of its inverse; the longest rows so far are kept."""
    if _POWERS[0].shape[1] < count:
        rows = np.full((2, 1 << (count - 1).bit_length()), _BASE, np.uint64)
        rows[1] = pow(_BASE, -1, 1 << 64)
        rows[:, 0] = 1
        _POWERS[0] = np.multiply.accumulate(rows, axis=1, out=rows)
    return _POWERS[0]


def _hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Polynomial hashes modulo 2**64 of ranges of values, alike wherever equal ranges stand."""
    forth, back = _powers(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * forth[: len(values)], out=sums[1:])
    mixed = (sums[ends] - sums[starts]) * back[starts]
    mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(_BASE)
    return mixed ^ (mixed >> np.uint64(29))


def _windowed(pick: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """Least or largest value of every window, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def fingerprints(texts: list[bytes], min_words: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, first word) of each run of ``gram`` words whose hash is the least of some window."""
    data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    edges = np.diff(_IS_WORD[data], prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    n = len(starts)
    if n < min_words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)
    word_hashes = _hashes(_BYTE_VALUES[data], starts, ends)
    offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
    owner = np.searchsorted(offsets, starts, "right") - 1
    first = np.arange(n - gram + 1)
    runs = _hashes(word_hashes, first, first + gram)
    width = min_words - gram + 1
    least = _windowed(np.minimum, runs, width)
    least[owner[: n - min_words + 1] != owner[min_words - 1 :]] = 0  # windows over two texts
    around = np.zeros(width - 1, np.uint64)
    reached = _windowed(np.maximum, np.concatenate([around, least, around]), width)
    chosen = np.flatnonzero((runs == reached) & (reached > 0))
    texts_of = owner[chosen]
    return texts_of, runs[chosen].view(np.int64), (chosen - np.searchsorted(owner, texts_of)).astype(np.int32)


def regions(at: np.ndarray, doc: np.ndarray, first: np.ndarray, floor: np.ndarray, gram: int) -> list[tuple]:
    """(document, place, own place) of the first run of each covered region, then of its last, and its floor.

    Places are those of one document; each covers ``gram`` words, but none below its floor.
    """
    begin = np.maximum(at, floor)
    order = np.lexsort((doc, first, at, begin))
    at, doc, first, floor, begin = (x[order] for x in (at, doc, first, floor, begin))
    end = np.maximum.accumulate(at + gram)
    starts = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    # The last run of a region is the first one that reaches its end.
    lasts = np.searchsorted(end, end[np.append(starts[1:], len(at)) - 1])
    columns = (doc[starts], first[starts], at[starts], doc[lasts], first[lasts], at[lasts], floor[starts])
    return list(zip(*(c.tolist() for c in columns), strict=True))


def repeated_passages(
    docs: DataFrame, min_words: int = MIN_PASSAGE, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, text_hash, passages): what repeats earlier text, for each document that has any.

    A passage has its place, and the words of the first document around its two ends, which
    ``gone_words`` compares. Documents come in order of id (null last), hash of the text and word.
    """
    slim = docs.select(F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), F.col(text_col).alias("text"))
    key_type = slim.schema["id"].dataType.simpleString()

    def winnow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in portions(batch.column("text")):
                number, fp, at = fingerprints(texts, min_words, gram)
                owner = pa.array(number + start)
                columns = [batch.column("id").take(owner), batch.column("text_hash").take(owner), pa.array(fp), pa.array(at)]
                yield pa.RecordBatch.from_arrays(columns, ["id", "text_hash", "fp", "at"])

    found = written(slim.mapInArrow(winnow, f"id {key_type}, text_hash long, fp long, at int"))
    often = written(found.groupBy("fp").count().filter("count > 1").select("fp"))
    shared = written(found.join(often.hint("merge"), "fp", "left_semi"))
    doc = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")
    place = F.struct(doc.alias("doc"), "at")
    firsts = shared.groupBy("fp").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    firsts = written(firsts.filter("first != last").drop("last"))
    later = shared.join(firsts.hint("merge"), "fp").filter(place > F.col("first"))
    # Within one document the first place itself stays.
    floor = F.when(doc == F.col("first.doc"), F.col("first.at") + gram).otherwise(0)
    seen = F.struct(_name("first.doc.").alias("doc"), F.col("first.at").alias("first_at"), "at", floor.alias("floor"))
    per_doc = later.groupBy("id", "text_hash").agg(F.collect_set(seen).alias("places"))

    @F.pandas_udf("array<struct<doc_a:long,first_a:int,a:int,doc_z:long,first_z:int,z:int,floor:int>>")
    def joined(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([regions(*places, gram) for places in zip(*batch, strict=True)], dtype=object)

    columns = (F.col("places")[name] for name in ("at", "doc", "first_at", "floor"))
    found = written(per_doc.select("id", "text_hash", F.inline(joined(*columns))))
    sides = F.array(
        F.struct(F.col("doc_a").alias("doc"), F.col("first_a").alias("first"), "a", "floor", F.lit(True).alias("is_start")),
        F.struct(F.col("doc_z").alias("doc"), F.col("first_z").alias("first"), F.col("z").alias("a"), "floor", F.lit(False).alias("is_start")),
    )
    region = F.struct("a", "z").alias("region")
    ends = found.select("id", "text_hash", region, F.inline(sides))
    ends = ends.join(_around(slim, ends, min_words - gram, gram).hint("merge"), ["doc", "first"])
    words = F.struct("before", "run", "after", "floor")
    both = ends.groupBy("id", "text_hash", "region").agg(
        F.max(F.when(F.col("is_start"), words)).alias("start"), F.max(F.when(~F.col("is_start"), words)).alias("end")
    )
    passage = F.struct("region.a", "region.z", "start.floor", "start.before", F.col("start.run").alias("run_a"),
                       F.col("end.run").alias("run_z"), "end.after")
    return both.groupBy("id", "text_hash").agg(F.collect_list(passage).alias("passages"))


def portions(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first, texts) in groups of about so many bytes; a null text is empty."""
    group, start, held = [], 0, 0
    for number, text in enumerate(column.cast(pa.binary())):
        group.append(text.as_py() or b"")
        held += len(group[-1])
        if held >= size:
            yield start, group
            group, start, held = [], number + 1, 0
    if group:
        yield start, group


def _name(prefix: str = "") -> Column:
    """One number for a document's id and hash of the text; what it leads to is compared by word."""
    key = F.col(f"{prefix}id")
    return F.xxhash64(f"{prefix}text_hash", key.isNull(), key)


def _around(slim: DataFrame, ends: DataFrame, reach: int, gram: int) -> DataFrame:
    """(doc, first, before, run, after): words of first documents at and around the ends of regions."""
    wanted = written(ends.groupBy("doc").agg(F.collect_set("first").alias("all")))

    @F.pandas_udf("array<struct<first:int,before:binary,run:binary,after:binary>>")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for texts, places in batches:
            out = []
            for text, some in zip(texts, places, strict=True):
                found = split_words(text)
                parts = ((at, found[max(0, at - reach) : at], found[at : at + gram], found[at + gram : at + gram + reach]) for at in some)
                out.append([(int(at), *map(b" ".join, part)) for at, *part in parts])
            yield pd.Series(out, dtype=object)

    holders = slim.withColumn("doc", _name()).join(wanted.hint("merge"), "doc").select("doc", F.inline(cut("text", "all")))
    # Rows that repeat a document say the same.
    return written(holders.dropDuplicates(["doc", "first"]))


def gone_words(found: list[bytes], passages, gram: int = GRAM) -> list[bool]:
    """Which words of a text its passages cover, each checked at its ends and extended both ways."""
    gone = [False] * len(found)
    for p in passages:
        a, z = p["a"], p["z"]
        if found[a : a + gram] != p["run_a"].split() or found[z : z + gram] != p["run_z"].split():
            continue  # equal hashes of different words
        end = z + gram
        for word in reversed(p["before"].split()):
            if a == 0 or found[a - 1] != word:
                break
            a -= 1
        for word in p["after"].split():
            if end == len(found) or found[end] != word:
                break
            end += 1
        a = max(a, p["floor"])
        if a < end:
            gone[a:end] = [True] * (end - a)
    return gone
