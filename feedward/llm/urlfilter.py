"""URL filter: exact membership in allow and block lists through Bloom filter cascades.

Level 0 of a cascade encodes the listed keys, level 1 those keys of the corpus that
level 0 lets through wrongly, level 2 the listed keys that level 1 catches wrongly, and so
on until nothing is judged wrongly. For every key of the corpus the answer is therefore
exact, and judging a page needs no join, only the cascades: a few bits for each listed key.
"""

import math
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, checkpointed, written

RULES_SCHEMA = "host string, path string, verdict string"
#: A key listed with both verdicts gets the first.
VERDICTS = ("block", "allow")

# Words of a filter that reach the driver at once.
PART_WORDS = 1 << 22
#: Filters that are sent to the executors together; longer lists are judged in parts.
MAX_BYTES = 1 << 28
#: What a listed key takes in all levels of its cascade, at most.
KEY_BYTES = 16


@dataclass
class Level:
    """A Bloom filter of ``bits`` bits and ``hashes`` positions for each key."""

    seed: int
    bits: int
    hashes: int
    bitmap: np.ndarray | None = None

    @staticmethod
    def sized(seed: int, keys: int, rate: float) -> "Level":
        bits = max(64, math.ceil(keys * math.log2(math.e) * math.log2(1 / rate)))
        return Level(seed, bits, max(1, round(math.log2(1 / rate))))

    def positions(self, key: str) -> list[int]:
        data = key.encode("utf-8", "surrogatepass")
        one = xxhash.xxh64_intdigest(data, 2 * self.seed)
        two = xxhash.xxh64_intdigest(data, 2 * self.seed + 1) | 1
        return [(one + i * two) % (1 << 64) % self.bits for i in range(self.hashes)]

    @property
    def planned(self) -> int:
        """Bytes of the bitmap, which is whole words of 64 bits."""
        return 8 * -(-self.bits // 64)

    def fill(self, parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> None:
        """Take the bitmap from its words that have bits, given as parts of (numbers, words)."""
        words = np.zeros(self.planned // 8, "<i8")
        for number, bits in parts:
            words[number] = bits
        self.bitmap = words.view(np.uint8)

    def has(self, key: str) -> bool:
        return all(self.bitmap[p >> 3] >> (p & 7) & 1 for p in self.positions(key))


@dataclass
class Cascade:
    levels: list[Level] = field(default_factory=list)

    def has(self, key: str) -> bool:
        """Exact for the listed keys and for every key of the corpus it was built over."""
        for number, level in enumerate(self.levels):
            if not level.has(key):
                return number % 2 == 1
        return len(self.levels) % 2 == 1

    @property
    def size(self) -> int:
        return sum(len(level.bitmap) for level in self.levels)


def _passing(keys: DataFrame, level: Level) -> DataFrame:
    @F.pandas_udf("boolean")
    def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([level.has(key) for key in batch], dtype=bool)

    return keys.filter(passes("key"))


def _filled(level: Level, keys: DataFrame) -> Level:
    """Set the bits of all keys, combined to words in Spark; only those reach the driver."""

    @F.pandas_udf("array<long>")
    def positions(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([level.positions(key) for key in batch])

    found = keys.select(F.explode(positions("key")).alias("position"))
    bit = F.expr("shiftleft(1L, CAST(position % 64 AS INT))")
    words = found.groupBy(F.expr("position div 64").alias("word")).agg(F.bit_or(bit).alias("bits"))
    total = level.planned // 8
    if total > PART_WORDS:
        words = checkpointed(words)

    def parts() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for at in range(0, total, PART_WORDS):
            part = words.filter(F.col("word").between(at, at + PART_WORDS - 1)).toArrow()
            yield part["word"].to_numpy(), part["bits"].to_numpy()

    level.fill(parts())
    return level


def first_level(listed: DataFrame, listed_size: int, universe_size: int) -> Level | None:
    """The filter of the listed keys among about so many keys; None without any."""
    if not listed_size:
        return None
    others = max(1, universe_size - listed_size)
    rate = min(0.5, max(1e-9, listed_size * math.sqrt(0.5) / others))
    return _filled(Level.sized(0, listed_size, rate), listed)


def build_cascade(
    listed: DataFrame, universe: DataFrame, universe_size: int, max_bytes: int = MAX_BYTES, first: Level | None = None
) -> Cascade:
    """A cascade that tells ``listed`` keys from all other keys of ``universe`` (columns ``key``).

    With its first level given, the universe may leave out keys that do not pass it. Raises before it fills a
    filter with which all of them, whose size is proportional to the listed keys, would exceed ``max_bytes``.
    """
    cascade = Cascade()

    def check(planned: int) -> None:
        if cascade.size + planned > max_bytes:
            raise ValueError(f"the listed keys need filters of more than {max_bytes} bytes")

    listed_size = listed.count()
    if not listed_size:
        return cascade
    if first is None:
        check(listed_size // 8)
        first = first_level(listed, listed_size, universe_size)
    check(first.planned)
    cascade.levels.append(first)
    wrong = checkpointed(_passing(universe, first).join(listed, "key", "left_anti"))
    right, wrong_size = listed, wrong.count()
    while wrong_size:
        level = Level.sized(len(cascade.levels), wrong_size, 0.5)
        check(level.planned)
        cascade.levels.append(_filled(level, wrong))
        # What the newest level encodes is right by now; the other side has to pass it.
        right, wrong = wrong, checkpointed(_passing(right, level))
        wrong_size = wrong.count()
    return cascade


def split_urls(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` and ``path``; both are empty for a url that is null or has no ``://``."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    mark = F.instr(url, "://")
    tail = F.when(mark > 0, F.expr(f"substring(coalesce(`{url_col}`, ''), instr(`{url_col}`, '://') + 3)")).otherwise("")
    pages = pages.withColumn("_tail", tail)
    raw_host = F.regexp_extract("_tail", r"^[^/?#]*", 0)
    pages = pages.withColumn("_rest", F.expr("substring(_tail, length(regexp_extract(_tail, '^[^/?#]*', 0)) + 1)"))
    return (
        pages.withColumn("host", ascii_lower(raw_host))
        .withColumn("path", F.regexp_extract("_rest", r"^[^?#]*", 0))
        .drop("_tail", "_rest")
    )


def _candidates(host: str, path: str, labels: Sequence[int], lengths: Sequence[int]) -> list[str]:
    """Keys that could be listed for a page, longest first; among equals the longer host."""
    parts = host.split(".")
    hosts = [".".join(parts[-n:]) for n in labels if n <= len(parts)]
    paths = [path[:n] for n in lengths if n <= len(path)]
    pairs = sorted(((h, p) for h in hosts for p in paths), key=lambda x: (-len(x[0] + x[1]), -len(x[0])))
    return [_key(h, p) for h, p in pairs]


def _key(host: str, path: str) -> str:
    return f"{host}\x00{path}"


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
    max_bytes: int = MAX_BYTES,
) -> DataFrame:
    """The longest fitting rule of each page's url and its verdict, by cascades of listed keys.

    ``rules`` has host, path and verdict (allow or block). A rule fits its host and all
    subdomains where the path starts with the rule's path. Of rules of equal length the one
    with the longer host wins; a key listed with both verdicts blocks; a rule with a null
    takes no part. A url without a rule gets ``default``, as no list names it. A null url or
    one without ``://`` has an empty host and path. Repeated rows give repeated rows; an
    empty table gives none; other columns of the pages and rules are ignored, whatever their names.

    The candidate keys of a page are the host endings and path beginnings of those lengths
    that rules have, so a very long url has no more of them than a short one. They are made in the tasks
    that read the pages; only those that pass the first filter of a list, its own keys and few others,
    leave them. Lists whose filters would take more than ``max_bytes`` are cut into parts by a
    hash of the key; pages are judged by one part after the other and keep the longest rule.
    """
    spark = pages.sparkSession
    rules = rules.select("host", "path", F.lower("verdict").alias("verdict")).dropna()
    rules = checkpointed(rules.filter(F.col("verdict").isin(*VERDICTS)).withColumn("key", F.concat("host", F.lit("\x00"), "path")).select("key", "verdict").distinct())
    parts = max(1, math.ceil(rules.count() * KEY_BYTES / max_bytes))
    judged = split_urls(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"))).drop("url")
    judged = judged.withColumn("key", F.lit(None).cast("string")).withColumn("verdict", F.lit(default))
    for part in range(parts):
        if part:
            judged = written(judged)
        some = rules if parts == 1 else checkpointed(rules.filter(F.pmod(F.xxhash64("key"), F.lit(parts)) == part))
        judged = _judged(spark, judged, some, max_bytes)
    rule = F.replace("key", F.lit("\x00"), F.lit(""))
    return judged.select(F.col("page_id").alias(id_col), "host", "path", rule.alias("rule"), "verdict")


def _judged(spark: SparkSession, pages: DataFrame, rules: DataFrame, max_bytes: int) -> DataFrame:
    """Pages with the better of their rule so far and the best of these rules."""
    host = F.substring_index("key", "\x00", 1)
    shape = rules.select(
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("key") - F.length(host) - 1).alias("length")
    ).distinct().collect()  # at most distinct label counts x distinct path lengths
    labels, lengths = sorted({row.labels for row in shape}), sorted({row.length for row in shape})
    longest = max(lengths, default=0)
    if not shape:
        return pages
    starts = pages.select("host", F.substring("path", 1, longest).alias("path")).distinct()
    fitting_labels = F.size(F.filter(F.lit(labels), lambda n: n <= F.size(F.split("host", r"\."))))
    fitting_lengths = F.size(F.filter(F.lit(lengths), lambda n: n <= F.length("path")))
    universe_size = starts.agg(F.sum((fitting_labels * fitting_lengths).cast("long"))).first()[0] or 0
    listed = {v: checkpointed(rules.filter(F.col("verdict") == v).select("key")) for v in VERDICTS}
    firsts = {v: first_level(keys, keys.count(), universe_size) for v, keys in listed.items()}
    known = spark.sparkContext.broadcast([level for level in firsts.values() if level is not None])

    @F.pandas_udf("array<string>")
    def passing(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        levels = known.value
        for hosts, paths in batches:
            found = (_candidates(h, p, labels, lengths) for h, p in zip(hosts, paths, strict=True))
            yield pd.Series([[k for k in keys if any(level.has(k) for level in levels)] for keys in found], dtype=object)

    universe = checkpointed(starts.select(F.explode(passing("host", "path")).alias("key")).distinct())
    cascades = {v: build_cascade(listed[v], universe, universe_size, max_bytes, firsts[v]) for v in VERDICTS}
    shared = spark.sparkContext.broadcast(cascades)

    @F.pandas_udf("key string, verdict string")
    def judge(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        verdicts = shared.value

        @lru_cache(maxsize=100_000)
        def best(host: str, start: str) -> tuple[str, str] | None:
            for key in _candidates(host, start, labels, lengths):
                for verdict, cascade in verdicts.items():
                    if cascade.has(key):
                        return key, verdict
            return None

        for columns in batches:
            rows = []
            for h, p, key, verdict in zip(*columns, strict=True):
                found = best(h, p[:longest])
                rows.append(found if found and (key is None or _rank(found[0]) > _rank(key)) else (key, verdict))
            yield pd.DataFrame(rows, columns=["key", "verdict"], dtype=object)

    judged = pages.select("page_id", "host", "path", judge("host", "path", "key", "verdict").alias("j"))
    return judged.select("page_id", "host", "path", "j.key", "j.verdict")


def _rank(key: str) -> tuple[int, int]:
    """Longer rules come first, among equals those of longer hosts."""
    return len(key), key.index("\x00")


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    return spark.createDataFrame(list(rules), RULES_SCHEMA)
