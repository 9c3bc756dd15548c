"""Vector code compression: product codes by exact integer k-means with adaptive distance bounds.

Every component becomes ``floor(scale * x)`` and every vector is cut into consecutive parts. For each
part position a codebook is trained by rounds of k-means over all rows in whole numbers, so results do
not depend on the order or the partitioning of rows.

The first assignment measures every part against every entry. With each part its ``b`` closest
entries are persisted in order, each with a lower bound below which neither it nor any later one can be, and
one outer bound for all entries that are not listed. When a codebook has moved, an entry's bound falls
by its own movement, the outer one by the largest movement. A part is then measured
against its present entry alone; only entries whose bound does not exceed that distance are uncertain and
are measured in whole numbers, in the order of the list, and all of them if the outer bound does not
hold. How far the lists were needed decides the next ``b``. Bounds are kept as 16-bit numbers, rounded down.
"""

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from .common import ensure_checkpoint_dir

#: Codebooks of so many numbers are sent to the executors at once; vectors of further lengths come after.
CODEBOOK_NUMBERS = 1 << 22
#: Per-label sums of at most so many rows are broadcast.
SMALL = 10_000
_LIMB = 40
_EPSILON = 1e-12
_MAX_LONG = (1 << 63) - 1
_ROWS = 4096
#: A place of a list that holds no entry.
_NONE = 255


def floor_scaled(value: float, scale: int = 256) -> int:
    """``floor(scale * value)``, exactly, for any finite value."""
    return int(value) * scale if abs(value) >= 2.0**53 / scale else math.floor(value * scale)


def part_slices(length: int, parts: int) -> list[slice]:
    """Consecutive parts; where they can't be equal, the first ones are longer by one."""
    size, longer = divmod(length, parts)
    ends = np.cumsum([size + (i < longer) for i in range(parts)]).tolist()
    return [slice(start, end) for start, end in zip([0, *ends[:-1]], ends, strict=True)]


def distances(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances, points x entries; both are whole numbers."""
    if points.dtype == object or entries.dtype == object:
        points, entries = points.astype(object), entries.astype(object)
        return np.array([[int(((p - e) ** 2).sum()) for e in entries] for p in points], object).reshape(len(points), len(entries))
    largest = max((int(np.abs(a).max()) for a in (points, entries) if a.size), default=0)
    if max(1, points.shape[1]) * 4 * largest**2 < 1 << 53:  # every term is exact in a double
        p, e = points.astype(float), entries.astype(float)
        return ((p**2).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e**2).sum(axis=1)).astype(np.int64)
    return ((points[:, None, :] - entries[None]) ** 2).sum(axis=2)


def is_exact(numbers: np.ndarray, size: int) -> bool:
    """Whether squared distances between parts of such numbers fit into 64 bits."""
    return numbers.dtype != object and (not numbers.size or max(1, size) * 4 * int(np.abs(numbers).max()) ** 2 < 1 << 62)


def whole_numbers(rows: list[list[int]], size: int) -> np.ndarray:
    """An array of 64-bit numbers if distances are exact in them, else of Python's."""
    if all(-(1 << 31) < x < 1 << 31 for row in rows for x in row):
        numbers = np.array(rows, np.int64).reshape(len(rows), -1)
        if is_exact(numbers, size):
            return numbers
    wide = np.empty((len(rows), len(rows[0]) if rows else 0), object)
    for i, row in enumerate(rows):
        wide[i] = row
    return wide


def _packed(bounds: np.ndarray) -> np.ndarray:
    """Upper halves of single-precision numbers no larger than the bounds."""
    capped = np.clip(bounds, 0, np.finfo(np.float32).max)
    single = capped.astype(np.float32)
    single = np.where(single > capped, np.nextafter(single, np.float32(0)), single)
    return (single.view(np.uint32) >> 16).astype(np.uint16)


def _unpacked(halves: np.ndarray) -> np.ndarray:
    return (halves.astype(np.uint32) << 16).view(np.float32).astype(float)


@dataclass
class Lists:
    """Of some points: the closest entries, lower bounds for each and all later ones, and for all others."""

    entries: np.ndarray  # points x b
    lower: np.ndarray  # points x b
    outer: np.ndarray  # points


def closest(points: np.ndarray, codebook: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, Lists]:
    """(entry, squared distance, lists) from all distances; ties go to the lower entry."""
    squared = distances(points, codebook)
    order = np.argsort(squared, axis=1, kind="stable")
    ranked = np.take_along_axis(squared, order, axis=1)
    rows, width = len(points), min(b, codebook.shape[0])
    entries = np.full((rows, b), _NONE, np.uint8)
    entries[:, :width] = order[:, :width]
    lower = np.full((rows, b), np.inf)
    outer = np.full(rows, np.inf)
    if ranked.dtype == object:  # too large for bounds: every entry stays uncertain
        lower[:], outer[:] = 0, 0
    else:
        lower[:, :width] = np.sqrt(ranked[:, :width])
        if width < codebook.shape[0]:
            outer = np.sqrt(ranked[:, width])
    return order[:, 0], ranked[:, 0], Lists(entries, lower, outer)


def reassign(
    points: np.ndarray, codebook: np.ndarray, moved: np.ndarray, lists: Lists, b: int
) -> tuple[np.ndarray, np.ndarray, Lists, np.ndarray]:
    """(entry, squared distance, lists, places needed) after the entries have moved so far; 64-bit numbers only.

    The first place of a list is the present entry. Places needed beyond the list count as its
    width and one.
    """
    width = lists.entries.shape[1]
    present = lists.entries[:, 0].astype(np.int64)
    listed = lists.entries != _NONE
    lower = np.where(listed, lists.lower - np.append(moved, [0.0] * (_NONE + 1 - len(moved)))[lists.entries], np.inf)
    outer = lists.outer - moved.max(initial=0.0)
    own = ((points - codebook[present]) ** 2).sum(axis=1)
    bounds = np.minimum.accumulate(np.column_stack([lower, outer])[:, ::-1], axis=1)[:, ::-1]
    upper = np.sqrt(own) * (1 + _EPSILON)
    needed = np.maximum(1, (bounds <= upper[:, None] + _EPSILON).sum(axis=1))
    entry, squared = present.copy(), own.copy()
    entries, lower = lists.entries.copy(), np.maximum(bounds[:, :width], 0)
    outer = np.maximum(outer, 0)
    for places in range(2, width + 1):
        rows = np.flatnonzero(needed == places)
        if not len(rows):
            continue
        tried = np.sort(entries[rows, :places], axis=1)  # by entry, so that the first of equals is the lower
        exact = ((points[rows, None, :] - codebook[tried]) ** 2).sum(axis=2)
        order = np.argsort(exact, axis=1, kind="stable")
        entries[rows, :places] = np.take_along_axis(tried, order, axis=1)
        lower[rows, :places] = np.sqrt(np.take_along_axis(exact, order, axis=1))
        entry[rows] = entries[rows, 0]
        squared[rows] = np.take_along_axis(exact, order[:, :1], axis=1)[:, 0]
    rows = np.flatnonzero(needed > width)
    # Narrower lists leave what they drop to the outer bound; wider ones are filled when measured anew.
    if b < width:
        outer = np.minimum(outer, lower[:, b:].min(axis=1))
        entries, lower = entries[:, :b], lower[:, :b]
    elif b > width:
        entries = np.pad(entries, ((0, 0), (0, b - width)), constant_values=_NONE)
        lower = np.pad(lower, ((0, 0), (0, b - width)), constant_values=np.inf)
    if len(rows):
        entry[rows], squared[rows], fresh = closest(points[rows], codebook, b)
        entries[rows], lower[rows], outer[rows] = fresh.entries, fresh.lower, fresh.outer
    return entry, squared, Lists(entries, lower, outer), needed


def next_width(needed: Counter, width: int, most: int) -> int:
    """The least b that would have served 99 in 100 parts; twice as many if lists were too short too often."""
    total = sum(needed.values())
    if not total:
        return width
    if needed[width + 1] > total / 20:
        return min(most, 2 * width)
    reached, b = 0, 1
    for b in range(1, width + 1):
        reached += needed[b]
        if reached >= 0.99 * total:
            break
    return min(most, max(2, b))


@dataclass
class Codebooks:
    """For vectors of each length, a list of entries for each part."""

    by_length: dict[int, list[list[list[int]]]]
    parts: int

    def arrays(self, length: int) -> list[np.ndarray]:
        found = []
        for entries, cut in zip(self.by_length[length], part_slices(length, self.parts), strict=True):
            found.append(whole_numbers(entries, cut.stop - cut.start))
        return found

    def digest(self, length: int) -> str:
        numbers = (str(x) for part in self.by_length[length] for entry in part for x in entry)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def movements(self, after: "Codebooks") -> dict[int, list[np.ndarray]]:
        """How far each entry is from where it was, rounded up."""
        return {
            length: [
                np.array([_root(sum((x - y) ** 2 for x, y in zip(a, b, strict=True))) for a, b in zip(part, new, strict=True)])
                for part, new in zip(books, after.by_length[length], strict=True)
            ]
            for length, books in self.by_length.items()
        }


def _root(number: int) -> float:
    return math.sqrt(number) * (1 + _EPSILON) if number < 1 << 200 else math.inf


def limbs(number: int) -> list[int]:
    """The number in base 2 ** 40, lowest first; only the last one may be negative."""
    found = []
    while not -(1 << _LIMB) < number < 1 << _LIMB:
        found.append(number & ((1 << _LIMB) - 1))
        number >>= _LIMB
    return [*found, number]


_STATE = pa.schema(
    [
        ("length", pa.int32()), ("numbers", pa.binary()), ("size", pa.int32()), ("codes", pa.binary()),
        ("entries", pa.binary()), ("lower", pa.binary()), ("outer", pa.binary()), ("error", pa.int64()),
    ]
)
_TALLY = pa.schema(
    [("t_length", pa.int32()), ("t_part", pa.int32()), ("t_entry", pa.int32()), ("t_place", pa.int32()), ("t_limb", pa.int32()), ("t_value", pa.int64())]
)
#: In the place of a component: a count of parts, and how many parts needed so many places of their lists.
_COUNT, _NEEDED = -1, -2


def _pack_numbers(numbers: np.ndarray) -> tuple[list[bytes], int]:
    """Each row in the fewest bytes that hold all of them; as text if none does."""
    if numbers.dtype == object:
        return [",".join(map(str, row)).encode() for row in numbers], 0
    largest = int(np.abs(numbers).max()) if numbers.size else 0
    size = 2 if largest < 1 << 15 else 4 if largest < 1 << 31 else 8
    return [row.tobytes() for row in numbers.astype(f"<i{size}")], size


def _unpack_numbers(rows: list[bytes], size: int, length: int, parts: int) -> np.ndarray:
    if size:
        return np.frombuffer(b"".join(rows), f"<i{size}").astype(np.int64).reshape(len(rows), length)
    return whole_numbers([[int(x) for x in row.split(b",")] if row else [] for row in rows], -(-length // parts))


class Pass:
    """One assignment of a task's rows, and the sums of the parts by their entries.

    Rows keep their id and label; what else they need is in ``_STATE``, the sums in ``_TALLY``.
    """

    def __init__(self, schema: pa.Schema, books: Codebooks, moved: dict[int, list[np.ndarray]] | None, width: int, b: int, scale: int) -> None:
        self.schema, self.books, self.moved, self.width, self.b, self.scale = schema, books, moved, width, b, scale

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        self.tally: dict[tuple[int, int, int, int], int] = Counter()
        self.arrays = {length: self.books.arrays(length) for length in self.books.by_length}
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                yield from self._rows(batch.slice(start, _ROWS))
        rows = [(*key, limb, value) for key, number in self.tally.items() for limb, value in enumerate(limbs(number))]
        for start in range(0, len(rows), 100_000):
            columns = list(zip(*rows[start : start + 100_000], strict=True))
            yield self._batch(len(columns[0]), {f.name: pa.array(c, f.type) for f, c in zip(_TALLY, columns, strict=True)})

    def _batch(self, rows: int, columns: dict[str, pa.Array]) -> pa.RecordBatch:
        arrays = [columns[f.name].cast(f.type) if f.name in columns else pa.nulls(rows, f.type) for f in self.schema]
        return pa.RecordBatch.from_arrays(arrays, schema=self.schema)

    def _rows(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        lengths = np.array(batch["length"].to_pylist(), np.int64)
        for length in np.unique(lengths).tolist():
            rows = batch.take(pa.array(np.flatnonzero(lengths == length)))
            if self.moved is None:
                flat = rows["vec"].flatten().to_numpy(zero_copy_only=False).reshape(len(rows), length)
                scaled = np.floor(flat * self.scale) if length else flat
                small = (np.abs(flat) < 2.0**53 / self.scale).all(axis=1) & (np.abs(scaled) < 2.0**31).all(axis=1)
                groups = [np.flatnonzero(small), np.flatnonzero(~small)]
                numbers = [scaled[groups[0]].astype(np.int64), None]
                if len(groups[1]):
                    exact = [[floor_scaled(x, self.scale) for x in row] for row in flat[groups[1]].tolist()]
                    numbers[1] = whole_numbers(exact, -(-length // self.books.parts))
            else:
                sizes = np.array(rows["size"].to_pylist())
                groups = [np.flatnonzero(sizes == size) for size in np.unique(sizes)]
                packed = rows["numbers"].to_pylist()
                numbers = [_unpack_numbers([packed[i] for i in g], int(sizes[g[0]]), length, self.books.parts) for g in groups]
            for group, values in zip(groups, numbers, strict=True):
                if len(group):
                    yield self._assign(rows.take(pa.array(group)), length, values)

    def _assign(self, rows: pa.RecordBatch, length: int, numbers: np.ndarray) -> pa.RecordBatch:
        n, parts = len(rows), self.books.parts
        stored, size = _pack_numbers(numbers)
        if self.moved is not None:
            old_entries = np.frombuffer(b"".join(rows["entries"].to_pylist()), np.uint8).reshape(n, parts, self.width)
            old_lower = _unpacked(np.frombuffer(b"".join(rows["lower"].to_pylist()), "<u2").reshape(n, parts, self.width))
            old_outer = _unpacked(np.frombuffer(b"".join(rows["outer"].to_pylist()), "<u2").reshape(n, parts))
        codes = np.zeros((n, parts), np.uint8)
        entries, lower, outer = np.zeros((n, parts, self.b), np.uint8), np.zeros((n, parts, self.b)), np.zeros((n, parts))
        error: np.ndarray | list = np.zeros(n, object)
        for p, cut in enumerate(part_slices(length, parts)):
            points, book = numbers[:, cut], self.arrays[length][p]
            if not is_exact(points, points.shape[1]) or book.dtype == object:
                points, book = points.astype(object), book.astype(object)
            if self.moved is None or points.dtype == object:
                code, squared, lists = closest(points, book, self.b)
            else:
                before = Lists(old_entries[:, p], old_lower[:, p], old_outer[:, p])
                code, squared, lists, needed = reassign(points, book, self.moved[length][p], before, self.b)
                for places, count in zip(*np.unique(needed, return_counts=True), strict=True):
                    self.tally[length, p, int(places), _NEEDED] += int(count)
            codes[:, p], entries[:, p], lower[:, p], outer[:, p] = code, lists.entries, lists.lower, lists.outer
            error = error + squared.astype(object)
            self._add(length, p, code.astype(np.int64), points)
        columns = {
            "length": rows["length"],
            "numbers": pa.array(stored, pa.binary()),
            "size": pa.array([size] * n, pa.int32()),
            "codes": pa.array([row.tobytes() for row in codes], pa.binary()),
            "entries": pa.array([row.tobytes() for row in entries], pa.binary()),
            "lower": pa.array([row.tobytes() for row in _packed(lower)], pa.binary()),
            "outer": pa.array([row.tobytes() for row in _packed(outer)], pa.binary()),
            "error": pa.array([min(int(e), _MAX_LONG) for e in error], pa.int64()),
        }
        return self._batch(n, columns | {name: rows[name] for name in ("id", "label")})

    def _add(self, length: int, part: int, code: np.ndarray, points: np.ndarray) -> None:
        for entry in np.unique(code).tolist():
            chosen = points[code == entry]
            self.tally[length, part, entry, _COUNT] += len(chosen)
            for place, total in enumerate(chosen.sum(axis=0).tolist()):
                self.tally[length, part, entry, place] += int(total)


def _moved_books(tallies: DataFrame, books: Codebooks) -> tuple[Codebooks, Counter]:
    """Each entry replaced by the mean of its parts, rounded down, and how many places were needed.

    One row reaches the driver for each number of the codebooks, which are bounded.
    """
    summed = tallies.filter("t_place IS NOT NULL").groupBy("t_length", "t_part", "t_entry", "t_place", "t_limb")
    totals: Counter = Counter()
    for row in summed.agg(F.sum("t_value").alias("value")).collect():
        totals[row.t_length, row.t_part, row.t_entry, row.t_place] += row.value << (_LIMB * row.t_limb)
    new, needed = {}, Counter()
    for length, parts in books.by_length.items():
        new[length] = [
            [
                [totals[length, p, e, i] // count for i in range(len(entry))] if (count := totals[length, p, e, _COUNT]) else entry
                for e, entry in enumerate(entries)
            ]
            for p, entries in enumerate(parts)
        ]
    for (_, _, places, kind), count in totals.items():
        if kind == _NEEDED:
            needed[places] += count
    return Codebooks(new, books.parts), needed


def _first_books(kept: DataFrame, lengths: list[int], parts: int, entries: int, scale: int) -> Codebooks:
    first = Window.partitionBy("length").orderBy(F.asc_nulls_last("id"), "vec")
    chosen = kept.filter(F.col("length").isin(lengths)).select("id", "vec", "length", F.row_number().over(first).alias("place"))
    books: dict[int, list[list[list[int]]]] = {length: [[] for _ in range(parts)] for length in lengths}
    for row in sorted(chosen.filter(F.col("place") <= entries).collect(), key=lambda row: row.place):
        numbers = [floor_scaled(x, scale) for x in row.vec]
        for book, cut in zip(books[row.length], part_slices(row.length, parts), strict=True):
            book.append(numbers[cut])
    return Codebooks(books, parts)


def compress_vectors(
    table: DataFrame,
    parts: int = 16,
    entries: int = 64,
    rounds: int = 2,
    scale: int = 256,
    listed: int = 8,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, label, code, error, label_error, codebooks_sha256) of every vector.

    ``code`` is the entry of each part, a byte each; at most 255 ``entries``. Codebooks start with the vectors
    of the smallest ids. ``error`` is the squared distance in whole numbers between a vector and
    what its code stands for, ``label_error`` its sum over equal labels, nulls together.
    ``listed`` is how many entries are listed at first; it changes no result.

    Rows whose vector is null or has null or non-finite components are dropped. Vectors of each
    length have codebooks of their own; parts that can't be equal differ by one component, and
    a vector without components has the code of zeros. Repeated ids are rows like others and come, in the
    choice of the first entries, by their vectors; null ids come last there. With fewer rows than
    ``entries`` the codebooks are as small. Components of any size are exact; sums of errors end at the largest
    long. An empty table gives no rows. Other columns are ignored, whatever their names.

    Rows are never shuffled but for the join with the sums of their labels, which are broadcast while they
    are counted few. Each pass writes rows with their lists and, once for a task, its sums for the codebooks.
    """
    if not 0 < entries < _NONE:
        raise ValueError("entries must be between 1 and 254")
    spark = table.sparkSession
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/codes-{uuid4().hex}"
    vectors = table.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    kept = vectors.filter(F.col("vec").isNotNull() & finite).withColumn("length", F.size("vec"))
    lengths = sorted(row.length for row in kept.select("length").distinct().collect())
    blocks: list[list[int]] = []
    for length in lengths:
        if blocks and (sum(blocks[-1]) + length + len(blocks[-1])) * entries <= CODEBOOK_NUMBERS:
            blocks[-1].append(length)
        else:
            blocks.append([length])
    coded = [_code_block(kept, block, parts, entries, rounds, scale, listed, f"{folder}/{number}") for number, block in enumerate(blocks)]
    if not coded:
        return vectors.limit(0).select(
            F.col("id").alias(id_col), F.col("label").alias(label_col), F.lit(b"").alias("code"),
            F.lit(0).cast("long").alias("error"), F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"),
        )
    whole = coded[0]
    for block in coded[1:]:
        whole = whole.unionByName(block)
    sums = whole.groupBy(F.col("label").alias("of")).agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("total"))
    sums = sums.select("of", F.least("total", F.lit(_MAX_LONG)).cast("long").alias("label_error"))
    if sums.count() <= SMALL:
        sums = F.broadcast(sums)
    joined = whole.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select(
        F.col("id").alias(id_col), F.col("label").alias(label_col), F.col("codes").alias("code"), "error", "label_error", "codebooks_sha256"
    )


def _code_block(
    kept: DataFrame, lengths: list[int], parts: int, entries: int, rounds: int, scale: int, listed: int, folder: str
) -> DataFrame:
    """(id, label, codes, error, codebooks_sha256) of the vectors of some lengths, written."""
    spark = kept.sparkSession
    types = dict(kept.dtypes)
    ddl = f"id {types['id']}, label {types['label']}, length int, numbers binary, size int, codes binary, entries binary, lower binary, outer binary, error long, t_length int, t_part int, t_entry int, t_place int, t_limb int, t_value long"
    rows = kept.filter(F.col("length").isin(lengths))
    books = _first_books(kept, lengths, parts, entries, scale)
    moved, width, b = None, listed, listed
    for number in range(rounds + 1):
        schema = _arrow_schema(rows)
        assign = Pass(schema, books, moved, width, b, scale)
        rows.mapInArrow(assign, ddl).write.parquet(f"{folder}/pass-{number}")
        done = spark.read.parquet(f"{folder}/pass-{number}")
        if number < rounds:
            after, needed = _moved_books(done, books)
            books, moved, width = after, books.movements(after), b
            b = next_width(needed, width, entries)
            rows = done.filter("t_place IS NULL").drop(*_TALLY.names)
    digests = F.create_map(*(F.lit(x) for length in lengths for x in (length, books.digest(length))))
    return done.filter("t_place IS NULL").select("id", "label", "codes", "error", F.element_at(digests, F.col("length")).alias("codebooks_sha256"))


def _arrow_schema(rows: DataFrame) -> pa.Schema:
    given = to_arrow_schema(rows.select("id", "label").schema)
    return pa.schema([*given, *_STATE, *_TALLY])
