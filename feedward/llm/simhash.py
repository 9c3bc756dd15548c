"""SimHash near-duplicates: fingerprints in a vantage-point tree with overlapping shards.

Distinct fingerprints are dealt out by a tree that a bounded sample defines: a node's vantage
point v and radius m send a fingerprint x inwards if d(x, v) <= m + r and outwards if
d(x, v) > m, where r is the largest distance of a link. Two fingerprints within r of each
other meet in at least one leaf: if only one of them is within m of v, the other is within
m + r by the triangle inequality. Only the narrow boundary (m, m + r] goes both ways. Each
shard continues the tree in memory, links what is close in its leaves, and gives out a star
for each local component; components of the stars over all shards are the result.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed
from .components import connected_components

SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: str, shingle: int = 3) -> int:
    """64-bit SimHash of the text's word shingles, unsigned; zero without words.

    Words are runs of anything but space and ``\\x09-\\x0D`` with A-Z lower-cased; shingles are
    joined by spaces and hashed by XXH64 with seed 42; a bit is set if it is in over half of them.
    """
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    starts = np.cumsum(sizes + 1) - sizes - 1
    n = max(1, len(found) - shingle + 1)
    ends = (starts + sizes)[-n:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts[:n].tolist(), ends, strict=True)), np.uint64, n
    )
    counts = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        part = np.ascontiguousarray(hashes[at : at + _CHUNK]).view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (counts * 2 > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.uint64)[0])


@dataclass
class Node:
    """Vantage point and radius; children are nodes or, as leaves, shard numbers."""

    point: int
    radius: int
    inner: "Node | int"
    outer: "Node | int"


def distances(points: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(points ^ np.uint64(point))


def choose_split(points: np.ndarray, reach: int, rng: np.random.Generator, tries: int = 12) -> tuple[int, int] | None:
    """The vantage point and radius with the smallest overlap among balanced ones; None if nothing splits."""
    best = None
    sample = points if len(points) <= 2048 else points[rng.integers(0, len(points), 2048)]
    for point in rng.choice(sample, min(tries, len(sample)), replace=False):
        seen = np.bincount(distances(sample, point), minlength=65 + reach)
        below = np.cumsum(seen) / len(sample)
        for radius in range(64):
            inner, outer = below[min(64, radius + reach)], 1 - below[radius]
            worst = max(inner, outer)
            if worst <= 0.9:
                # Rows are copied in proportion to inner + outer; depth follows from the larger child.
                cost = np.log(inner + outer) / -np.log(worst) if inner + outer > 1 else worst - 1
                if best is None or cost < best[0]:
                    best = (cost, int(point), radius)
    return best and best[1:]


def build_tree(sample: np.ndarray, leaf: int, reach: int, seed: int = 0) -> tuple[Node | int, int]:
    """A tree whose leaves hold at most ``leaf`` of the sample where it can be split, and their number."""
    rng, shards = np.random.default_rng(seed), 0

    def build(points: np.ndarray, depth: int) -> Node | int:
        nonlocal shards
        split = choose_split(points, reach, rng) if len(points) > leaf and depth < 60 else None
        if split is None:
            shards += 1
            return shards - 1
        d = distances(points, split[0])
        return Node(*split, build(points[d <= split[1] + reach], depth + 1), build(points[d > split[1]], depth + 1))

    return build(sample, 0), shards


def shards_of(tree: Node | int, points: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, indices of its points): each point on the boundary of a node goes to both sides."""
    stack = [(tree, np.arange(len(points)))]
    while stack:
        node, index = stack.pop()
        if not len(index):
            continue
        if isinstance(node, int):
            yield node, index
            continue
        d = distances(points[index], node.point)
        stack.append((node.inner, index[d <= node.radius + reach]))
        stack.append((node.outer, index[d > node.radius]))


def local_roots(points: np.ndarray, reach: int, leaf: int = 256) -> np.ndarray:
    """For distinct points the index of the smallest point of each one's component, within these points."""
    parent = np.arange(len(points))
    rng = np.random.default_rng(1)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def union(group: np.ndarray) -> None:
        roots = {find(i) for i in group.tolist()}
        least = min(roots, key=lambda i: points[i])
        for root in roots:
            parent[root] = least

    stack = [np.arange(len(points))]
    while stack:
        index = stack.pop()
        split = choose_split(points[index], reach, rng, 4) if len(index) > leaf else None
        if split is None:
            for group in close_groups(points[index], reach):
                union(index[group])
            continue
        d = distances(points[index], split[0])
        stack.append(index[d <= split[1] + reach])
        stack.append(index[d > split[1]])
    return np.array([find(i) for i in range(len(points))], np.int64)


def close_groups(points: np.ndarray, reach: int, block: int = 64) -> Iterator[np.ndarray]:
    """Components of more than one point, by widening from each point over those not yet reached."""
    left = np.arange(len(points))
    while len(left):
        group, front, left = [left[:1]], left[:1], left[1:]
        while len(front) and len(left):
            near = np.zeros(len(left), bool)
            for at in range(0, len(front), block):
                apart = np.bitwise_count(points[front[at : at + block], None] ^ points[None, left])
                near |= (apart <= reach).any(axis=0)
            front, left = left[near], left[~near]
            group.append(front)
        members = np.concatenate(group)
        if len(members) > 1:
            yield members


def sample_for(total: int, shard_size: int, sample_size: int) -> int:
    """How many of so many fingerprints define a tree whose leaves hold about ``shard_size`` each.

    A leaf keeps 32 of the sample, so the sample grows with the number of leaves up to its bound.
    """
    return min(sample_size, max(20_000, -(-total * 32 // shard_size)))


def link_fingerprints(
    fingerprints: DataFrame, reach: int, sample_size: int = 1 << 21, shard_size: int = 4_096, most: int = 65_536
) -> DataFrame:
    """(fp, root) of all distinct ``fp`` (signed longs) that have a link within ``reach`` bits.

    The tree is built from a sample that grows with the table, of at most ``sample_size``. A leaf
    that nothing splits further, as the near copies around one text make it, may hold any number of
    fingerprints: where the sample tells of more than ``most``, they are linked by the neighbours
    that they share, see :func:`dense_stars`, and no task gathers them.
    """
    distinct = fingerprints.select("fp")
    total = distinct.count()
    wanted = sample_for(total, shard_size, sample_size)
    sample = distinct.orderBy(F.xxhash64("fp"), "fp").limit(wanted).toPandas()["fp"].to_numpy(np.int64)
    leaf = max(32, int(len(sample) * shard_size / max(1, total)))
    points = sample.view(np.uint64)
    tree, _ = build_tree(points, leaf, reach)
    ratio = total / max(1, len(sample))
    dense = sorted(shard for shard, index in shards_of(tree, points, reach) if len(index) * ratio > most and reach == 2)
    shared = fingerprints.sparkSession.sparkContext.broadcast(tree)

    @F.pandas_udf("array<int>")
    def shards(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = [[] for _ in range(len(batch))]
            for shard, index in shards_of(shared.value, batch.to_numpy(np.int64).view(np.uint64), reach):
                for i in index.tolist():
                    out[i].append(shard)
            yield pd.Series(out, dtype=object)

    def stars(group: pd.DataFrame) -> pd.DataFrame:
        fps = np.unique(group["fp"].to_numpy(np.int64))
        points = fps.view(np.uint64)
        roots = local_roots(points, reach)
        linked = roots != np.arange(len(points))
        return pd.DataFrame({"a": fps[linked], "b": fps[roots[linked]]})

    dealt = distinct.select("fp", shards("fp").alias("shards"))
    if not dense:
        edges = dealt.select("fp", F.explode("shards").alias("shard"))
        edges = edges.groupBy("shard").applyInPandas(stars, "a long, b long")
    else:
        dealt = checkpointed(dealt)
        crowded = F.array(*map(F.lit, dense))
        sparse = dealt.select("fp", F.explode(F.array_except("shards", crowded)).alias("shard"))
        edges = sparse.groupBy("shard").applyInPandas(stars, "a long, b long")
        edges = edges.unionByName(dense_stars(dealt.filter(F.arrays_overlap("shards", crowded))))
    return connected_components(edges).withColumnRenamed("node", "fp")


def dense_stars(fingerprints: DataFrame) -> DataFrame:
    """(a, b) links that join all distinct ``fp`` within two bits of each other.

    Two fingerprints are within two bits exactly if some number is within one bit of both. Of the
    at most 65 fingerprints around each number, all are linked to the least.
    """
    around = F.expr("transform(sequence(0, 64), i -> if(i = 64, fp, fp ^ shiftleft(1L, i)))")
    near = fingerprints.select("fp", F.explode(around).alias("number"))
    least = F.min("fp").over(Window.partitionBy("number"))
    return near.select(F.col("fp").alias("a"), least.alias("b")).filter("a != b").distinct()


def text_hash(column: Column) -> Column:
    return F.xxhash64(F.coalesce(column, F.lit("")))


def near_duplicates(
    docs: DataFrame, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Fingerprint and component of every document; links are at most ``max_bits`` differing bits.

    ``component_id`` is the smallest id reachable, the document's own included. ``first``
    names one document of the component by id and hash of the text, that with the smallest
    id (and hash among repeated ids). Fingerprints are computed once and written; exact copies
    meet in an aggregation that combines before the shuffle, so only distinct fingerprints
    are searched.

    Null and empty texts and those without words have fingerprint zero and link like any
    other. Null ids belong to components but name one only where no other id does. Repeated
    rows give repeated rows, an empty table none; other columns are ignored.
    """

    @F.pandas_udf("long")
    def signed(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            found = np.fromiter((fingerprint(t or "", shingle) for t in batch), np.uint64, len(batch))
            yield pd.Series(found.view(np.int64))

    marked = checkpointed(
        docs.select(
            F.col(id_col).alias("id"), text_hash(F.col(text_col)).alias("text_hash"), signed(text_col).alias("fp")
        )
    )
    key = F.struct(F.col("id").isNull().alias("unnamed"), "id", "text_hash")
    distinct = checkpointed(marked.groupBy("fp").agg(F.min(key).alias("first")))
    links = link_fingerprints(distinct, max_bits)
    rooted = distinct.join(links, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = rooted.groupBy("root").agg(F.min("first").alias("first"))
    by_fingerprint = rooted.drop("first").join(firsts, "root").select("fp", "first")
    return marked.join(by_fingerprint, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.id").alias("component_id"),
        "text_hash",
        "first",
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """One document of each component with all its columns: that with the smallest id.

    Rows that repeat an id and a text count as one document. Null and empty texts are near
    duplicates of each other; a null id stays only where its component has no other, an empty
    table gives an empty table, and further columns stay whatever their names. Texts are shuffled once, by id
    and text hash, after such repeated rows have been combined; decisions are slim rows.
    """
    found = near_duplicates(docs, shingle, max_bits)
    firsts = found.groupBy("first").agg(F.count(F.lit(1)).alias("n")).select(
        F.col("first.id").alias("first_id"), F.col("first.text_hash").alias("first_hash")
    )
    # Whole rows in one column, so that no name of theirs can clash with those used here.
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumn("id", F.col("row.doc_id")).withColumn("hash", text_hash(F.col("row.text")))
    kept = rows.dropDuplicates(["id", "hash"]).join(
        firsts, F.col("id").eqNullSafe(F.col("first_id")) & (F.col("hash") == F.col("first_hash")), "left_semi"
    )
    return kept.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
