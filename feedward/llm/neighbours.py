"""Approximate nearest neighbours by inner product: multiprobe p-stable hashing.

Vectors are scaled by the largest norm and given one more coordinate that makes them unit
vectors; a query gets zero there. Euclidean distance then orders candidates as the inner
product does. Each table hashes with ``functions`` Gaussian projections cut into cells of
one width. A query visits, in each table, the buckets next to its own in the order of the
estimated chance that a near neighbour fell into them: the product over projections of the
normal mass of the cell. Candidates of all tables are ranked by the exact inner product.
A query that gets fewer rows than the table has for it visits every bucket next to its own,
and one that is still short is compared with all rows.
"""

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed


def _normal_cdf(x: np.ndarray) -> np.ndarray:
    """Logistic form of the normal distribution function; good to 0.0002, enough to order buckets."""
    return 1 / (1 + np.exp(-np.clip(1.5976 * x + 0.07056 * x**3, -60, 60)))


@dataclass
class Hashes:
    """Projections of all tables, cell width, largest norm, and the typical neighbour distance."""

    projections: np.ndarray  # tables x functions x (dimension + 1)
    offsets: np.ndarray  # tables x functions
    width: float
    norm: float
    distance: float = 1.0
    probes: int = 1

    @staticmethod
    def draw(tables: int, functions: int, dimension: int, width: float, norm: float, seed: int) -> "Hashes":
        rng = np.random.default_rng(seed)
        return Hashes(
            rng.normal(size=(tables, functions, dimension + 1)), rng.uniform(0, width, (tables, functions)), width, norm
        )

    @property
    def steps(self) -> np.ndarray:
        """Every way to stay in a cell or move by one in each projection."""
        functions = self.offsets.shape[1]
        return np.stack(np.meshgrid(*[(-1, 0, 1)] * functions, indexing="ij"), axis=-1).reshape(-1, functions)

    def places(self, vectors: np.ndarray, is_query: bool) -> np.ndarray:
        """Positions in cells, vectors x tables x functions."""
        if is_query:
            unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
            extra = np.zeros((len(vectors), 1))
        else:
            unit = vectors / self.norm
            extra = np.sqrt(np.maximum(0, 1 - (unit**2).sum(axis=1, keepdims=True)))
        wide = np.hstack([unit, extra])
        return (np.einsum("nd,tfd->ntf", wide, self.projections) + self.offsets) / self.width

    def chances(self, places: np.ndarray, steps: np.ndarray) -> np.ndarray:
        """Log chance of each step that a neighbour is there: vectors x tables x steps."""
        within = places - np.floor(places)
        scale = self.width / max(1e-9, self.distance)
        masses = [
            np.log(np.maximum(1e-300, _normal_cdf((d + 1 - within) * scale) - _normal_cdf((d - within) * scale)))
            for d in (-1, 0, 1)
        ]
        total = np.zeros((*places.shape[:2], len(steps)))
        for f in range(places.shape[2]):
            for d in (-1, 0, 1):
                total[:, :, steps[:, f] == d] += masses[d + 1][:, :, f, None]
        return total


def bucket_keys(cells: np.ndarray) -> np.ndarray:
    """One long for the cells in the last axis; the multiplier is odd, so near cells differ."""
    key = np.zeros(cells.shape[:-1], np.int64)
    with np.errstate(over="ignore"):
        for f in range(cells.shape[-1]):
            key = key * np.int64(1_000_003) + cells[..., f].astype(np.int64)
    return key


def _matrix(series: pd.Series) -> np.ndarray:
    return np.stack(series.to_numpy()).astype(float) if len(series) else np.zeros((0, 0))


def _best(scores: np.ndarray, keys: np.ndarray, k: int) -> list[np.ndarray]:
    """For each row the columns of its k largest scores, ties at the end to the smaller key."""
    if scores.shape[1] > k:
        least = -np.partition(-scores, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(scores), -np.inf)
    out = []
    for row, bound in zip(scores, least, strict=True):
        among = np.flatnonzero(row >= bound)
        out.append(among[np.lexsort((keys[among], -row[among]))][:k])
    return out


def inner_products(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Of each row with the row beside it, added from the first component to the last."""
    return np.add.accumulate(queries * vectors, axis=1)[:, -1] if queries.shape[1] else np.zeros(len(queries))


def _best_exact(
    queries: np.ndarray, vectors: np.ndarray, keys: np.ndarray, k: int, apart: np.ndarray | None = None
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each query (numbers, scores) of its k best vectors, ties to the smaller key.

    A product of matrices, whose last bits depend on its shape, only chooses among whom to look; all
    within its error of the k-th best get their score by ``inner_products``, and that decides.
    ``apart`` marks pairs that don't count.
    """
    rough = queries @ vectors.T
    if apart is not None:
        rough[apart] = -np.inf
    norms = np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0.0)
    slack = 4 * (queries.shape[1] + 1) * np.finfo(float).eps * norms
    if rough.shape[1] > k:
        least = -np.partition(-rough, k - 1, axis=1)[:, k - 1]
    else:
        least = np.full(len(rough), -np.inf)
    out = []
    for query, row, bound in zip(queries, rough, least - slack, strict=True):
        among = np.flatnonzero((row >= bound) & (row > -np.inf))
        scores = inner_products(np.broadcast_to(query, (len(among), len(query))), vectors[among])
        order = np.lexsort((keys[among], -scores))[:k]
        out.append((among[order], scores[order]))
    return out


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part."""
    vectors = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vec"))
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vectors.filter(F.col("vec_id").isNotNull() & finite & F.exists("vec", lambda x: x != 0))


def nearest_neighbours(
    table: DataFrame,
    k: int = 20,
    every: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    tables: int = 8,
    width: float = 2.2,
    bucket_rows: int = 1024,
    shard_rows: int = 32_768,
    shard_queries: int = 4096,
    calibration: int = 96,
    recall: float = 0.96,
    exact_queries: int = 1024,
    seed: int = 0,
) -> DataFrame:
    """The k nearest rows found for each row whose id is divisible by ``every``, by inner product.

    Every row is indexed. The number of buckets to visit is the least that finds ``recall`` of
    the true neighbours of ``calibration`` query vectors, which an exact search over all rows
    gives; that bounded sample is all that is fitted. If more of these neighbours are out of
    reach, too far in every table, the tables are drawn again with fewer functions. Every query
    gets k rows, or all that the table has: one with fewer visits all buckets next to its own,
    and one still short is compared with every row, ``exact_queries`` at a time. Equal vectors are searched as one that
    stands for its k + 1 smallest ids, which can change no result. The buckets of a table are
    dealt into shards of about ``shard_rows`` rows; one that has many more, or many visitors,
    is cut into parts, all of which are visited.

    Scores are inner products in double precision, added from the first component to the last, however
    the rows are dealt; ties go to the smaller id. Vectors that are null, zero or hold a null or non-finite
    component take no part, nor do null ids. Vectors of each length are searched by themselves, as there is no
    inner product between two lengths. Rows that repeat id and vector count once, and an
    id with several vectors is searched for each. An empty table gives no rows; other columns are ignored.
    """
    rows = valid_vectors(table, id_col, vector_col)
    lengths = sorted(row.n for row in rows.select(F.size("vec").alias("n")).distinct().collect())
    options = (k, every, tables, width, bucket_rows, shard_rows, shard_queries, calibration, recall, exact_queries, seed)
    searched = [_search(rows.filter(F.size("vec") == n), *options) for n in lengths or [0]]
    return reduce(DataFrame.unionByName, searched)


def _search(
    rows: DataFrame, k: int, every: int, tables: int, width: float, bucket_rows: int, shard_rows: int,
    shard_queries: int, calibration: int, recall: float, exact_queries: int, seed: int,
) -> DataFrame:
    """The answers among vectors of one length."""
    key = F.struct(F.xxhash64("vec").alias("x"), F.xxhash64(F.lit(seed + 1), F.col("vec")).alias("y"))
    rows = checkpointed(rows.withColumn("vid", key).dropDuplicates(["vec_id", "vid"]))
    by_id = Window.partitionBy("vid").orderBy("vec_id")
    ids = rows.select("vid", "vec_id").withColumn("n", F.row_number().over(by_id)).filter(F.col("n") <= k + 1)
    distinct = checkpointed(rows.groupBy("vid").agg(F.first("vec").alias("vec"), F.min("vec_id").alias("least")))
    own = Window.partitionBy("vec_id")
    queries = rows.filter(F.col("vec_id") % every == 0).withColumn("own", F.count(F.lit(1)).over(own))
    queries = queries.select(F.col("vid").alias("query"), F.col("vec_id").alias("query_id"), "vec", "own")
    asked = checkpointed(queries.groupBy(F.col("query").alias("vid")).agg(F.first("vec").alias("vec")))
    size = distinct.agg(
        F.count(F.lit(1)).alias("n"), F.max(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)).alias("square"),
        F.max(F.size("vec")).alias("dimension"),
    ).first()
    functions = int(np.clip(round(math.log(max(2, size.n) / bucket_rows) / math.log(2.3)), 2, 9))
    hashes = _calibrate(
        lambda n: Hashes.draw(tables, n, size.dimension or 1, width, math.sqrt(size.square or 1.0), seed),
        functions, distinct, asked, k, calibration, recall,
    )
    queries = queries.withColumn("due", F.least(F.lit(k), F.lit(rows.count()) - F.col("own")))

    def answers(found: DataFrame) -> DataFrame:
        """The k best rows of each query among the vectors found for it."""
        best = Window.partitionBy("query").orderBy(F.desc("score"), "least")
        found = found.groupBy("query", "vid", "least").agg(F.max("score").alias("score"))
        found = found.withColumn("n", F.row_number().over(best)).filter(F.col("n") <= k + 1).drop("n", "least")
        named = found.join(ids.select("vid", "vec_id"), "vid").select("query", "vec_id", "score")
        return _ranked(named.join(queries.select("query", "query_id"), "query"), k)

    pair = ["query_id", "query"]
    parts, hungry = [], None
    for probes in sorted({hashes.probes, len(hashes.steps)}):
        if hungry is not None:
            asked = hungry.groupBy(F.col("query").alias("vid")).agg(F.first("vec").alias("vec"))
        found = _candidates(replace(hashes, probes=probes), distinct, size.n, asked, k + 1, shard_rows, shard_queries)
        part = checkpointed(answers(found))
        if hungry is not None:  # a vector may be that of other queries too, which have their rows
            part = part.join(hungry.select(*pair), pair, "left_semi")
        got = part.groupBy(*pair).agg(F.count(F.lit(1)).alias("got"))
        among = queries if hungry is None else hungry
        short = among.join(got, pair, "left").filter(F.coalesce("got", F.lit(0)) < F.col("due")).drop("got")
        hungry = checkpointed(short)
        if hungry.isEmpty():
            return reduce(DataFrame.unionByName, [*parts, part]).drop("query")
        parts.append(part.join(hungry.select(*pair), pair, "left_anti"))
    pool = ids.select("vid", "vec_id").join(distinct.select("vid", "vec"), "vid")
    return reduce(DataFrame.unionByName, [*parts, _exact(pool, hungry, k, exact_queries)]).drop("query")


def _ranked(answers: DataFrame, k: int) -> DataFrame:
    """The k best other rows of each query, with their ranks."""
    rank = Window.partitionBy("query_id", "query").orderBy(F.desc("score"), "vec_id")
    return (
        answers.filter("vec_id != query_id")
        .withColumn("rank", F.row_number().over(rank))
        .filter(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score", "query")
    )


def _exact(pool: DataFrame, queries: DataFrame, k: int, block: int) -> DataFrame:
    """The k best rows of the pool for each query, by comparing all.

    So many queries at a time go to all tasks, which keep the best rows of theirs; no row of the
    pool is shuffled.
    """
    blocks = max(1, -(-queries.count() // block))
    dealt = queries.select("query", "query_id", "vec", F.pmod(F.xxhash64("query_id", "query"), F.lit(blocks)).alias("block"))
    found = []
    for number in range(blocks):
        asking = dealt.filter(F.col("block") == number).drop("block").toPandas()
        if not len(asking):
            continue
        wanted, own = _matrix(asking["vec"]), asking["query_id"].to_numpy(np.int64)
        x, y = (np.array([q[name] for q in asking["query"]], np.int64) for name in ("x", "y"))
        best = pool.select("vec_id", "vec").mapInPandas(_keep_best(wanted, own, x, y, k), "qx long, qy long, query_id long, vec_id long, score double")
        best = best.withColumn("query", F.struct(F.col("qx").alias("x"), F.col("qy").alias("y")))
        found.append(checkpointed(_ranked(best, k)))
    return reduce(DataFrame.unionByName, found)


def _keep_best(wanted: np.ndarray, own: np.ndarray, x: np.ndarray, y: np.ndarray, k: int) -> Callable:
    """For a task's rows: the k best of each query, which is all that a task holds."""

    def keep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        best = [(np.zeros(0, np.int64), np.zeros(0))] * len(wanted)
        for batch in batches:
            vectors, ids = _matrix(batch["vec"]), batch["vec_id"].to_numpy(np.int64)
            for at in range(0, len(wanted) if len(ids) else 0, 256):
                some = slice(at, at + 256)
                near = _best_exact(wanted[some], vectors, ids, k, own[some, None] == ids)
                for q, (rows, scores) in enumerate(near, at):
                    among, values = np.concatenate([best[q][0], ids[rows]]), np.concatenate([best[q][1], scores])
                    order = np.lexsort((among, -values))[:k]
                    best[q] = among[order], values[order]
        for q, (among, values) in enumerate(best):
            if len(among):
                yield pd.DataFrame({"qx": x[q], "qy": y[q], "query_id": own[q], "vec_id": among, "score": values})

    return keep


def _calibrate(
    draw: Callable[[int], Hashes], functions: int, distinct: DataFrame, asked: DataFrame, k: int, queries: int, recall: float
) -> Hashes:
    """Hashes with the typical distance and the number of probes, from exact answers to a few queries."""
    chosen = asked.orderBy("vid").limit(queries).toPandas()
    if not len(chosen):
        return draw(functions)
    asked_vectors = _matrix(chosen["vec"])

    def exact(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                vectors = _matrix(batch["vec"])
                scores = asked_vectors @ vectors.T
                for q, best in enumerate(_best(scores, batch["least"].to_numpy(), k + 1)):
                    yield pd.DataFrame({"q": q, "score": scores[q, best], "vec": list(vectors[best])})

    near = distinct.select("vec", "least").mapInPandas(exact, "q int, score double, vec array<double>")
    order = Window.partitionBy("q").orderBy(F.desc("score"))
    near = near.withColumn("n", F.row_number().over(order)).filter(F.col("n") <= k + 1).toPandas()
    asked_of = near["q"].to_numpy()
    neighbours = _matrix(near["vec"])
    norms = np.linalg.norm(asked_vectors, axis=1)[asked_of]
    for count in range(functions, 0, -1):
        hashes = draw(count)
        cosine = near["score"].to_numpy() / norms / hashes.norm
        hashes.distance = max(0.05, float(np.median(np.sqrt(np.maximum(0, 2 - 2 * cosine)))))
        steps = hashes.steps
        places = hashes.places(asked_vectors, is_query=True)
        order = np.argsort(-hashes.chances(places, steps), axis=2, kind="stable")
        rank = np.empty_like(order)
        np.put_along_axis(rank, order, np.arange(len(steps))[None, None, :], axis=2)
        apart = (np.floor(hashes.places(neighbours, is_query=False)) - np.floor(places)[asked_of]).astype(int)
        reachable = (np.abs(apart) <= 1).all(axis=2)
        code = ((np.clip(apart, -1, 1) + 1) * 3 ** np.arange(apart.shape[2])[::-1]).sum(axis=2)
        at = np.take_along_axis(rank[asked_of], code[:, :, None], axis=2)[:, :, 0]
        first = np.sort(np.where(reachable, at, len(steps)).min(axis=1))
        need = min(len(first) - 1, math.ceil(recall * len(first)) - 1)
        hashes.probes = int(min(len(steps), first[need] + 1))
        if first[need] < len(steps):
            break
    return hashes


def _candidates(
    hashes: Hashes, distinct: DataFrame, rows: int, asked: DataFrame, k: int, shard_rows: int, shard_queries: int
) -> DataFrame:
    """(query, vid, least, score): the k best of each shard that a query visits.

    A shard holds several buckets of one table; a query visits it once for all that it wants there.
    """
    shared = distinct.sparkSession.sparkContext.broadcast(hashes)

    @F.pandas_udf("array<long>")
    def buckets(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            cells = np.floor(shared.value.places(_matrix(batch), is_query=False))
            yield pd.Series(list(bucket_keys(cells)))

    def probes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        h, steps = shared.value, shared.value.steps
        some = max(1, (1 << 18) // (h.projections.shape[0] * len(steps)))
        for batch in batches:
            for at in range(0, len(batch), some):
                part = batch.iloc[at : at + some]
                places = h.places(_matrix(part["vec"]), is_query=True)
                order = np.argsort(-h.chances(places, steps), axis=2, kind="stable")[:, :, : h.probes]
                wanted = bucket_keys(np.floor(places)[:, :, None, :] + steps[order])
                q, number, _ = np.indices(wanted.shape, np.int32).reshape(3, -1)
                x, y = part["x"].to_numpy()[q], part["y"].to_numpy()[q]
                yield pd.DataFrame({"x": x, "y": y, "number": number, "bucket": wanted.ravel()})

    keys = ["number", "shard"]
    parts = max(1, -(-rows // shard_rows))
    shard_of = F.pmod(F.xxhash64("bucket"), F.lit(parts)).cast("int")
    stored = distinct.select("vid", "least", "vec", F.posexplode(buckets("vec")).alias("number", "bucket"))
    stored = stored.withColumn("shard", shard_of)
    visits = asked.select("vid.x", "vid.y", "vec").mapInPandas(probes, "x long, y long, number int, bucket long")
    visits = visits.select(F.struct("x", "y").alias("query"), "number", "bucket")
    visits = checkpointed(
        visits.withColumn("shard", shard_of).groupBy("query", *keys).agg(F.collect_list("bucket").alias("wanted"))
    )
    sizes = stored.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    visitors = visits.groupBy(*keys).agg(F.count(F.lit(1)).alias("m"))
    cuts = checkpointed(
        sizes.join(visitors, keys).select(
            *keys,
            F.ceil(F.col("n") / (2 * shard_rows)).cast("int").alias("row_parts"),
            F.ceil(F.col("m") / shard_queries).cast("int").alias("query_parts"),
        )
    )
    group = [*keys, "row_part", "query_part"]
    left = stored.join(cuts, keys).select(
        *keys,
        F.pmod(F.col("vid.y"), F.col("row_parts")).cast("int").alias("row_part"),
        F.explode(F.sequence(F.lit(0), F.col("query_parts") - 1)).alias("query_part"),
        "vid.x", "vid.y", "least", "bucket", "vec",
    )
    right = visits.join(cuts, keys).select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.col("row_parts") - 1)).alias("row_part"),
        F.pmod(F.col("query.y"), F.col("query_parts")).cast("int").alias("query_part"),
        "query",
        "wanted",
    )
    right = right.join(asked.withColumnRenamed("vid", "query"), "query").select(
        *group, F.col("query.x").alias("qx"), F.col("query.y").alias("qy"), "wanted", "vec"
    )

    def rank(stored_rows: pd.DataFrame, visiting: pd.DataFrame) -> pd.DataFrame:
        found = best_of_buckets(stored_rows, visiting, k) if len(stored_rows) and len(visiting) else []
        out = [np.concatenate(part) for part in zip(*found, strict=True)] if found else [[]] * 3
        q, row, score = out[0], out[1], out[2]
        q, row = np.asarray(q, np.int64), np.asarray(row, np.int64)
        return pd.DataFrame(
            {
                "qx": visiting["qx"].to_numpy()[q],
                "qy": visiting["qy"].to_numpy()[q],
                **{name: stored_rows[name].to_numpy()[row] for name in ("x", "y", "least")},
                "score": np.asarray(score, float),
            }
        )

    schema = "qx long, qy long, x long, y long, least long, score double"
    ranked = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInPandas(rank, schema)
    return ranked.select(
        F.struct(F.col("qx").alias("x"), F.col("qy").alias("y")).alias("query"), F.struct("x", "y").alias("vid"), "least", "score"
    )


def best_of_buckets(stored: pd.DataFrame, visiting: pd.DataFrame, k: int) -> list[tuple[np.ndarray, ...]]:
    """For each visitor of a shard (its number repeated, rows, scores) of the k best in its wanted buckets."""
    vectors, least, bucket = _matrix(stored["vec"]), stored["least"].to_numpy(), stored["bucket"].to_numpy()
    queries = _matrix(visiting["vec"])
    wanted_by: dict[int, list[int]] = {}
    for q, wanted in enumerate(visiting["wanted"]):
        for b in wanted:
            wanted_by.setdefault(int(b), []).append(q)
    order = np.argsort(bucket, kind="stable")
    edges = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] - 1))
    near: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(len(queries))]
    for rows in np.split(order, edges[1:]):
        asking = wanted_by.get(int(bucket[rows[0]]), [])
        for at in range(0, len(asking), 256):
            some = asking[at : at + 256]
            for q, (best, scores) in zip(some, _best_exact(queries[some], vectors[rows], least[rows], k), strict=True):
                near[q].append((rows[best], scores))
    out = []
    for q, parts in enumerate(near):
        if parts:
            rows, scores = (np.concatenate(x) for x in zip(*parts, strict=True))
            best = np.lexsort((least[rows], -scores))[:k]
            out.append((np.full(len(best), q), rows[best], scores[best]))
    return out
