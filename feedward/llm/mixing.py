"""Mixing sources to target weights by temperature.

A source's weight is its share of all words to the power of an exponent, normalised. The
exponent is found by bisection: the largest up to 1 whose weights reach the target entropy,
but no smaller than the repetition limit allows. Weights times the token budget give each
source's budget. Documents are dealt into blocks by a hash; every epoch of a source is a
permutation of its blocks, and the last, partial epoch takes blocks in its own order
until the budget is met, the block on the boundary by document.
"""

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, free_name
from .simhash import text_hash

#: Tables of at most so many rows are sent to all executors; larger ones are joined by shuffling.
SMALL = 10_000


def _lookup(table: DataFrame) -> DataFrame:
    """For the small side of a join: broadcast only after its rows have been counted."""
    return F.broadcast(table) if table.count() <= SMALL else table


def count_tokens(text: Column) -> Column:
    """Words between blanks; none in a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _bisect(holds: Callable[[list[float]], list[bool]], points: int = 16, rounds: int = 10) -> float:
    """The largest exponent of [0, 1] for which a condition holds that fails only above some point.

    Each round tries several points at once, as each is one pass over the sources' table.
    0 if it holds nowhere.
    """
    low, high = 0.0, 1.0
    if holds([1.0])[0]:
        return 1.0
    for _ in range(rounds):
        tried = [low + (high - low) * i / (points + 1) for i in range(1, points + 1)]
        for point, held in zip(tried, holds(tried), strict=True):
            if not held:
                high = point
                break
            low = point
    return low


def find_exponent(sources: DataFrame, budget: float, entropy: float | None, max_epochs: float | None) -> float:
    """The exponent for sources with columns tokens (> 0).

    ``entropy`` is a target share of the largest possible entropy, the logarithm of the number
    of sources. ``max_epochs`` limits how often a source may be repeated; where both cannot
    hold, the limit does. Below a budget of all tokens times the limit there is an exponent.
    """
    total, count, least = sources.agg(F.sum("tokens"), F.count(F.lit(1)), F.min("tokens")).first()
    if not count:
        return 1.0

    def totals(exponents: list[float]) -> list[tuple[float, float]]:
        """Sum of share ** a, and of share ** a * log(share), for each a."""
        part = F.col("tokens") / F.lit(float(total))
        row = sources.agg(
            *(F.sum(F.pow(part, F.lit(a))) for a in exponents),
            *(F.sum(F.pow(part, F.lit(a)) * F.log(part)) for a in exponents),
        ).first()
        return list(zip(row[: len(exponents)], row[len(exponents) :], strict=True))

    def entropic(exponents: list[float]) -> list[bool]:
        goal = entropy * math.log(count) - 1e-12
        return [math.log(z) - a * s / z >= goal for a, (z, s) in zip(exponents, totals(exponents), strict=True)]

    def repeats_too_often(exponents: list[float]) -> list[bool]:
        # The smallest source is repeated most.
        smallest = least / total
        return [smallest**a / z * budget / least > max_epochs * (1 + 1e-12) for a, (z, _) in zip(exponents, totals(exponents), strict=True)]

    exponent = 1.0 if entropy is None else _bisect(entropic)
    if max_epochs is not None and repeats_too_often([exponent])[0]:
        # The limit fails up to a point and holds above it.
        exponent = min(1.0, _bisect(repeats_too_often) + 1e-9)
    return exponent


def mix_sources(
    docs: DataFrame,
    budget: int | None = None,
    entropy: float | None = 0.9,
    max_epochs: float | None = 4.0,
    block_docs: int = 4096,
    seed: int = 0,
    source_col: str = "source",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents as often as the mix takes them, with all columns and the place in the mix.

    ``budget`` is in words; by default the words of all documents. Added columns (preceded by
    underscores where the table has such names): ``mix_epoch`` from 0, ``mix_block`` within
    the source, and ``mix_order``, by which sorting interleaves the blocks of all sources.
    A source realises its budget to within one document; rows that repeat an id and a text
    are taken together.

    A null source is a source of its own. Null and empty texts have no words: they come along
    with their block. A source without any word has no weight and is not taken. Null ids are
    treated like others. An empty table, or one without words, gives no rows.

    Sources, blocks (one for about ``block_docs`` documents) and the documents of the one
    boundary block of each source are slim tables; only counted ones of at most SMALL
    rows are broadcast. Texts are never shuffled where those tables are small.
    """
    source, key = free_name(docs, "_source"), free_name(docs, "_key")
    number = F.xxhash64(F.lit(seed), F.col(id_col), text_hash(F.col(text_col)))
    wide = docs.withColumns({source: F.col(source_col), key: number})
    slim = checkpointed(
        docs.select(F.col(source_col).alias("source"), number.alias("key"), count_tokens(F.col(text_col)).alias("tokens"))
    )
    counted = slim.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    sources = checkpointed(counted.filter("tokens > 0"))
    total = sources.agg(F.sum("tokens")).first()[0] or 0
    budget = total if budget is None else budget
    exponent = find_exponent(sources, budget, entropy, max_epochs)
    power = F.pow(F.col("tokens") / F.lit(float(max(1, total))), F.lit(exponent))
    whole = sources.agg(F.sum(power)).first()[0] or 1.0
    plan = sources.withColumn("weight", power / F.lit(whole)).withColumn("budget", F.floor(F.col("weight") * F.lit(budget)))
    plan = checkpointed(
        plan.withColumn("epochs", F.floor(F.col("budget") / F.col("tokens")).cast("int"))
        .withColumn("rest", F.col("budget") - F.col("epochs") * F.col("tokens"))
        .withColumn("blocks", F.ceil(F.col("docs") / block_docs).cast("int"))
        .select("source", "epochs", "rest", "blocks")
    )
    small_plan = _lookup(plan)

    def with_blocks(table: DataFrame, source_name: str, key_name: str) -> DataFrame:
        joined = table.join(small_plan.withColumnRenamed("source", "_planned"), F.col(source_name).eqNullSafe(F.col("_planned")))
        return joined.drop("_planned").withColumn("block", F.pmod(F.col(key_name), F.col("blocks")).cast("int"))

    dealt = with_blocks(slim, "source", "key")
    blocks = checkpointed(dealt.groupBy("source", "block", "epochs", "rest").agg(F.sum("tokens").alias("tokens")))
    in_order = Window.partitionBy("source").orderBy(_block_order(F.col("source"), F.col("epochs"), seed), "block")
    ends = blocks.withColumn("end", F.sum("tokens").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("begin", F.col("end") - F.col("tokens"))
    judged = checkpointed(
        ends.select(
            "source", "block", "begin", "rest", (F.col("end") <= F.col("rest")).alias("all"),
            ((F.col("begin") < F.col("rest")) & (F.col("end") > F.col("rest"))).alias("part"),
        )
    )
    some = _lookup(judged.filter("part").select(F.col("source").alias("_s"), F.col("block").alias("_b"), "begin", F.col("rest").alias("limit")))
    on_edge = dealt.join(some, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")))
    on_edge = on_edge.groupBy("source", "block", "key", "begin", "limit").agg(F.sum("tokens").alias("tokens"))
    running = Window.partitionBy("source", "block").orderBy(F.xxhash64("key"), "key")
    reach = F.col("begin") + F.sum("tokens").over(running.rowsBetween(Window.unboundedPreceding, 0))
    edge = checkpointed(on_edge.withColumn("reach", reach).filter("reach <= limit").select(F.col("source").alias("_es"), F.col("key").alias("_ek"), F.lit(True).alias("_edge")))
    whole_blocks = _lookup(judged.filter("all").select(F.col("source").alias("_ws"), F.col("block").alias("_wb"), F.lit(True).alias("_whole")))

    epoch, block, order = (free_name(docs, name) for name in ("mix_epoch", "mix_block", "mix_order"))
    placed = with_blocks(wide.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), source, key), source, key)
    placed = placed.join(whole_blocks, F.col(source).eqNullSafe(F.col("_ws")) & (F.col("block") == F.col("_wb")), "left")
    placed = placed.join(_lookup(edge), F.col(source).eqNullSafe(F.col("_es")) & (F.col(key) == F.col("_ek")), "left")
    taken = F.col("epochs") + F.when(F.coalesce("_whole", "_edge", F.lit(False)), 1).otherwise(0)
    placed = placed.withColumn("taken", taken).filter("taken > 0")
    placed = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("taken") - 1)))
    return placed.select(
        "row.*",
        F.col("epoch").alias(epoch),
        F.col("block").alias(block),
        _block_order(F.col(source), F.col("epoch"), seed).alias(order),
    )


def _block_order(source: Column, epoch: Column, seed: int) -> Column:
    """A block's place among all blocks of all sources and epochs."""
    return F.xxhash64(F.lit(seed), F.coalesce(source.cast("string"), F.lit("")), epoch, F.col("block"))
