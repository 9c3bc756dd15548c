"""Session settings that the operators count on."""

from __future__ import annotations

import math
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from pathlib import Path
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes shuffle partitions, turns joins with a side that
# proved small into broadcasts, and splits hot keys. "force" lets it split a
# hot key even where the next operator would have reused the partitioning.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Before the shuffle of a large child, a Bloom filter of its parents' keys drops
    # rows without a parent, where the parents were filtered themselves.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
}

BYTES_PER_SHUFFLE_PARTITION = 256 * 1024**2

# Text takes up to so many times the space of its packed files.
PACKED_TEXT = 8
PACKED_NAMES = (".gz", ".gzip", ".bz2", ".lz4", ".snappy", ".deflate", ".zst")


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session that is already running."""
    for key, value in ADAPTIVE.items():
        spark.conf.set(key, value)
    return spark


def planned_bytes(df: DataFrame) -> int:
    """What the plan's sources hold, by Spark's own statistics; starts no job."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def text_bytes(df: DataFrame) -> int:
    """What text files hold: planned_bytes, more of it where they are packed. Starts no job."""
    packed = any(name.endswith(PACKED_NAMES) for name in df.inputFiles())
    return planned_bytes(df) * (PACKED_TEXT if packed else 1)


def partitions_for(total_bytes: int) -> int:
    """Shuffle partitions of about BYTES_PER_SHUFFLE_PARTITION, however many that takes."""
    return max(1, math.ceil(total_bytes / BYTES_PER_SHUFFLE_PARTITION))


@contextmanager
def sized_shuffles(spark: SparkSession, total_bytes: int) -> Iterator[int]:
    """Within the block, at least as many shuffle partitions as the input needs.

    Adaptive execution merges small partitions at run time but cannot divide
    all of them, so the starting number has to grow with the data. The session
    has its own setting again afterwards.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    needed = max(int(before), partitions_for(total_bytes))
    spark.conf.set(key, str(needed))
    try:
        yield needed
    finally:
        spark.conf.set(key, before)


# For a chain of jobs that write tables and read them again.
CHAINED = {
    # A job's shuffle files go when it ends, not when the driver happens to collect the garbage of its plan; a
    # plan that is run a second time has to shuffle again.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Tables packed with zstd hold more than their files, which matters to what is small enough to broadcast.
    "spark.sql.sources.fileCompressionFactor": "8.0",
}


@contextmanager
def chained_jobs(spark: SparkSession) -> Iterator[None]:
    """CHAINED within the block; the session has its own settings again afterwards."""
    before = {key: spark.conf.get(key) for key in CHAINED}
    for key, value in CHAINED.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


# Whole rows that a step shuffles at one time for each core, so that its files don't grow with the table.
ROWS_PER_CORE = 4_000_000


def slices_for(spark: SparkSession, rows: int, parents: int) -> int:
    """In how many slices to shuffle whole rows that meet their parents.

    Every slice meets all parents, whose keys are shuffled again and held by its tasks; so it has
    at least as many rows as there are parents.
    """
    wanted = math.ceil(rows / (ROWS_PER_CORE * spark.sparkContext.defaultParallelism))
    return max(1, min(wanted, rows // max(1, parents)))


def together(act: Callable[..., Any], calls: Mapping[str, tuple]) -> dict[str, Any]:
    """What ``act`` returns for each call's arguments, their jobs running side by side.

    One job's last tasks leave executors idle that the next one's can use. All calls are waited for; the first that
    failed raises.
    """
    inheriting = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max(1, len(calls))) as pool:
        futures = {name: pool.submit(inheriting(act), *args) for name, args in calls.items()}
    return {name: future.result() for name, future in futures.items()}


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for each application.

    Workers that find it on their own path use that; others, as on a cluster where only the driver
    has it, get it from the driver.
    """
    context = spark.sparkContext
    if getattr(context, "_feedward_shipped", False):
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="feedward-package-")) / "feedward.zip"
    with zipfile.ZipFile(archive, "w") as package:
        for path in sorted(root.rglob("*.py")):
            package.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._feedward_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the cluster names it.

    Only a local session, whose executors are this process, may do without.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="feedward-")


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings; keyword names use ``__`` for the dots."""
    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    for key, value in (conf | {"spark__ui__enabled": "false"}).items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())
