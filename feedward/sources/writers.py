"""Layer tables and CSV exports. A new run replaces the previous one's tables when it has been written.

A layer table is a folder with a folder for each version. A version counts once its marker is
there, which is written last, so a write that fails leaves the table as it was and a
table can be rebuilt from itself. The version before the newest stays for readers that
have begun with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from feedward.sources.files import delete, list_paths, touch

_READY = "_READY"
_KEPT = 2

#: How layer tables are packed: smaller than Spark's default at much the same speed.
LAYER_CODEC = "zstd"


def _versions(spark: SparkSession, path: str) -> list[str]:
    return list_paths(spark, f"{path}/v[0-9]*")


def _ready(spark: SparkSession, path: str) -> list[str]:
    return [marker.rsplit("/", 1)[0] for marker in list_paths(spark, f"{path}/v[0-9]*/{_READY}")]


def write_layer(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), others: Sequence[DataFrame] = ()
) -> str:
    """Write the next version of the Parquet table at ``path`` and return the version's folder.

    ``others`` are further slices of its rows, which are written one after the other.
    """
    spark = df.sparkSession
    before = _versions(spark, path)
    number = 1 + max((int(name.rsplit("/v", 1)[1]) for name in before), default=0)
    folder = f"{path}/v{number:08d}"
    for part in (df, *others):
        writer = part.write.mode("error" if part is df else "append").option("compression", LAYER_CODEC)
        writer.partitionBy(*partition_by).parquet(folder)
    touch(spark, f"{folder}/{_READY}")
    kept = _ready(spark, path)[-_KEPT:]
    for old in before:
        if old not in kept:
            delete(spark, old)
    return folder


def layer_path(spark: SparkSession, path: str) -> str:
    """The folder of the newest complete version of the table at ``path``."""
    found = _ready(spark, path)
    if not found:
        raise FileNotFoundError(f"no complete version of {path}")
    return found[-1]


def read_layer(spark: SparkSession, path: str) -> DataFrame:
    """The newest complete version of the table at ``path``."""
    return spark.read.parquet(layer_path(spark, path))


def write_table(df: DataFrame, name: str) -> None:
    """Replace what the catalog knows as ``name`` by a view of a new version of its rows.

    Versions lie in the warehouse beside the tables. A plan that has begun with the
    former rows goes on with them; a stored table of this name is dropped.
    """
    spark = df.sparkSession
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    folder = write_layer(df, f"{warehouse}/{name.replace('.', '/')}.versions")
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{folder}`")


def rebuild(
    spark: SparkSession,
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    others: Sequence[DataFrame] = (),
) -> DataFrame:
    """Write a layer table, see :func:`write_layer`, and continue from the written copy.

    This is also where lineage is cut: losing executors later costs at most a
    re-read of the written files.
    """
    folder = write_layer(df, path, partition_by, others)
    return spark.read.schema(df.schema).parquet(folder).select(*df.columns)


def write_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> DataFrame:
    """Store a table in buckets of a key, known to the catalog as ``name``, and return it.

    Tables with equal buckets of their keys join, and are added up by them, without a
    shuffle. A hot key makes its bucket large: a join in place can't be split, so this suits
    keys that are spread out. The files stay at ``path`` when the table is dropped.
    """
    spark = df.sparkSession
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    # One task for each bucket, which then is one sorted file.
    dealt = df.repartition(buckets, key)
    dealt.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)
    return spark.table(name)


#: Records of one CSV part. One with line breaks inside quotes is read by a single task.
CSV_RECORDS = 500_000


#: Exports that only another job reads: the fastest level of gzip that takes them to about a quarter.
PACKED = {"compression": "gzip", "zlib.compress.level": "FOUR"}


def export_csv(df: DataFrame, path: str, *, packed: bool = False) -> None:
    """Replace the CSV export at ``path``; a task writes a part for every CSV_RECORDS rows.

    ``packed`` writes ``.csv.gz`` parts, which the readers unpack by their name.
    """
    formats = {"dateFormat": "yyyy-MM-dd", "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss"}
    formats["maxRecordsPerFile"] = CSV_RECORDS
    if packed:
        formats |= PACKED
    df.write.mode("overwrite").options(**formats).csv(path, header=True, escape='"')


def write_audit(audit: DataFrame, path: str, history: str | None = None) -> None:
    """Export the audit log as one ordered CSV part, replacing the last run's.

    A log has one row per check, so a single part is bounded by the number of
    checks. ``history`` names a Parquet table, partitioned by run, to add it to;
    a repeated run replaces its own partition only. The log is computed once: what
    the history holds is what is exported.
    """
    if history is not None:
        audit.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "run_at"
        ).parquet(history)
        runs = [row.run_at for row in audit.select("run_at").distinct().collect()]
        kept = audit.sparkSession.read.schema(audit.schema).parquet(history)
        audit = kept.filter(F.col("run_at").isin(runs)).select(*audit.columns)
    ordered = audit.coalesce(1).sortWithinPartitions("check_no")
    export_csv(ordered.drop("check_no"), path)
