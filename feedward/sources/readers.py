"""CSV scan with a declared schema, and the loader for a whole raw directory."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType,
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructType,
)

from feedward.functions import number_prefix
from feedward.sources.files import list_paths

# The field texts that pandas' CSV reader takes for a missing value.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Where a row stood in its file; sorting by these three is file order.
POSITION_COLUMNS = ("source_file", "source_block", "source_row")


def read_raw(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    *,
    positions: bool = False,
    multi_line: bool = False,
) -> DataFrame:
    """Scan CSV with a header, matching columns by name and typing them explicitly.

    Fields are read as text first. That lets one scan honour every null token
    and parse numbers leniently, where a typed scan would silently turn a bad
    field into NULL.

    A record with too few or too many fields stops every job over the table,
    also one that only counts: a scan that parsed the columns it needs alone
    would take such a record for a row, and one cut by a line break for two.

    ``positions`` adds :data:`POSITION_COLUMNS`. ``multi_line`` allows line
    breaks inside quotes, at the price of one task per file.
    """
    reader = spark.read.option("columnPruning", False).option("mode", "FAILFAST")
    lines = reader.csv(
        path, header=True, enforceSchema=False, quote='"', escape='"', multiLine=multi_line
    )
    if schema is None:
        schema = StructType.fromDDL(", ".join(f"`{name}` STRING" for name in lines.columns))
    columns = [_typed(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in schema]
    if positions:
        columns += [
            F.col("_metadata.file_path").alias("source_file"),
            F.col("_metadata.file_block_start").alias("source_block"),
            F.monotonically_increasing_id().alias("source_row"),
        ]
    return lines.select(*columns)


def load_raw_dir(
    spark: SparkSession,
    directory: str,
    schemas: Mapping[str, StructType],
    *,
    positions: bool = False,
    multi_line: Collection[str] = (),
) -> dict[str, DataFrame]:
    """Load every ``<stem>.csv`` (a file or a directory of parts) as ``raw_<stem>``.

    ``multi_line`` names the stems whose fields may have line breaks inside quotes;
    such files are read by one task each. In all others a record with too few or
    too many fields, as a line break makes it, stops the load.

    Only the directory itself is listed, however many parts a table has.
    """
    tables = {}
    for path in list_paths(spark, f"{directory.rstrip('/')}/*.csv"):
        stem = path.rsplit("/", 1)[1].removesuffix(".csv")
        tables[f"raw_{stem}"] = read_raw(
            spark, path, schemas.get(stem), positions=positions, multi_line=stem in multi_line
        )
    return tables


def _typed(text: Column, kind: DataType) -> Column:
    value = F.when(~text.isin(*NULL_TOKENS), text)
    match kind:
        case StringType():
            return value
        case DoubleType() | IntegerType() | LongType() | DecimalType():
            return F.coalesce(value.try_cast(kind), number_prefix(value).try_cast(kind))
        case _:
            return value.try_cast(kind)
