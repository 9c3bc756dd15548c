"""Shared pieces: per-text functions, lineage cuts in shared storage, free column names."""

import tempfile
from collections.abc import Callable, Iterator
from uuid import uuid4

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string


def per_text(score: Callable[[str], tuple], schema: str) -> Callable[[Column], Column]:
    """A column function that gives a struct for each text; a null text counts as empty."""
    names = _struct(schema).names

    @F.pandas_udf(schema)
    def apply(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([score(text or "") for text in texts], columns=names)

    return apply


def text_portions(texts: pa.Array, chars: int = 1 << 19, overhead: int = 512) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) in groups of about so many characters, to bound what is held at once.

    Each text counts ``overhead`` characters besides its own, so that groups of short ones
    stay small too. A null text is empty.
    """
    group, start, held = [], 0, 0
    for number, text in enumerate(texts):
        group.append(text.as_py() or "")
        held += len(group[-1]) + overhead
        if held >= chars:
            yield start, group
            group, start, held = [], number + 1, 0
    if group:
        yield start, group


def _struct(schema: str) -> StructType:
    return _parse_datatype_string(f"struct<{schema}>")


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that the table does not have, whatever its case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows as written to the folder that the cluster names, so that no executor is needed twice.

    ``spark.checkpoint.dir`` is read from the session. Only a local session, whose
    executors are this very process, may do without it.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Like ``checkpointed``, but as Parquet: smaller for rows of repeated values, and Spark knows its size."""
    ensure_checkpoint_dir(df.sparkSession)
    path = f"{df.sparkSession.sparkContext.getCheckpointDir()}/table-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not context.master.startswith("local["):
                raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
            named = tempfile.mkdtemp(prefix="feedward-checkpoints-")
        context.setCheckpointDir(named)


def ascii_lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
