"""Small typed tables for the tests."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql.types import DoubleType

from feedward.sources.schemas import RAW_SCHEMAS


def raw(spark, table, *rows, **defaults):
    """A raw table from dicts; columns that are not given are NULL."""
    schema = RAW_SCHEMAS[table]
    filled = []
    for row in rows:
        row = defaults | row
        unknown = row.keys() - set(schema.names)
        assert not unknown, unknown
        values = [row.get(field.name) for field in schema]
        filled.append(
            [
                float(v) if v is not None and isinstance(f.dataType, DoubleType) else v
                for v, f in zip(values, schema, strict=True)
            ]
        )
    return spark.createDataFrame(filled, schema)


def stamp(text):
    return datetime.fromisoformat(text)


def values(df, *columns):
    """Rows as sorted tuples of the given (default: all) columns."""
    rows = [tuple(row) for row in df.select(*(columns or df.columns)).collect()]
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def only(df):
    """The single value of a one-row, one-column table."""
    ((value,),) = [tuple(row) for row in df.collect()]
    return value
