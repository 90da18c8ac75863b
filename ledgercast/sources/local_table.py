"""Small tables that come from settings or fitted parameters, never from data rows."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

# A table of settings larger than this is not broadcast by hint; the optimizer decides.
BROADCAST_ROWS = 200_000


def local_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A table whose rows are known here; Spark sees its exact size."""
    schema = T._parse_datatype_string(ddl) if isinstance(ddl, str) else ddl
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    table = pa.table(
        [pa.array(list(values), type=field.type) for values, field in zip(columns, arrow)],
        schema=arrow,
    )
    return spark.createDataFrame(table, schema)


def broadcast_if_small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast hint only when the known row count is within the bound."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df
