"""What tables exist, which columns they have, and which ones belong to a key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SCHEMA = "schema string, table string, position int, column string"


def structure_of(spark: SparkSession, frames: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """``(schema, table, columns)`` for named DataFrames; columns in their own order."""
    rows = [
        (schema, table, i, name)
        for schema, tables in frames.items()
        for table, df in tables.items()
        for i, name in enumerate(df.columns)
    ]
    return _fold(spark.createDataFrame(rows, _SCHEMA))


def catalog_structure(spark: SparkSession, databases: Sequence[str] | None = None) -> DataFrame:
    """The same for the tables of the session catalog (metadata only, no data is read)."""
    names = databases or [d.name for d in spark.catalog.listDatabases()]
    rows = [
        (db, t.name, i, c.name)
        for db in names
        for t in spark.catalog.listTables(db)
        if not t.isTemporary
        for i, c in enumerate(spark.catalog.listColumns(f"`{db}`.`{t.name}`"))
    ]
    return _fold(spark.createDataFrame(rows, _SCHEMA))


def _fold(columns: DataFrame) -> DataFrame:
    ordered = F.array_sort(F.collect_list(F.struct("position", "column")))
    return columns.groupBy("schema", "table").agg(F.transform(ordered, lambda c: c["column"]).alias("columns"))


def child_tables(structure: DataFrame, schema: str, key: str, ignored: Sequence[str] = ()) -> DataFrame:
    """Tables of a schema that contain the key column, minus an ignore list."""
    has_key = F.array_contains("columns", key)
    return structure.where((F.col("schema") == schema) & has_key & ~F.col("table").isin(list(ignored)))
