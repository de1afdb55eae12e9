"""Writers and readers of finished datasets."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession


def append_rows(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> None:
    """One Snappy Parquet folder per split. Ids and token counts stay in the rows."""
    df.write.mode("overwrite").option("compression", "snappy").partitionBy(split).parquet(path)


def read_split(spark: SparkSession, path: str, name: str, split: str = "split") -> DataFrame:
    """One split; the partition filter prunes the other folders."""
    return spark.read.parquet(path).where(f"{split} = '{name}'").drop(split)


def iterate(df: DataFrame) -> Iterator[Row]:
    """Rows one partition at a time, for a consumer that reads lazily."""
    return df.toLocalIterator(prefetchPartitions=True)
