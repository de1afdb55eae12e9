"""Readers: Parquet folders and relational databases."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def spread(df: DataFrame) -> DataFrame:
    """Give every core work where the input has fewer splits than that.

    For scans that feed costly row-wise expressions. Input with as many splits as
    cores, as any large table has, is left alone.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def jdbc_table(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_on: str,
    lower: int,
    upper: int,
    splits: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table, read by ``splits`` tasks over ranges of a numeric column.

    The bounds only place the ranges; rows outside them are read as well.
    """
    reader = spark.read.format("jdbc").options(
        url=url,
        dbtable=table,
        partitionColumn=split_on,
        lowerBound=str(lower),
        upperBound=str(upper),
        numPartitions=str(splits),
        fetchsize="10000",
    )
    return reader.options(**(properties or {})).load()
