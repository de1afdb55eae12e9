"""The table of ids that are done."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from chronoweave.operators.joins import not_in


def run_names(spark: SparkSession, path: str) -> set[str]:
    """The names in a table of runs; none if it is not there yet."""
    try:
        return {r["run"] for r in spark.read.schema("run string").parquet(path).collect()}
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return set()


class Ledger:
    """A Parquet id table; its path and id type are parameters."""

    def __init__(self, spark: SparkSession, path: str, key: str, key_type: str = "bigint"):
        self.spark = spark
        self.path = path
        self.key = key
        self.key_type = key_type

    @property
    def schema(self) -> str:
        return f"{self.key} {self.key_type}"

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(self.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], self.schema)

    def reset(self) -> None:
        self.spark.createDataFrame([], self.schema).write.mode("overwrite").parquet(self.path)
        self.spark.createDataFrame([], "run string").write.mode("overwrite").parquet(f"{self.path}-runs")

    def runs(self) -> set[str]:
        """Names of the runs whose ids are all logged."""
        return run_names(self.spark, f"{self.path}-runs")

    def add_run(self, run: str) -> None:
        self.spark.createDataFrame([(run,)], "run string").write.mode("append").parquet(f"{self.path}-runs")

    def todo(self, candidates: DataFrame) -> DataFrame:
        """Distinct candidate ids that are not done."""
        return not_in(candidates.select(self.key).distinct(), self.read(), [self.key])

    def add(self, ids: DataFrame) -> None:
        """Append ids that are not there yet; adding an id twice changes nothing."""
        self.todo(ids).write.mode("append").parquet(self.path)
