"""The corpus pipeline: documents to a training mix, stage by stage.

STAGES lists (name, function). Each function takes (spark, docs, sf_dir) and returns a
DataFrame; ``run`` writes it as Parquet to the shared folder and reads it as the next
stage's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm import language, secrets
from chronoweave.llm.base import recording, release
from chronoweave.llm.dart import keep_one
from chronoweave.llm.decontaminate import without_leaks
from chronoweave.llm.mixing import mix_sources
from chronoweave.session import stage

_DONE: list[str] = []  # what the stage before has staged; its result has been written since


def tidy(step):
    """The stage, with the intermediate tables of the stage before deleted first."""

    @wraps(step)
    def run_step(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        release(spark, _DONE)
        with recording() as paths:
            result = step(spark, docs, sf_dir)
        _DONE[:] = paths
        return result

    return run_step


@tidy
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that language identification rejects, and write the language it finds.

    It learns from all labelled documents: nothing here is held out to be judged.
    """
    columns = docs.columns
    labelled = language.identify(docs, language.train(docs), F.lit(True))
    kept = labelled.where(~F.col("rejected")).withColumn("lang", F.col("lang_pred"))
    return kept.select(*[F.col(f"`{c}`") for c in columns])


@tidy
def drop_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return keep_one(docs)


@tidy
def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@tidy
def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets by a mark; every document stays, with its new length."""
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else clean


@tidy
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document once per copy that the target of its source asks for."""
    return mix_sources(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_duplicates),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("mix_sources", mix),
]

#: The stages hold trained models, which SQL can't express; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
