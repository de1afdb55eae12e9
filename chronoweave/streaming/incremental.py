"""Builds that continue where the last one stopped."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from chronoweave.operators.joins import restrict
from chronoweave.session import cut_lineage
from chronoweave.sources.ledger import Ledger, run_names


def build_new(
    candidates: DataFrame, ledger: Ledger, build: Callable[[DataFrame], DataFrame], out: str, run: str | None = None
) -> None:
    """Build the ids that are not in the ledger, then log them. One writer at a time.

    Each run writes a folder of its own below ``out``, publishes it by a mark beside ``out``,
    and logs its ids. Rows of a run that died while writing have no mark: ``published`` leaves
    them out and their ids are built again. A run that died after its mark is
    logged by the next one, from that run's folder alone.

    A run that may be repeated brings its name in ``run``: it then overwrites what it left half
    written, and does nothing once it is published.
    """
    spark = candidates.sparkSession
    marked = _marked(spark, out)
    for done in sorted(marked - ledger.runs()):
        ledger.add(spark.read.parquet(f"{out}/run={done}"))
        ledger.add_run(done)
    if run in marked:
        return
    todo = cut_lineage(ledger.todo(candidates))
    run = uuid.uuid4().hex if run is None else run
    build(todo).write.mode("overwrite").parquet(f"{out}/run={run}")
    spark.createDataFrame([(run,)], "run string").write.mode("append").parquet(_marks(out))
    ledger.add(todo)
    ledger.add_run(run)


def published(spark: SparkSession, out: str) -> DataFrame:
    """The rows of all runs that ``build_new`` finished; at least one must be."""
    return spark.read.parquet(*[f"{out}/run={run}" for run in sorted(_marked(spark, out))])


def _marks(out: str) -> str:
    return f"{out.rstrip('/')}-published"


def _marked(spark: SparkSession, out: str) -> set[str]:
    """Names of the finished runs; there are as many as there were runs."""
    return run_names(spark, _marks(out))


def file_arrivals(
    spark: SparkSession, path: str, schema: T.StructType, *, files_per_trigger: int | None = None, pattern: str | None = None, nested: bool = False
) -> DataFrame:
    """A stream of the Parquet files that arrive in a folder, at most ``files_per_trigger`` to a micro-batch.

    ``pattern`` is held against names of files, not of folders. With ``nested``, files in folders below
    count too (their names give no partition columns), and ``path`` may be one file: so it reads a table whether
    that is a file or a folder of part files.
    """
    reader = spark.readStream.schema(schema)
    if nested:
        reader = reader.option("recursiveFileLookup", "true")
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(path)


def stream_builds(
    arrivals: DataFrame,
    ledger: Ledger,
    build: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
) -> StreamingQuery:
    """Run ``build_new`` over arriving stays; process what is there, then stop.

    The stream checkpoint remembers finished files and the ledger finished ids. A run is
    named by the stream's id, which its checkpoint keeps, and the number of the
    micro-batch: one that failed midway overwrites its own folder when it is
    repeated, and one that was published is skipped. Arrivals are read twice, for
    their ids and for their rows, and not kept in between, so a backlog needs no memory;
    ``file_arrivals`` bounds how much of it one micro-batch takes.
    """

    def one(batch: DataFrame, number: int) -> None:
        stream = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        build_new(batch, ledger, lambda ids: build(restrict(batch, ids, [ledger.key])), out, f"{stream}-{number}")

    return (
        arrivals.writeStream.foreachBatch(one)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def running_totals(stream: DataFrame, keys: list[str], count: str, out: str, checkpoint: str) -> StreamingQuery:
    """Running token totals, complete after each micro-batch, in the Parquet table ``out``.

    A micro-batch that is run again writes the same totals again.
    """
    totals = stream.groupBy(*keys).agg(F.sum(count).alias("tokens"), F.count(F.lit(1)).alias("n_rows"))
    return (
        totals.writeStream.outputMode("complete")
        .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
