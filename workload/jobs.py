"""Jobs with state on disk: splits, the ledger of done ids, streams, Arrow hooks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from chronoweave.functions.hooks import good_and_failed, guarded_map
from chronoweave.functions.tokens import HookTokenizer, map_batches
from chronoweave.plans.splits import split_by_hash
from chronoweave.session import shared_folder
from chronoweave.sources.ledger import Ledger
from chronoweave.sources.shuffled import buffered_shuffle
from chronoweave.sources.sinks import append_rows, read_split, write_splits
from chronoweave.streaming.incremental import build_new, file_arrivals, published, running_totals, stream_builds
from workload.base import query, table
from workload.texts import COUNT, FRACTION


def _folder(spark) -> str:
    return f"{shared_folder(spark)}/job-{uuid.uuid4().hex}"


@query("parquet_splits", f"SELECT doc_id, lang, n_chars FROM documents WHERE {FRACTION.format('doc_id')} < 0.2")
def parquet_splits(spark, sf):
    """Write both splits, read one back."""
    path = _folder(spark)
    documents = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    write_splits(split_by_hash(documents, "doc_id", 0.2, seed=7), path)
    return read_split(spark, path, "test")


@query("append_sink", "SELECT o_orderstatus, count(*) AS n_rows FROM orders GROUP BY 1")
def append_sink(spark, sf):
    path = _folder(spark)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    append_rows(orders.where("o_orderstatus = 'F'"), path)
    append_rows(orders.where("o_orderstatus <> 'F'"), path)
    return spark.read.parquet(path).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n_rows"))


@query("processed_log", "SELECT DISTINCT l_orderkey FROM lineitem")
def processed_log(spark, sf):
    """Ids logged in two overlapping runs: each occurs once."""
    ledger = Ledger(spark, _folder(spark), "l_orderkey")
    lines = table(spark, sf, "lineitem")
    ledger.reset()
    ledger.add(lines.where("l_returnflag = 'A'"))
    ledger.add(lines)
    return ledger.read()


def _build_orders(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return lambda ids: orders.join(ids.select("o_orderkey"), "o_orderkey", "left_semi")


@query("incremental_build", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def incremental_build(spark, sf):
    """Two runs over overlapping candidates write every order once."""
    path = _folder(spark)
    ledger = Ledger(spark, f"{path}/log", "o_orderkey")
    orders = table(spark, sf, "orders")
    build = _build_orders(spark, sf)
    build_new(orders.where("o_orderstatus = 'F'"), ledger, build, f"{path}/out")
    build_new(orders, ledger, build, f"{path}/out")
    return published(spark, f"{path}/out")


@query("streaming_build", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def streaming_build(spark, sf):
    """The same as a file stream that is run twice over the same arrivals."""
    path = _folder(spark)
    ledger = Ledger(spark, f"{path}/log", "o_orderkey")
    schema = table(spark, sf, "orders").schema
    for _ in range(2):
        arrivals = file_arrivals(spark, f"{sf}/orders.parquet", schema, files_per_trigger=100, nested=True)
        stream_builds(
            arrivals, ledger, lambda held: held.select("o_orderkey", "o_custkey", "o_totalprice"), f"{path}/out", f"{path}/state"
        ).awaitTermination()
    return published(spark, f"{path}/out")


@query(
    "streaming_totals",
    f"SELECT lang, CAST(sum({COUNT.format('text')}) AS BIGINT) AS tokens, count(*) AS n_rows FROM documents GROUP BY lang",
)
def streaming_totals(spark, sf):
    from chronoweave.functions.tokens import PatternTokenizer

    schema = table(spark, sf, "documents").schema
    stream = file_arrivals(spark, f"{sf}/documents.parquet", schema, nested=True)
    counted = stream.select("lang", PatternTokenizer().count(F.col("text")).alias("n"))
    out = _folder(spark)
    running_totals(counted, ["lang"], "n", out, _folder(spark)).awaitTermination()
    return spark.read.parquet(out)


@query(
    "hook_tokens",
    f"""SELECT doc_id, {COUNT.format('text')} AS n_tokens,
  array_to_string(list_transform(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \\t\\n\\r]'), lambda x: length(x)), ' ') AS ids FROM documents""",
)
def hook_tokens(spark, sf):
    """A Python tokenizer that is called once per Arrow batch."""

    def load():  # runs once per task; local, so that it travels with the task
        import re

        pattern = re.compile(r"[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r]")
        return lambda texts: [[len(t) for t in pattern.findall(text)] for text in texts]

    ids = HookTokenizer(load, longest=16, batched=True).ids(F.col("text"))
    tokens = table(spark, sf, "documents").select("doc_id", ids.alias("ids"))
    return tokens.select("doc_id", F.size("ids").alias("n_tokens"), F.array_join("ids", " ").alias("ids"))


@query("batched_map", "SELECT doc_id, CAST(length(text) AS BIGINT) AS n_chars FROM documents")
def batched_map(spark, sf):
    """A Python function over batches of rows."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def lengths(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = pc.cast(pc.utf8_length(batch.column("text")), pa.int64())
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), n], names=["doc_id", "n_chars"])

    return map_batches(table(spark, sf, "documents").select("doc_id", "text"), lengths, "doc_id long, n_chars long")


@query(
    "hook_quarantine",
    """WITH counted AS (SELECT doc_id, len(regexp_extract_all(text, '[^ \t\n\r]+')) AS n FROM documents)
SELECT doc_id, CASE WHEN n BETWEEN 5 AND 400 THEN n END AS n_words,
  CASE WHEN n < 5 THEN 'ValueError: only ' || n || ' words' WHEN n > 400 THEN 'OverflowError: ' || n || ' words' END AS error FROM counted""",
)
def hook_quarantine(spark, sf):
    """A hook that fails on very short and on long texts: their ids and messages beside all other results."""
    import pyarrow as pa

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        import re

        words = [len(re.findall(r"[^ \t\n\r]+", text)) for text in batch.column("text").to_pylist()]
        for n in words:
            if n < 5:
                raise ValueError(f"only {n} words")
            if n > 400:
                raise OverflowError(f"{n} words")
        return pa.RecordBatch.from_arrays([pa.array(words, pa.int64())], names=["n_words"])

    tried = guarded_map(table(spark, sf, "documents").select("doc_id", "text"), count, "n_words long", ["doc_id"])
    good, failed = good_and_failed(tried, ["doc_id"])
    return good.unionByName(failed, allowMissingColumns=True)


@query("buffered_shuffle", "SELECT doc_id, lang, n_chars FROM documents")
def buffered_shuffle_query(spark, sf):
    """Every row once, in the order that shard and place say; tests check the order, which SQL has no words for."""
    read = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return buffered_shuffle(read, seed=7, buffer=1_000).drop("shard", "place")
