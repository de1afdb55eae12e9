import os


import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from chronoweave.session import cut_lineage, shared_folder, stage
from chronoweave.sources.catalog import catalog_structure, child_tables
from chronoweave.sources.ledger import Ledger
from chronoweave.sources.paging import batches, keyset_page, offset_page, page_count
from chronoweave.sources.relational import jdbc_table, spread
from chronoweave.sources.sinks import append_rows, iterate, read_split, write_splits
from chronoweave.functions.hooks import good_and_failed, guarded_map
from chronoweave.sources.shuffled import buffered_shuffle, iterate_shuffled
from chronoweave.streaming.incremental import build_new, file_arrivals, published, running_totals, stream_builds


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def test_shared_folder_is_taken_from_the_session(spark):
    assert shared_folder(spark) == spark.sparkContext.getCheckpointDir()
    df = stage(spark.range(5).withColumn("p", F.col("id") % 2), "p")
    assert df.where("p = 1").count() == 2
    assert cut_lineage(spark.range(3)).count() == 3


def test_catalog(spark):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS cat LOCATION '{shared_folder(spark)}/cat'")
    try:
        spark.range(1).selectExpr("id AS hadm_id", "1 AS b").write.mode("overwrite").saveAsTable("cat.child")
        spark.range(1).write.mode("overwrite").saveAsTable("cat.other")
        structure = catalog_structure(spark, ["cat"])
        assert {r["table"]: r["columns"] for r in structure.collect()} == {"child": ["hadm_id", "b"], "other": ["id"]}
        assert [r["table"] for r in child_tables(structure, "cat", "hadm_id").collect()] == ["child"]
        assert child_tables(structure, "cat", "hadm_id", ["child"]).count() == 0
    finally:
        spark.sql("DROP DATABASE cat CASCADE")


def test_jdbc_options_reach_the_reader(spark):
    with pytest.raises(Exception, match="(?i)driver|suitable|ClassNotFound"):
        jdbc_table(spark, "jdbc:nothing://h/d", "t", split_on="id", lower=0, upper=10, splits=2)


def test_pages_and_batches(spark, rows_of):
    df = spark.range(10).withColumnRenamed("id", "i").repartition(4)
    assert rows_of(offset_page(df, ["i"], 3, 4)) == [(4,), (5,), (6,)]
    assert rows_of(keyset_page(df, "i", 6, 2)) == [(7,), (8,)]
    assert rows_of(page_count(df, 4)) == [(10, 3)]
    assert rows_of(batches(df, ["i"], 4).groupBy("batch").count()) == [(0, 4), (1, 4), (2, 2)]
    assert spread(df).rdd.getNumPartitions() >= 4


def test_splits_on_disk(spark, folder, rows_of):
    df = spark.createDataFrame([("1_0", 5, "train"), ("2_0", 6, "test")], "sample_id string, token_count int, split string")
    write_splits(df, f"{folder}/d")
    assert rows_of(read_split(spark, f"{folder}/d", "test")) == [("2_0", 6)]
    append_rows(df, f"{folder}/a")
    append_rows(df, f"{folder}/a")
    assert sum(1 for _ in iterate(spark.read.parquet(f"{folder}/a"))) == 4


def test_ledger(spark, folder, rows_of):
    ledger = Ledger(spark, f"{folder}/log", "id", "string")
    ids = spark.createDataFrame([("a",), ("b",), ("a",)], "id string")
    assert ledger.read().count() == 0
    ledger.add(ids)
    ledger.add(ids)
    assert rows_of(ledger.read()) == [("a",), ("b",)]
    assert rows_of(ledger.todo(spark.createDataFrame([("b",), ("c",), ("c",)], "id string"))) == [("c",)]
    ledger.reset()
    assert ledger.read().count() == 0


def _double(ids):
    return ids.withColumn("v", F.col("id") * 2)


def test_building_twice_is_building_once(spark, folder, rows_of):
    ledger = Ledger(spark, f"{folder}/log", "id")
    build_new(spark.range(3), ledger, _double, f"{folder}/out")
    # A run that wrote its rows and died before logging: the rows count as done.
    ledger.reset()
    build_new(spark.range(5), ledger, _double, f"{folder}/out")
    build_new(spark.range(5), ledger, _double, f"{folder}/out")
    assert rows_of(published(spark, f"{folder}/out"), "id", "v") == [(i, 2 * i) for i in range(5)]
    assert ledger.read().count() == 5


def test_a_run_that_died_while_writing_is_built_again(spark, folder, rows_of):
    """Half of the rows of id 1 and one of id 2 are there, from a run without a mark."""
    ledger = Ledger(spark, f"{folder}/log", "id")

    def pairs(ids):
        return ids.selectExpr("id", "explode(array(1, 2)) AS v")

    build_new(spark.range(1), ledger, pairs, f"{folder}/out")
    pairs(spark.range(1, 3)).where("v = 1").write.parquet(f"{folder}/out/run=dead")
    build_new(spark.range(4), ledger, pairs, f"{folder}/out")
    assert rows_of(published(spark, f"{folder}/out"), "id", "v") == [(i, v) for i in range(4) for v in (1, 2)]
    assert ledger.read().count() == 4


def test_stream_in_two_drops_equals_one_batch(spark, folder, rows_of):
    ledger = Ledger(spark, f"{folder}/log", "id")
    for ids in (spark.range(0, 4), spark.range(2, 7)):
        ids.write.mode("append").parquet(f"{folder}/in")
        arrivals = spark.readStream.schema("id long").parquet(f"{folder}/in")
        stream_builds(arrivals, ledger, _double, f"{folder}/out", f"{folder}/state").awaitTermination()
    assert rows_of(published(spark, f"{folder}/out"), "id", "v") == [(i, 2 * i) for i in range(7)]
    assert ledger.read().count() == 7


def test_running_totals_continue(spark, folder, rows_of):
    seen = []
    for n in (3, 2):
        spark.createDataFrame([("a", 10)] * n, "k string, n int").write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema("k string, n int").parquet(f"{folder}/in")
        running_totals(stream, ["k"], "n", f"{folder}/totals", f"{folder}/state").awaitTermination()
        seen.append(rows_of(spark.read.parquet(f"{folder}/totals")))
    assert seen == [[("a", 30, 3)], [("a", 50, 5)]]


@pytest.mark.parametrize("name", ["streaming_totals", "streaming_build"])
def test_streams_read_a_table_of_part_files(spark, folder, name):
    """A table may be one file or a folder of part files; both give the same rows."""
    whole, parts = "/root/testdata/sf0.001", f"{folder}/parts"
    for t in ("documents", "orders"):
        spark.read.parquet(f"{whole}/{t}.parquet").repartition(3).write.parquet(f"{parts}/{t}.parquet")
    one, many = queries()[name](spark, whole), queries()[name](spark, parts)
    assert many.count() == one.count() > 0 and many.exceptAll(one).count() == 0


class _Killed(Exception):
    pass


def test_a_killed_micro_batch_is_repeated_once(spark, folder, rows_of):
    """Three drops, one file to a micro-batch. The second one dies after half of its rows, then after its mark."""
    ledger, died = Ledger(spark, f"{folder}/log", "id"), []

    def dying(ids):
        if ids.where("id = 5").count() and len(died) < 2:
            died.append(1)
            run = [p for p in os.listdir(f"{folder}/out") if p.startswith("run=")][0].rpartition("-")[0]
            if len(died) == 1:
                _double(ids).where("id = 5").write.parquet(f"{folder}/out/{run}-1")
            else:
                # All of it is there, and the mark too, when the driver goes.
                _double(ids).write.mode("overwrite").parquet(f"{folder}/out/{run}-1")
                spark.createDataFrame([(f"{run[4:]}-1",)], "run string").write.mode("append").parquet(f"{folder}/out-published")
            raise _Killed("driver lost")
        return _double(ids)

    for ids in (spark.range(0, 4), spark.range(3, 9), spark.range(7, 12)):
        ids.coalesce(1).write.mode("append").parquet(f"{folder}/in")
    for attempt in range(3):
        arrivals = file_arrivals(spark, f"{folder}/in", ids.schema, files_per_trigger=1)
        stream = stream_builds(arrivals, ledger, dying, f"{folder}/out", f"{folder}/state")
        if attempt < 2:
            with pytest.raises(Exception, match="driver lost"):
                stream.awaitTermination()
        else:
            stream.awaitTermination()
    assert len(died) == 2
    assert rows_of(published(spark, f"{folder}/out"), "id", "v") == sorted([(i, 2 * i) for i in range(12)], key=str)
    assert ledger.read().count() == 12 and len(ledger.runs()) == 3


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("shuffled"))
    spark.range(5_000).withColumn("v", F.col("id") * 2).repartitionByRange(4, "id").write.mode("overwrite").parquet(path)
    return path


def _order(df):
    return [tuple(r) for r in df.orderBy("shard", "place").select("shard", "place", "id", "v").collect()]


def test_buffered_shuffle_is_seeded_and_whole(spark, files):
    once = _order(buffered_shuffle(spark.read.parquet(files), seed=1, buffer=100))
    assert sorted(r[2] for r in once) == list(range(5_000)) and all(r[3] == 2 * r[2] for r in once)
    assert len({r[0] for r in once}) == 4 and len({r[:2] for r in once}) == 5_000
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        again = _order(buffered_shuffle(spark.read.parquet(files), seed=1, buffer=100))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert again == once  # whatever the batches are
    other = _order(buffered_shuffle(spark.read.parquet(files), seed=2, buffer=100))
    assert [r[2] for r in other] != [r[2] for r in once]
    read = list(iterate_shuffled(buffered_shuffle(spark.read.parquet(files), seed=1, buffer=100)))
    assert [r["id"] for r in read] == [r[2] for r in once]


def test_buffered_shuffle_moves_rows_within_its_buffer(spark, files):
    rows = _order(buffered_shuffle(spark.read.parquet(files), seed=3, buffer=100))
    for shard in {r[0] for r in rows}:
        ids = [r[2] for r in rows if r[0] == shard]
        assert all(i - min(ids) <= place + 100 for place, i in enumerate(ids)) and ids != sorted(ids)
    assert [r[2] for r in _order(buffered_shuffle(spark.read.parquet(files), buffer=1))] != []
    whole = _order(buffered_shuffle(spark.read.parquet(files).where("id % 2 = 1").select("id", "v"), buffer=10_000))
    assert sorted(r[2] for r in whole) == list(range(1, 5_000, 2))
    assert buffered_shuffle(spark.read.parquet(files).where("id < 0")).count() == 0


def _square(batch):
    import pyarrow as pa

    n = batch.column("n").to_pylist()
    if 13 in n:
        raise ValueError("thirteen")
    if None in n:
        raise TypeError("no number")
    return pa.RecordBatch.from_arrays([pa.array([x * x for x in n])], names=["square"])


def test_hook_failures_are_captured_by_row(spark, rows_of):
    df = spark.createDataFrame([(i, None if i == 40 else i % 50) for i in range(200)], "id long, n long").repartition(3)
    tried = guarded_map(df, _square, "square long", ["id"])
    good, failed = good_and_failed(tried, ["id"])
    want = [(i, "TypeError: no number") for i in (40,)] + [(i, "ValueError: thirteen") for i in (13, 63, 113, 163)]
    assert rows_of(failed) == sorted(want, key=str)
    assert rows_of(good) == sorted([(i, (i % 50) ** 2) for i in range(200) if i not in (13, 40, 63, 113, 163)], key=str)
    assert guarded_map(df.limit(0), _square, "square long", ["id"]).count() == 0


def test_a_hook_that_returns_too_few_rows_fails_for_all_of_them(spark):
    df = spark.createDataFrame([(1, 1), (2, 2)], "id long, n long").coalesce(1)
    rows = guarded_map(df, lambda batch: batch.select(["n"]).slice(1), "n long", ["id"]).collect()
    assert [r["error"] for r in rows] == ["ValueError: 0 rows returned for 1"] * 2
