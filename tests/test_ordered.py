"""Scans by stretches against plain windows, with keys that hold a third of the rows, an hour's or an instant's."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from chronoweave.operators.ordered import first_by, global_positions, hash_positions, key_cuts, ordered_scan
from chronoweave.session import stage


@pytest.fixture(scope="module")
def skewed(spark):
    rng = random.Random(3)
    start = datetime(2020, 1, 1)
    rows = []
    for i in range(1500):
        key = 0 if i % 3 == 0 else rng.randrange(1, 60)
        t = None if i % 97 == 0 else start + timedelta(hours=rng.randrange(0, 2000))
        rows.append((key, t, i, rng.choice([None, i]), rng.randrange(10)))
    return stage(spark.createDataFrame(rows, "k int, t timestamp_ntz, i int, v int, n int"))


def _scanned(d, **options):
    d = d.withColumn("vt", F.when(F.col("v").isNotNull(), F.struct("t", "i")))
    return ordered_scan(
        d, ["k"], ["t", "i"], number="rn", running={"total": "n"},
        carry={"last_v": "v"}, following={"next_v": "v", "next_t": "vt"}, monotone=["next_t"], **options,
    )


def _by_windows(d, columns):
    w = Window.partitionBy("k").orderBy("t", "i")
    upto, after = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(1, Window.unboundedFollowing)
    d = d.withColumn("vt", F.when(F.col("v").isNotNull(), F.struct("t", "i")))
    return d.withColumns(
        {
            "rn": F.row_number().over(w).cast("bigint"),
            "total": F.sum("n").over(upto),
            "last_v": F.last("v", ignorenulls=True).over(upto),
            "next_v": F.first("v", ignorenulls=True).over(after),
            "next_t": F.first("vt", ignorenulls=True).over(after),
        }
    ).select(*columns)


@pytest.mark.parametrize("rows", [1, 10, 100, 400, 1_000_000])
def test_scan_equals_windows(skewed, rows):
    got = _scanned(skewed, rows=rows)
    assert got.count() == 1500
    assert got.exceptAll(_by_windows(skewed, got.columns)).count() == 0


@pytest.mark.parametrize("cut_by", [["t"], ["t", "i"]])
def test_shared_cuts(skewed, cut_by):
    """Cuts of one table serve others along the same order, or along its first columns."""
    cuts = key_cuts(skewed.where("i % 2 = 0"), ["k"], cut_by, 20)
    got = _scanned(skewed, cuts=cuts)
    assert got.exceptAll(_by_windows(skewed, got.columns)).count() == 0 and got.count() == 1500
    finer = ordered_scan(skewed, ["k", "n"], ["t", "i"], number="rn", cuts=cuts)
    want = skewed.withColumn("rn", F.row_number().over(Window.partitionBy("k", "n").orderBy("t", "i")).cast("bigint"))
    assert finer.exceptAll(want.select(*finer.columns)).count() == 0


@pytest.mark.parametrize("instants", [1, 60])
def test_a_key_within_one_hour_is_spread(spark, instants):
    """All rows of a key in one instant, or in one hour: stretches stay short, and lie in several tasks."""
    rows = spark.range(40_000).select(
        F.lit(1).alias("k"), F.make_dt_interval(mins=(F.col("id") % instants).cast("int")).alias("at"), F.col("id").alias("i"), (F.col("id") % 7).alias("n")
    )
    rows = stage(rows.withColumn("t", F.lit(datetime(2020, 1, 1, 9)).cast("timestamp_ntz") + F.col("at")).drop("at"))
    cuts = key_cuts(rows, ["k"], ["t", "i"], 2_000)
    placed = cuts.placed(rows)
    sizes = [r["count"] for r in placed.groupBy("__stretch").count().collect()]
    assert 15 <= len(sizes) <= 26 and max(sizes) < 3_000
    tasks = placed.repartition(8, "k", "__stretch").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks >= 5
    got = ordered_scan(rows, ["k"], ["t", "i"], number="rn", running={"total": "n"}, cuts=cuts)
    w = Window.partitionBy("k").orderBy("t", "i")
    want = rows.withColumns({"rn": F.row_number().over(w).cast("bigint"), "total": F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))})
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_cuts_of_no_rows_and_short_keys(skewed):
    assert key_cuts(skewed.limit(0), ["k"], ["t"], 5).table is None
    assert key_cuts(skewed, ["k"], ["t"]).table is None
    long = key_cuts(skewed, ["k"], ["t", "i"], 100).table.collect()
    assert [r["k"] for r in long] == [0] and len(long[0]["__cuts"]) == 4 and long[0]["__cuts"] == sorted(long[0]["__cuts"])


def test_first_by(skewed):
    got = first_by(skewed, ["k", "n"], ["t", "i"])
    w = Window.partitionBy("k", "n").orderBy("t", "i")
    want = skewed.withColumn("rn", F.row_number().over(w)).where("rn = 1").drop("rn")
    assert got.exceptAll(want).count() == 0 and got.count() == want.count()


def test_global_positions(skewed):
    got = global_positions(skewed.select("n", "i"), ["n", "i"], "p")
    want = skewed.select("n", "i").withColumn("p", F.row_number().over(Window.orderBy("n", "i")).cast("bigint"))
    assert got.exceptAll(want).count() == 0 and got.count() == 1500


def test_positions_over_keys_alone(skewed):
    """The same numbers, joined back to wide rows that were never sorted."""
    wide = skewed.withColumn("text", F.repeat(F.lit("x"), 50))
    got, want = global_positions(wide, ["n", "i"], "p", unique=True), global_positions(wide, ["n", "i"], "p")
    assert got.columns == want.columns and got.exceptAll(want).count() == 0 and got.count() == 1500
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan


def test_hash_positions_survive_repartitioning(skewed):
    digest = F.md5(F.col("i").cast("string"))
    once = hash_positions(skewed.select("i"), digest, ["i"])
    again = hash_positions(skewed.select("i").repartition(3), digest, ["i"])
    assert once.exceptAll(again).count() == 0
    assert [r["position"] for r in once.orderBy("position").collect()] == list(range(1, 1501))
