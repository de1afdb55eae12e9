"""Mixing sources to target weights: whole copies plus one seeded Bernoulli copy.

Tokens are summed per source. A source's target is its share by weight of all
tokens, at most ``max_rate`` times its own; what is above goes to the others by
weight until none is above. The repetition rate of a source is target / tokens; each
document is taken floor(rate) times, and once more with a probability equal to the
fraction. These Bernoulli copies are drawn systematically, so that what a source gives
stays within a few documents of its target: a source is dealt into groups of about
``group`` rows by a digest of key and text, the rows of a group stand in order of size,
and the r-th is copied if a whole number lies in (phase + (r-1) f, phase + r f]. The phase
of a group is a digest of the seed, so each document is copied with probability f.

Defined results: a null text has no tokens; a null source is a source of its own that
sorts last; a source without tokens has target 0 and rate 0; an empty table gives an
empty plan. Rows that repeat key and text get the same decision. Columns of the input
whose names clash with an output are replaced by it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from chronoweave.llm.base import WORD, query, stage, table
from chronoweave.operators.ordered import global_positions

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
SEED = "mix-1"
GROUP = 10_000


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def digest_of(seed: str, *parts: Column) -> Column:
    bare = [F.coalesce(p.cast("string"), F.lit("")) for p in parts]
    return F.md5(F.concat_ws("|", F.lit(seed), *bare))


def first_bits(digest: Column) -> Column:
    """The first 52 bits of a hex digest as a number."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """Per source: tokens, weight and target, from rows of (source, size).

    The level of the sources below their cap is exact: each step adds the sources
    above it to the capped ones, which only raises the level, so the loop ends after
    at most as many steps as there are caps to reach, and reads only three sums a step.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    last = totals.withColumn("__last", F.col("source").isNull())
    ranked = global_positions(last, ["__last", "source"], "__rank")
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (((F.col("__rank") - 1) % len(weights)) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", "rows", weight.cast("long").alias("weight")))
    cap = F.col("source_size") * max_rate
    total, free, kept = ranked.agg(F.sum("source_size"), F.sum("weight"), F.lit(0)).first()
    total = total or 0
    while free:
        above = cap * free > F.col("weight") * F.lit(total - kept)
        capped = F.when(~above, F.lit(1))
        held, left = ranked.agg(F.sum(F.when(capped.isNotNull(), cap)), F.sum(F.when(above, F.col("weight")))).first()
        if (held or 0) == kept and (left or 0) == free:
            break
        kept, free = held or 0, left or 0
    level = F.col("weight") * F.lit(total - kept).cast("double") / F.lit(float(free or 1))
    open_ = (cap * (free or 0) > F.col("weight") * F.lit(total - kept)) & F.lit(bool(free))
    return stage(ranked.withColumn("target", F.when(open_, level).otherwise(cap.cast("double"))))


def mix_plan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = WEIGHTS,
    max_rate: int = MAX_RATE,
    seed: str = SEED,
    group: int = GROUP,
) -> DataFrame:
    """The documents with size, source_size, target and copies; all other columns stay."""
    made = ("size", "source_size", "target", "copies")
    sized = docs.drop(*made).withColumn("size", word_count(text)).withColumn("__digest", digest_of(seed, F.col(key), F.col(text)))
    shares = source_targets(sized.select(F.col(source).alias("source"), "size"), weights, max_rate)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    shares = shares.select(
        F.col("source").alias("__source"), "source_size", "target", rate.alias("__rate"), F.ceil(F.col("rows") / group).alias("__groups")
    )
    joined = sized.join(shares, F.col(source).eqNullSafe(F.col("__source")))
    joined = joined.withColumn("__group", first_bits(F.col("__digest")) % F.col("__groups"))
    rank = F.row_number().over(Window.partitionBy("__source", "__group").orderBy("size", "__digest"))
    phase = first_bits(digest_of(seed, F.col("__source"), F.col("__group"))) / F.lit(float(1 << 52))
    part = F.col("__rate") - F.floor("__rate")
    extra = F.floor(rank * part + phase) - F.floor((rank - 1) * part + phase)
    planned = joined.withColumn("copies", F.floor("__rate") + extra)
    return planned.drop("__source", "__rate", "__groups", "__group", "__digest")


def mix_sources(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document once per copy, numbered from 1 in ``copy``."""
    columns = [c for c in docs.columns if c != "copy"]
    plan = mix_plan(docs.drop("copy"), **options).where("copies > 0")
    return plan.select(*[F.col(f"`{c}`") for c in columns], F.explode(F.sequence(F.lit(1).cast("long"), "copies")).alias("copy"))


# The level: sources in order of cap / weight; the first so many are capped, the rest share.
TARGET_SQL = """
sized AS (
  SELECT *, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
    md5('mix-1|' || coalesce(doc_id::VARCHAR, '') || '|' || coalesce(text, '')) AS digest FROM {docs}),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size, count(*) AS n, CASE (row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3
    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM sized GROUP BY source),
steps AS (
  SELECT coalesce(sum(3 * source_size) OVER before, 0)::BIGINT AS kept, sum(weight) OVER after_::BIGINT AS free,
    3 * source_size AS cap, weight, (SELECT sum(source_size) FROM totals)::BIGINT AS total
  FROM totals WINDOW before AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    after_ AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
level AS (SELECT kept, free, total FROM steps WHERE cap * free > weight * (total - kept) ORDER BY kept LIMIT 1),
shares AS (
  SELECT t.source, source_size, n, CASE WHEN free IS NOT NULL AND 3 * source_size * free > weight * (total - kept)
    THEN weight * (total - kept)::DOUBLE / free ELSE (3 * source_size)::DOUBLE END AS target
  FROM totals t LEFT JOIN level ON true),
dealt AS (
  SELECT d.*, s.source_size, s.target, CASE WHEN s.source_size > 0 THEN s.target / s.source_size ELSE 0 END AS rate,
    ('0x' || substr(digest, 1, 13))::BIGINT % ceil(n / 10000)::BIGINT AS part
  FROM sized d JOIN shares s ON d.source IS NOT DISTINCT FROM s.source),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source, part ORDER BY size, digest) AS r,
    ('0x' || substr(md5('mix-1|' || coalesce(source, '') || '|' || part), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS phase FROM dealt),
rated AS (
  SELECT *, (floor(rate) + floor(r * (rate - floor(rate)) + phase) - floor((r - 1) * (rate - floor(rate)) + phase))::BIGINT AS copies FROM placed)
"""


@query("op9_mix_sources", "WITH " + TARGET_SQL.format(docs="documents") + """
SELECT doc_id, size, source_size, target, size * copies AS taken FROM rated
""")
def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mix_plan(table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
