"""Line deduplication across documents.

Every line is normalised (white space stripped at both ends, A-Z lowered) and hashed to
128 bits. Lines of at least ``min_chars`` code points whose hash occurs in at least
``min_docs`` documents are dropped everywhere but in the document with the smallest key;
the other lines are put together again by position. All of it is DataFrame functions.

Only hashes travel: the lines are staged as (document, position, hash), counted by hash
(documents are made distinct by (hash, document) first, so a line that a third of all
documents hold is spread over many tasks), and joined with the repeated hashes, which the
planner broadcasts if they are few and splits by skew if not. The positions to drop, at
most the lines of one text, meet their text in one join.

Defined results: null and empty texts are one empty line. Null keys are one document,
which sorts after all others. Rows that repeat a key are one document: decisions depend on
key and line alone, and each row is put together from its own lines. A very long text
costs time in proportion to its lines. A text that loses all its lines becomes empty. An
empty table gives no rows. Input columns named n_lines, n_dropped or kept are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.base import query, stage, table

MIN_DOCS = 2
MIN_CHARS = 10
STRIPPED = " \t\n\x0b\f\r"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z lowered and other letters as they are."""
    bare = F.btrim(line, F.lit(STRIPPED))
    plain = F.octet_length(bare) == F.char_length(bare)  # in ASCII, lower() changes A-Z alone, and is fast
    return F.when(plain, F.lower(bare)).otherwise(F.translate(bare, _UPPER, _UPPER.lower()))


def line_rows(docs: DataFrame, key: str, text: str, min_chars: int) -> DataFrame:
    """(id, body, pos, h, g): the lines of ``min_chars`` and more; body tells texts of one key apart."""
    full = F.coalesce(F.col(text).cast("string"), F.lit(""))
    each = docs.select(F.col(key).alias("id"), F.xxhash64(full).alias("body"), F.posexplode(F.split(full, "\n")).alias("pos", "line"))
    keyed = each.select("id", "body", "pos", line_key(F.col("line")).alias("line")).where(F.char_length("line") >= min_chars)
    return keyed.select("id", "body", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit(1), F.col("line")).alias("g"))


def repeated_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """(h, g, n_docs, first): hashes in at least ``min_docs`` documents, and the smallest key that holds them."""
    counts = lines.groupBy("h", "g").agg(
        (F.countDistinct("id") + F.max(F.col("id").isNull()).cast("long")).alias("n_docs"), F.min("id").alias("first")
    )
    return counts.where(F.col("n_docs") >= min_docs)


def drop_repeated_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS
) -> DataFrame:
    """The documents with n_lines, n_dropped and kept, the text that is left; other columns stay."""
    lines = stage(line_rows(docs, key, text, min_chars))
    repeated = stage(repeated_lines(lines, min_docs).select("h", "g", "first"))
    again = lines.join(repeated, ["h", "g"]).where(~F.col("id").eqNullSafe(F.col("first")))
    spots = again.groupBy("id", "body").agg(F.collect_set("pos").alias("__spots"))
    spots = spots.select(F.col("id").alias("__id"), F.col("body").alias("__spots_body"), "__spots")

    rest = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept")]
    full = docs.select(*[F.col(f"`{c}`") for c in rest], F.col(key).alias("__key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__full"))
    full = full.withColumn("__body", F.xxhash64("__full"))
    joined = full.join(spots, F.col("__key").eqNullSafe(F.col("__id")) & (F.col("__body") == F.col("__spots_body")), "left")
    n_lines = F.char_length("__full") - F.char_length(F.replace(F.col("__full"), F.lit("\n"), F.lit(""))) + 1
    split = F.array(F.split("__full", "\n"))  # of one element, so that transform binds the lines once

    def rebuilt(all_lines: Column) -> Column:
        left = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), F.col("__spots"))
        return F.array_join(F.transform(left, lambda at: F.get(all_lines, at)), "\n")

    return joined.select(
        *[F.col(f"`{c}`") for c in rest],
        n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("__spots"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("__spots").isNull(), F.col("__full")).otherwise(F.transform(split, rebuilt)[0]).alias("kept"),
    )


LINES_SQL = """
WITH texts AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
each AS (SELECT r, doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS pos FROM texts),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM each),
often AS (SELECT k, min(doc_id) AS first FROM keyed WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2),
marked AS (SELECT m.*, o.k IS NOT NULL AND m.doc_id <> o.first AS gone FROM keyed m LEFT JOIN often o ON m.k = o.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY r, doc_id
"""


@query("op13_line_dups", LINES_SQL)
def op13_line_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
