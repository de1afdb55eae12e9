"""Importance resampling towards a target distribution, with n-gram buckets by prefix CRC.

A text is lower-cased (A-Z) and its words joined by one space. That string is scanned once
and its running CRCs kept: in blocks that go forward in lockstep, then joined by carries.
A run of bytes from a to b has CRC prefix[b] ^ shift(prefix[a], b - a), because appending
m bytes multiplies a CRC by a power of x modulo its polynomial; that product is one table
look-up per byte of the CRC and base-256 digit of m. So every n-gram's CRC, and
from it its bucket, comes from two running CRCs, whatever its length.

Buckets of all documents and of all target texts are counted by tasks and summed by Spark,
which gives a table of ``buckets`` gains, a parameter's size. A document's weight is the
sum of its features' gains; with one seeded Gumbel number on top, the highest scores are a
draw without replacement by weight. Ranks come from range partitions of the narrow
(score, key) rows; no texts are sorted or collected.

Defined results: null and empty texts have no features and weight 0. Texts with fewer than
``min_words`` words are scored, not drawn. Ties go to the smaller key, null first; rows that
repeat a key are scored each on its own, and equal ones rank in the order they are read.
Very long texts are scanned in windows of whole words, with a carry. An empty table, or
an empty target (all gains then come from the documents alone), is no special case.
Input columns named n_features, n_words, weight, score or rank are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import CHUNK_BYTES, LOWER, query, stage, table, text_batches, text_bytes
from chronoweave.operators.ordered import global_positions

LONGEST = 1  # words in a feature
BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = "2024"
SCALE = 1000
_POLYNOMIAL = 0xEDB88320  # of the CRC-32 in general use, lowest power first
_ONES = np.uint32(0xFFFFFFFF)
_BLOCK = 256
_MADE = ("n_features", "n_words", "weight", "score", "rank")

_WORD = np.zeros(256, bool)
_WORD[[*range(ord("0"), ord("9") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 0x100)]] = True


def _byte_table() -> np.ndarray:
    value = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        value = np.where(value & 1, value >> 1 ^ np.uint32(_POLYNOMIAL), value >> 1).astype(np.uint32)
    return value


_BYTE = _byte_table()


def _looked_up(lanes: np.ndarray, value: np.ndarray) -> np.ndarray:
    return lanes[0][value & 0xFF] ^ lanes[1][value >> 8 & 0xFF] ^ lanes[2][value >> 16 & 0xFF] ^ lanes[3][value >> 24]


@cache
def _shift_tables() -> list[np.ndarray]:
    """[level][digit, lane, byte]: the CRC ``byte`` in lane ``lane``, moved on by digit * 256**level bytes."""
    still = np.arange(256, dtype=np.uint32)[None, :] << np.arange(0, 32, 8, dtype=np.uint32)[:, None]
    levels: list[np.ndarray] = []
    for level in range(4):
        rows = np.empty((256, 4, 256), np.uint32)
        rows[0] = still
        for digit in range(1, 256):
            if level:
                rows[digit] = _looked_up(levels[-1][1], _looked_up(levels[-1][255], rows[digit - 1]))
            else:
                rows[digit] = rows[digit - 1] >> 8 ^ _BYTE[rows[digit - 1] & 0xFF]
        levels.append(rows)
    return levels


def shift(crc: np.ndarray, length: np.ndarray) -> np.ndarray:
    """What running CRCs become after ``length`` more zero bytes."""
    crc = crc.copy()
    for level, rows in enumerate(_shift_tables()):
        digit = length >> 8 * level & 0xFF
        some = np.flatnonzero(digit)
        if len(some):
            d, v = digit[some], crc[some]
            crc[some] = rows[d, 0, v & 0xFF] ^ rows[d, 1, v >> 8 & 0xFF] ^ rows[d, 2, v >> 16 & 0xFF] ^ rows[d, 3, v >> 24]
    return crc


def running_crcs(raw: np.ndarray, places: np.ndarray, before: int = 0) -> np.ndarray:
    """The running CRC (no inversion of bits) after the first ``places`` bytes, for places that rise.

    ``before`` is the state that earlier bytes left. Blocks of bytes go forward side by
    side from zero; their carries are summed by doubling; a place adds the carry of its
    block, moved on by the bytes since.
    """
    n_blocks = max(-(-len(raw) // _BLOCK), 1)
    lanes = np.zeros(n_blocks * _BLOCK, np.uint8)
    lanes[: len(raw)] = raw
    lanes = np.ascontiguousarray(lanes.reshape(n_blocks, _BLOCK).T)
    kept = np.zeros((_BLOCK + 1, n_blocks), np.uint32)
    for i in range(_BLOCK):
        kept[i + 1] = _BYTE[(kept[i] ^ lanes[i]) & 0xFF] ^ kept[i] >> 8
    carry = np.empty(n_blocks, np.uint32)
    carry[0], carry[1:] = before, kept[_BLOCK, :-1]
    far = 1
    while far < n_blocks:
        carry[far:] ^= shift(carry[:-far], np.full(n_blocks - far, far * _BLOCK))
        far *= 2
    block = np.maximum(places - 1, 0) // _BLOCK
    inside = places - block * _BLOCK
    return kept[inside, block] ^ shift(carry[block], inside)


class Scan:
    """The words of a batch of texts: owner, and length and running CRC at both ends."""

    def __init__(self, column: pa.Array, window: int = CHUNK_BYTES) -> None:
        raw, offsets = text_bytes(column)
        parts, low, state, self.n_texts = [], 0, 0, len(offsets) - 1
        while low < len(raw):
            high = _whole_words(raw, low, window)
            part, state = _scan_window(raw[low:high], low, offsets, state)
            parts.append(part)
            low = high
        columns = zip(*parts, strict=True) if parts else [[np.empty(0, k)] for k in (np.int64, np.int64, np.uint32, np.uint32)]
        self.owner, self.length, self.head, self.tail = (np.concatenate(c) for c in columns)
        self.first = np.searchsorted(self.owner, np.arange(self.n_texts + 1))
        self.n_words = np.diff(self.first)

    def features(self, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(text, CRC-32) of the runs of 1, 2, ... ``longest`` words."""
        place = np.concatenate([[0], np.cumsum(self.length + 1)])  # words are a space apart
        for n in range(1, longest + 1):
            at = np.flatnonzero(np.arange(len(self.owner)) + n <= self.first[1:][self.owner])
            size = place[at + n] - place[at] - 1
            yield self.owner[at], self.tail[at + n - 1] ^ shift(self.head[at] ^ _ONES, size) ^ _ONES


def _whole_words(raw: np.ndarray, low: int, window: int) -> int:
    """The end of a window from ``low`` on that cuts no word."""
    high = low + window
    if high >= len(raw):
        return len(raw)
    gap = np.flatnonzero(~_WORD[LOWER[raw[low:high]]])
    if len(gap):
        return low + int(gap[-1]) + 1
    while high < len(raw) and _WORD[LOWER[raw[high]]]:
        high += 1
    return high


def _scan_window(raw: np.ndarray, low: int, offsets: np.ndarray, state: int) -> tuple[tuple[np.ndarray, ...], int]:
    """((owner, length, CRC ahead, CRC after) of each word, the CRC at the end) of one window of whole words."""
    raw = LOWER[raw]
    inside = _WORD[raw]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[(offsets > low) & (offsets < low + len(raw))] - low  # a word never runs over the end of its text
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    size = end - start
    place = np.cumsum(size + 1) - size - 1
    joined = np.full(int(size.sum()) + len(size), ord(" "), np.uint8)
    joined[np.arange(int(size.sum())) + np.repeat(np.arange(len(size)), size)] = raw[inside]
    at = np.empty(2 * len(size) + 1, np.int64)
    at[0:-1:2], at[1:-1:2], at[-1] = place, place + size, len(joined)
    crc = running_crcs(joined, at, state)
    owner = np.searchsorted(offsets, low + start, "right") - 1
    return (owner, size, crc[0:-1:2], crc[1:-1:2]), int(crc[-1])


def bucket_counts(docs: DataFrame, text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): features of all texts by bucket. Each task sends one row a bucket."""
    schema = "bucket long, n long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(buckets, np.int64)
        for batch in text_batches(batches, "text"):
            for _, crc in Scan(batch.column("text")).features(longest):
                counts += np.bincount(crc % np.uint32(buckets), minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    texts = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    return texts.mapInArrow(run, schema).groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(
    docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text", longest: int = LONGEST, buckets: int = BUCKETS
) -> list[int]:
    """The gain of each bucket: how much more frequent it is in the target, as a scaled logarithm."""
    sides = bucket_counts(docs, text, longest, buckets).withColumn("side", F.lit(0))
    sides = sides.unionByName(bucket_counts(target, target_text, longest, buckets).withColumn("side", F.lit(1)))
    counts = np.zeros((2, buckets), np.int64)
    for r in sides.collect():  # at most two rows a bucket
        counts[r.side, r.bucket] = r.n
    (s, t), (all_s, all_t) = counts.tolist(), counts.sum(1).tolist()
    return [
        math.floor(SCALE * math.log(float(t[i] + 1) * float(all_s + buckets) / (float(s[i] + 1) * float(all_t + buckets)))) for i in range(buckets)
    ]


def gumbel(key: Column, seed: str) -> Column:
    """A scaled Gumbel number from a digest of seed and key."""
    hexes = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(hexes, 1, 8), 16, 10).cast("long")
    return F.floor(-SCALE * F.ln(-F.ln((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def importance(
    docs: DataFrame, gains: list[int], key: str = "doc_id", text: str = "text", longest: int = LONGEST, seed: str = SEED
) -> DataFrame:
    """The documents with n_features, n_words, weight and score; other columns stay. No shuffle."""
    rest = [c for c in docs.columns if c not in _MADE]
    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"), F.col(f"`{key}`").alias("__key"))
    kept = [*rest, "__key"]
    schema = T.StructType([*[given.schema[c] for c in kept], *[T.StructField(c, T.LongType()) for c in _MADE[:3]]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = np.array(gains, np.int64)
        for batch in text_batches(batches, "__text"):
            scan = Scan(batch.column("__text"))
            total, n = np.zeros(scan.n_texts, np.int64), np.zeros(scan.n_texts, np.int64)
            for owner, crc in scan.features(longest):
                n += np.bincount(owner, minlength=scan.n_texts)
                np.add.at(total, owner, gain[crc % np.uint32(len(gain))])
            made = [pa.array(a) for a in (n, scan.n_words, total)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], *made], names=schema.names)

    return given.mapInArrow(run, schema).withColumn("score", F.col("weight") + gumbel(F.col("__key"), seed)).drop("__key")


def ranked(scored: DataFrame, key: str = "doc_id", percent: int = PERCENT, min_words: int = MIN_WORDS) -> DataFrame:
    """Add ``rank`` to scored rows (give narrow ones): 1 on from the highest score, null if not drawn."""
    rows = stage(scored)
    able = F.col("n_words") >= min_words
    n = rows.where(able).count()
    order = rows.where(able).withColumns({"__order": -F.col("score"), "__tie": F.monotonically_increasing_id()})
    placed = global_positions(order, ["__order", key, "__tie"], "rank").drop("__order", "__tie")
    drawn = F.when(F.col("rank") <= n * percent // 100, F.col("rank"))
    return placed.withColumn("rank", drawn).unionByName(rows.where(~able).withColumn("rank", F.lit(None).cast("long")))


def resample_plan(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """(key, n_features, n_words, weight, score, rank): one row per document."""
    gains = bucket_gains(docs, target, text, target_text, longest, buckets)
    scored = importance(docs.select(*dict.fromkeys([key, text])), gains, key, text, longest, seed)
    return ranked(scored.select(key, *_MADE[:4]), key, percent, min_words)


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    longest: int = LONGEST, buckets: int = BUCKETS, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED,
) -> DataFrame:
    """The drawn documents with all their columns, figures and rank. Rows that repeat key and score share their first rank."""
    gains = bucket_gains(docs, target, text, target_text, longest, buckets)
    scored = importance(docs, gains, key, text, longest, seed)
    plan = ranked(scored.select(key, *_MADE[:4]), key, percent, min_words).where("rank is not null")
    drawn = plan.groupBy(F.col(f"`{key}`").alias("__key"), F.col("score").alias("__score")).agg(F.min("rank").alias("rank"))
    same = F.col(f"`{key}`").eqNullSafe(F.col("__key")) & (F.col("score") == F.col("__score"))
    return scored.where(F.col("n_words") >= min_words).join(drawn, same).drop("__key", "__score")


# CRCs by SQL: a byte's share of a word's CRC depends on it and on how many bytes follow; shares add up by xor.
RESAMPLE_SQL = """
WITH RECURSIVE rounds AS (
  SELECT b::BIGINT AS b, b::BIGINT AS v, 0 AS i FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, i + 1 FROM rounds WHERE i < 8),
bytes AS (SELECT b, v AS c FROM rounds WHERE i = 8),
words AS (
  SELECT doc_id, d, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w
  FROM (SELECT doc_id, text, 1 AS d FROM documents UNION ALL SELECT NULL, text, 0 FROM benchmark)),
kinds AS (SELECT w, hex(encode(w)) AS x, octet_length(encode(w)) AS n FROM (SELECT DISTINCT w FROM words)),
shares AS (
  SELECT b, 0 AS far, c FROM bytes
  UNION ALL SELECT s.b, far + 1, xor(s.c >> 8, t.c) FROM shares s JOIN bytes t ON t.b = s.c & 255
  WHERE far < (SELECT max(n) FROM kinds)),
opening AS (  -- what the first state, all ones, has become after n bytes
  SELECT 0 AS n, 4294967295::BIGINT AS c
  UNION ALL SELECT n + 1, xor(o.c >> 8, t.c) FROM opening o JOIN bytes t ON t.b = o.c & 255 WHERE n < (SELECT max(n) FROM kinds)),
spelled AS (SELECT w, n, i, ('0x' || substr(x, 2 * i + 1, 2))::BIGINT AS b FROM (SELECT *, unnest(range(n)) AS i FROM kinds)),
crcs AS (
  SELECT w, xor(xor(bit_xor(s.c), any_value(o.c)), 4294967295) % 10000 AS bucket
  FROM spelled p JOIN shares s ON s.b = p.b AND s.far = p.n - 1 - p.i JOIN opening o ON o.n = p.n GROUP BY w),
found AS (SELECT doc_id, d, bucket FROM words JOIN crcs USING (w)),
counts AS (SELECT bucket, count(*) FILTER (WHERE d = 1) AS s, count(*) FILTER (WHERE d = 0) AS t FROM found GROUP BY bucket),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * ((SELECT sum(s) FROM counts) + 10000)::DOUBLE
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM counts) + 10000)::DOUBLE)))::BIGINT AS gain FROM counts),
weights AS (SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight FROM found JOIN gains USING (bucket) WHERE d = 1 GROUP BY doc_id),
scored AS (
  SELECT doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0)
    + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents LEFT JOIN weights USING (doc_id)),
placed AS (SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score,
  CASE WHEN place <= (SELECT count(*) FILTER (WHERE n_features >= 20) * 10 // 100 FROM scored) THEN place END AS rank FROM placed
"""


@query("op12_resample", RESAMPLE_SQL)
def op12_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample_plan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("n_words")
