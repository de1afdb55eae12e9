"""Fill-in-middle transformation by displacement scatter.

A text is cut into units (a word with the white space ahead of it, or white space that
ends the text). Two cuts, drawn from a digest of seed and key, part it into prefix, middle
and suffix, which are written in another order behind markers. For a batch of texts all
moves are one difference array: at each byte where a part begins stands how much farther
its bytes go than those before. Its cumulative sum is every byte's shift, one scatter
writes the outputs, and the markers go to the gaps. The inverse finds the markers, builds
the same sums over the restored bytes, and gathers.

Work is per document without a shuffle; sums are taken over windows of a fixed length
with a carry, so a very long text costs a few times its own size.

Defined results: null is empty; an empty text, one that holds a marker, and the share
that the digest says stay plain, which leaves the counts of characters null. A null key
is digested as an empty string; rows that repeat key and text are cut alike. An empty
table gives no rows. Input columns named like an output are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import SPACE, query, table, text_batches, text_bytes

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = "42"
RATE = 50  # percent of the texts that are cut
SPM = 80  # percent of those with the suffix first
WINDOW = 1 << 20
_MARK = len(PREFIX)
_OUT = ("n", "form", "prefix_chars", "middle_chars", "output")


def unit_ends(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ends, first, n): where units end, the number of each text's first one, and how many it has."""
    last = np.zeros(len(raw), bool)
    if len(raw):
        inside = ~SPACE[raw]
        last[:-1] = inside[:-1] & ~inside[1:]
        last[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    ends = np.flatnonzero(last) + 1
    # A word at the start of a text ends the unit of none before: texts end units at their last byte.
    first = np.searchsorted(ends, offsets[:-1], "right")
    return ends, first, np.searchsorted(ends, offsets[1:], "right") - first


def code_points(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Code points of spans in order that do not overlap."""
    found = np.zeros(len(start), np.int64)
    some = np.flatnonzero(end > start)
    if len(some):
        edges = np.stack([start[some], end[some]], 1).ravel()
        lead = np.append((raw & 0xC0) != 0x80, False)
        found[some] = np.add.reduceat(lead, edges, dtype=np.int64)[::2]
    return found


def shifts(starts: np.ndarray, moves: np.ndarray, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(first byte, shift of each byte) by windows; ``moves`` holds the shift from each start on."""
    steps = np.diff(moves, prepend=0)
    carry = 0
    for low in range(0, n, WINDOW):
        size = min(WINDOW, n - low)
        a, b = np.searchsorted(starts, (low, low + size))
        change = np.zeros(size, np.int64)
        np.add.at(change, starts[a:b] - low, steps[a:b])
        change[0] += carry
        shift = np.cumsum(change)
        carry = int(shift[-1])
        yield low, shift


def _interleave(*parts: np.ndarray) -> np.ndarray:
    return np.stack(parts, 1).ravel()


def scatter(raw: np.ndarray, offsets: np.ndarray, one: np.ndarray, two: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the outputs. ``one`` and ``two`` are the cuts, form is 0 plain, 1 suffix first, 2 prefix first."""
    start, end = offsets[:-1], offsets[1:]
    cut = form > 0
    ends = np.zeros(len(offsets), np.int64)
    np.cumsum(end - start + np.where(cut, 3 * _MARK, 0), out=ends[1:])
    base, n_prefix, n_suffix = ends[:-1], one - start, end - two
    prefix = base + np.where(form == 1, n_suffix + 2 * _MARK, _MARK)
    suffix = base + np.where(form == 1, _MARK, n_prefix + 2 * _MARK)
    middle = base + n_prefix + n_suffix + 3 * _MARK
    moves = _interleave(np.where(cut, prefix, base) - start, np.where(cut, middle - one, base - start), np.where(cut, suffix - two, base - start))
    out = np.empty(int(ends[-1]), np.uint8)
    for low, shift in shifts(_interleave(start, one, two), moves, len(raw)):
        out[np.arange(low, low + len(shift)) + shift] = raw[low : low + len(shift)]
    for mark, place in ((PREFIX, prefix), (SUFFIX, suffix), (MIDDLE, middle)):
        for i, byte in enumerate(mark.encode()):
            out[place[cut] - _MARK + i] = byte
    return out, ends


def gather(raw: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets, whole) of the texts behind outputs; not whole: the markers are not those of the form."""
    start, end = offsets[:-1], offsets[1:]
    found = np.zeros(max(len(raw) - 2, 0), bool)
    names = [ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)]
    if len(found):
        found = (raw[:-2] == ord("<")) & np.isin(raw[1:-1], names) & (raw[2:] == ord(">"))
    marks = np.flatnonzero(found)
    at = np.searchsorted(marks, start)
    cut = form > 0
    whole = ~cut | (np.searchsorted(marks, end - 2) - at == 3)
    cut = cut & whole
    marks = np.append(marks, [0, 0, 0])
    a, b, c = (np.where(cut, marks[at + i], 0) for i in range(3))
    kinds = np.array([ord(PREFIX[1]), ord(SUFFIX[1]), ord(MIDDLE[1])])
    for f, order in ((1, (1, 0, 2)), (2, (0, 1, 2))):
        if len(raw):
            right = np.all([raw[np.minimum(p + 1, len(raw) - 1)] == kinds[k] for p, k in zip((a, b, c), order, strict=True)], 0) & (a == start)
            whole &= (form != f) | right
    cut &= whole
    head, tail = (a + _MARK, b), (b + _MARK, c)
    swap = form == 1
    prefix = np.where(cut, np.where(swap, tail[0], head[0]), start)
    n_prefix = np.where(cut, np.where(swap, tail[1], head[1]) - prefix, end - start)
    suffix = np.where(cut, np.where(swap, head[0], tail[0]), end)
    n_suffix = np.where(cut, np.where(swap, head[1], tail[1]) - suffix, 0)
    middle = np.where(cut, c + _MARK, end)
    n_middle = end - middle
    ends = np.zeros(len(offsets), np.int64)
    np.cumsum(n_prefix + n_middle + n_suffix, out=ends[1:])
    base = ends[:-1]
    starts = _interleave(base, base + n_prefix, base + n_prefix + n_middle)
    moves = _interleave(prefix, middle, suffix) - starts
    out = np.empty(int(ends[-1]), np.uint8)
    for low, shift in shifts(starts, moves, len(out)):
        out[low : low + len(shift)] = raw[np.arange(low, low + len(shift)) + shift]
    return out, ends, whole


def _strings(raw: np.ndarray, offsets: np.ndarray, valid: np.ndarray | None = None) -> pa.Array:
    made = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(raw))
    return made if valid is None or valid.all() else pa.compute.if_else(pa.array(valid), made, pa.scalar(None, pa.string()))


def _draw(digest: Column, group: int) -> Column:
    return F.conv(F.substring(digest, 8 * group + 1, 8), 16, 10).cast("long")


def fill_in_middle(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = SEED, rate: int = RATE, spm: int = SPM) -> DataFrame:
    """The documents with n (units), form, prefix_chars, middle_chars and output; other columns stay."""
    rest = [c for c in docs.columns if c not in _OUT]
    full = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    plain = (full == "") | (_draw(digest, 2) % 100 >= rate)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(full, F.lit(mark))
    form = F.when(plain, 0).when(_draw(digest, 3) % 100 < spm, 1).otherwise(2)
    given = docs.select(
        *[F.col(f"`{c}`") for c in rest], full.alias("__text"), _draw(digest, 0).alias("__one"), _draw(digest, 1).alias("__two"), form.alias("__form")
    )
    counts = [T.StructField("n", T.LongType()), T.StructField("form", T.StringType())]
    counts += [T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()), T.StructField("output", T.StringType())]
    schema = T.StructType([*[given.schema[c] for c in rest], *counts])
    names = pa.array(["plain", "spm", "psm"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "__text"):
            raw, offsets = text_bytes(batch.column("__text"))
            draws = np.stack([batch.column(c).to_numpy() for c in ("__one", "__two")])
            form = batch.column("__form").to_numpy()
            ends, first, n = unit_ends(raw, offsets)
            taken = draws % (n + 1)
            edge = np.append(ends, 0)
            one, two = (np.where(k > 0, edge[first + k - 1], offsets[:-1]) for k in (taken.min(0), taken.max(0)))
            out, bounds = scatter(raw, offsets, one, two, form)
            cut = form > 0
            chars = code_points(raw, _interleave(offsets[:-1], one), _interleave(one, two))
            made = [pa.array(n), names.take(pa.array(form))]
            made += [pa.array(chars[i::2], mask=~cut) for i in (0, 1)]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(rest))], *made, _strings(out, bounds)], names=schema.names)

    return given.mapInArrow(run, schema)


def restore(docs: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """Add the exact text behind ``output``; null if it does not hold the markers of its form. Other columns stay."""
    rest = [c for c in docs.columns if c != out]
    code = F.when(F.col(f"`{form}`") == "spm", 1).when(F.col(f"`{form}`") == "psm", 2).otherwise(0)
    given = docs.select(*[F.col(f"`{c}`") for c in rest], F.coalesce(F.col(f"`{output}`"), F.lit("")).alias("__text"), code.alias("__form"))
    schema = T.StructType([*[given.schema[c] for c in rest], T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "__text"):
            raw, offsets = text_bytes(batch.column("__text"))
            found, bounds, whole = gather(raw, offsets, batch.column("__form").to_numpy())
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in range(len(rest))], _strings(found, bounds, whole)], names=schema.names)

    return given.mapInArrow(run, schema)


FIM_SQL = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
units AS (
  SELECT *, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
    ('0x' || substr(h, 1, 8))::BIGINT AS h1, ('0x' || substr(h, 9, 8))::BIGINT AS h2,
    ('0x' || substr(h, 17, 8))::BIGINT AS h3, ('0x' || substr(h, 25, 8))::BIGINT AS h4 FROM texts),
cuts AS (
  SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
      WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM units),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
    coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cuts)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(p || m || s) AS restored_sha256 FROM parts
"""


@query("op11_fill_in_middle", FIM_SQL)
def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    back = restore(made)
    return back.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256"),
    )
