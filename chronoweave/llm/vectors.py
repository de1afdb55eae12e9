"""Near-duplicate vectors by an inverted multi-index.

Vectors are scaled to length one. The two halves have independent codebooks, fitted
by k-means on a bounded sample; every vector is indexed in the cell that its nearest
codewords form on the product grid. From a vector, cells are visited in order of
the squared distance to them (the sum of the squared distances of its halves to the
borders of the codewords' regions, as a multi-sequence traversal yields them), up to
``reach`` of the largest squared distance that a link can have. A displacement spreads
over all dimensions, so only a small part of it points across borders: with the
default quarter, recall was 1 against brute force on all tables at hand
(``reach=1`` proves it, at more cells). Visited pairs are verified by cosine in double
precision, block against block.

Equal vectors are one class before anything is compared; cells with many members are
dealt into blocks. Only counts and spanning links leave a block, never its pairs.

Defined results: vectors that are null, zero, of length zero or hold null, NaN or
infinite values, and vectors without a label link with nothing; so do vectors of
different lengths. A table without links gives single classes, an empty table none.
Null ids are ignored for the smallest id; rows that repeat an id count as vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import query, stage, table
from chronoweave.llm.components import components
from chronoweave.llm.groups import group_bounds, map_groups

COSINE = 0.98
REACH = 0.25
SAMPLE = 16_384  # vectors that fit the codebooks, at most
BLOCK = 1024  # vectors on each side of one comparison
MAX_CODES = 1024


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; by the largest entry first, which keeps extreme values finite."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def _nodes(vectors: DataFrame, key: str, vector: str, label: str) -> DataFrame:
    """(id, label, node, vec): node is a digest of label and vector, null if it links with nothing."""
    schema = T.StructType(
        [
            T.StructField("id", vectors.schema[key].dataType),
            T.StructField("label", vectors.schema[label].dataType),
            T.StructField("node", T.BinaryType()),
            T.StructField("vec", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, packed = [], []
            labels = batch.column("label").to_pylist()
            for vec, lab in zip(batch.column("vec"), labels, strict=True):
                raw = None
                if lab is not None and vec.is_valid and len(vec.values) and not vec.values.null_count:
                    raw = vec.values.to_numpy().astype(np.float64) + 0.0
                if raw is None or not np.isfinite(raw).all() or not raw.any():
                    nodes.append(None)
                    packed.append(None)
                    continue
                data = raw.tobytes()
                nodes.append(hashlib.md5(repr(lab).encode() + b"|" + data).digest())
                packed.append(data)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(nodes, pa.binary()), pa.array(packed, pa.binary())],
                names=["id", "label", "node", "vec"],
            )

    picked = vectors.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("vec"))
    return picked.mapInArrow(run, schema)


def _kmeans(points: np.ndarray, k: int, rounds: int = 10) -> np.ndarray:
    rng = np.random.default_rng(0)
    centres = points[rng.choice(len(points), min(k, len(points)), replace=False)]
    for _ in range(rounds):
        nearest = ((centres * centres).sum(1) - 2 * points @ centres.T).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, points)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return np.unique(centres, axis=0)


def _borders(half: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, squared distance to the border of every codeword's region)."""
    d = (half * half).sum(1)[:, None] + (codes * codes).sum(1) - 2 * half @ codes.T
    own = d.argmin(1)
    apart = np.sqrt(np.maximum((codes * codes).sum(1)[:, None] + (codes * codes).sum(1) - 2 * codes @ codes.T, 1e-30))
    gap = np.maximum(d - d[np.arange(len(d)), own][:, None], 0) / (2 * apart[own])
    gap[np.arange(len(d)), own] = 0
    return own, gap * gap


def _codebooks(classes: DataFrame, sample: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per vector length, two codebooks, fitted on a sample of at most ``sample`` vectors in all."""
    sizes = classes.groupBy((F.length("vec") / 8).cast("int").alias("dim"), "label").agg(F.count(F.lit(1)).alias("n"))
    largest = {r[0]: r[1] for r in sizes.groupBy("dim").agg(F.max("n")).orderBy("dim").limit(64).collect()}
    drawn = classes.orderBy(F.xxhash64("node")).limit(sample).select("vec").toPandas()["vec"]
    books = {}
    for dim, n in largest.items():
        rows = [np.frombuffer(v) for v in drawn if len(v) == dim * 8]
        points = _unit(np.array(rows)) if rows else np.zeros((1, dim))
        k = int(np.clip(2 ** round(np.log2(max(n, 4) ** 0.5 / 2)), 2, MAX_CODES))
        half = dim // 2
        books[dim] = (_kmeans(points[:, :half], k) if half else np.zeros((1, 0)), _kmeans(points[:, half:], k))
    return books


def _visits(classes: DataFrame, books: dict, cosine: float, reach: float) -> DataFrame:
    """(cell, member, node, copies, vec): one row in the own cell, one for each later cell visited."""
    fields = [("cell", T.StringType()), ("member", T.BooleanType()), ("node", T.BinaryType()), ("copies", T.LongType()), ("vec", T.BinaryType())]
    schema = T.StructType([T.StructField(*f) for f in fields])
    names = [f[0] for f in fields]
    bound = (2 - 2 * cosine) * reach + 1e-12

    def cells_of(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, second = books.get(unit.shape[1], (np.zeros((1, unit.shape[1] // 2)), np.zeros((1, unit.shape[1] - unit.shape[1] // 2))))
        a, to_a = _borders(unit[:, : first.shape[1]], first)
        b, to_b = _borders(unit[:, first.shape[1] :], second)
        # Cells by rising sum of the two borders, stopped where the sum passes the bound.
        row, i = np.nonzero(to_a <= bound)
        rest = bound - to_a[row, i]
        at, j = np.nonzero(to_b[row] <= rest[:, None])
        row, i = row[at], i[at]
        own = a[row] * len(second) + b[row]
        cell = i * len(second) + j
        later = cell >= own  # a pair is met from its lower cell
        return row[later], cell[later], cell[later] == own[later]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vec").to_pylist()
            lengths = np.array([len(v) for v in vectors])
            for size in np.unique(lengths):
                for part in np.array_split(np.flatnonzero(lengths == size), max(1, (lengths == size).sum() // 1024)):
                    if not len(part):
                        continue
                    unit = _unit(np.array([np.frombuffer(vectors[i]) for i in part]))
                    row, cell, member = cells_of(unit)
                    rows = batch.take(pa.array(part)).take(pa.array(row))
                    labels = rows.column("label").to_pylist()
                    keys = [f"{x!r}|{size}|{c}" for x, c in zip(labels, cell.tolist(), strict=True)]
                    columns = [pa.array(keys), pa.array(member), rows.column("node"), rows.column("copies"), rows.column("vec")]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return classes.select("label", "node", "copies", "vec").mapInArrow(run, schema)


def _blocks(visits: DataFrame) -> DataFrame:
    """Deal cells into blocks, and meet every block of visitors and members with every block of members.

    Sides: 0 visitors or members on the left, 1 members on the right; ``same`` marks a block
    of members met with itself.
    """
    sizes = visits.groupBy("cell").agg(
        F.ceil(F.sum(F.col("member").cast("long")) / BLOCK).alias("own"), F.ceil(F.sum((~F.col("member")).cast("long")) / BLOCK).alias("guests")
    )
    sizes = stage(sizes.where("own > 0"))
    dealt = visits.join(sizes, "cell")
    slot = F.pmod(F.xxhash64("node"), F.when(F.col("member"), F.col("own")).otherwise(F.greatest("guests", F.lit(1))))
    dealt = dealt.withColumn("slot", slot)

    def meeting(kind: str, left, right, side: int):
        name = F.concat_ws("|", "cell", F.lit(kind), left.cast("string"), right.cast("string"))
        return F.struct(name.alias("meeting"), F.lit(side).alias("side"), (F.lit(kind == "m") & (left == right)).alias("same"))

    up = F.sequence(F.lit(0).cast("long"), F.col("own") - 1)
    guests = F.when(F.col("guests") > 0, F.sequence(F.lit(0).cast("long"), F.col("guests") - 1)).otherwise(F.array().cast("array<long>"))
    as_guest = F.transform(up, lambda t: meeting("g", F.col("slot"), t, 0))
    as_left = F.transform(F.filter(up, lambda t: t >= F.col("slot")), lambda t: meeting("m", F.col("slot"), t, 0))
    as_right = F.transform(F.filter(up, lambda t: t < F.col("slot")), lambda t: meeting("m", t, F.col("slot"), 1))
    as_host = F.transform(guests, lambda g: meeting("g", g, F.col("slot"), 1))
    where = F.when(F.col("member"), F.concat(as_left, as_right, as_host)).otherwise(as_guest)
    return dealt.select(F.explode(where).alias("__m"), "node", "copies", "vec").select("__m.*", "node", "copies", "vec")


def _roots(hit: np.ndarray) -> np.ndarray:
    """Least index that each row of a symmetric relation reaches."""
    root = np.full(len(hit), -1)
    for i in range(len(hit)):
        if root[i] >= 0:
            continue
        root[i] = i
        front = np.array([i])
        while len(front):
            reached = hit[front].any(axis=0) & (root < 0)
            root[reached] = i
            front = np.flatnonzero(reached)
    return root


def _compare(cosine: float):
    def one(node: np.ndarray, copies: np.ndarray, unit: np.ndarray, side: np.ndarray, same: bool):
        if same:
            hit = unit @ unit.T >= cosine
            np.fill_diagonal(hit, False)
            linked = np.flatnonzero(hit.any(axis=1))
            hit = hit[np.ix_(linked, linked)]
        else:
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if not len(left) or not len(right):
                return None
            across = unit[left] @ unit[right].T >= cosine
            left, right, across = left[across.any(axis=1)], right[across.any(axis=0)], across[np.ix_(across.any(axis=1), across.any(axis=0))]
            linked = np.concatenate([left, right])
            hit = np.zeros((len(linked), len(linked)), bool)
            hit[: len(left), len(left) :] = across
            hit[len(left) :, : len(left)] = across.T
        if not len(linked):
            return None
        return node[linked], hit @ copies[linked], node[linked][_roots(hit)]

    def run(chunk: pa.Table) -> pa.RecordBatch | None:
        bounds = group_bounds(chunk.column("meeting"))
        node = np.array(chunk.column("node").to_pylist(), dtype=object)
        copies = chunk.column("copies").to_numpy()
        side, same = chunk.column("side").to_numpy(), chunk.column("same").to_numpy()
        vectors = chunk.column("vec").to_pylist()
        found = []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            if b - a > 1:
                unit = _unit(np.array([np.frombuffer(v) for v in vectors[a:b]]))
                found.append(one(node[a:b], copies[a:b], unit, side[a:b], bool(same[a])))
        found = [f for f in found if f is not None]
        if not found:
            return None
        n, c, r = (np.concatenate(x) for x in zip(*found, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(n, pa.binary()), pa.array(c.astype(np.int64)), pa.array(r, pa.binary())], names=["node", "links", "root"]
        )

    return run


def near_vectors(
    vectors: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    cosine: float = COSINE,
    reach: float = REACH,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per vector: its id, n_links, component_id and kept."""
    rows = stage(_nodes(vectors, key, vector, label))
    classes = rows.where("node IS NOT NULL").groupBy("node").agg(
        F.count(F.lit(1)).alias("copies"), F.min("id").alias("id"), F.first("label").alias("label"), F.first("vec").alias("vec")
    )
    classes = stage(classes)
    books = _codebooks(classes, sample)
    visits = stage(_visits(classes, books, cosine, reach))
    schema = T.StructType(
        [T.StructField("node", T.BinaryType()), T.StructField("links", T.LongType()), T.StructField("root", T.BinaryType())]
    )
    found = stage(map_groups(_blocks(visits), "meeting", ["side"], _compare(cosine), schema))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found, "node", "root")
    joined = classes.select("node", "copies", "id").join(links, "node", "left").join(roots, "node", "left")
    joined = stage(joined.withColumn("root", F.coalesce("root", "node")).withColumn("links", F.coalesce("links", F.lit(0)) + F.col("copies") - 1))
    least = joined.groupBy("root").agg(F.min("id").alias("component"))
    results = stage(joined.join(least, "root").select("node", "links", "component"))
    component = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component"))
    return rows.select("id", "node").join(results, "node", "left").select(
        F.col("id").alias(key),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"),
    )


@query("op2_vector_dups")
def op2_vector_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = near_vectors(table(spark, sf_dir, "embeddings"))
    return made.withColumn("component_id", F.col("component_id").cast("long"))
