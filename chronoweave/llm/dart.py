"""Near-duplicate documents by dart MinHash signatures and banded joining.

A document is the multiset of its runs of five words (letters A-Z in lower case); the
weight of a run is how often it occurs. The similarity of two documents is the sum of
the smaller weights over the sum of the larger ones.

Signature: every element owns a strip of the plane for each unit of its weight. Darts fall
on a strip as a Poisson process along the rank axis; where they fall is computed by
hashing (element, unit, number of the dart), so equal elements of different documents
meet equal darts. A document throws darts up to the rank at which enough have landed
(ln k + 4 for each of the k coordinates), a hash of the dart names its coordinate, and the
earliest dart of every coordinate is the signature. Two signatures agree at a
coordinate with the probability of the similarity. Darts thrown do not depend on the
length of a text. Documents in which a coordinate stayed empty throw on to twice the rank.

Candidates: bands of six coordinates. 40 bands miss a pair of similarity 0.8 with a
probability of 5e-6. Equal multisets are one class first. In every bucket one member leads,
the one that meets most others over all its buckets, and every document is paired with the
leader it meets most often; that joins a group of copies in one pass over its rows. Buckets
whose members are then not all in one component are paired once more, between members of
different components only, so that nothing is left unseen. There a pair is left out if it
can't be similar enough: what two documents have in common is at most what each shares with
more than ``FEW`` of these documents, unless they meet in an element that ``FEW`` or fewer
have; such pairs are found by the element, with the weight that each shares with any other
as their bound. Copies that were changed too much for a link have many elements of their
own, so a large group of them gives few pairs.
Candidates are verified by their exact similarity.

Defined results: null, empty and blank texts have no runs and are single classes;
texts of fewer than five words are one run of all words. A class is named by its least id
(null ids are ignored; null if it has no other). Repeated rows are copies. An empty
table gives no rows. Columns of the input other than key and text play no part.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import Words, files_of, mix, query, release, shuffles_dropped, stage, table, text_batches
from chronoweave.llm.components import components

WIDTH = 5
SIMILARITY = 0.8
BANDS = 40
ROWS = 6
FEW = 8
_SEED = np.uint64(0xA0761D6478BD642F)
_STEP = np.uint64(0xE7037ED1A0B428DB)
_WRAP = (1 << 64) - 1


def occurrences(owner: np.ndarray, element: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, unit): rows sorted by owner and element, and which occurrence each one is."""
    order = np.lexsort((element, owner))
    o, e = owner[order], element[order]
    new = np.ones(len(o), bool)
    new[1:] = (o[1:] != o[:-1]) | (e[1:] != e[:-1])
    at = np.arange(len(o))
    return order, at - np.maximum.accumulate(np.where(new, at, 0))


def dart_signatures(owner: np.ndarray, strip: np.ndarray, n: int, k: int) -> np.ndarray:
    """The k-coordinate signature of each of n documents from the strips (element and unit) they own."""
    out = np.zeros((n, k), np.uint64)
    units = np.bincount(owner, minlength=n)
    reach = k * (math.log(k) + 4) / np.maximum(units, 1)
    todo = units > 0
    while todo.any():
        best = np.full((n, k), np.inf)
        mine = todo[owner]
        own, seed = owner[mine], strip[mine]
        rank = np.zeros(len(own))
        number = 0
        while len(own):
            number += 1
            dart = mix(seed ^ np.uint64(number * int(_STEP) & _WRAP))
            # the gap to the strip's next dart is exponential
            rank = rank - np.log1p(-(dart >> np.uint64(11)).astype(np.float64) * 2.0**-53)
            landed = rank <= reach[own]
            own, seed, rank, dart = own[landed], seed[landed], rank[landed], dart[landed]
            value = mix(dart ^ _SEED)
            slot = own * k + (value % np.uint64(k)).astype(np.int64)
            order = np.lexsort((rank, slot))
            first = np.ones(len(order), bool)
            first[1:] = slot[order][1:] != slot[order][:-1]
            pick = order[first]
            better = rank[pick] < best.ravel()[slot[pick]]
            pick = pick[better]
            best.ravel()[slot[pick]] = rank[pick]
            out.ravel()[slot[pick]] = value[pick]
        todo = todo & np.isinf(best).any(axis=1)
        reach = np.where(todo, reach * 2, reach)
    return out


def _signed(docs: DataFrame, key: str, text: str, width: int, bands: int, rows: int) -> DataFrame:
    """(id, digest, body, words, bands): digest of the multiset, null without words; body is the MD5 of the text."""
    fields = [("id", docs.schema[key].dataType), ("digest", T.BinaryType()), ("body", T.StringType()), ("words", T.LongType()), ("bands", T.ArrayType(T.LongType()))]
    schema = T.StructType([T.StructField(*f) for f in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            n = batch.num_rows
            owner, element = Words(batch.column("text")).shingles(width)
            order, unit = occurrences(owner, element)
            owner, element = owner[order], element[order]
            strip = mix(element + unit.astype(np.uint64) * _SEED)
            digest = np.zeros((n, 2), np.uint64)
            np.add.at(digest[:, 0], owner, strip)
            np.add.at(digest[:, 1], owner, mix(strip ^ _STEP))
            weight = np.bincount(owner, minlength=n)
            full = weight > 0
            signature = dart_signatures(owner, strip, n, bands * rows).reshape(n, bands, rows)
            keys = np.broadcast_to(mix(np.arange(1, bands + 1, dtype=np.uint64)), (n, bands)).copy()
            for i in range(rows):
                keys = mix(keys ^ signature[:, :, i]) + _STEP
            offsets = np.concatenate([[0], np.cumsum(full * bands)]).astype(np.int32)
            digests = pa.array([d.tobytes() if f else None for d, f in zip(digest, full, strict=True)], pa.binary())
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys[full].ravel().view(np.int64)))
            columns = [batch.column("id"), digests, batch.column("body"), pa.array(weight.astype(np.int64)), lists]
            yield pa.RecordBatch.from_arrays(columns, names=[f[0] for f in fields])

    body = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return docs.select(F.col(key).alias("id"), body.alias("body"), F.col(text).cast("string").alias("text")).mapInArrow(run, schema)


def _verified(pairs: DataFrame, texts: DataFrame, width: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose exact similarity is high enough."""
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(text_batches(batches, "left"), "right"):
            n = batch.num_rows
            sides = []
            for side in ("left", "right"):
                owner, element = Words(batch.column(side)).shingles(width)
                order, unit = occurrences(owner, element)
                sides.append((owner[order], mix(element[order] + unit.astype(np.uint64) * _SEED)))
            pair = np.concatenate([s[0] for s in sides])
            strip = np.concatenate([s[1] for s in sides])
            order = np.lexsort((strip, pair))
            pair, strip = pair[order], strip[order]
            both = (pair[1:] == pair[:-1]) & (strip[1:] == strip[:-1])
            common = np.bincount(pair[1:][both], minlength=n)
            total = np.bincount(pair, minlength=n)
            near = common >= similarity * (total - common) - 1e-9
            yield batch.select(["a", "b"]).filter(pa.array(near))

    a = texts.select(F.col("node").alias("a"), F.col("text").alias("left"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("right"))
    return pairs.join(b, "b").join(a, "a").select("a", "b", "left", "right").mapInArrow(run, schema)


def _led(shared: DataFrame, close) -> DataFrame:
    """(a, b): every node b with the leader a that it shares the most buckets with.

    The leader of a bucket is the member that meets most others over all its buckets: in a
    group of copies that is the text the copies were made from, or one close to it.
    """
    met = stage(shared.groupBy("node").agg(F.sum("n").alias("met")))
    best = F.max(F.struct("met", (-F.col("node")).alias("other"), F.col("words").alias("leading"))).alias("best")
    leaders = stage(shared.select("bucket", "node", "words").join(met, "node").groupBy("bucket").agg(best))
    led = shared.select("bucket", "node", "words").join(leaders, "bucket").select(
        "node", "words", (-F.col("best.other")).alias("leader"), F.col("best.leading").alias("leading")
    )
    led = led.where((F.col("node") != F.col("leader")) & close("words", "leading")).repartition("node")
    votes = led.groupBy("node", "leader").agg(F.count(F.lit(1)).alias("votes"))
    first = votes.groupBy("node").agg(F.max(F.struct("votes", (-F.col("leader")).alias("other"))).alias("first"))
    return first.select((-F.col("first.other")).alias("a"), F.col("node").alias("b"))


def _cores(nodes: DataFrame, texts: DataFrame, width: int) -> tuple[DataFrame, DataFrame]:
    """(node, words, shared, common), and (node, strip) of the strips that 2 to FEW nodes have.

    shared is the part of a node's weight that any other of the nodes has as well, common
    the part that more than FEW nodes have.
    """
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("strip", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            owner, element = Words(batch.column("text")).shingles(width)
            order, unit = occurrences(owner, element)
            strip = mix(element[order] + unit.astype(np.uint64) * _SEED)
            yield pa.RecordBatch.from_arrays([batch.column("node").take(pa.array(owner[order])), pa.array(strip.view(np.int64))], names=schema.names)

    texts = texts.join(nodes, "node", "left_semi")
    strips = stage(texts.select("node", "text").mapInArrow(run, schema))
    few = strips.groupBy("strip").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= FEW)
    held = stage(strips.join(few, "strip"))
    less = held.groupBy("node").agg(F.count(F.lit(1)).alias("few"), F.sum((F.col("n") == 1).cast("long")).alias("alone"))
    cores = texts.select("node", "words").join(less, "node", "left").select(
        "node",
        "words",
        (F.col("words") - F.coalesce("alone", F.lit(0))).alias("shared"),
        (F.col("words") - F.coalesce("few", F.lit(0))).alias("common"),
    )
    cores = stage(cores)
    release(nodes.sparkSession, files_of(strips))
    return cores, held.where("n > 1").select("node", "strip")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    width: int = WIDTH,
    similarity: float = SIMILARITY,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(id, body, class_id, kept): one row per document.

    body is the MD5 of the text (null as empty); kept marks the representative of a class,
    its least id and, among rows of that id, the least body. Rows that repeat both are
    all marked.
    """
    with shuffles_dropped(docs.sparkSession):
        return _classed(docs, key, text, width, similarity, bands, rows)


def _classed(docs: DataFrame, key: str, text: str, width: int, similarity: float, bands: int, rows: int) -> DataFrame:
    """Every table is deleted after its last reader; bands, of which a document has many, lie on disk once."""
    spark = docs.sparkSession
    signed = stage(_signed(docs, key, text, width, bands, rows))
    name = F.struct(F.col("id").isNull().alias("none"), "id", "body")
    classes = signed.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(name).alias("name"), F.first("words").alias("words"), F.first("bands").alias("bands")
    )
    numbered = stage(classes.withColumn("node", F.monotonically_increasing_id()))
    classes, signs = stage(numbered.drop("bands")), stage(signed.select("id", "body", "digest"))
    release(spark, files_of(signed))

    def close(x: str, y: str):
        """No pair is similar enough whose sizes differ too much."""
        return F.least(x, y) >= similarity * F.greatest(x, y) - 1e-9

    keyed = numbered.select("node", "words", F.explode("bands").alias("bucket"))
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = stage(keyed.join(sizes, "bucket"))
    release(spark, files_of(numbered))
    pairs = stage(_led(shared, close))
    met = shared.select("node").distinct().join(classes.select("node", "words", "name"), "node").select("node", "words", F.col("name.body").alias("body"))
    bodies = docs.select(F.md5(F.coalesce(F.col(text).cast("string"), F.lit(""))).alias("body"), F.col(text).cast("string").alias("text"))
    # Both sides grow with the corpus: without the hint a small one would be broadcast, and the plan change with the size.
    texts = stage(bodies.join(stage(met).hint("merge"), "body").groupBy("node").agg(F.first("words").alias("words"), F.first("text").alias("text")))
    links = stage(_verified(pairs, texts, width, similarity))
    roots = components(links, "a", "b")

    # What the leaders did not settle: buckets that hold more than one component.
    roots = stage(roots)
    placed = shared.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_ = placed.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("bucket")
    rest = shared.select("bucket", "node").join(stage(open_), "bucket")
    rest = stage(rest.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    release(spark, files_of(shared))
    cores, seldom = _cores(rest.select("node").distinct(), texts, width)

    def apart(core: str):
        """Two nodes of different components whose weights in common can be enough."""
        most = F.least(f"l.{core}", f"r.{core}")
        enough = most >= similarity * (F.col("l.words") + F.col("r.words") - most) - 1e-9
        return (F.col("l.node") < F.col("r.node")) & (F.col("l.root") != F.col("r.root")) & enough

    def met_in(rows: DataFrame, by: str, core: str) -> DataFrame:
        rows = rows.where(F.col(core) >= similarity * F.col("words") - 1e-9)
        both = rows.alias("l").join(rows.alias("r"), (F.col(f"l.{by}") == F.col(f"r.{by}")) & apart(core))
        return both.select(F.col("l.node").alias("a"), F.col("r.node").alias("b"))

    roles = cores.join(rest.groupBy("node").agg(F.first("root").alias("root")), "node")
    usual = rest.select("bucket", "node").join(roles, "node")
    more = met_in(usual, "bucket", "common").union(met_in(seldom.join(roles, "node"), "strip", "shared")).distinct()
    tried = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    more = stage(more.join(tried, ["a", "b"], "left_anti"))
    links = stage(links.union(_verified(more, texts, width, similarity)))
    roots = components(links, "a", "b")

    joined = stage(classes.select("node", "digest", "name").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")))
    named = joined.groupBy("root").agg(F.min("name").alias("best"))
    named = stage(joined.join(named, "root").select("digest", "best"))
    single = F.col("digest").isNull()
    same = F.col("id").eqNullSafe(F.col("best.id")) & (F.col("body") == F.col("best.body"))
    release(spark, files_of(texts, rest, cores, joined, classes))
    return signs.join(named, "digest", "left").select(
        "id", "body", F.when(single, F.col("id")).otherwise(F.col("best.id")).alias("class_id"), (single | same).alias("kept")
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near-duplicates: one row of each class, and all without words."""
    body = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    kept = near_duplicates(docs, key, text, **options).where("kept").groupBy(F.col("id").alias("__id"), F.col("body").alias("__match"))
    marked = stage(kept.agg(F.count(F.lit(1)).alias("__n")))
    keyed = docs.withColumn("__body", body)
    blank = ~F.coalesce(F.col(text).cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    same = F.col(key).eqNullSafe(F.col("__id")) & (F.col("__body") == F.col("__match"))
    # Rows that repeat key and text are few; the others need no grouping, which would move their texts again.
    once = keyed.where(~blank).join(marked.where("__n = 1"), same, "left_semi")
    again = keyed.where(~blank).join(marked.where("__n > 1"), same, "left_semi")
    first = [F.first(f"`{c}`").alias(c) for c in docs.columns if c != key]
    again = again.groupBy(key, "__body").agg(*first)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return once.select(*columns).unionByName(again.select(*columns)).unionByName(docs.where(blank))


@query("op3_minhash_dups")
def op3_minhash_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = near_duplicates(table(spark, sf_dir, "documents"))
    return made.select(F.col("id").alias("doc_id"), "class_id", "kept")
