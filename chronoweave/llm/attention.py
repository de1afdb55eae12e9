"""Scoring texts with a causal self-attention model on subword ids.

Tokens of the report are words, letters A-Z in lower case, and one end per text. The
model splits every word into subwords of a public vocabulary (never trained here). Two
experts give the probability of the next subword, and are mixed:

* counts: what follows in a word after all its subwords so far, interpolated with trigrams
  of subwords, from the counts of all training words, which Spark sums; it also says
  where a word ends;
* attention: one causal head over the last subwords predicts a class of subwords; within
  a class a subword has its share of the counts. How a word begins is left to it. Inside
  words it counts for ``GATE``, and says that a word ends as often as words do.

So what can follow (the subwords at the beginning of a word; the subwords and the stop inside
one) has probabilities that sum to 1, and a score is a log probability.

The network is trained in numpy by averaging, in one pass over all training texts: each
round reads the texts of its own part, chosen by digest; every partition takes steps of its
own over its windows, Spark averages the weights, and the averages start the next round.
Only sums of fixed size reach the driver.

Texts are read in windows of 32 subwords, 24 apart; a subword is scored once, in the
first window that holds it, with at least 8 subwords of context unless the text has
less. Windows of equal length are batched, and later subwords are masked.

Counts of words, of what follows in a word and of trigrams cover all training texts and stay in
Spark tables, where the probabilities of every different word are worked out. The ``HEAD``
most frequent words are looked up; a text has all its other words with it, joined by their
64-bit hash. So ``head`` changes no score.

Tables of over ``SLICE`` different words are worked on in up to ``SLICES`` slices, one after the
other, so that the disk holds the shuffle files of one slice only: what follows in words by their first
subword, which no slice shares with another, and texts by their digest.

Defined results: null is empty; an empty text is one end. Without training texts all
counts are 0, and the model is uniform. A null id is a training row. Repeated rows are
scored alike.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import LOWER, Words, files_of, mix, query, recording, release, shuffles_dropped, stage, table, text_batches

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how texts are cut before byte pairs are merged; words reach it one by one.
PIECES = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
FOLDS, HELD = 7, 2
GATE = 0.1  # weight of the attention inside words
HEAD = 150_000
DISCOUNT = 0.5
WINDOW, STRIDE = 32, 24
LEAD = WINDOW - STRIDE  # places of a window that only the first one of a text scores
WIDTH, CLASSES, KNOWN = 16, 48, 4096
ROUNDS, BATCH, RATE = 2, 128, 0.01
SUMS = 16  # partitions in which weights are added up
SLICE, SLICES = 200_000, 4  # different words of a slice; slices at most, since each shuffles the rare words again
_START, _STOP = 65535, 65534
FACTS = ("hash", "n", "ids", "chance")


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Inside, Spark joins by a hash table, not by two sorts, where every partition that the table is made of was shuffled and is small."""
    name = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(name, None)
    spark.conf.set(name, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def tokenizer(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("subwords", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


def split_words(encoding, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, subwords of each word); every word has at least one.

    Pieces never run over a space, so words are split many at a time, and the bytes of the
    subwords tell where each word ends. Words that hold white space of their own go one by one.
    """
    spelled = [w.decode("utf-8", "replace") for w in words]
    plain = np.array([w.split() == [w] for w in spelled], bool)
    counts, ids = np.zeros(len(words), np.int64), [np.empty(0, np.int64)]
    size = np.array([len(encoding.decode_single_token_bytes(i)) for i in range(encoding.n_vocab)])
    bounds = np.unique(np.concatenate([[0, len(words)], np.arange(0, len(words), 10_000), np.flatnonzero(~plain), np.flatnonzero(~plain) + 1]))
    for at, end in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        found = np.array(encoding.encode_ordinary("".join([" " + w for w in spelled[at:end]])), np.int64)
        ids.append(found)
        if end == at + 1:
            counts[at] = len(found)
        else:
            ends = np.cumsum([len(w.encode()) + 1 for w in spelled[at:end]])
            counts[at:end] = np.diff(np.searchsorted(np.cumsum(size[found]), ends), prepend=-1)
    return np.concatenate(ids), counts


def most_frequent(counted: DataFrame, limit: int) -> pa.Table:
    """The rows whose ``m`` is so high that at most ``limit`` rows have as much; read without a sort."""
    sizes = counted.groupBy("m").agg(F.count(F.lit(1)).alias("c")).toArrow()  # a row for each different count
    m, c = sizes.column("m").to_numpy(), sizes.column("c").to_numpy()
    order = np.argsort(-m)
    fits = np.flatnonzero(np.cumsum(c[order]) <= limit)
    return counted.where(F.col("m") >= int(m[order[fits[-1]]]) if len(fits) else F.lit(False)).toArrow()


def _gather(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of consecutive stretches."""
    total = int(counts.sum())
    return np.arange(total) + np.repeat(starts - (np.cumsum(counts) - counts), counts)


class Sorted:
    """Finds values among sorted hashes, from where the leading bits of each begin."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.hashes = np.append(hashes, np.uint64(0xFFFFFFFFFFFFFFFF))
        bits = min(max(len(hashes), 1).bit_length() + 2, 22)
        self.shift = np.uint64(64 - bits)
        self.first = np.searchsorted(hashes, np.arange(1 << bits, dtype=np.uint64) << self.shift).astype(np.int32)

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place where each value is, or would be; whether it is there)."""
        at = self.first.take((values >> self.shift).view(np.int64))
        left = np.flatnonzero(self.hashes.take(at) < values)
        while len(left):
            at[left] += 1
            left = left[self.hashes.take(at[left]) < values[left]]
        return at, (self.hashes.take(at) == values) & (at < len(self.hashes) - 1)


def _slices(df: DataFrame, key: Column, n: int) -> list[DataFrame]:
    """``df`` in ``n`` parts, rows with equal ``key`` together."""
    return [df.where(F.pmod(F.xxhash64(key), F.lit(n)) == i) for i in range(n)] if n > 1 else [df]


def word_counts(docs: DataFrame) -> DataFrame:
    """(word, n, m) of all texts, n in training texts and m in all; each chunk is summed before it is shuffled."""
    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType()), T.StructField("m", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text", 4 << 20):
            words = Words(batch.column("text"))
            _, first, index, m = np.unique(words.hash, return_index=True, return_inverse=True, return_counts=True)
            training = ~batch.column("held_out").to_numpy(zero_copy_only=False)
            n = np.bincount(index, training[words.text], minlength=len(first)).astype(np.int64)
            start = words.offsets[words.text[first]] + words.start[first]
            length = words.end[first] - words.start[first]
            data = LOWER[words.raw[_gather(start, length)]].tobytes()
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            names = pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data))
            yield pa.RecordBatch.from_arrays([names, pa.array(n), pa.array(m)], names=schema.names)

    counted = docs.select("held_out", "text").mapInArrow(run, schema)
    return counted.groupBy("word").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))


def _split(vocabulary: DataFrame, path: str) -> DataFrame:
    """(hash, n, m, ids) of all words; ids are the subwords."""
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in ("hash", "n", "m")), T.StructField("ids", T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = tokenizer(path)
        for batch in batches:
            hashes = pa.array(Words(batch.column("word")).hash.view(np.int64))
            ids, counts = split_words(encoding, [w.encode() for w in batch.column("word").to_pylist()])
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([hashes, batch.column("n"), batch.column("m"), lists], names=schema.names)

    return vocabulary.mapInArrow(run, schema)


def _trigrams(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed trigrams of every subword, packed trigrams of every word's stop)."""
    first = np.cumsum(counts) - counts
    place = np.arange(len(ids)) - np.repeat(first, counts)
    one = np.where(place > 0, np.roll(ids, 1), _START)
    two = np.where(place > 1, np.roll(ids, 2), _START)
    last = first + counts - 1
    stop = (one[last] << 32) | (ids[last] << 16) | _STOP
    return (two << 32) | (one << 16) | ids, stop


def _list(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(values, length of each list) of a list column without nulls."""
    return column.flatten().to_numpy(zero_copy_only=False), column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def _steps(words: DataFrame) -> DataFrame:
    """(hash, at, parent, child, gram, n): what follows in a word after its first subword, and its stop last."""
    longs = ("hash", "parent", "child", "gram", "n")
    schema = T.StructType([*(T.StructField(c, T.LongType()) for c in longs), T.StructField("at", T.IntegerType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, counts = _list(batch.column("ids"))
            ids = ids.astype(np.int64)
            grams, stops = _trigrams(ids, counts)
            before, after, stopped = _prefixes(ids, counts)
            last = np.cumsum(counts) - 1
            word = np.repeat(np.arange(len(counts)), counts)
            at = np.arange(len(ids)) - (last - counts + 1)[word]
            inner = np.flatnonzero(at > 0)
            word = np.concatenate([word[inner], np.arange(len(counts))])
            columns = [batch.column("hash").take(pa.array(word))]
            for a, b in ((before, after[last]), (after, stopped), (grams, stops)):
                columns.append(pa.array(np.concatenate([a[inner], b]).view(np.int64)))
            columns += [batch.column("n").take(pa.array(word)), pa.array(np.concatenate([at[inner], counts]).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return words.select("hash", "n", "ids").mapInArrow(run, schema)


def _prefixes(ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of what a word has before each subword, hash with the subword, hash with each word's stop)."""
    after = np.zeros(len(ids), np.uint64)
    before = np.zeros(len(ids), np.uint64)
    first = np.cumsum(counts) - counts
    values = ids.astype(np.uint64) + np.uint64(1)
    alive, depth, state = np.flatnonzero(counts > 0), 0, np.zeros(len(counts), np.uint64)
    while len(alive):
        at = first[alive] + depth
        before[at] = state[alive]
        state[alive] = mix(state[alive] * np.uint64(0x9E3779B97F4A7C15) + values[at])
        after[at] = state[alive]
        depth += 1
        alive = alive[counts[alive] > depth]
    return before, after, mix(state * np.uint64(0x9E3779B97F4A7C15) + np.uint64(_STOP + 1))


def _discounted(below: str) -> Column:
    """Probability by counts ``n`` of ``total`` with absolute discounting; the rest, or all if nothing is known, goes by ``below``."""
    kept = f"greatest(n - {DISCOUNT}D, 0D)"
    return F.expr(f"CASE WHEN total > 0 THEN {kept} / total + (1 - held / total) * {below} ELSE {below} END")


def _totals(counted: DataFrame, context: str) -> DataFrame:
    return counted.groupBy(context).agg(F.sum("n").alias("total"), F.sum(F.expr(f"greatest(n - {DISCOUNT}D, 0D)")).alias("held"))


def word_chances(words: DataFrame, slices: int = 1) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """``words`` with chance (probability by counts of every subword but the first, then of the stop), and two arrays
    by subword: its count, and the count of words that it begins.

    Counts are interpolated: what follows in a word after all its subwords so far, trigrams, pairs, single subwords.
    Words that no training text has come with n = 0, so every probability that is asked for has its row.
    """
    parts = _slices(words, F.col("ids")[0], slices)
    node = [F.first("parent").alias("parent"), F.first("gram").alias("gram"), F.sum("n").alias("n")]
    nodes = [stage(_steps(part).groupBy("child").agg(*node)) for part in parts]
    grams = stage(reduce(DataFrame.unionByName, nodes).groupBy("gram").agg(F.sum("n").alias("n")))
    pairs = stage(grams.groupBy(F.expr("gram & 4294967295").alias("pair")).agg(F.sum("n").alias("n")))
    pairs = pairs.withColumns({"one": F.expr("shiftright(pair, 16)"), "last": F.expr("pair & 65535")})

    def by_subword(counted: DataFrame) -> np.ndarray:
        found = counted.toArrow()  # at most 65,536 rows
        out = np.zeros(65536)
        out[found.column("last").to_numpy()] = found.column("n").to_numpy()
        return out

    starts = by_subword(words.groupBy(F.col("ids")[0].cast("long").alias("last")).agg(F.sum("n").alias("n")))
    single = by_subword(pairs.groupBy("last").agg(F.sum("n").alias("n"))) + starts
    spark = words.sparkSession
    singles = pa.table({"last": np.arange(65536), "p1": (single + 0.5) / (single.sum() + 0.5 * 65536)})
    singles = spark.createDataFrame(singles)
    pairs = pairs.join(F.broadcast(singles), "last").join(F.broadcast(_totals(pairs, "one")), "one")
    pairs = pairs.select("pair", _discounted("p1").alias("p2"))
    grams = grams.withColumns({"two": F.expr("shiftright(gram, 16)"), "pair": F.expr("gram & 4294967295")})
    grams = grams.join(_totals(grams, "two"), "two").join(pairs, "pair").select("gram", _discounted("p2").alias("p3"))
    grams = stage(grams)
    made = []
    for part, counted in zip(parts, nodes, strict=True):
        known = stage(counted.join(_totals(counted, "parent"), "parent").join(grams, "gram").select("child", _discounted("p3").alias("p")))
        release(spark, files_of(counted))
        chances = _steps(part).select("hash", "at", "child").join(known, "child").groupBy("hash")
        chances = chances.agg(F.array_sort(F.collect_list(F.struct("at", "p"))).alias("chance"))  # one for each subword of a word
        made.append(stage(part.join(chances.select("hash", F.col("chance.p").alias("chance")), "hash")))
        release(spark, files_of(known))
    return reduce(DataFrame.unionByName, made), single, starts


class Lexicon:
    """Subwords of frequent words with their probabilities, and the classes of subwords."""

    def __init__(self, words: pa.Table, single: np.ndarray, starts: np.ndarray) -> None:
        """``words`` has hash, n, ids and chance; the arrays are those of ``word_chances``."""
        self.head = self.read([pa.concat_arrays(words.column(c).chunks) if words.num_rows else words.column(c).combine_chunks() for c in FACTS])
        order = np.argsort(self.head[0])
        self.order, self.hash = order, self.head[0][order]
        self.looked_up = Sorted(self.hash)
        self.single = (single + 0.5) / (single.sum() + 0.5 * 65536)
        self.ends = float((single[_STOP] + 0.5) / (single.sum() - starts.sum() + 1))  # of what comes inside words
        total = max(starts.sum(), 1.0)
        kept = np.maximum(starts - DISCOUNT, 0) / total
        self.starts = self.single
        for _ in range(2):  # as a pair and as a trigram with nothing before it
            self.starts = kept + (1 - kept.sum()) * self.starts if starts.any() else self.single
        self.rank = np.full(65536, KNOWN, np.int64)
        top = np.argsort(-self.single, kind="stable")[:KNOWN]
        self.rank[top] = np.arange(len(top))
        self.top = top
        self.shared = None
        self.classify(None)

    def send(self, spark: SparkSession) -> None:
        """Send the frequent words to the executors once, not with every job."""
        self.shared = spark.sparkContext.broadcast((self.head, self.order, self.hash, self.looked_up))

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if self.shared is None or k not in ("head", "order", "hash", "looked_up")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        if self.shared is not None:
            self.head, self.order, self.hash, self.looked_up = self.shared.value

    def classify(self, context: np.ndarray | None) -> None:
        """Classes of the frequent subwords by the direction of their contexts; the rest is the last class."""
        self.group = np.full(65536, CLASSES - 1)
        if context is not None:
            points = context[: len(self.top)] / np.maximum(np.linalg.norm(context[: len(self.top)], axis=1, keepdims=True), 1e-9)
            centres = points[: CLASSES - 1]  # the most frequent ones
            for _ in range(15):
                near = (points @ centres.T).argmax(1)
                sums = np.zeros_like(centres)
                np.add.at(sums, near, points)
                centres = np.where(np.abs(sums).sum(1, keepdims=True) > 0, sums, centres)
                centres = centres / np.maximum(np.linalg.norm(centres, axis=1, keepdims=True), 1e-9)
            self.group[self.top] = (points @ centres.T).argmax(1)
        self.share, self.start_share = (self._shares(weight) for weight in (self.single, self.starts))

    def _shares(self, weight: np.ndarray) -> np.ndarray:
        """The share of each subword in its class; the stop is none."""
        weight = weight.copy()
        weight[_STOP] = 0
        return weight / np.maximum(np.bincount(self.group, weight, minlength=CLASSES)[self.group], 1e-30)

    def contexts(self, laid: dict[str, np.ndarray]) -> np.ndarray:
        """For every frequent subword the sum of what its windows hold, in a random projection."""
        project = np.random.default_rng(0).standard_normal((KNOWN + 1, 32)).astype(np.float32)
        project[: len(self.top)] /= np.sqrt(self.single[self.top] + 1e-4)[:, None].astype(np.float32)
        project[KNOWN] = 0
        out = np.zeros((KNOWN + 1, 32), np.float32)
        ranks = self.rank[laid["ids"]]
        for at in range(0, len(laid["index"]), 256):
            rank = ranks[laid["index"][at : at + 256]]
            held = project.take(rank, axis=0)
            around = (held.sum(1, keepdims=True) - held).reshape(-1, 32)
            around /= np.maximum(np.sqrt((around * around) @ np.ones(32, np.float32)), 1e-9)[:, None]
            _add_by(out, rank.ravel(), around)
        return out[:KNOWN]

    @staticmethod
    def read(facts: list[pa.Array]) -> tuple[np.ndarray, ...]:
        """(hash, n, subwords per word, log10 probability of each stop, ids of all words, their probabilities)."""
        hashes, n, ids, chance = facts
        ids, counts = _list(ids)
        chance, _ = _list(chance)  # all subwords but the first, and the stop
        last = np.cumsum(counts) - 1
        stop = np.log10(np.maximum(chance[last], 1e-30)) if len(last) else np.zeros(0)
        shifted = np.roll(chance, 1).astype(np.float32)
        shifted[last - counts + 1] = 0  # how words begin is left to the attention
        return hashes.to_numpy().view(np.uint64), n.to_numpy(), counts, stop, ids.astype(np.int64), shifted

    @staticmethod
    def read_short(facts: list[pa.Array]) -> tuple[np.ndarray, ...]:
        """The same of the columns that ``_short`` makes."""
        hashes, n, ids, chance, stop = facts
        ids, counts = _list(ids)
        shifted = np.zeros(len(ids), np.float32)
        inner = np.ones(len(ids), bool)
        inner[np.cumsum(counts) - counts] = False
        shifted[inner] = _list(chance)[0]
        return hashes.to_numpy().view(np.uint64), n.to_numpy(), counts, np.log10(np.maximum(stop.to_numpy(), 1e-30)), ids.astype(np.int64) & 65535, shifted

    def subwords(self, batch: pa.RecordBatch, words: Words) -> tuple[np.ndarray, ...]:
        """For a chunk of texts: count of each word, then id, probability, share, opening and text of every subword, and stops by word."""
        rare = self.read_short(batch.column("rare").flatten().flatten())
        hashes, pick = np.unique(rare[0], return_index=True)
        # A word is in one of the two sorted halves.
        at, inside = self.looked_up.find(words.hash)
        other = np.flatnonzero(~inside)
        found = np.searchsorted(hashes, words.hash[other])
        if len(found) and not (len(hashes) and (hashes.take(found, mode="clip") == words.hash[other]).all()):
            raise ValueError("a text came without its words")
        word = self.order.take(at, mode="clip") if len(self.order) else np.zeros(len(at), np.int64)
        word[other] = len(self.order) + pick[found]
        n, sizes, stops, all_ids, all_chance = (np.concatenate(pair) for pair in zip(self.head[1:], rare[1:], strict=True))
        starts, ended = np.cumsum(sizes) - sizes, np.log10(GATE * self.ends + (1 - GATE) * 10.0**stops)
        first = np.zeros(len(all_ids), bool)
        first[starts] = True
        share = np.where(first, self.start_share[all_ids], (1 - self.ends) * self.share[all_ids]).astype(np.float32)
        counts = sizes.take(word)
        flat = _gather(starts.take(word), counts)
        return n.take(word), all_ids.take(flat), all_chance.take(flat), share.take(flat), first.take(flat), np.repeat(words.text, counts), ended.take(word)


def _short(words: DataFrame) -> DataFrame:
    """hash, n, ids (two bytes each), chance (floats, as they are used) and stop (the last chance) of ``words``."""
    ids = F.transform("ids", lambda i: F.when(i > 32767, i - 65536).otherwise(i).cast("smallint"))
    inner = F.slice("chance", F.lit(1), F.size("chance") - 1).cast("array<float>")
    return words.select("hash", "n", ids.alias("ids"), inner.alias("chance"), F.element_at("chance", -1).alias("stop"))


def with_rare_words(docs: DataFrame, words: DataFrame, head: np.ndarray) -> DataFrame:
    """``docs`` with rare: what ``_short`` gives for the words of each text that are not in ``head``, sorted hashes."""
    schema = T.StructType([T.StructField("body", T.BinaryType()), T.StructField("hash", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = Sorted(head)
        for batch in text_batches(batches, "text"):
            found = Words(batch.column("text"))
            rare = np.flatnonzero(~frequent.find(found.hash)[1])
            owner, hashes = found.text[rare], found.hash[rare]
            order = np.lexsort((hashes, owner))
            owner, hashes = owner[order], hashes[order]
            new = np.ones(len(owner), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
            columns = [batch.column("body").take(pa.array(owner[new])), pa.array(hashes[new].view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    keyed = docs.withColumn("body", F.unhex(F.md5("text")))
    pairs = keyed.select("body", "text").mapInArrow(run, schema).repartition("hash").distinct()  # dealt once, for the join too
    facts = _short(words)
    listed = pairs.join(facts, "hash").groupBy("body")
    listed = listed.agg(F.collect_list(F.struct(*facts.columns)).alias("rare"))  # at most one for each word of a text
    joined = keyed.join(listed, "body", "left").drop("body")
    none = F.array().cast(listed.schema["rare"].dataType)
    return joined.withColumn("rare", F.coalesce("rare", none))


def windows(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(indices into the subwords, valid, scored) of all windows of texts laid end to end."""
    n = np.where(lengths > 0, 1 + np.maximum(0, -(-(lengths - WINDOW) // STRIDE)), 0)
    text = np.repeat(np.arange(len(lengths)), n)
    number = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    inside = (number * STRIDE)[:, None] + np.arange(WINDOW)
    valid = inside < lengths[text][:, None]
    scored = valid & ((number == 0)[:, None] | (np.arange(WINDOW) >= WINDOW - STRIDE))
    base = (np.cumsum(lengths) - lengths)[text][:, None]
    return base + np.minimum(inside, lengths[text][:, None] - 1), valid, scored


_CAUSAL = np.tri(WINDOW, dtype=np.float32)


def _exponentials(logits: np.ndarray, seen: np.ndarray | None = None) -> np.ndarray:
    """exp in place, up to a factor by row, and 0 where ``seen`` is; the largest is only taken off where the range of floats asks for it."""
    if logits.size and not max(logits.max(), -logits.min()) < 40:
        if seen is not None:
            logits += np.where(seen > 0, np.float32(0), np.float32(-1e9))
        logits -= logits.max(-1, keepdims=True)
    np.exp(logits, out=logits)
    if seen is not None:
        logits *= seen
    return logits


def _add_by(out: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """``out[at] += rows`` with repeated ``at`` (below 65,536), summed in the order of rows."""
    at = at.astype(np.uint16)
    order = np.argsort(at, kind="stable")
    at = at[order]
    first = np.flatnonzero(np.diff(at, prepend=at[:1] + np.uint16(1)))
    out[at[first]] += np.add.reduceat(rows.take(order, axis=0), first, axis=0)


class Network:
    """One causal attention head over subwords; outputs classes of subwords."""

    SHAPES = {
        "embed": (KNOWN + 2, WIDTH), "place": (WINDOW, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH),
        "value": (WIDTH, WIDTH), "merge": (WIDTH, WIDTH), "out": (WIDTH, CLASSES), "bias": (CLASSES,),
    }

    def __init__(self, flat: np.ndarray | None = None) -> None:
        if flat is None:
            rng = np.random.default_rng(1)
            parts = [rng.standard_normal(s) * (0.0 if k == "bias" else 0.3 if k == "embed" else 0.1 if k == "place" else WIDTH**-0.5) for k, s in self.SHAPES.items()]
            flat = np.concatenate([p.ravel() for p in parts])
        self.flat, at = flat.astype(np.float32), 0
        for name, shape in self.SHAPES.items():
            size = int(np.prod(shape))
            setattr(self, name, self.flat[at : at + size].reshape(shape))
            at += size

    def _ahead(self, inputs: np.ndarray, scored: np.ndarray) -> dict:
        """What the rows that may be scored need: ``LEAD`` .. ``WINDOW`` of every window, then what is before of those windows that score there.

        Exponentials stay as they are, with the reciprocal of their sums beside them.
        """
        x = self.embed.take(inputs, axis=0)
        x += self.place
        weights = np.concatenate([self.query * np.float32(WIDTH**-0.5), self.key, self.value], 1)
        qkv = (x.reshape(-1, WIDTH) @ weights).reshape(len(inputs), WINDOW, 3 * WIDTH)
        parts, mixed, own, held = [], [], [], []
        early = np.flatnonzero(scored[:, :LEAD].any(1))
        for some, at, to in ((slice(None), LEAD, WINDOW), (early, 0, LEAD)):
            part = qkv[some, :to]
            q, k, v = part[:, at:, :WIDTH], part[..., WIDTH : 2 * WIDTH], part[..., 2 * WIDTH :]
            e = _exponentials(q @ k.transpose(0, 2, 1), _CAUSAL[at:to, :to])
            r = 1 / (e.reshape(-1, to) @ np.ones(to, np.float32))
            mixed.append((e @ v).reshape(-1, WIDTH) * r[:, None])
            own.append(x[some, at:to].reshape(-1, WIDTH))
            held.append(r)
            parts.append((some, at, to, q, k, v, e))
        mixed, own = np.concatenate(mixed), np.concatenate(own)
        own += mixed @ self.merge
        logits = own @ self.out
        logits += self.bias
        e = _exponentials(logits)
        return {"x": x, "weights": weights, "parts": parts, "mixed": mixed, "z": own, "r": np.concatenate(held), "e": e, "s": e @ np.ones(CLASSES, np.float32)}

    @staticmethod
    def _rows(f: dict, values: np.ndarray) -> np.ndarray:
        """``values`` of all places in the order of the rows of ``_ahead``."""
        return np.concatenate([values[some, at:to].reshape(-1) for some, at, to, *_ in f["parts"]])

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        f = self._ahead(inputs, np.ones(inputs.shape, bool))
        classes = f["e"] / f["s"][:, None]
        late = len(inputs) * STRIDE
        return {"classes": np.concatenate([classes[late:].reshape(len(inputs), LEAD, CLASSES), classes[:late].reshape(len(inputs), STRIDE, CLASSES)], 1)}

    @staticmethod
    def _mixed(own: np.ndarray, share: np.ndarray, chance: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        gate = np.where(opening, np.float32(1), np.float32(GATE))  # how words begin is left to the attention
        own = gate * own * share
        total = own + (1 - gate) * chance
        return total, own / np.maximum(total, 1e-30)

    def probability(self, f: dict, group: np.ndarray, share: np.ndarray, chance: np.ndarray, opening: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(probability, part of the attention expert in it) of the subwords that came."""
        return self._mixed(np.take_along_axis(f["classes"], group[..., None], -1)[..., 0], share, chance, opening)

    def scores(self, inputs: np.ndarray, group: np.ndarray, share: np.ndarray, chance: np.ndarray, opening: np.ndarray, scored: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, probability) of the scored subwords; ``place`` is what the caller calls each of them."""
        f = self._ahead(inputs, scored)
        kept = np.flatnonzero(self._rows(f, scored))
        place, group, share, chance, opening = (self._rows(f, values)[kept] for values in (place, group, share, chance, opening))
        own = f["e"].ravel().take(kept * CLASSES + group) / f["s"][kept]
        return place, self._mixed(own, share, chance, opening)[0]

    def gradient(self, inputs: np.ndarray, group: np.ndarray, share: np.ndarray, chance: np.ndarray, opening: np.ndarray, scored: np.ndarray) -> np.ndarray:
        """Gradient of the mean log probability of the scored subwords, laid out as ``flat``."""
        f = self._ahead(inputs, scored)
        weight = self._rows(f, scored).astype(np.float32) * np.float32(1 / max(scored.sum(), 1))
        group, share, chance, opening = (self._rows(f, values) for values in (group, share, chance, opening))
        hit, s = np.arange(len(group)) * CLASSES + group, f["s"]
        _, part = self._mixed(f["e"].ravel().take(hit) / s, share, chance, opening)
        part = (part * weight).astype(np.float32)
        dlogits = f["e"]
        dlogits *= (-part / s)[:, None]
        dlogits.ravel()[hit] += part
        g = Network(np.zeros_like(self.flat))
        mixed, z = f["mixed"], f["z"]
        g.out[...] = z.T @ dlogits
        g.bias[...] = np.ones(len(z), np.float32) @ dlogits
        dz = dlogits @ self.out.T
        g.merge[...] = mixed.T @ dz
        dmixed = dz @ self.merge.T
        dmixed *= f["r"][:, None]
        dot = (dmixed * mixed) @ np.ones(WIDTH, np.float32)
        dqkv = np.zeros((*inputs.shape, 3 * WIDTH), np.float32)
        dx, row = np.zeros((*inputs.shape, WIDTH), np.float32), 0
        for some, at, to, q, k, v, e in f["parts"]:
            end = row + e.shape[0] * (to - at)
            dm = dmixed[row:end].reshape(-1, to - at, WIDTH)
            ds = dm @ v.transpose(0, 2, 1)
            ds -= dot[row:end].reshape(-1, to - at, 1)
            ds *= e
            back = np.zeros((len(e), to, 3 * WIDTH), np.float32) if at == 0 else dqkv
            back[:, at:to, :WIDTH] = ds @ k
            back[..., WIDTH : 2 * WIDTH] = ds.transpose(0, 2, 1) @ q
            back[..., 2 * WIDTH :] = e.transpose(0, 2, 1) @ dm
            if at == 0:
                dqkv[some, :to] += back
            dx[some, at:to] += dz[row:end].reshape(-1, to - at, WIDTH)
            row = end
        rows = dqkv.reshape(-1, 3 * WIDTH)
        found = f["x"].reshape(-1, WIDTH).T @ rows
        g.query[...], g.key[...], g.value[...] = found[:, :WIDTH] * np.float32(WIDTH**-0.5), found[:, WIDTH : 2 * WIDTH], found[:, 2 * WIDTH :]
        dx += (rows @ f["weights"].T).reshape(dx.shape)
        g.place[...] = dx.sum(0)
        _add_by(g.embed, inputs.ravel(), dx.reshape(-1, WIDTH))
        return g.flat


def _laid_out(lexicon: Lexicon, batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    words = Words(batch.column("text"))
    n, ids, chance, share, opening, text, stops = lexicon.subwords(batch, words)
    lengths = np.bincount(text, minlength=len(words.first) - 1)
    index, valid, scored = windows(lengths)
    rank = lexicon.rank[ids]
    begins = np.zeros(len(ids), bool)
    begins[(np.cumsum(lengths) - lengths)[lengths > 0]] = True
    before = np.where(begins, KNOWN + 1, np.roll(rank, 1)) if len(ids) else rank
    return {"words": words, "n": n, "ids": ids, "chance": chance, "share": share, "opening": opening, "text": text, "stops": stops, "index": index, "scored": scored, "before": before}


def added(made: DataFrame) -> tuple[np.ndarray | None, int]:
    """Sum of the float arrays of all rows (part, made, n), weighted by n, and the sum of n; added up in Spark, the driver gets one row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n, part = None, 0, 0
        for batch in batches:
            for array, weight, at in zip(batch.column("made"), batch.column("n").to_pylist(), batch.column("part").to_pylist(), strict=True):
                more = np.frombuffer(array.as_py(), np.float64) * weight
                total, n, part = (more, weight, at) if total is None else (total + more, n + weight, part)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([(total / n).tobytes()]), pa.array([n])], names=["part", "made", "n"])

    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("made", T.BinaryType()), T.StructField("n", T.LongType())])
    for deal in (lambda df: df.repartition(SUMS, "part"), lambda df: df.repartition(1)):
        made = deal(made).sortWithinPartitions("part").select("part", "made", "n").mapInArrow(run, schema)
    rows = made.select("made", "n").collect()
    return (np.frombuffer(rows[0].made, np.float64) * rows[0].n, rows[0].n) if rows else (None, 0)


def _train_network(texts: DataFrame, lexicon: Lexicon, rounds: int) -> np.ndarray:
    """Weights after rounds of local steps and averaging; sets the classes of ``lexicon`` before."""
    schema = T.StructType([T.StructField("made", T.BinaryType()), T.StructField("n", T.LongType())])

    def one(made: np.ndarray, n: int) -> Iterator[pa.RecordBatch]:
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([made.astype(np.float64).tobytes()]), pa.array([n])], names=["made", "n"])

    def context(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, n = np.zeros((KNOWN, 32)), 0
        for batch in text_batches(batches, "text"):
            out, n = out + lexicon.contexts(_laid_out(lexicon, batch)), n + batch.num_rows
        yield from one(out / max(n, 1), n)

    def gathered(some: DataFrame, run) -> tuple[np.ndarray | None, int]:
        return added(some.select("text", "rare").mapInArrow(run, schema).withColumn("part", F.spark_partition_id().cast("long")))

    found, _ = gathered(texts, context)
    weights = Network().flat
    if found is None:
        return weights
    lexicon.classify(found.reshape(KNOWN, 32))
    for number in range(rounds):

        def steps(batches: Iterator[pa.RecordBatch], start: np.ndarray = weights) -> Iterator[pa.RecordBatch]:
            net, m, v, step = Network(start.copy()), np.zeros_like(start), np.zeros_like(start), 0
            seen = 0
            for batch in text_batches(batches, "text"):
                laid = _laid_out(lexicon, batch)
                order = np.random.default_rng(step).permutation(len(laid["index"]))
                for at in range(0, len(order), BATCH):
                    step, seen = step + 1, seen + len(order[at : at + BATCH])
                    adam_step(net, lexicon, laid, order[at : at + BATCH], m, v, step)
            yield from one(net.flat, seen)

        made, seen = gathered(texts.where(F.pmod(F.xxhash64(F.md5("text")), F.lit(rounds)) == number), steps)
        if seen:
            weights = (made / seen).astype(np.float32)
    return weights


def adam_step(net: Network, lexicon: Lexicon, laid: dict, rows: np.ndarray, m: np.ndarray, v: np.ndarray, step: int) -> None:
    index = laid["index"][rows]
    known = [laid[k][index] for k in ("share", "chance", "opening")]
    g = net.gradient(laid["before"][index], lexicon.group[laid["ids"][index]], *known, laid["scored"][rows])
    change = g - m
    change *= 0.1
    m += change
    np.multiply(g, g, out=change)
    change -= v
    change *= 0.01
    v += change
    np.divide(v, 1 - 0.99**step, out=g)
    np.sqrt(g, out=g)
    g += 1e-6
    np.multiply(m, RATE / (1 - 0.9**step), out=change)
    change /= g
    net.flat += change


def _scored(docs: DataFrame, lexicon: Lexicon, weights: np.ndarray, train_tokens: int, distinct: int, ends: int) -> DataFrame:
    """(id, held_out, n_tokens, n_known, base_score, score)."""
    fields = [docs.schema["id"], docs.schema["held_out"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType())]
    fields += [T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType())]
    room = train_tokens + distinct + 1.0
    end_base, end_chance = np.log10((ends + 1) / room), (ends + 1) / (train_tokens + 2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(weights.copy())
        for batch in text_batches(batches, "text"):
            n, laid = batch.num_rows, _laid_out(lexicon, batch)
            words = laid["words"]
            logs = np.zeros(len(laid["ids"]))
            for at in range(0, len(laid["index"]), 128):
                rows, scored = laid["index"][at : at + 128], laid["scored"][at : at + 128]
                known = [laid[k][rows] for k in ("share", "chance", "opening")]
                place, p = net.scores(laid["before"][rows], lexicon.group[laid["ids"][rows]], *known, scored, rows)
                logs[place] = np.log10(np.maximum(p, 1e-300))
            per_text = np.diff(words.first)
            score = np.bincount(laid["text"], logs, minlength=n) + np.bincount(words.text, laid["stops"], minlength=n)
            score = score + per_text * np.log10(1 - end_chance) + np.log10(end_chance)
            base = np.bincount(words.text, np.log10((laid["n"] + 1) / room), minlength=n) + end_base
            n_known = np.bincount(words.text, laid["n"] > 0, minlength=n).astype(np.int64) + (ends > 0)
            columns = [batch.column("id"), batch.column("held_out"), pa.array((per_text + 1).astype(np.int64)), pa.array(n_known), pa.array(base), pa.array(score)]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return docs.select("id", "held_out", "text", "rare").mapInArrow(run, T.StructType(fields))


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str = VOCABULARY, head: int = HEAD) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): one row per document."""
    held = F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))
    slim = docs.select(F.col(key).alias("id"), held.alias("held_out"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    spark = docs.sparkSession
    with shuffles_dropped(spark), hashed_joins(spark):
        with recording() as counted:
            split = stage(_split(word_counts(slim), path))
            words, distinct = split.where("n > 0").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
            ends = slim.where(~F.col("held_out")).count()
            train_tokens, distinct = words + ends, distinct + (ends > 0)
            slices = min(SLICES, 1 + split.count() // SLICE)
            chances, single, starts = word_chances(split, slices)
        chosen = {os.path.dirname(f): f for f in chances.inputFiles()}
        release(spark, [f for f in counted if os.path.dirname(f) not in chosen])
        frequent = most_frequent(chances, head)
        lexicon = Lexicon(frequent, single, starts)
        lexicon.send(spark)
        rare = chances.where(F.col("m") < int(frequent.column("m").to_numpy().min())) if frequent.num_rows else chances
        full = [stage(with_rare_words(part, rare, lexicon.hash)) for part in _slices(slim, F.col("text"), slices)]
        full = reduce(DataFrame.unionByName, full)
        release(spark, [*chosen.values()])
        weights = _train_network(full.where(~F.col("held_out")), lexicon, ROUNDS)
    scored = _scored(full, lexicon, weights, train_tokens, distinct, ends)
    return scored.select(F.col("id").alias(key), "held_out", "n_tokens", "n_known", F.lit(train_tokens).cast("long").alias("train_tokens"), "base_score", "score")


@query("op4_attention_scores")
def op4_attention_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))
