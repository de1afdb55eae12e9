"""Language identification with interpolated Kneser-Ney character models.

Texts are read as letters in lower case, every other run of characters as one space.
For each language the counts of all three-letter runs of all labelled training texts are
summed with Spark; the three-letter, two-letter and one-letter distributions are
interpolated by absolute discounting, the lower ones over distinct left contexts. The
probabilities of all languages stand side by side in one array per order, sorted
by the hash of the run, and are looked up by binary search. A text gets the language of
the least cross-entropy per character.

Rejection is calibrated on the training texts: a text is rejected if its cross-entropy is
above the 99.9th percentile of the training texts of its language in its class of length
(powers of two) by more than one bit, or above the largest of any class
where a class has none; and if it has no letter. The score is the posterior of the
language with equal priors, from cross-entropies times at most 32 characters.

The model is bounded: per language the ``max_runs`` most frequent three-letter runs (ties
by run); the counts themselves cover all training texts.

Defined results: a null text, and a text without letters, is ``und`` with score 0 and is
rejected; a null language is never learned; without training texts every text is ``und``.
Characters beyond the basic plane count as one unknown letter. Rows that repeat
are labelled alike.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chronoweave.llm.base import mix, query, stage, table, text_batches

UNDETERMINED = "und"
FOLDS = 5
MAX_RUNS = 100_000
DISCOUNT = 0.75
MARGIN = 1.0  # bits per character
PERCENTILE = 0.999
_SPACE = 32
_UNKNOWN = 0xFFFD


@cache
def _letters() -> np.ndarray:
    """For every code point its lower-case letter, a space for what is no letter."""
    out = np.full(0x110000, _SPACE, np.uint32)
    for c in range(0x10000):
        if 0xD800 <= c < 0xE000:
            continue
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            out[c] = ord(low) if len(low) == 1 else c
    for c in range(0x10000, 0x110000):
        if chr(c).isalpha():
            out[c] = _UNKNOWN
    return out


def letter_runs(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(owner, packed runs of three, letters per text); a text starts and ends with a space."""
    texts = [t or "" for t in texts]
    n = len(texts)
    lengths = np.fromiter((len(t) + 2 for t in texts), np.int64, n)
    joined = "".join(f" {t} " for t in texts)
    codes = _letters()[np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    owner = np.repeat(np.arange(n), lengths)
    blank = codes == _SPACE
    keep = np.ones(len(codes), bool)
    keep[1:] = ~(blank[1:] & blank[:-1] & (owner[1:] == owner[:-1]))
    codes, owner = codes[keep].astype(np.uint64), owner[keep]
    letters = np.bincount(owner[codes != _SPACE], minlength=n)
    if len(codes) < 3:
        return np.empty(0, np.int64), np.empty(0, np.uint64), letters
    inside = owner[2:] == owner[:-2]
    packed = (codes[:-2] << np.uint64(32)) | (codes[1:-1] << np.uint64(16)) | codes[2:]
    return owner[2:][inside], packed[inside], letters


def run_counts(docs: DataFrame, text: str, lang: str) -> DataFrame:
    """(lang, run, n) over all texts; each chunk is summed before it is shuffled."""
    schema = T.StructType([T.StructField("lang", T.StringType()), T.StructField("run", T.LongType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            langs = batch.column("lang").to_pylist()
            names = sorted(set(langs))
            number = np.array([names.index(x) for x in langs])
            owner, packed, _ = letter_runs(batch.column("text").to_pylist())
            for i, name in enumerate(names):
                runs, n = np.unique(packed[number[owner] == i], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(runs), pa.string()), pa.array(runs.astype(np.int64)), pa.array(n)], names=["lang", "run", "n"]
                )

    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    return rows.mapInArrow(run, schema).groupBy("lang", "run").agg(F.sum("n").alias("n"))


class Model:
    """Interpolated Kneser-Ney models of several languages over shared sorted hash arrays.

    runs, pairs, singles   sorted hashes of three, two and one letters
    log3, log2, log1       log2 probability of the last letter, a column per language
    back2                  log2 of the weight left for shorter contexts, by context of two letters
    back1                  the same by context of one letter
    floor                  log2 probability of a letter never seen
    """

    def __init__(self, counts: list[tuple[str, int, int]]) -> None:
        self.languages = sorted({c[0] for c in counts})
        k = len(self.languages)
        number = {x: i for i, x in enumerate(self.languages)}
        runs = np.unique(np.array([c[1] for c in counts], np.uint64))
        table3 = np.zeros((len(runs), k))
        at = np.searchsorted(runs, np.array([c[1] for c in counts], np.uint64))
        table3[at, [number[c[0]] for c in counts]] = [c[2] for c in counts]

        pairs, end = np.unique(runs & np.uint64(0xFFFFFFFF), return_inverse=True)
        left = _sums(end, (table3 > 0).astype(float), len(pairs))  # distinct letters before a pair
        singles, last = np.unique(pairs & np.uint64(0xFFFF), return_inverse=True)
        alone = _sums(last, (left > 0).astype(float), len(singles))

        size = len(singles) + 1
        total1 = np.maximum(alone.sum(0), 1)
        used1 = (alone > 0).sum(0)
        p1 = np.maximum(alone - DISCOUNT, 0) / total1 + DISCOUNT * np.maximum(used1, 1) / total1 / size
        floor = DISCOUNT * np.maximum(used1, 1) / total1 / size

        # Pairs: context of one letter.
        context1, first = np.unique(pairs >> np.uint64(16), return_inverse=True)
        total2, used2 = _sums(first, left, len(context1)), _sums(first, (left > 0).astype(float), len(context1))
        weight1 = np.where(total2 > 0, DISCOUNT * used2 / np.maximum(total2, 1), 1.0)
        p2 = np.maximum(left - DISCOUNT, 0) / np.maximum(total2, 1)[first] + weight1[first] * p1[last]

        # Runs: context of two letters.
        context2, ahead = np.unique(runs >> np.uint64(16), return_inverse=True)
        total3, used3 = _sums(ahead, table3, len(context2)), _sums(ahead, (table3 > 0).astype(float), len(context2))
        weight2 = np.where(total3 > 0, DISCOUNT * used3 / np.maximum(total3, 1), 1.0)
        p3 = np.maximum(table3 - DISCOUNT, 0) / np.maximum(total3, 1)[ahead] + weight2[ahead] * p2[end]

        self.runs, self.log3 = _by_hash(runs, p3)
        self.pairs, self.log2 = _by_hash(pairs, p2)
        self.singles, self.log1 = _by_hash(singles, p1)
        self.context2, self.back2 = _by_hash(context2, weight2)
        self.context1, self.back1 = _by_hash(context1, weight1)
        self.floor = np.log2(floor)

    def log_probabilities(self, packed: np.ndarray) -> np.ndarray:
        """log2 probability of the last letter of each run, a column per language."""
        at, known = _find(self.runs, packed)
        out = self.log3[at]
        miss = np.flatnonzero(~known)
        if len(miss):
            rest = packed[miss]
            a2, k2 = _find(self.pairs, rest & np.uint64(0xFFFFFFFF))
            value = self.log2[a2]
            deeper = np.flatnonzero(~k2)
            if len(deeper):
                pair = rest[deeper] & np.uint64(0xFFFFFFFF)
                a1, k1 = _find(self.singles, pair & np.uint64(0xFFFF))
                single = np.where(k1[:, None], self.log1[a1], self.floor)
                c1, kc1 = _find(self.context1, pair >> np.uint64(16))
                value[deeper] = single + np.where(kc1[:, None], self.back1[c1], 0.0)
            c2, kc2 = _find(self.context2, rest >> np.uint64(16))
            out[miss] = value + np.where(kc2[:, None], self.back2[c2], 0.0)
        return out

    def entropies(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(cross-entropy in bits per character and language, letters) of each text."""
        owner, packed, letters = letter_runs(texts)
        n = len(texts)
        out = np.zeros((n, len(self.languages)))
        step = 1 << 18
        for a in range(0, len(packed), step):
            logs = self.log_probabilities(packed[a : a + step])
            for j in range(out.shape[1]):
                out[:, j] += np.bincount(owner[a : a + step], logs[:, j], minlength=n)
        return -out / np.maximum(np.bincount(owner, minlength=n), 1)[:, None], letters


def _sums(group: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros((n, values.shape[1]))
    np.add.at(out, group, values)
    return out


def _by_hash(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashed = mix(keys)
    order = np.argsort(hashed)
    return hashed[order], np.log2(np.maximum(values[order], 1e-30)).astype(np.float32)


def _find(hashed: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wanted = mix(keys)
    at = np.minimum(np.searchsorted(hashed, wanted), len(hashed) - 1)
    return at, hashed[at] == wanted


def train(docs: DataFrame, text: str = "text", lang: str = "lang", max_runs: int = MAX_RUNS) -> Model | None:
    """The model of all rows; None if no row has a language."""
    counts = stage(run_counts(docs, text, lang))
    rows = []
    for (name,) in counts.select("lang").distinct().orderBy("lang").collect():
        top = counts.where(F.col("lang") == name).orderBy(F.col("n").desc(), "run").limit(max_runs)
        rows += [tuple(r) for r in top.select("lang", "run", "n").collect()]
    return Model(rows) if rows else None


def identify(
    docs: DataFrame, model: Model | None, training: Column, text: str = "text", lang: str = "lang", columns: Sequence[str] | None = None
) -> DataFrame:
    """``columns`` (all if None) with lang_pred, score, entropy and rejected, in place of columns of these names.

    ``training`` says, by these columns, which rows calibrate the rejection; they hold
    ``lang``. Texts are scored once.
    """
    made = ["lang_pred", "score", "entropy", "rejected"]
    keep = [c for c in columns or docs.columns if c not in made]
    base = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text).cast("string").alias("__text"))
    if model is None:
        nothing = [F.lit(UNDETERMINED).alias(made[0]), F.lit(0.0).alias(made[1]), F.lit(None).cast("double").alias(made[2]), F.lit(True).alias(made[3])]
        return base.select(*[F.col(f"`{c}`") for c in keep], *nothing)
    fields = [*(docs.schema[c] for c in keep), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
              T.StructField("entropy", T.DoubleType()), T.StructField("__size", T.IntegerType())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "__text"):
            entropy, letters = model.entropies(batch.column("__text").to_pylist())
            best = entropy.argmin(axis=1)
            odds = np.exp2(-(entropy - entropy.min(axis=1, keepdims=True)) * np.minimum(letters, 32)[:, None])
            some = letters > 0
            names = np.where(some, np.array(model.languages, object)[best], UNDETERMINED)
            columns = [
                *[batch.column(c) for c in keep],
                pa.array(names.tolist(), pa.string()),
                pa.array(np.where(some, 1 / odds.sum(axis=1), 0.0)),
                pa.array(entropy[np.arange(len(best)), best], mask=~some),
                pa.array(np.log2(np.maximum(letters, 1)).astype(np.int32)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    scored = stage(base.mapInArrow(run, T.StructType(fields)))
    known = scored.where(training & F.col("entropy").isNotNull() & (F.col(lang) == F.col("lang_pred")))
    limits = known.groupBy("lang_pred", "__size").agg(F.percentile_approx("entropy", PERCENTILE, 10_000).alias("limit"))
    top = {r[0]: r[1] for r in limits.groupBy("lang_pred").agg(F.max("limit")).collect()}
    limits = {(r[0], r[1]): r[2] for r in limits.collect()}  # languages times at most 32 classes
    bound = F.lit(None).cast("double")
    for name in model.languages:
        classes = [F.when(F.col("__size") == z, F.lit(v)) for (lg, z), v in sorted(limits.items()) if lg == name]
        bound = F.when(F.col("lang_pred") == name, F.coalesce(*classes, F.lit(top.get(name, float("inf"))))).otherwise(bound)
    rejected = F.coalesce(F.col("entropy") > bound + MARGIN, F.lit(True))
    return scored.withColumn("rejected", rejected).drop("__size")


def fold(key: str, folds: int) -> Column:
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds


@query("op6_language")
def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    training = F.coalesce(fold("doc_id", FOLDS) != 0, F.lit(False))
    model = train(docs.where(training))
    labelled = identify(docs, model, training, columns=["doc_id", "lang"])
    held = F.coalesce(fold("doc_id", FOLDS) == 0, F.lit(False))
    return labelled.select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
