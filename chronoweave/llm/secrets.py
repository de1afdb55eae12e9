"""Secret scans with DataFrame functions only.

Known forms are found by pattern: values assigned to a telling name, access keys, hex
strings. Other secrets are found by two character Markov models, one of random strings
and one of ordinary words and identifiers: a run of 16 or more letters, digits and
``_ + / = -`` that does not lie inside a known form is a secret if the log-likelihood ratio of
the models over its neighbouring characters is above a threshold. The models are trained
from all documents: the values that the known forms find against the other words and
identifiers made of them. Texts are joined to identifiers by each of ``JOINERS``; these are many, so
an identifier weighs ``1 / IDENTIFIER_SHARE`` of a word. The random model
starts from a uniform prior, so that alphabets no text shows are still random. The
threshold is the larger of ``odds`` and the 99.9th percentile of the ordinary words, by weight, rounded up to
``STEP``.

Everything is per row, apart from counts of different runs of letters, digits and ``_ + / = -`` and sums of the training
counts (at most 4 x 97 x 97 pairs).
Positions are code points, ends exclusive.

Defined results: null and empty texts hold nothing; repeated rows give the same spans;
a corpus without known secrets is judged with the uniform prior alone. An empty table gives
no rows. Columns whose names clash with an output are replaced.
"""

from __future__ import annotations

import math
import string
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoweave.llm.base import query, stage, table

# Classes are written with \w and \p{Alnum}, which are ASCII here: Java tests [^A-Za-z0-9_+/=-] some ten times slower.
# The known forms, each with the group that holds the secret.
ASSIGN = r"""(?=[PSTApsta][AEOPaeop])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([\w+/.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the longest run is taken, so a shorter one that fails hides none
HEX = r"[0-9a-f]{16,}"
ASSIGNED = 12  # characters of an assigned value

CANDIDATE = r"(?<![\w+/=-])[\w+/=-]{16,}"  # an access key or hex string lies inside one
BETWEEN = r"[^\w+/=-]+"
GAP = r"\P{Alnum}+"
RUN = 16  # characters of a run, at least
ORDINARY = 8  # characters of an ordinary word, at least
LONGEST = 64  # words and identifiers for the threshold have fewer characters
EDGE, SHORT, VALUE = " ", "~", "!"  # first characters of tokens that are no words
KINDS = ("assign", "access", "hex", "random")
ODDS = math.log(10_000)
PRIOR = 64.0  # weight of the uniform prior in each context of the random model
JOINERS = ("_", "-", "/", "_2_")  # identifiers are made of the words of a text
IDENTIFIER_SHARE = 16
MARK = "[SECRET]"
STEP = 0.01  # of a score, so that the percentile is taken over a bounded number of values
_SYMBOLS = 96
_ALPHABET = 65
_NAME = string.ascii_letters + string.digits


def _spans(text: Column, pattern: str, kind: int, value: str | None = None) -> Column:
    """(start, kind, end, from) of all leftmost matches; from is where the value starts."""
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    both = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda gap, hit: F.struct(gap.alias("gap"), hit.alias("hit")))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,from:int>>")

    def add(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        length = F.length(F.regexp_extract(x["hit"], value, 1)) if value else F.length(x["hit"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), (end - length).alias("from"))
        return F.struct(end.alias("at"), F.concat(state["found"], F.array(span)).alias("found"))

    begin = F.struct(F.lit(0).alias("at"), nothing.alias("found"))
    found = F.aggregate(both, begin, add, lambda state: state["found"])
    return F.when(text.rlike(pattern), found).otherwise(nothing)


def known_spans(text: Column) -> Column:
    assign = F.filter(_spans(text, ASSIGN, 0, ASSIGN), lambda s: s["end"] - s["from"] >= ASSIGNED)
    return F.concat(assign, _spans(text, ACCESS, 1), _spans(text, HEX, 2))


def _has_known(text: Column) -> Column:
    return text.rlike(ASSIGN) | (text.rlike(CANDIDATE) & (text.rlike(ACCESS) | text.rlike(HEX)))


def _place(c: Column) -> Column:
    return F.ascii(c) - 32


def _pairs(token: Column) -> Column:
    """Numbers of the neighbouring characters of an ASCII token."""
    both = F.regexp_extract_all(token, F.lit("(?s)(?=(..))"), F.lit(1))  # a substring by position costs its distance from the start
    return F.transform(both, lambda p: _place(p) * _SYMBOLS + _place(F.substring(p, 2, 1)))


def _counted(docs: DataFrame, text: str) -> DataFrame:
    """(token, n): the runs of letters, digits and ``_ + / = -`` of the texts without known forms, each with how often it occurs.

    Other tokens begin with a mark: ``EDGE`` the first and last character of a text, each a space if it belongs to a gap
    (what an identifier has a joiner for); ``SHORT`` an identifier that counts for the threshold; ``VALUE`` a secret value.
    """
    texts = docs.select(F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    marked = texts.select("text", _has_known(F.col("text")).alias("known"))
    without = reduce(lambda t, p: F.regexp_replace(t, p, " "), (ASSIGN, ACCESS, HEX), F.col("text"))
    values = F.transform(known_spans(F.col("text")), lambda s: F.concat(F.lit(VALUE), F.substr("text", s["from"] + 1, s["end"] - s["from"])))
    nothing = F.array().cast("array<string>")
    plain = marked.select(F.when(F.col("known"), without).otherwise(F.col("text")).alias("plain"), F.when(F.col("known"), values).otherwise(nothing).alias("values"))

    edges = [F.regexp_replace(c, GAP, " ") for c in (F.substring("plain", 1, 1), F.right(F.col("plain"), F.lit(1)))]
    edge = F.when(F.col("plain") == "", nothing).otherwise(F.array(F.concat(F.lit(EDGE), *edges)))
    names = F.array(*[F.concat(F.lit(SHORT), F.regexp_replace("plain", GAP, j)) for j in JOINERS])
    many = F.col("plain").rlike(rf"^(?:\P{{Alnum}}*+\p{{Alnum}}){{{LONGEST}}}")  # read no further than that
    tokens = F.concat(F.split("plain", BETWEEN), edge, F.when(many, nothing).otherwise(names), "values")
    each = plain.select(tokens.alias("tokens")).select(F.explode("tokens").alias("token"))
    useless = F.col("token").startswith(SHORT) & ~F.length("token").between(RUN + 1, LONGEST)
    return each.where((F.col("token") != "") & ~useless).groupBy("token").agg(F.count("*").alias("n"))


def pair_counts(docs: DataFrame, text: str = "text") -> dict[bool, dict[int, float]]:
    """How often characters are neighbours in secret values (True) and in ordinary words and identifiers (False)."""
    return _pair_sums(stage(_counted(docs, text)))


def _pair_sums(counted: DataFrame) -> dict[bool, dict[int, float]]:
    """A name of an identifier is a run of letters and digits; what it shares with a joiner follows from where names begin and end."""
    token = F.col("token")
    kind = F.when(token.startswith(VALUE), "value").when(token.startswith(EDGE), "edge").when(F.length(token) >= ORDINARY, "word").otherwise("names")
    body = F.when(F.col("kind") == "value", F.substr(token, F.lit(2))).otherwise(F.concat(F.lit(" "), token, F.lit(" ")))
    both = F.regexp_extract_all(body, F.lit("(?s)(?=(..))"), F.lit(1))  # a substring by position costs its distance from the start
    tokens = counted.where(~token.startswith(SHORT)).select("token", "n", kind.alias("kind"))
    pairs = tokens.select("kind", "n", F.explode(F.when(F.col("kind") == "edge", F.array(token)).otherwise(both)).alias("pair"))
    value, plain = Counter(), Counter()
    begins, ends, gaps = Counter(), Counter(), 0
    for kind, pair, n in pairs.groupBy("kind", "pair").agg(F.sum("n")).collect():  # at most 4 x 97 x 97 rows
        if kind == "value":
            value[pair] += n
        elif kind == "edge":  # a text has a gap less than names, and one more for each end that is a gap
            first, last = pair[1:]
            begins[first] -= n
            ends[last] -= n
            gaps += n * ((first == " ") + (last == " ") - 1)
        else:
            inside = [c in _NAME for c in pair]
            plain[pair] += n * (IDENTIFIER_SHARE * (kind == "word" and " " not in pair) + len(JOINERS) * all(inside))
            if inside == [False, True]:
                begins[pair[1]] += n
                gaps += n
            elif inside == [True, False]:
                ends[pair[0]] += n
    for j in JOINERS:
        for c in _NAME:
            plain[j[-1] + c] += begins[c]
            plain[c + j[0]] += ends[c]
        for pair in zip(j, j[1:], strict=False):
            plain["".join(pair)] += gaps
    number = {p: (ord(p[0]) - 32) * _SYMBOLS + ord(p[1]) - 32 for p in {*value, *plain}}
    return {True: {number[p]: n for p, n in value.items()}, False: {number[p]: n / IDENTIFIER_SHARE for p, n in plain.items() if n}}


def _ordinary(counted: DataFrame) -> DataFrame:
    """(token, weight): the words and identifiers that the threshold is taken from."""
    short, word = F.col("token").startswith(SHORT), F.length("token").between(RUN, LONGEST - 1) & ~F.col("token").startswith(VALUE)
    weight = F.when(short, F.col("n")).otherwise(F.col("n") * IDENTIFIER_SHARE).alias("weight")
    return counted.where(short | word).select(F.when(short, F.substr("token", F.lit(2))).otherwise(F.col("token")).alias("token"), weight)


def train(docs: DataFrame, text: str = "text", odds: float = ODDS) -> tuple[list[float], float]:
    """(log-likelihood ratio by pair of characters, threshold), from all texts."""
    counted = stage(_counted(docs, text))
    seen = _pair_sums(counted)
    ratio = [0.0] * (_SYMBOLS * _SYMBOLS)
    for first in range(_SYMBOLS):
        row = range(first * _SYMBOLS, (first + 1) * _SYMBOLS)
        random = sum(seen[True].get(p, 0) for p in row) + PRIOR
        plain = sum(seen[False].get(p, 0) for p in row) + _ALPHABET
        for p in row:
            ratio[p] = math.log((seen[True].get(p, 0) + PRIOR / _ALPHABET) / random) - math.log((seen[False].get(p, 0) + 1) / plain)
    score = F.ceil(_score(F.col("token"), ratio) / STEP) * STEP
    high = _ordinary(counted).select(score.alias("score"), "weight").groupBy("score").agg(F.sum("weight").alias("weight"))
    high = high.select(F.percentile("score", 0.999, F.col("weight"))).first()[0]
    return ratio, max(odds, high if high is not None else odds)


def _score(token: Column, ratio: list[float]) -> Column:
    table_ = F.split(F.lit(",".join(f"{x:.6g}" for x in ratio)), ",").cast("array<double>")  # folded to one constant
    return F.aggregate(_pairs(token), F.lit(0.0), lambda s, p: s + F.element_at(table_, p + 1))


def find_secrets(docs: DataFrame, model: tuple[list[float], float] | None = None, text: str = "text") -> DataFrame:
    """The documents with ``secrets``: an array of (start, kind, end, from), by start and kind."""
    ratio, threshold = model or train(docs, text)
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    columns = [F.col(f"`{c}`") for c in docs.columns if c != "secrets"]
    found = docs.select(*columns, known_spans(body).alias("__known"), _spans(body, CANDIDATE, 3).alias("__runs"))

    def random(s: Column) -> Column:
        token = F.substr(body, s["start"] + 1, s["end"] - s["start"])
        inside = F.exists("__known", lambda k: (k["start"] <= s["start"]) & (s["end"] <= k["end"]))
        return ~inside & (_score(token, ratio) > threshold)

    return found.select(*columns, F.array_sort(F.concat("__known", F.filter("__runs", random))).alias("secrets"))


def redact(docs: DataFrame, model: tuple[list[float], float] | None = None, text: str = "text", mark: str = MARK) -> DataFrame:
    """The documents with every secret value replaced by ``mark``; overlapping values by one mark."""
    body = F.col(text)

    def step(state: Column, s: Column) -> Column:
        fresh = s["from"] >= state["at"]
        gap = F.substr(body, state["at"] + 1, s["from"] - state["at"])
        out = F.when(fresh, F.concat(state["out"], gap, F.lit(mark))).otherwise(state["out"])
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"), out.alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    by_value = F.array_sort(F.transform("secrets", lambda s: F.struct(s["from"].alias("from"), s["end"].alias("end"))))
    clean = F.aggregate(by_value, begin, step, lambda z: F.concat(z["out"], F.substr(body, z["at"] + 1)))
    text_ = F.when(F.size("secrets") > 0, clean).otherwise(body)
    found = find_secrets(docs, model, text)
    return found.select(*[text_.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns])


def _listed(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.element_at(kinds, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))))


@query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secrets")
    kinds = F.transform("secrets", lambda s: s["kind"])
    counts = [(F.size("secrets") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{KINDS[k]}") for k in range(4)]
    base = F.filter("secrets", lambda s: s["kind"] < 3)
    return found.select("doc_id", *counts, F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("secrets")).alias("spans"))
