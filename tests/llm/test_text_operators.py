"""Fill-in-middle, importance resampling and line deduplication against brute force, and their odd cases."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from chronoweave.llm import fim, lines, queries, resample
from tests.test_queries import SF, _rows, duck  # noqa: F401

DOCS = "doc_id long, text string, n long, output string, kept string, score string, body string"
LONG = " ".join(f"w{i % 977} é" for i in range(400_000))  # above the windows of a batch


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    made = ["".join(rng.choice("ab Zé\t\n<-") for _ in range(rng.randrange(60))) for _ in range(150)]
    made += [" \t ", "x", " x", "x ", "é", "", None, "a <P> b c d", "one two <S three", "<P><S><M>", "a<P" * 9, LONG]
    return list(enumerate(made)) + [(7, made[7]), (7, "another text of the same id"), (None, "no id here at all"), (None, None)]


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame([(i, t, -1, "o", "k", "s", "b") for i, t in texts], DOCS).repartition(5)


@pytest.mark.parametrize("name", ["op11_fill_in_middle", "op12_resample", "op13_line_dups"])
def test_equals_sql(spark, duck, name):  # noqa: F811
    got = queries.QUERIES[name](spark, SF).toPandas()
    assert len(got) == 200 and _rows(got) == _rows(duck.execute(queries.SQL[name]).df())


def _middle_filled(i, text, rate=50, spm=80):
    text = text or ""
    units = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    h = [int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[8 * k : 8 * k + 8], 16) for k in range(4)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", None, None, text
    a, b = sorted(x % (len(units) + 1) for x in h[:2])
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("rate, spm", [(50, 80), (100, 50), (100, 0), (0, 80)])
def test_fill_in_middle(docs, texts, rate, spm, monkeypatch):
    monkeypatch.setattr(fim, "WINDOW", 1000)
    made = fim.fill_in_middle(docs, rate=rate, spm=spm)
    assert sorted(made.columns) == sorted({*docs.columns, "form", "prefix_chars", "middle_chars"})
    back = fim.restore(made).collect()
    assert len(back) == len(texts) and all(r.restored == (r.text or "") and r.body == "b" for r in back)
    want = collections.Counter((i, *_middle_filled(i, t, rate, spm)) for i, t in texts)
    assert collections.Counter((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in back) == want


def test_fill_in_middle_odd_tables(spark, docs):
    assert fim.restore(fim.fill_in_middle(docs.limit(0))).count() == 0
    odd = spark.createDataFrame([("<P>a<S>b", "psm"), ("<S>a<P>b<M>c", "psm"), ("x<P>a<S>b<M>c", "psm"), ("<P>b", "plain"), (None, None)], "output string, form string")
    assert [r.restored for r in fim.restore(odd.coalesce(1)).collect()] == [None, None, None, "<P>b", ""]


def test_shifts_carry_over_windows(monkeypatch):
    starts, moves = np.array([0, 0, 3, 7, 7]), np.array([5, 2, -1, 4, 9])
    whole = np.concatenate([s for _, s in fim.shifts(starts, moves, 10)])
    monkeypatch.setattr(fim, "WINDOW", 3)
    assert whole.tolist() == np.concatenate([s for _, s in fim.shifts(starts, moves, 10)]).tolist() == [2] * 3 + [-1] * 4 + [9] * 3


def _words(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@pytest.mark.parametrize("window", [50, 1 << 21])
def test_every_run_has_its_crc(texts, window):
    column = [t for _, t in texts if t is not LONG] + ["x" * 5000 + " y", LONG[: 20 * window]]
    scan = resample.Scan(pa.array(column), window)
    for n, (owner, crc) in enumerate(scan.features(3), 1):
        want = [(i, zlib.crc32(" ".join(w[k : k + n]).encode())) for i, w in enumerate(map(_words, column)) for k in range(len(w) - n + 1)]
        assert list(zip(owner.tolist(), crc.tolist(), strict=True)) == want


def test_shift_appends_zero_bytes():
    for length in (0, 1, 255, 256, 70_000, 17_000_000):
        state = int(resample.running_crcs(np.frombuffer(b"some" + bytes(length), np.uint8), np.array([4 + length]))[0])
        start = resample.running_crcs(np.frombuffer(b"some", np.uint8), np.array([4]))
        assert int(resample.shift(start, np.array([length]))[0]) == state


@pytest.mark.parametrize("longest, percent", [(1, 10), (3, 60)])
def test_resample(spark, docs, texts, longest, percent):
    target = [(1, "zé a b a ab"), (2, None), (3, "w1 é w2 é zé zé")]
    items = spark.createDataFrame(target, "item_id long, text string")
    options = {"longest": longest, "percent": percent, "buckets": 97, "min_words": 4}

    def features(text):
        w = _words(text)
        return [zlib.crc32(" ".join(w[k : k + n]).encode()) % 97 for n in range(1, longest + 1) for k in range(len(w) - n + 1)]

    s, t = (collections.Counter(b for _, text in rows for b in features(text)) for rows in (texts, target))
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + 97) / ((s[b] + 1) * (t.total() + 97)))) for b in range(97)]

    def draw(i):
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))

    want = []
    for i, text in texts:
        f = features(text)
        want.append((i, len(f), len(_words(text)), sum(gain[b] for b in f), sum(gain[b] for b in f) + draw(i)))
    able = sorted((w for w in want if w[2] >= 4), key=lambda w: (-w[4], w[0] is not None, w[0] or 0))
    drawn = able[: percent * len(able) // 100]
    rows = resample.resample_plan(docs, items, **options).collect()
    assert collections.Counter(tuple(r)[:5] for r in rows) == collections.Counter(want)
    ranks = sorted((r.rank, r.doc_id, r.score) for r in rows if r.rank is not None)
    assert ranks == [(k, w[0], w[4]) for k, w in enumerate(drawn, 1)]
    kept = resample.resample(docs, items, **options).collect()
    assert collections.Counter((r.doc_id, r.score) for r in kept) == collections.Counter((w[0], w[4]) for w in drawn)
    assert all(r.body == "b" and r.text is not None for r in kept)


def test_resample_odd_tables(spark, docs):
    items = spark.createDataFrame([], "text string")
    assert resample.resample_plan(docs.limit(0), items).count() == 0 and resample.resample(docs.limit(0), docs).count() == 0
    same = spark.createDataFrame([(1, "a " * 30)] * 40 + [(2, "b " * 30)] * 2, "doc_id long, text string")
    rows = resample.resample_plan(same, items, percent=50).collect()
    assert sorted(r.rank for r in rows if r.rank is not None) == list(range(1, 22)) and len(rows) == 42


def _line_key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\f\r"))


@pytest.mark.parametrize("min_docs, min_chars", [(2, 10), (3, 1), (2, 0)])
def test_line_dups(spark, min_docs, min_chars):
    rng = random.Random(4)
    pool = ["a common line of text", "A Common LINE of text", " a common line of text\t", "ÉCOLE publique ici", "école publique ici", "short", "", "tenletters", "\x0bTENLETTERS\r"]
    pool += [f"line number {i} of the pool" for i in range(20)]
    rows = [(i, "\n".join(rng.choice(pool) for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(9, rows[9][1]), (9, "another\na common line of text"), (None, "a common line of text\nonly here, without an id"), (None, "only here, without an id"), (70, None), (71, "")]
    rows += [(72, "\n".join(f"own line {i % 5000}" for i in range(60_000))), (73, "own line 77\n" * 50 + "the end of it"), (74, "own line 77")]
    holds = collections.defaultdict(set)
    for i, text in rows:
        for line in (text or "").split("\n"):
            holds[_line_key(line)].add(math.inf if i is None else i)
    want = []
    for i, text in rows:
        parts = (text or "").split("\n")
        gone = [len(k) >= min_chars and len(holds[k]) >= min_docs and min(holds[k]) != (math.inf if i is None else i) for k in map(_line_key, parts)]
        want.append((i, len(parts), sum(gone), "\n".join(p for p, g in zip(parts, gone, strict=True) if not g)))
    df = spark.createDataFrame([(i, t, "k", "b") for i, t in rows], "doc_id long, text string, kept string, body string").repartition(4)
    got = lines.drop_repeated_lines(df, min_docs=min_docs, min_chars=min_chars).collect()
    assert collections.Counter((r.doc_id, r.n_lines, r.n_dropped, r.kept) for r in got) == collections.Counter(want)
    assert all(r.body == "b" for r in got) and sum(w[2] for w in want) > 20


def test_line_dups_of_no_rows_and_without_python(spark, docs):
    assert lines.drop_repeated_lines(docs.limit(0)).count() == 0
    plan = lines.drop_repeated_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
