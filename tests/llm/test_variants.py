"""Spelling variant grouping against brute force, and its defined cases."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm import queries, variants
from starloom.llm.ship import ready

RUN = re.compile("[A-Za-zÀ-ÿ]+")
rnd = random.Random(4)


def runs(t):
    return ["".join(c.lower() if "A" <= c <= "Z" else c for c in w) for w in RUN.findall(t or "")]


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows, typos=97):
    counts = collections.Counter()
    for doc, t in rows:
        for w in runs(t):
            h = zlib.crc32(f"{doc}:{w}".encode()) if doc is not None else 1
            if typos and h % typos == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            counts[w] += 1
    kept = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    by_gap = collections.defaultdict(set)  # words that share a one-letter deletion, or are one
    for w in kept:
        by_gap[w].add(w)
        for i in range(len(w)):
            by_gap[w[:i] + w[i + 1:]].add(w)
    links = {w: set() for w in kept}
    for group in by_gap.values():
        for a in group:
            links[a].update(b for b in group if near(a, b))
    form = {}
    for w, others in links.items():
        best = min(others, key=lambda o: (-kept[o], o), default=None)
        form[w] = best if best is not None and kept[best] >= 2 * kept[w] else None

    def root(w):
        return root(form[w]) if form[w] else w
    return {w: (n, len(links[w]), form[w], kept[form[w]] if form[w] else None, root(w)) for w, n in kept.items()}


def rows_of(df):
    out = {}
    for r in df.collect():
        assert r.word not in out
        out[r.word] = (r.n, r.n_near, r.form, r.form_n, r.root)
    return out


@pytest.fixture(scope="module")
def table(spark):
    ready(spark)
    letters = "abcdeéÿ"
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(4, 9))) for _ in range(150)]
    words = list(base)
    for w in base:
        for _ in range(3):
            i, c = rnd.randrange(len(w)), rnd.choice(letters)
            words += [w[:i] + w[i + 1:], w[:i] + c + w[i:], w[:i] + c + w[i + 1:], "".join(rnd.sample(w, len(w)))]
    weights = [rnd.choice((1, 2, 4, 9, 20)) for _ in words]
    rows = [(i, " ".join(w if rnd.random() < 0.8 else w.upper() for w in rnd.choices(words, weights, k=60))) for i in range(300)]
    long = "ab" * 150
    rows += [(900, None), (901, ""), (902, "12 !? --"), (903, f"{long} x{long} {long} {long} x{long} x{long}"),
             (904, "naïve2naïve×naïve_ānaïve naïvE naive NAIVE naive naive naive"), rows[0], rows[0],
             (None, rows[1][1]), (905, rows[2][1] * 40)]
    df = spark.createDataFrame([(i, t, t, 0) for i, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    return rows, df


@pytest.mark.parametrize("sizes", [{}, {"cell_words": 25, "sample_words": 60},
                                   {"cell_words": 40, "block_words": 15, "block_searches": 20}])
def test_matches_brute_force(table, sizes):
    rows, df = table
    got, want = rows_of(variants.group_variants(df, typos=97, **sizes)), brute(rows)
    assert got.keys() == want.keys()
    assert {w: (got[w], want[w]) for w in want if got[w] != want[w]} == {}
    assert any(want[w][4] != want[w][2] and want[w][2] for w in want)  # chains of forms occur


def test_without_typos(table):
    rows, df = table
    assert rows_of(variants.group_variants(df)) == brute(rows, typos=0)


def test_empty_table(table):
    out = variants.group_variants(table[1].limit(0))
    assert set(out.columns) == {"word", "n", "n_near", "form", "form_n", "root"} and out.count() == 0


def test_runs_and_checksums():
    texts = ["Añb×c÷d e1f", None, "āxé", "é", "", "z" * 100 + " y"]
    r = variants.Runs(pa.array(texts))
    data, ptr = r.latin()
    got = [(int(d), data[ptr[i]:ptr[i + 1]].tobytes().decode("latin-1")) for i, d in enumerate(r.doc)]
    want = [(i, w) for i, t in enumerate(texts) for w in runs(t)]
    assert got == want
    sums = r.checksums([f"{i}:".encode() for i in range(len(texts))])
    assert [int(x) for x in sums] == [zlib.crc32(f"{i}:{w}".encode()) for i, w in want]


def test_leaves_are_few():
    """Box pruning leaves out most pairs before any letter is compared."""
    r = np.random.default_rng(2)
    words = np.unique(r.integers(97, 117, size=(4000, 8), dtype=np.uint8), axis=0)
    looked = []

    class Counted(variants.Matches):
        def _leaf(self, rows, mine):
            looked.append(len(rows) * len(mine))
            super()._leaf(rows, mine)
    Counted(words, words, np.ones(len(words), dtype=bool))
    assert sum(looked) < 0.5 * len(words) ** 2


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert rows_of(queries.QUERIES["op11_spelling_variants"](spark, sf)) == brute(rows)


def test_very_long_words(spark):
    ready(spark)
    long = "ab" * 40_000
    docs = spark.createDataFrame([(1, " ".join([long] * 6 + ["x" + long] * 3))], "doc_id long, text string")
    assert rows_of(variants.group_variants(docs)) == {long: (6, 1, None, None, long), "x" + long: (3, 1, long, 6, long)}
