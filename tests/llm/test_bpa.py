"""Ranked lexical search against brute force, and its defined cases."""

import collections
import math
import random
import re

import numpy as np
import pytest

from starloom.llm import bpa
from starloom.llm.ship import ready

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
rnd = random.Random(3)
VOCAB = [f"w{i}" for i in range(80)]


def terms(t):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, k):
    bags = [collections.Counter(terms(t)) for _, t in docs]
    n = sum(1 for b in bags if b)
    total = sum(sum(b.values()) for b in bags)
    out = collections.Counter()
    for item, text in items:
        scored = []
        for (doc, _), bag in zip(docs, bags):
            score = 0
            for t in set(terms(text)) & bag.keys():
                df = sum(1 for b in bags if t in b)
                m = 50 + 50 * sum(bag.values()) * n // total
                score += math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m))
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        scored.sort()
        out.update((item, r + 1, s[3], -s[0]) for r, s in enumerate(scored[:k]))
    return out


def text(n):
    return " ".join(rnd.choice(VOCAB[:rnd.choice((5, 20, 80))]) for _ in range(n))


@pytest.fixture(scope="module")
def tables(spark):
    ready(spark)
    docs = [(i, text(rnd.randint(1, 30))) for i in range(400)]
    docs += [(400, None), (401, ""), (402, "-- !!"), (None, docs[3][1]), docs[5], docs[5], (403, docs[5][1]),
             (404, "É É é x2,W1-w2_W3"), (405, text(5000))]
    items = [(i, text(rnd.randint(1, 12))) for i in range(15)] + [(15, None), (16, "unheard"), (17, "é É w3 W3"), (None, "w1 w7")]
    d = spark.createDataFrame([(i, t, i, "s") for i, t in docs], "doc_id long, text string, rank long, score string")
    q = spark.createDataFrame([(i, t, i) for i, t in items], "item_id long, text string, doc_id long")
    return docs, items, d.repartition(4), q


def rows(df):
    return collections.Counter((r.item_id, r.rank, r.doc_id, r.score) for r in df.collect())


@pytest.mark.parametrize("k,sizes", [(7, {}), (50, {"block_terms": 9, "block_postings": 60}), (1000, {"task_postings": 10})])
def test_matches_brute_force(tables, k, sizes):
    docs, items, d, q = tables
    assert rows(bpa.search(d, q, k=k, **sizes)) == brute(docs, items, k)


def test_empty_tables(spark, tables):
    _, _, d, q = tables
    for a, b in ((d.limit(0), q), (d, q.limit(0))):
        out = bpa.search(a, b)
        assert out.columns == ["item_id", "rank", "doc_id", "score"] and out.count() == 0


def test_stops_before_the_lists_end_and_strictly_below_the_kth():
    n = 20_000
    r = np.random.default_rng(1)
    doc = np.concatenate([r.permutation(n)[:n // 2] for _ in range(3)])
    term = np.repeat(np.arange(3), n // 2)
    impact = (1_000_000 * r.power(0.1, len(doc))).astype(np.int64) + 1
    lists = bpa.ImpactLists(n, doc, term, impact, 3)
    total = np.zeros(n, dtype=np.int64)
    np.add.at(total, doc, impact)
    place = np.arange(n)
    want = np.lexsort((place, -total))[:10]
    docs, scores = lists.top(np.arange(3), 10, place, 0)
    assert list(docs[np.lexsort((place[docs], -scores))]) == list(want)
    assert lists.sorted_accesses < len(doc) / 4
    # equal scores: reading goes on until smaller ids can no longer enter
    same = bpa.ImpactLists(n, np.arange(n), np.zeros(n, dtype=np.int64), np.full(n, 7), 1)
    assert sorted(same.top(np.array([0]), 10, place[::-1].copy(), 0)[0]) == list(range(n - 10, n))
