"""License scan against brute force, and its defined cases."""

import random
import re

import numpy as np
import pytest

from starloom.llm import licenses, queries
from starloom.llm.ship import ready
from starloom.llm.textops import PUNCTUATION

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PHRASES = {"mit": "mit license", "apache": "apache license", "gpl": "general public license"}
rnd = random.Random(11)


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def places(t):
    w = words(t)
    return sorted((i, label) for label, p in PHRASES.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diag = 0
        for j, y in enumerate(b):
            diag, row[j + 1] = row[j + 1], diag + 1 if x == y else max(row[j], row[j + 1])
    return row[-1]


def brute_labels(t):
    """Labels whose template has, in some window of 1.25 times its words, a
    common subsequence of 0.8 of them."""
    w, out = words(t), {label for _, label in places(t)}
    for template in licenses.TEXTS:
        m = words(template.text)
        size = len(m) + len(m) // 4
        for i in range(max(1, len(w) - size + 1)):
            window = w[i:i + size]
            if set(template.needs) <= set(window) and lcs(m, window) >= 0.8 * len(m):
                out.add(template.label)
                break
    return out


def noise(n):
    return " ".join("".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 7))) for _ in range(n))


def edited(text, share):
    out = []
    for w in text.split():
        r = rnd.random()
        out += [] if r < share / 3 else ["zz"] if r < 2 * share / 3 else [w, "yy"] if r < share else [w]
    return " ".join(out)


@pytest.fixture(scope="module")
def rows():
    out = [noise(rnd.randint(0, 80)) for _ in range(30)]
    for t in licenses.TEMPLATES:
        out += [t.text, f"{noise(20)}. {t.text.upper()}! {noise(30)}", f"{noise(9)} {t.text}\n{noise(5)} {t.text} {noise(3)}"]
        if len(words(t.text)) > 20:
            out += [f"{noise(20)} {edited(t.text, 0.08)} {noise(20)}", " ".join(t.text.split()[:len(t.text.split()) // 2])]
    out += [None, "", " .. ", "MIT  License", "the MIT-license, the mit_License", "mit licenses", "permit license", "MITé license",
            "GNU general public, license general public license public license", "mit license " * 500,
            "Released under the Artistic License", "This work is licensed under the terms of nobody",
            noise(70_000) + " apache license " + noise(70_000) + licenses.TEXTS[0].text]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    ready(spark)
    data = [(i, t, "x", "y", i) for i, t in enumerate(rows)] + [(None, rows[31], "x", "y", 0), (5, rows[5], "x", "y", 0), (5, rows[5], "x", "y", 0)]
    return data, spark.createDataFrame(data, "doc_id long, text string, key string, spans string, template int").repartition(3)


@pytest.mark.parametrize("broadcast", [10**6, 0])
def test_matches_brute_force(docs, broadcast):
    data, df = docs
    got = licenses.scan(df, broadcast_spans=broadcast).collect()
    assert sorted(r.doc_id for r in got if r.doc_id is not None) == sorted(d[0] for d in data if d[0] is not None)
    text_of = {d[0]: d[1] for d in data}
    for r in got:
        t = text_of[r.doc_id]
        assert r.n_words == len(words(t))
        assert sorted((s.first_word, s.label) for s in r.spans if s.exact) == places(t)
        assert len(words(t)) > 10**5 or {s.label for s in r.spans} == brute_labels(t), t
        assert all(0.8 <= s.similarity <= 1 for s in r.spans)
    long = max(got, key=lambda r: r.n_words)
    assert [(s.label, s.exact) for s in long.spans] == [("apache", True), ("mit", False)]


def test_empty_table(docs):
    assert licenses.scan(docs[1].limit(0)).count() == 0


def test_common_words_is_the_longest_common_subsequence():
    for _ in range(200):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randint(1, 12))] for _ in range(2))
        assert licenses.common_words(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64)) == lcs(a, b)


def test_query_matches_plain_search(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = queries.QUERIES["op12_license_scan"](spark, sf).collect()
    assert len(got) == len(docs)
    for r in got:
        own = places(docs[r.doc_id])
        assert (r.n_words, r.n_base) == (len(words(docs[r.doc_id])), len(own))
        assert (r.first_word, r.last_word) == ((own[0][0], own[-1][0]) if own else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in own}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert set(filter(None, r.labels.split(","))) == brute_labels(docs[r.doc_id])


def test_word_bytes():
    assert not PUNCTUATION[list(b"azAZ09\xc3\xff")].any() and PUNCTUATION[list(b" /:@[`{\x7f_-")].all()
