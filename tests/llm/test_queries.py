"""Registered queries and the pipeline over the smallest tables."""

import collections
import math
import os

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

import corpus_pipeline
from starloom.llm import langid, mixing, packing, queries
from starloom.llm.queries import tokenizer_path
from starloom.llm.ship import ready
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_matches_sql(spark, name):
    r = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE[name], SF)
    assert r["ok"], r.get("why")


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    both = queries.QUERIES["op9_langid"](spark, SF).filter("held_out").join(docs, "doc_id")
    assert both.filter("lang = lang_pred").count() >= 0.95 * both.count()


def test_language_model_beats_the_base(spark):
    r = queries.QUERIES["op4_hpylm"](spark, SF).filter("held_out").selectExpr("sum(score) s", "sum(base_score) b").first()
    assert r.s > r.b


def test_line_dedup_stage_on_a_small_source(spark):
    rows = [(i, f"body {i}\n{'Menu' if i < 3 else f'own {i}'}", "en", "small", 9) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}
    assert [got[i].text for i in range(3)] == [f"body {i}" for i in range(3)] and got[0].n_chars == 6
    assert all(got[i].text == rows[i][1] for i in range(3, 20))


def test_pipeline_stages(spark):
    ready(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        kept = stage(spark, kept, SF)
        assert kept.columns == docs.columns, name
    ids = collections.Counter(r.doc_id for r in kept.select("doc_id").collect())
    assert ids and set(ids) <= {r.doc_id for r in docs.select("doc_id").collect()} and max(ids.values()) <= 3
    assert corpus_pipeline.run(spark, SF).count() > 0


def test_spotsigs_query_finds_all_pairs(spark):
    from starloom.llm import spotsigs
    prints = spotsigs.fingerprints(spark.read.parquet(f"{SF}/documents.parquet")).collect()
    sets = {}
    for r in prints:
        s = frozenset(spotsigs.decode(r.fingerprint).tolist())
        if s:
            sets[s] = min(sets.get(s, r.doc_id), r.doc_id)
    want = {(i, j): len(a & b) / len(a | b) for a, i in sets.items() for b, j in sets.items()
            if i < j and len(a & b) >= 0.8 * len(a | b)}
    got = {(r.a_id, r.b_id): r.likeness for r in queries.QUERIES["near_duplicates_spotsigs"](spark, SF).collect()}
    assert got == pytest.approx(want) and want


def brute_mix(text, model, em=20, refit=6):
    """Operator 9 for one text, word by word: proportions by expectation
    maximisation over all languages, then nested sets by penalised likelihood."""
    names, table = model
    words = [w for w in text.lower().encode().split() if any(97 <= c <= 122 or c >= 128 for c in w)]
    like = []
    for w in words:
        p = b" " + w + b" "
        grams = [(((p[i] << 16 | p[i + 1] << 8 | p[i + 2]) * 2654435761) & 0xFFFFFFFF) >> 16 for i in range(len(w))]
        log = [sum(float(t[g]) for g in grams) for t in table]
        like.append([math.exp(max(x - max(log), -60.0)) for x in log])

    def fit(start, steps):
        mix = start
        for _ in range(steps):
            joint = [[m * x for m, x in zip(mix, row)] for row in like]
            mix = [sum(j[i] / sum(j) for j in joint) / len(like) for i in range(len(mix))]
        return mix, sum(math.log(sum(m * x for m, x in zip(mix, row))) for row in like)
    full, _ = fit([1 / len(names)] * len(names), em)
    order, best = sorted(range(len(names)), key=lambda i: -full[i]), None
    for k in range(1, len(names) + 1):
        start = [full[i] + 1e-6 if i in order[:k] else 0.0 for i in range(len(names))]
        mix, ll = fit([x / sum(start) for x in start], refit if k > 1 else 0)
        ll -= (k - 1) * math.log(max(len(like), 2))
        if best is None or ll > best[0]:
            best = ll, mix
    return {n: m for n, m in zip(names, best[1]) if m}


def test_language_mixture_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ready(spark)
    model = langid.learn(docs.filter("doc_id % 3 > 0"))
    texts = [" ".join(r.text.split()[:40]) for r in docs.filter("text IS NOT NULL").limit(30).collect()]
    texts += [f"{a} {b}" for a, b in zip(texts[::2], texts[1::2])]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r in langid.predict(df, model).filter("lang_pred <> 'und'").collect():
        want = brute_mix(r.text, model)
        assert r.lang_mix.keys() == want.keys() and all(abs(r.lang_mix[k] - v) < 1e-3 for k, v in want.items())
        assert want[r.lang_pred] == pytest.approx(max(want.values()), abs=1e-3) and r.score == pytest.approx(max(want.values()), abs=1e-3)


def test_too_many_languages_are_refused(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_LANGUAGES", 3)
    df = spark.createDataFrame([(f"text {i}", f"l{i}") for i in range(4)], "text string, lang string")
    with pytest.raises(ValueError):
        langid.learn(df)


def test_pipeline_stages_against_brute_force(spark):
    ready(spark)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = [(10_001, None, None, "src0", 0), (10_002, "", "en", "src1", 0), (10_003, "123 !!!", "en", None, 7), (None, "the cat and the dog", None, "src0", 3)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema)).checkpoint()
    rows = docs.collect()
    stages = dict(corpus_pipeline.STAGES)
    kept = {(r.doc_id, r.text): r for r in stages["language_id"](spark, docs, SF).collect()}
    assert set(kept) == {(r.doc_id, r.text) for r in rows if any(map(str.isalpha, r.text or ""))}
    assert all(r.lang for r in kept.values())

    lines, pages = collections.Counter(), collections.defaultdict(set)
    for s, t in {(r.source, r.text) for r in rows if r.text is not None}:
        pages[s].add(t)
        lines.update({(s, x.strip(" ")) for x in t.split("\n") if x.strip(" ")})
    bad = {k for k, n in lines.items() if n >= 2 and n > 0.1 * len(pages[k[0]])}
    want = [(r.doc_id, r.text and "\n".join(x for x in r.text.split("\n") if (r.source, x.strip(" ")) not in bad)) for r in rows]
    assert collections.Counter(want) == collections.Counter(map(tuple, stages["line_dedup"](spark, docs, SF).select("doc_id", "text").collect()))

    sets = {}
    for r in rows:
        w = (r.text or "").encode().lower().split()
        if w and r.doc_id is not None:
            sets[r.doc_id] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            a, b = sets[i], sets[j]
            if 0.8 * len(a) <= len(b) <= 1.25 * len(a) and 100 * len(a & b) >= 80 * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    gone = {i for i in ids if find(i) != i}
    assert {r.doc_id for r in rows} - gone == {r.doc_id for r in stages["near_duplicates"](spark, docs, SF).collect()}

    size = {r.doc_id: len((r.text or "").encode().split()) for r in rows}
    mixed = collections.Counter(r.doc_id for r in stages["mix_sources"](spark, docs, SF).collect())
    rate = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert set(mixed) <= set(size) and max(mixed.values()) <= 3
    taken = collections.Counter()
    for r in rows:
        taken[r.source] += mixed[r.doc_id] * size[r.doc_id]
    largest = collections.defaultdict(int)
    for r in rate.values():
        largest[r.source] = max(largest[r.source], r.size)
    for r in rate.values():  # ten documents a source: within one of them
        assert abs(taken[r.source] - r.target) <= largest[r.source] and mixed[r.doc_id] == r.copies

    whole = collections.defaultdict(list)
    for r in stages["pack_sequences"](spark, docs, SF).collect():
        whole[r.doc_id].append((r.start, bytes(r.ids)))
    plain = packing.coder(tokenizer_path()).tokenizer
    for r in rows:
        ids = [*plain.encode(r.text or "", add_special_tokens=False).ids, 2]
        assert b"".join(x for _, x in sorted(whole[r.doc_id])) == np.array(ids, "<u4").tobytes()


def test_spotsigs_sets_are_integers(spark):
    from starloom.llm import spotsigs
    docs = spark.createDataFrame([(3, "the quick brown fox is on the old red mat"), (2, "the quick brown fox is on the old red mat"),
                                  (5, "a cat was in the small green house by the river"), (7, None)], "doc_id long, text string")
    prints = spotsigs.fingerprints(docs)
    got = spotsigs.representatives(prints)
    assert dict(got.dtypes)["sigs"] == "array<int>"
    want = {r.doc_id: [int(x) for x in spotsigs.decode(r.fingerprint)] for r in prints.collect() if r.doc_id in (2, 5)}
    assert {r.id: [x & 0xFFFFFFFF for x in r.sigs] for r in got.collect()} == want


def test_long_rows_are_written_in_small_groups(spark, tmp_path):
    ready(spark)

    def run(batches):
        for b in batches:
            for _ in range(b.num_rows):
                yield pa.RecordBatch.from_arrays([pa.array([os.urandom(100_000)])], names=["ids"])

    spark.range(0, 500, 1, 1).mapInArrow(run, "ids binary").write.parquet(str(tmp_path / "long"))
    (file,) = (tmp_path / "long").glob("*.parquet")
    held = pq.ParquetFile(file).metadata
    assert held.num_rows == 500 and held.num_row_groups > 1
    assert max(held.row_group(i).total_byte_size for i in range(held.num_row_groups)) < 32 << 20
