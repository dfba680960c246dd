"""Operators on small tables against brute force, and their defined cases:
nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import base64
import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starloom.llm import cotrain, hpylm, jaccard, langid, linededup, merkle, mixing, packing, spotsigs, topk
from starloom.llm.queries import tokenizer_path
from starloom.llm.textops import Words

DOCS = "doc_id long, text string, lang string, source string, n_chars long, class int, n int, c string, slice string"
rnd = random.Random(5)
VOCAB = ["".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(300)]


def prose(n):
    return " ".join(rnd.choice(VOCAB) for _ in range(n))


@pytest.fixture(scope="module")
def texts():
    base = [prose(rnd.randint(3, 60)) for _ in range(60)]
    near = []
    for t in base[:25]:
        w = t.split()
        w[rnd.randrange(len(w))] = "zz"
        near.append(" ".join(w))
    odd = [None, "", "  \n\t ", "one", "Two words", base[0], base[0].upper(), "é à ü 字 " + base[1], prose(3000), "12 34 !!", base[2] + "\n" + base[3]]
    return base + near + odd


@pytest.fixture(scope="module")
def docs(spark, texts):
    from starloom.llm.ship import ready

    ready(spark)
    rows = [(i, t, ["en", "de", None][i % 3], [None, "a", "b", "hot", "hot", "hot"][i % 6], None if t is None else len(t),
             i, i, "x", "y") for i, t in enumerate(texts)]
    rows.append(rows[3])  # a repeated row
    rows.append((None, prose(9), "en", "a", 1, 0, 0, "", ""))
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def words(t):
    return (t or "").encode().lower().split()


def test_words_match_bytes_split(texts):
    w = Words(pa.array(texts))
    seen = {}
    at = 0
    for i, t in enumerate(texts):
        own = words(t)
        assert w.ptr[i + 1] - w.ptr[i] == len(own)
        for x in own:
            assert seen.setdefault(x, w.hashes[at]) == w.hashes[at]
            at += 1
    assert len(set(seen.values())) == len(seen)


def shingles(t):
    w = words(t)
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_components(rows):
    ids = [i for i, _ in rows]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    sets = dict((i, shingles(t)) for i, t in rows)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                k = len(sets[a] & sets[b])
                if 100 * k >= 80 * (len(sets[a]) + len(sets[b]) - k):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def test_jaccard_components(docs, none):
    got = jaccard.join_components(docs).collect()
    want = brute_components([(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect() if r.doc_id is not None])
    assert len(got) == docs.count()
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r
    assert jaccard.join_components(none).count() == 0
    assert jaccard.join_components(none).columns[0] == "doc_id"


def test_jaccard_large_near_group_and_blocks(spark, monkeypatch):
    """A group of near copies around the threshold, larger than a block."""
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(150):
        w = list(base)
        for j in rnd.sample(range(60), rnd.choice([0, 1, 2])):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, prose(40)) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = brute_components(rows)
    assert len({c for _, c in want.values()}) > 31  # some stay alone
    for r in jaccard.join_components(df).collect():
        assert (r.n_shingles, r.component_id) == want[r.doc_id]


@pytest.mark.parametrize("block", [16, 512])
def test_jaccard_all_links(spark, monkeypatch, block):
    """Every link of every component, and each document's number of them."""
    monkeypatch.setattr(jaccard, "BLOCK", block)
    base = [f"w{i}" for i in range(64)]
    chain = [" ".join(base[i:i + 54]) for i in (0, 4, 8)]  # no link between the first and the last
    rows = [*enumerate(chain), (3, chain[1])]
    for i in range(60):
        w = [f"v{j}" for j in range(160)]
        for j in rnd.sample(range(160), rnd.choice([0, 1, 2])):
            w[j] = f"x{i}_{j}"
        rows.append((100 + i, " ".join(w)))
    rows += [(1000, "a lone text of six words"), (1001, None), (1002, chain[0].upper())]
    sets = {}
    for i, t in rows:
        w = words(t)
        sets.setdefault(frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)), []).append(i)
    sets.pop(frozenset(), None)
    want = {(min(sets[a]), min(sets[b])) for a in sets for b in sets
            if min(sets[a]) < min(sets[b]) and 100 * len(a & b) >= 80 * len(a | b)}
    assert {(0, 1), (1, 2)} <= want and (0, 2) not in want and len(want) > 500
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.a, r.b) for r in jaccard.join_links(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    number = collections.Counter(x for link in want for x in link)
    of = {i: number[min(ids)] for ids in sets.values() for i in ids}
    assert all(r.linked_classes == of.get(r.doc_id, 0) for r in jaccard.join_components(df).collect())


def test_jaccard_steps_are_few_files(spark):
    same = prose(40)
    rows = [(i, same + " " + str(i % 50)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(100)
    sig, classes, profile, roots = jaccard._joined(df, "doc_id", "text", jaccard.SHINGLE, jaccard.PERCENT)
    few = max(jaccard.FEW_FILES, 2 * spark.sparkContext.defaultParallelism)
    for step, n in ((sig, 400), (classes, 50), (profile, 50), (roots, 50)):
        assert step.count() == n and 0 < len(step.inputFiles()) <= few


def test_jaccard_keep_one(docs):
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    want = brute_components([(r.doc_id, r.text) for r in docs.dropDuplicates(["doc_id"]).collect() if r.doc_id is not None])
    assert sorted(i for i in ids if i is not None) == sorted(i for i, (_, c) in want.items() if c == i)
    assert None in ids


def test_packing(docs, none):
    for capacity in (16, 4096):
        got = packing.pack(docs, tokenizer_path(), capacity=capacity).collect()
        plain = packing.coder(tokenizer_path()).tokenizer
        want = collections.Counter((r.doc_id, tuple([*plain.encode(r.text or "", add_special_tokens=False).ids, 2]))
                                   for r in docs.collect())
        whole = collections.defaultdict(list)
        for r in got:
            ids = np.frombuffer(bytes(r.ids), "<u4")
            assert zlib.crc32(bytes(r.ids)) == r.ids_crc32 and len(ids) == r.length > 0
            whole[r.doc_id].append((r.start, r.doc_tokens, tuple(ids)))
        for doc_id, pieces in whole.items():
            sides = [ids for (i, ids), n in want.items() if i == doc_id for _ in range(n)]
            assert sum(len(p[2]) for p in pieces) == sum(map(len, sides))
            for start, n, ids in pieces:
                assert any(len(s) == n and s[start:start + len(ids)] == ids for s in sides)
        bins = collections.defaultdict(list)
        for r in got:
            bins[r.sequence_id].append((r.offset, r.length))
        pad = 0
        for parts in bins.values():
            at = 0
            for o, n in sorted(parts):
                assert o == at
                at += n
            assert at <= capacity
            pad += 0 if at & (at - 1) == 0 else capacity - at
        if capacity == 4096:
            assert pad <= 0.02 * sum(r.length for r in got)
    assert packing.pack(none, tokenizer_path()).count() == 0


def test_packing_cuts_stay_in_their_class():
    for n in range(1, 5000, 7):
        cut = packing.cuts(n, 4096, 64)
        assert sum(x for x, _ in cut) == n
        assert all(4096 // (k + 1) < x <= 4096 // k or x == 4096 // k for x, k in cut)
        assert len(cut) <= 6


def test_word_ids_fall_back_where_a_tokenizer_keeps_space():
    coder = packing.WordIds(tokenizer_path("byte_bpe_50k.json"))
    assert not coder.splits
    assert coder.text_ids([b"a  b"]) == [coder._ids("a  b")]


def test_word_ids_random_text():
    coder = packing.coder(tokenizer_path())
    letters = "aAbé ÉİßΣς.,'s'tlĺ  \x1c\x85|<>1²ǅ가ᄀ"
    for _ in range(300):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 14))) + rnd.choice(["", "<|endoftext|>", " <|ENDOFTEXT|> a"])
        assert coder.text_ids([t.encode()])[0] == coder._ids(t)


def brute_targets(sizes, weights, cap):
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in full]
        left = total - sum(full.values())
        share = {s: left * w[s] / sum(w[x] for x in rest) for s in rest}
        over = [s for s in rest if share[s] > cap * sizes[s]]
        if not over:
            return {**full, **share}
        full.update({s: cap * sizes[s] for s in over})


def test_mixing(docs, none, spark):
    rows = mixing.mix(docs).collect()
    assert len(rows) == docs.count()
    sizes = collections.Counter()
    for r in docs.collect():
        sizes[r.source] += len(words(r.text))
    want = brute_targets(dict(sizes), (5, 2, 1), 3)
    taken = collections.Counter()
    for r in rows:
        assert r.source_size == sizes[r.source] and 0 <= r.copies <= 3 and r.taken == r.copies * r.size
        assert math.isclose(r.target, want[r.source], rel_tol=1e-9)
        taken[r.source] += r.taken
    for s in want:
        assert abs(taken[s] - want[s]) <= max(60, 0.02 * want[s]), (s, taken[s], want[s])
    again = sorted(map(str, mixing.mix(docs.repartition(5)).collect()))
    assert again == sorted(map(str, rows))
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    copies = collections.Counter(r.doc_id for r in mixed.collect())
    assert copies == +collections.Counter({i: sum(r.copies for r in rows if r.doc_id == i) for i in {r.doc_id for r in rows}})
    assert mixing.mix(none).count() == 0 and mixing.apply_mix(none).count() == 0


def test_mixing_tilt_is_the_dual_solution(docs):
    """At the solution rate = min(cap, exp(lambda x)) and the tokens meet the target."""
    sums = collections.defaultdict(float)
    target = {}
    for r in mixing.mix(docs).collect():
        sums[r.source] += r.rate * r.size
        target[r.source] = r.target
    for s, t in target.items():
        assert math.isclose(sums[s], t, rel_tol=1e-6)


def test_line_dedup(spark, none):
    rows = [(i, "h1" if i < 20 else None, f"Menu\nbody {i} text\n\n  Menu  \nshared {i % 2}") for i in range(30)]
    rows += [(100 + i, "h2", "Menu\nonly here") for i in range(40)]  # copies are one page
    rows += [(200, "h1", None), (201, "h1", ""), (202, None, rows[25][2])]
    df = spark.createDataFrame(rows, "page_id long, host string, text string").withColumn("host_pages", F.lit(1))
    for limit in (linededup.BROADCAST_LINES, 0):  # both ways to the pages
        got = {r.page_id: r for r in linededup.drop_boilerplate(df, ratio=0.45, counts=True, broadcast_lines=limit).collect()}
        assert len(got) == len(rows)
        # 'shared' stands on half of the host's pages less the empty one
        assert got[0].text == "body 0 text\n" and got[0].n_lines == 5 and got[0].n_dropped == 3
        assert got[25].text.startswith("body 25 text")
        assert got[105].text == "Menu\nonly here" and got[105].n_dropped == 0
        assert got[200].text is None and got[201].text == ""
    empty = linededup.drop_boilerplate(df.limit(0))
    assert empty.count() == 0 and empty.columns == df.columns


def test_line_dedup_deals_a_hot_host(spark):
    rows = [(i, "hot" if i % 3 else f"h{i % 7}", f"Menu\nown {i}") for i in range(300)]
    df = spark.createDataFrame(rows, "page_id long, host string, text string").repartition(3)
    got = {limit: sorted(map(tuple, linededup.drop_boilerplate(df, broadcast_lines=limit).collect())) for limit in (10**6, 0)}
    assert got[0] == got[10**6] == [(i, h, f"own {i}") for i, h, _ in rows]


CLASHING = ["score", "lang_pred", "__size", "__hash", "__copies", "__h", "__kept", "__keys", "__gone", "__n", "__again",
            "host", "h", "keys", "kept", "row", "id", "gone", "again", "size", "rate", "bin", "target"]


def test_user_columns_clash_with_nothing(spark):
    """Every name an operator once used inside, carried untouched by the stages."""
    import corpus_pipeline

    rows = [(i, f"Menu\n{prose(12)}" if i % 4 else None if i % 8 else "Menu\nsame text here for all to see again", "en", f"s{i % 2}", 9)
            for i in range(60)]
    rows += [rows[8], rows[8], (None, rows[9][1], "en", "s0", 9)]
    base = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = base.select("*", *[F.concat(F.lit(f"{c}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias(c)
                               for c in CLASHING])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, extra, "")
        assert out.columns == extra.columns, name
        kept = out.collect()
        assert kept and all(r[c] == f"{c}:{'' if r.doc_id is None else r.doc_id}" for r in kept for c in CLASHING), name
        plain = stage(spark, base, "").collect()
        assert collections.Counter((r.doc_id, r.text) for r in kept) == collections.Counter((r.doc_id, r.text) for r in plain)
        assert stage(spark, extra.limit(0), "").count() == 0
    assert corpus_pipeline.STAGES[4][1](spark, extra, "").count() >= len(rows)


def test_langid(docs, none):
    model = langid.learn(docs)
    assert model[0] == ["de", "en"]
    out = langid.predict(docs, model)
    assert out.columns == [*docs.columns, "lang_pred", "score", "lang_mix"]
    for r in out.collect():
        letter = any(ch.isalpha() for ch in r.text or "")
        assert (r.lang_pred == "und") == (not letter)
        assert 0 <= r.score <= 1
    assert {r.lang_pred for r in langid.predict(docs, langid.learn(none)).collect()} == {"und"}


def test_langid_mixture_and_penalty(spark):
    en, de = ["the and of with this from"], ["der und nicht mit auch eine"]
    train = [(t, "en") for t in en * 20] + [(t, "de") for t in de * 20]
    model = langid.learn(spark.createDataFrame(train, "text string, lang string"))
    mixed = "the and of with this from " * 4 + "der und nicht mit auch eine " * 2
    df = spark.createDataFrame([(mixed,), (en[0] * 3,)], "text string")
    a, b = langid.predict(df, model).collect()
    assert a.lang_pred == "en" and set(a.lang_mix) == {"en", "de"} and abs(a.score - 2 / 3) < 0.1
    assert b.lang_mix == {"en": 1.0}


def test_langid_finds_more_than_four_languages(spark):
    parts = {f"l{i}": " ".join(c * 3 + x * 2 for x in "stuvwx") for i, c in enumerate("abcdefg")}
    model = langid.learn(spark.createDataFrame([(t, g) for g, t in parts.items()] * 5, "text string, lang string"))
    mixed = " ".join(t for g, t in parts.items() for _ in range(9 if g == "l6" else 5))
    a, b = langid.predict(spark.createDataFrame([(mixed,), (parts["l2"],)], "text string"), model).collect()
    assert a.lang_pred == "l6" and set(a.lang_mix) == set(parts) and abs(a.score - 9 / 39) < 0.02
    assert b.lang_mix == {"l2": 1.0}


def test_topk(spark):
    g = np.random.default_rng(3)
    rows = [(i, [float(x) for x in g.normal(size=8)]) for i in range(400)]
    rows += [(400 + i, rows[7][1]) for i in range(60)]  # ties
    rows += [(1000, None), (1001, [1.0, float("nan")] * 4), (1002, [1.0, None] * 4), (None, rows[0][1]), (1003, []),
             (1020, [2.0, 3.0]), (1021, [1.0, 1.0]), rows[5], rows[20], (6, rows[9][1]), (40, rows[3][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("v", F.lit(1)).withColumn("id", F.lit("x"))
    vectors = df.select("vec_id", "v", "id", topk.quantised(F.col("embedding")).alias("vector")).withColumn("row", F.lit(0))
    good = [(i, np.floor(64 * np.array(e, dtype=np.float32).astype(float)).astype(int)) for i, e in rows
            if i is not None and e and None not in e and not any(math.isnan(x) for x in e)]
    # every row but the query's own: two rows of one id are rows of their own
    want = collections.Counter()
    for n, (i, q) in enumerate(good):
        if i % 20 == 0:
            scored = sorted((-int(q @ x), j) for m, (j, x) in enumerate(good) if m != n and len(x) == len(q))[:20]
            want.update((i, r + 1, j, -s) for r, (s, j) in enumerate(scored))
    for sizes in ({"block": 64, "query_block": 7}, {}):
        got = topk.top_k(vectors, F.col("vec_id") % 20 == 0, **sizes).collect()
        assert collections.Counter((r.query_id, r.rank, r.vec_id, r.score) for r in got) == want
    assert topk.top_k(vectors.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_topk_takes_exact_products_of_survivors_only():
    g = np.random.default_rng(8)
    centres = g.normal(size=(40, 64))
    for x, share in ((centres[g.integers(0, 40, 6000)] + 0.3 * g.normal(size=(6000, 64)), 0.3), (g.normal(size=(6000, 64)), 0.9)):
        x = np.floor(64 * x).astype(np.int64)
        rows, seen = np.arange(len(x)), [0] * (len(topk.LEVELS) + 1)
        q = rows[::100]
        a, b, score = topk.search_block(q, x[q], rows, rows, x, 20, seen=seen)
        exact = x[q] @ x.T
        exact[np.arange(len(q)), q] = -2**60
        best = np.lexsort((np.broadcast_to(rows, exact.shape), -exact), axis=1)[:, :20]
        assert (b.reshape(-1, 20) == best).all() and (score == exact[q[a] // 100, b]).all()
        assert seen[0] == len(q) * (len(x) - 1) and seen == sorted(seen, reverse=True) and seen[-1] < share * seen[0]


def test_spotsigs_next_and_edited(docs, none):
    out = spotsigs.compare_with_next(docs).collect()
    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    assert len(out) == len(rows)
    got = collections.defaultdict(list)
    for r in out:
        got[r.doc_id].append(r)
    prints = {}
    for i, (doc_id, text) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        m = len(text) // 4
        changed = text[:len(text) - m] + nxt[:m]
        r = next(x for x in got[doc_id] if x.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest())
        assert r.n_chars == len(text)
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        a, b = set(spotsigs.decode(r.fingerprint).tolist()), set(spotsigs.decode(r.edited_fingerprint).tolist())
        assert math.isclose(r.near_edited, len(a & b) / len(a | b) if a | b else 1.0)
    assert spotsigs.compare_with_next(none).count() == 0


def test_spotsigs_slices_are_whole(spark):
    rows = [(i * 3, f"text {i} the cat and dog") for i in range(100)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    cut, n = spotsigs.with_next(df, per_slice=10)
    assert n > 5
    seen = cut.collect()
    assert sorted(r.doc_id for r in seen if not r["last"]) == [i for i, _ in rows]
    for s in {r.slice for r in seen}:
        own = sorted(r.doc_id for r in seen if r.slice == s and not r["last"])
        follow = [r.doc_id for r in seen if r.slice == s and r["last"]]
        assert follow == [own[-1] + 3 if own[-1] < 297 else 0]


@pytest.mark.parametrize("hot", [None, 7])
def test_spotsigs_slices_split_a_hot_id(spark, hot):
    rows = [(hot, f"text {i} the cat and dog") for i in range(60)] + [(i * 3, f"own {i}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    cut, n = spotsigs.with_next(df, per_slice=10)
    seen = [r for r in cut.collect() if not r["last"]]
    assert sorted((r.doc_id or -1, r.text) for r in seen) == sorted((i or -1, t) for i, t in rows)
    assert max(collections.Counter(r.slice for r in seen).values()) < 40
    got = {(r.doc_id, r.n_chars) for r in spotsigs.compare_with_next(df).collect()}
    assert got == {(i, len(t)) for i, t in rows}


@pytest.mark.parametrize("hot", [2000, 2])
def test_spotsigs_near_duplicates(docs, monkeypatch, hot):
    monkeypatch.setattr(spotsigs, "HOT_SIGNATURE", hot)
    prints = spotsigs.fingerprints(docs)
    got = {(r.a_id, r.b_id): r.likeness for r in spotsigs.near_duplicates(prints, 0.6).collect()}
    sets = {}
    for r in prints.collect():
        if r.doc_id is not None:
            s = frozenset(spotsigs.decode(r.fingerprint).tolist())
            if s:
                sets[s] = min(sets.get(s, r.doc_id), r.doc_id)
    want = {}
    for a, i in sets.items():
        for b, j in sets.items():
            if i < j and len(a & b) / len(a | b) >= 0.6:
                want[(i, j)] = len(a & b) / len(a | b)
    assert got == pytest.approx(want) and want


def test_merkle_audit(spark):
    rows = [(i, f"http://x/{i}", f"page {i}" if i % 7 else None) for i in range(300)] + [(None, None, "lost id"), (5, "http://x/5", "page 5")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n", F.lit(1)).withColumn("digest", F.lit(""))

    def recs(d):
        return merkle.records(d, F.col("page_id"), merkle.warc_record(F.col("url"), F.col("html")),
                              merkle.archives_by_id(F.col("page_id"), 64))
    same = merkle.fixity_audit(recs(df), recs(df.repartition(3)), fanout=4)
    assert same.count() == 0
    bad = df.withColumn("html", F.when(F.col("page_id").isin(3, 70, 299), "PAGE").otherwise(F.col("html"))).filter(
        F.coalesce(F.col("page_id") != 255, F.lit(True)))
    got = {(r.record_id, r.status) for r in merkle.fixity_audit(recs(df), recs(bad), fanout=4).collect()}
    # a change of length moves the records behind it in its archive
    assert {(3, "corrupt"), (70, "corrupt"), (299, "corrupt"), (255, "missing")} <= got
    assert not any(r is not None and (r in (0, 1, 2) or 192 <= r < 255) for r, _ in got)
    gone = merkle.fixity_audit(recs(df), recs(df.filter("page_id < 64")), fanout=4)
    assert gone.filter("status = 'missing'").count() == gone.count() == 302 - 65
    assert merkle.fixity_audit(recs(df.limit(0)), recs(df.limit(0))).count() == 0


def test_merkle_audit_reports_only_the_lost_record(spark):
    rows = [(i, f"http://x/{i}", f"page {i}") for i in range(-70, 300)]
    rows += [(9, "http://x/9", "other"), (9, "http://x/9", "other"), (None, None, "lost id"), (None, None, "other")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")

    def recs(d):
        return merkle.records(d, F.col("page_id"), merkle.warc_record(F.col("url"), F.col("html")),
                              merkle.archives_by_id(F.col("page_id"), 64))

    def found(a, b):
        return sorted((r.record_id, r.status) for r in merkle.fixity_audit(recs(a), recs(b), fanout=4).collect())
    whole = F.coalesce(~F.col("page_id").isin(-30, 20, 100, 101, 255), F.lit(True))
    bad = df.filter(whole).withColumn("html", F.when(F.col("page_id") == 130, "a longer page").otherwise(F.col("html")))
    lost = [(-30, "missing"), (20, "missing"), (100, "missing"), (101, "missing"), (130, "corrupt"), (255, "missing")]
    assert found(df, bad) == lost
    assert found(bad, df) == [(i, s.replace("missing", "extra")) for i, s in lost]
    # a copy of a repeated id, and a record without one
    copies = df.dropDuplicates().filter(F.coalesce(F.col("page_id") > -100, F.col("html") == "other"))
    got = {(r.record_id, r.status) for r in merkle.fixity_audit(recs(df), recs(copies), fanout=4).collect()}
    assert got == {(9, "missing"), (None, "missing")}
    assert found(df, df.repartition(3)) == []


def test_merkle_many_records_of_one_id(spark, monkeypatch):
    """Null and repeated ids are placed and compared in chunks, as if whole."""
    monkeypatch.setattr(merkle, "CHUNK", 4)
    rows = [(i % 3 if i % 2 else None, f"r{i % 150}") for i in range(400)] + [(2**60 + i, "big") for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, html string")

    def recs(d):
        return merkle.records(d, F.col("page_id"), merkle.warc_record(F.lit("u"), F.col("html")),
                              merkle.archives_by_id(F.col("page_id"), 64))
    placed = [(r.archive, r.n, r.record_id, r.offset, r.length, r.digest) for r in recs(df).collect()]
    want, at = [], collections.Counter()
    for r in sorted(placed, key=lambda r: (r[0] is not None, r[0] or 0, r[2] is not None, r[2] or 0, r[5])):
        want.append((r[0], at[r[0], "n"], r[2], at[r[0], "offset"], r[4], r[5]))
        at[r[0], "n"] += 1
        at[r[0], "offset"] += r[4]
    assert sorted(map(str, placed)) == sorted(map(str, want)) and len(placed) == len(rows)
    assert {r[0] for r in placed if r[2] and r[2] > 9} == {2**54}
    worse = spark.createDataFrame([(i, "x" + h if n in (0, 7, 9) else h) for n, (i, h) in enumerate(rows) if n != 20],
                                  "page_id long, html string")
    got = collections.Counter((r.record_id, r.status) for r in merkle.fixity_audit(recs(df), recs(worse), fanout=4).collect())
    assert got == {(None, "corrupt"): 1, (None, "missing"): 1, (1, "corrupt"): 1, (0, "corrupt"): 1}
    assert merkle.fixity_audit(recs(df), recs(df.repartition(5)), fanout=4).count() == 0


def test_hpylm(docs, none):
    held = langid.held_out(F.col("doc_id"), part=1)
    for buckets in (2, 24):  # with 24 the commonest contexts are dealt over buckets
        got = {r.doc_id: r for r in hpylm.score(docs, "doc_id", "text", held, buckets).collect()}
        rows = docs.collect()
        counts = collections.Counter()
        for r in rows:
            if zlib.crc32(str("" if r.doc_id is None else r.doc_id).encode()) % 5 != 1:
                counts.update([*words(r.text), None])
        n, v = sum(counts.values()), len(counts)
        for r in rows:
            tokens = [*words(r.text), None]
            g = got[r.doc_id]
            assert (g.n_tokens, g.n_known, g.train_tokens) == (len(tokens), sum(counts[t] > 0 for t in tokens), n)
            assert math.isclose(g.base_score, sum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens), rel_tol=1e-9)
            assert g.score < 0
        trained = [g for g in got.values() if not g.held_out]
        assert sum(g.score for g in trained) > sum(g.base_score for g in trained)
    again = {r.doc_id: r.score for r in hpylm.score(docs.repartition(2), "doc_id", "text", held, 24).collect()}
    assert all(math.isclose(again[i], got[i].score, rel_tol=1e-9) for i in got)
    assert hpylm.score(none, "doc_id", "text", held, 4).count() == 0


def test_hpylm_deals_one_bucket_to_a_task(docs):
    plan = hpylm.score(docs, "doc_id", "text", F.lit(False), 5)._jdf.queryExecution().executedPlan().toString()
    for key in ("bucket", "owner"):
        assert f"direct_shuffle_partition_id({key}" in plan and f"hashpartitioning({key}" not in plan


def test_hpylm_tells_words_apart_by_all_bits():
    # equal in the lower 40 bits
    w = np.array([7, 7 | 1 << 45, 7, 9, 7 | 1 << 63, *range(100, 100 + (1 << 16)), 7 | 1 << 45], dtype=np.uint64)
    for tokens in (w[:5], w):  # indices of 16 and of 32 bits
        types = [(x, pa.binary()) for x in ("u", "run", "words", "word", "doc")]
        rows = [(np.array([3], np.uint32).tobytes(), np.array([len(t)], np.uint32).tobytes(), *hpylm._coded(t),
                 np.zeros(len(t), np.uint16).tobytes()) for t in (tokens, tokens[:2])]
        b = hpylm.Bucket(hpylm._table(rows, types), np.zeros(0, np.uint64), 0, 1)
        want = collections.Counter([*tokens.tolist(), *tokens[:2].tolist()])
        assert dict(zip(b.words.tolist(), b.word_count.tolist())) == want


def test_hpylm_draws_tables_from_their_posterior():
    """Against the sum over all seatings, customer by customer."""
    theta, d = hpylm.THETA, hpylm.DISCOUNT
    for c, others, parent in ((2, 0, 0.5), (5, 3, 0.2), (9, 40, 0.01), (64, 7, 0.3)):
        weight = {1: (theta + d * others) * parent}
        for i in range(1, c):
            new = collections.Counter()
            for t, w in weight.items():
                new[t] += w * (i - d * t)
                new[t + 1] += w * (theta + d * (others + t)) * parent
            weight = new
        n = 40_000
        got = np.bincount(hpylm.draw_tables(np.full(n, c), np.full(n, others), np.full(n, parent), d, np.random.default_rng(c)))
        for t, w in weight.items():
            p = w / sum(weight.values())
            assert abs(got[t] / n - p if t < len(got) else p) < 5 * math.sqrt(p / n) + 1e-3
    # beyond the exact part tables go on growing
    few, many = (hpylm.draw_tables(np.full(500, c), np.full(500, 10), np.full(500, 0.2), d, np.random.default_rng(0)) for c in (64, 6400))
    assert 5 < many.mean() / few.mean() < 100 ** d


def plain_gibbs(train, texts, sweeps=150):
    """Average log10 probabilities under a sampler that seats one customer at
    a time, in every context and at the root."""
    r = random.Random(2)
    theta, d, e = hpylm.THETA, hpylm.DISCOUNT, hpylm.ROOT_DISCOUNT
    known = {w for t in train for w in t}
    seats = collections.defaultdict(list)  # (context, word) -> sizes of tables
    rooms, root, total = collections.Counter(), collections.defaultdict(list), collections.Counter()

    def at_root(w):
        own = max(sum(root[w]) - e * len(root[w]), 0.0)
        return (own + (theta + e * total["tables"]) / (len(known) + 1)) / (theta + total["customers"])

    def enter(tables, d, new, room):
        weights = [n - d for n in tables] + [new]
        i = r.choices(range(len(weights)), weights)[0]
        if i < len(tables):
            tables[i] += 1
            return False
        tables.append(1)
        return True

    def leave(tables):
        i = r.choices(range(len(tables)), tables)[0]
        tables[i] -= 1
        if not tables[i]:
            del tables[i]
            return True
        return False

    def sit(u, w):
        if enter(seats[u, w], d, (theta + d * rooms[u]) * at_root(w), u):
            rooms[u] += 1
            total["tables"] += enter(root[w], e, (theta + e * total["tables"]) / (len(known) + 1), None)
            total["customers"] += 1

    def rise(u, w):
        if leave(seats[u, w]):
            rooms[u] -= 1
            total["tables"] -= leave(root[w])
            total["customers"] -= 1
    tokens = [(u, w) for t in train for u, w in zip([None, *t], t)]
    customers = collections.Counter(u for u, _ in tokens)
    for x in tokens:
        sit(*x)
    sums = [[0.0] * len(t) for t in texts]
    for sweep in range(sweeps):
        for x in tokens:
            rise(*x)
            sit(*x)
        if sweep >= 30:
            for s, t in zip(sums, texts):
                for i, (u, w) in enumerate(zip([None, *t], t)):
                    own = max(sum(seats[u, w]) - d * len(seats[u, w]), 0.0) if (u, w) in seats else 0.0
                    s[i] += (own + (theta + d * rooms[u]) * at_root(w)) / (theta + customers[u]) / (sweeps - 30)
    return [sum(math.log10(p) for p in s) for s in sums]


def test_hpylm_agrees_with_a_plain_sampler(spark):
    r = random.Random(7)
    texts = [" ".join(r.choice(["aa", "bb", "cc dd", "cc ee", "ff gg hh", "ii"] + [f"w{i}" for i in range(r.randint(1, 30))])
                      for _ in range(25)) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokens = [[*t.split(), "</s>"] for t in texts]
    want = plain_gibbs([t for i, t in enumerate(tokens) if i % 3], tokens)
    size = [len(t) for t in tokens]
    for buckets in (1, 8):
        got = {x.doc_id: x.score for x in hpylm.score(df, "doc_id", "text", F.col("doc_id") % 3 == 0, buckets).collect()}
        apart = [abs(got[i] - w) / n for i, (w, n) in enumerate(zip(want, size))]
        assert sum(apart) / len(apart) < 0.02 and max(apart) < 0.08, (buckets, sum(apart) / len(apart), max(apart))


def test_hpylm_scores_hardly_change_with_the_buckets(docs):
    held = langid.held_out(F.col("doc_id"), part=1)
    few, many = ({r.doc_id: r for r in hpylm.score(docs, "doc_id", "text", held, b).collect()} for b in (2, 24))
    apart = [abs(few[i].score - many[i].score) / few[i].n_tokens for i in few]
    assert sum(apart) / len(apart) < 0.02


def test_cotraining(spark, docs, none):
    rows = [(i, prose(30) if i % 4 else "### " + " !!! ".join(prose(20).split()), "en", "good" if i % 4 else "bad", 100) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(0, 400, 3)] + [(None, 1, 0), (1, None, 0)],
                                   "doc_id long, quality int, toxic int")
    out = cotrain.classify(df, labels).collect()
    assert np.mean([r.keep == bool(r.doc_id % 4) for r in out]) > 0.98
    assert cotrain.classify(none, labels).count() == 0
    got = cotrain.classify(docs, labels.limit(0)).collect()
    assert len(got) == docs.count() and all(r.score == 1.0 and r.keep for r in got)
    assert len(cotrain.classify(docs, labels).collect()) == docs.count()


def test_cotraining_learns_from_all_unlabelled(spark):
    """More documents than a pool of 8,000 would hold, and a labelled id with many rows."""
    def text(n):
        bad, good = F.lit("### !!! ### !!!"), F.lit("plain words of a page")
        return F.concat(F.when(n % 4 == 0, bad).otherwise(good), F.lit(" "), n.cast("string"))
    i = F.col("id")
    many = spark.range(12000).select(i.alias("doc_id"), text(i).alias("text"), F.lit("en").alias("lang"),
                                     F.when(i % 4 == 0, "bad").otherwise("good").alias("source"), F.lit(20).cast("long").alias("n_chars"))
    df = many.unionByName(many.filter("doc_id = 8").withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(500)))).drop("copy"))
    labels = many.filter("doc_id < 400").select("doc_id", (F.col("doc_id") % 4 > 0).cast("int").alias("quality"))
    model = cotrain.train(df, labels)
    assert model.labelled == 400 and min(model.taken) > 11000
    wrong = cotrain.classify(df, labels).filter(F.col("keep") != (F.col("doc_id") % 4 > 0))
    assert wrong.count() == 0


def test_cotraining_exchanges_both_ways(spark):
    """Text and source each tell quality apart with errors of their own, by
    more words and sources than the labels show well: both views are taught,
    and do better on documents without labels than from the labels alone."""
    r = random.Random(4)
    rows = []
    for i in range(6000):
        good = r.random() < 0.6
        by_text, by_source = (good if r.random() < 0.9 else not good for _ in range(2))
        text = " ".join(f"{'good' if by_text else 'bad'}{r.randint(0, 120)}" if r.random() < 0.3 else f"w{r.randint(0, 200)}"
                        for _ in range(8))
        rows.append((i, text, "en", f"s{r.randint(0, 29) + 30 * by_source}", 100, int(good)))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, quality int")
    labels = df.filter("doc_id < 250").select("doc_id", "quality")
    model = cotrain.train(df.drop("quality"), labels)
    assert min(model.taken) > 500  # handed over in both directions
    out = cotrain.classify(df.drop("quality"), labels).join(df.select("doc_id", "quality"), "doc_id").filter("doc_id >= 250").collect()
    alone = cotrain.classify(df.drop("quality"), labels, rounds=0).join(df.select("doc_id", "quality"), "doc_id").filter("doc_id >= 250").collect()

    def auc(found, name):
        order = sorted(found, key=lambda x: x[name])
        good = [n for n, x in enumerate(order) if x.quality]
        return (sum(good) - len(good) * (len(good) - 1) / 2) / (len(good) * (len(order) - len(good)))
    for name, gain in (("p_content", 0.05), ("p_metadata", 0), ("score", 0)):
        assert auc(out, name) > auc(alone, name) + gain
    assert auc(out, "score") > max(auc(out, "p_content"), auc(out, "p_metadata"))
