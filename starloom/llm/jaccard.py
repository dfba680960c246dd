"""N-gram Jaccard join by multiple-global-order filtering.

Documents are sets of distinct 5-word shingles (64-bit hashes); two link when
their Jaccard similarity reaches ``percent``. The join is exact:

1. Equal sets form one class, so copies are never paired with each other.
2. A set of size n needs ceil(percent * n) shingles that another class has
   too. Shingles travel once, as binary blocks of hash ranges, and classes
   with too few shared shingles are out. The blocks carry 32 bits besides
   the range; a collision can only keep a class that could have gone.
3. For the rest, document frequencies give several total orders of all
   shingles (by frequency with two different tie breaks, and by frequency
   class with a third). In each order a linked pair must share one of its
   first n - ceil(percent * n) + 1 shingles. A pair is a candidate only if it
   does so in every order; only then are the sets compared.
4. Pairs that already are in one component need no comparison. First every
   class is compared with one hub per prefix shingle (linear in the
   postings); what still stands in different components and shares a prefix
   shingle is compared block against block (blocks of about ``BLOCK``
   classes, placed by their hub), inside tasks and without listing pairs.
5. Components come from alternating large-star and small-star steps over the
   links, as joins and aggregations.
6. Every link lies inside a component. ``join_links`` and the number of links
   of a document compare all classes of a component with each other, block
   against block, by the prefixes of every order and then the sets; plain
   components (``keep_one``) need no such step.

Nothing is collected but counts. A shingle or class that a third of the rows
have is aggregated before it is shuffled or met through its hub.

Defined cases: a text with fewer than 5 words is one shingle; without words,
or null, it has the empty set and links with nothing; a row with a null id
has a null component and takes part only as an equal of others; repeated
rows, and rows that share an id, are classes by their texts; extra columns
are ignored; empty table, empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from starloom.session import stored

from .textops import Words, mix, packed, release, slices, unpacked

SHINGLE = 5
PERCENT = 80
BLOCK = 512  # classes of a block
TOKENS_PER_BUCKET = 2_000_000
ORDERS = 3
BROADCAST_ROWS = 1_000_000  # ids; 8 MB
FEW_FILES = 32  # of a small step, or two for each core

_U = np.uint64


def needed(n, percent: int):
    """Fewest shared shingles with which a set of size n can link."""
    return -(-n * percent // 100)


def _sets(column: pa.Array, k: int):
    """Shingles, pointer and class key (a hash of the set) per document."""
    tokens, ptr = Words(column).shingles(k)
    n = np.diff(ptr)
    with np.errstate(over="ignore"):
        run = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(mix(tokens ^ _U(0x5851F42D4C957F2D)))))
        key = mix((run[ptr[1:]] - run[ptr[:-1]]) + n.astype(np.uint64))
    return tokens, ptr, n, key


def _few(df: DataFrame) -> DataFrame:
    """``df``, behind a shuffle, in few files: where permissions are set by a
    process of their own, every file costs its writer one."""
    return df.coalesce(max(FEW_FILES, 2 * df.sparkSession.sparkContext.defaultParallelism))


def shingle_sets(docs: DataFrame, id_col: str, text_col: str, k: int = SHINGLE) -> DataFrame:
    """doc_id, n (set size), c (class key, null for the empty set)."""
    def run(batches):
        for part in slices(batches, "text"):
            _, _, n, key = _sets(part.column(1), k)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(n.astype(np.int64)), pa.array(key.view(np.int64), mask=n == 0)],
                names=["doc_id", "n", "c"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        run, "doc_id long, n long, c long")


def _bucket(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(keys, np.arange(buckets + 1))


def _rows(names: dict, rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, names.values())], names=list(names))


def _spread(owner: np.ndarray, bucket: np.ndarray, buckets: int, arrays: list[np.ndarray], owners: np.ndarray) -> list:
    """Cut token arrays into one row per bucket: (bucket, owners present,
    tokens per owner, *arrays). ``owner`` ascends within a bucket."""
    order = np.argsort(bucket, kind="stable")
    ends = _cut(bucket[order], buckets)
    rows = []
    for b in np.flatnonzero(ends[1:] > ends[:-1]):
        pick = order[ends[b]:ends[b + 1]]
        who, count = np.unique(owner[pick], return_counts=True)
        rows.append((int(b), owners[who].tobytes(), count.astype(np.uint32).tobytes(),
                     *(a[pick].tobytes() for a in arrays)))
    return rows


def _gather(batches, types: list):
    """Concatenate the arrays of all rows: owners, counts and further ones."""
    parts = [[] for _ in types]
    for b in batches:
        for i, t in enumerate(types):
            parts[i] += [np.frombuffer(x.as_buffer(), dtype=t) for x in b.column(i + 1)]
    return [np.concatenate(p) if p else np.zeros(0, dtype=t) for p, t in zip(parts, types)]


def shared_counts(docs: DataFrame, buckets: int, k: int, text_col: str) -> DataFrame:
    """c, shared: how many of a class's shingles another class has too (an
    upper bound, by hash collisions within a bucket)."""
    def send(batches):
        for part in slices(batches, "text"):
            tokens, ptr, n, key = _sets(part.column(0), k)
            # one entry per class and slice
            first = np.zeros(len(key), dtype=bool)
            first[np.unique(key, return_index=True)[1]] = True
            use = np.repeat(first, n)
            owner = np.repeat(np.arange(len(n)), n)[use]
            t = tokens[use]
            rows = _spread(owner, _bucket(t, buckets), buckets, [t.astype(np.uint32)], key)
            yield _rows({"bucket": pa.int32(), "c": pa.binary(), "count": pa.binary(), "t": pa.binary()}, rows)

    def count(batches):
        c, counts, t = _gather(batches, [np.uint64, np.uint32, np.uint32])
        if not len(t):
            return
        c = np.repeat(c, counts)
        order = np.argsort(t, kind="stable")
        c, t = c[order], t[order]
        starts = np.flatnonzero(np.concatenate(([True], t[1:] != t[:-1])))
        several = np.minimum.reduceat(c, starts) != np.maximum.reduceat(c, starts)
        mask = np.repeat(several, np.diff(np.append(starts, len(t))))
        c, t = c[mask], t[mask]
        order = np.lexsort((t, c))
        c, t = c[order], t[order]
        new = np.concatenate(([True], (c[1:] != c[:-1]) | (t[1:] != t[:-1])))[:len(c)]
        who, n = np.unique(c[new], return_counts=True)
        to = _bucket(mix(who), buckets)
        rows = _spread(np.arange(len(who)), to, buckets, [n.astype(np.uint32)], who)
        del c, t, order, mask, new, starts, several
        release()
        yield _rows({"bucket": pa.int32(), "c": pa.binary(), "count": pa.binary(), "t": pa.binary()}, rows)

    def total(batches):
        c, _, n = _gather(batches, [np.uint64, np.uint32, np.uint32])
        who, inverse = np.unique(c, return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(who.view(np.int64)), pa.array(np.bincount(inverse, weights=n, minlength=len(who)).astype(np.int64))],
            names=["c", "shared"])

    block = "bucket int, c binary, count binary, t binary"
    sent = docs.select(F.col(text_col).alias("text")).mapInArrow(send, block)
    per = sent.repartitionById(buckets, F.col("bucket")).mapInArrow(count, block)
    return per.repartitionById(buckets, F.col("bucket")).mapInArrow(total, "c long, shared long")


def profiles(docs: DataFrame, buckets: int, k: int, percent: int) -> DataFrame:
    """For the surviving classes (rows text, c, n of one document each):
    slice (of the classes), c, n, tokens (shared ones, sorted), pre0.. (prefix
    in every order)."""
    def send(batches):
        for part in slices(batches, "text"):
            tokens, ptr, n, key = _sets(part.column(0), k)
            want = part.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            use = np.repeat(key == want, n)
            owner = np.repeat(np.arange(len(n)), n)[use]
            t = tokens[use]
            who = np.stack([key, n.astype(np.uint64)], axis=1)
            rows = _spread(owner, _bucket(t, buckets), buckets, [t], who)
            yield _rows({"bucket": pa.int32(), "c": pa.binary(), "count": pa.binary(), "t": pa.binary()}, rows)

    def frequency(batches):
        c, counts, t = _gather(batches, [np.uint64, np.uint32, np.uint64])
        if not len(t):
            return
        who = c.reshape(-1, 2)
        owner = np.repeat(np.arange(len(who)), counts)
        _, inverse, df = np.unique(t, return_inverse=True, return_counts=True)
        df = df[inverse]
        keep = df > 1
        owner, t, df = owner[keep], t[keep], df[keep].astype(np.uint32)
        to = _bucket(mix(who[:, 0]), buckets)[owner]
        rows = _spread(owner, to, buckets, [t, df], who)
        yield _rows({"bucket": pa.int32(), "c": pa.binary(), "count": pa.binary(), "t": pa.binary(),
                     "df": pa.binary()}, rows)

    names = {"slice": pa.int64(), "c": pa.int64(), "n": pa.int64(), "tokens": pa.binary(), **{f"pre{i}": pa.binary() for i in range(ORDERS)}}

    def profile(batches):
        who, counts, t, df = _gather(batches, [np.uint64, np.uint32, np.uint64, np.uint32])
        if not len(t):
            return
        who = np.repeat(who.reshape(-1, 2), counts, axis=0)
        order = np.lexsort((t, who[:, 0]))
        who, t, df = who[order], t[order], df[order].astype(np.int64)
        # a repeated row sends its shingles twice
        new = np.concatenate(([True], (who[1:, 0] != who[:-1, 0]) | (t[1:] != t[:-1])))
        who, t, df = who[new], t[new], df[new]
        starts = np.flatnonzero(np.concatenate(([True], who[1:, 0] != who[:-1, 0])))
        ties = [mix(t ^ mix(np.array([i + 1], dtype=np.uint64))) for i in range(ORDERS)]
        ranks = [df, df, np.floor(np.log2(df))]
        rows = []
        places = _bucket(mix(who[starts, 0]), buckets)
        for a, b, place in zip(starts, np.append(starts[1:], len(t)), places):
            n = int(who[a, 1])
            need = needed(n, percent)
            room = n - need + 1 - (n - (b - a))  # unshared shingles come first in every order
            if b - a < need or room <= 0:
                continue
            own = t[a:b]
            pre = [np.sort(own[np.lexsort((tie[a:b], rank[a:b]))[:room]]).tobytes() for tie, rank in zip(ties, ranks)]
            rows.append((int(place), int(who[a, 0].view(np.int64)), n, own.tobytes(), *pre))
            if len(rows) >= 512:
                yield _rows(names, rows)
                rows = []
        if rows:
            yield _rows(names, rows)
        del who, t, df, ties, ranks, order, new
        release()

    binary = "bucket int, c binary, count binary, t binary"
    sent = docs.select("text", "c").mapInArrow(send, binary)
    counted = sent.repartitionById(buckets, F.col("bucket")).mapInArrow(frequency, binary + ", df binary")
    schema = "slice long, c long, n long, tokens binary, " + ", ".join(f"pre{i} binary" for i in range(ORDERS))
    return counted.repartitionById(buckets, F.col("bucket")).mapInArrow(profile, schema)


def _least(owner: np.ndarray, t: np.ndarray, hub: np.ndarray, x: np.ndarray, hi: np.ndarray, lo_x: np.ndarray,
           hi_x: np.ndarray):
    """Per (owner, t): smallest class and its x, largest class, range of x."""
    order = np.lexsort((hub, t, owner))
    owner, t = owner[order], t[order]
    at = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (owner[1:] != owner[:-1]))))
    first = order[at]
    return (owner[at], t[at], hub[first], x[first], np.maximum.reduceat(hi[order], at),
            np.minimum.reduceat(lo_x[order], at), np.maximum.reduceat(hi_x[order], at), order, at)


def _postings(column) -> tuple[np.ndarray, np.ndarray]:
    pre = [np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in column]
    return np.concatenate(pre) if pre else np.zeros(0, dtype=np.uint64), np.array([len(v) for v in pre], dtype=np.int64)


def meet(rows: DataFrame, buckets: int, apart: str, finish, schema: str) -> DataFrame:
    """``rows``: slice, c, x, pre0. Every prefix shingle of the first order
    meets its hub, the smallest class that has it, if the classes (``apart``
    = "c") or the x (``apart`` = "x") that have it differ. The postings stay
    in their slice: a batch asks with one entry per shingle, so a shingle that
    a third of the classes have costs its task one entry per batch.
    ``finish`` turns the arrays t, c, x, hub, x of the hub into a table."""
    arrays = ("t", "hub", "x", "hi", "lo_x", "hi_x")

    def ask(batches):
        for b in batches:
            t, size = _postings(b.column(3))
            if not len(t):
                continue
            owner, c, x = (np.repeat(b.column(i).to_numpy().astype(np.int64), size) for i in range(3))
            owner, *entry = _least(owner, t, c, x, c, x, x)[:7]
            names, owner = np.unique(owner, return_inverse=True)
            sent = _spread(owner, _bucket(entry[0], buckets), buckets, entry, names)
            yield _rows({"bucket": pa.int32(), **dict.fromkeys(("slice", "count", *arrays), pa.binary())}, sent)

    def answer(batches):
        owner, counts, t, *entry = _gather(batches, [np.int64, np.uint32, np.uint64] + [np.int64] * 5)
        if not len(t):
            return
        owner = np.repeat(owner, counts)
        _, _, hub, x, hi, lo_x, hi_x, order, at = _least(np.zeros(len(t), dtype=np.int64), t, *entry)
        alive = hub < hi if apart == "c" else lo_x < hi_x
        of = np.empty(len(t), dtype=np.int64)
        of[order] = np.repeat(np.arange(len(at)), np.diff(np.append(at, len(t))))
        back = np.flatnonzero(alive[of])
        back = back[np.argsort(owner[back], kind="stable")]
        cut = np.flatnonzero(np.diff(owner[back])) + 1
        rows = [(int(owner[p[0]]), t[p].tobytes(), hub[of[p]].tobytes(), x[of[p]].tobytes())
                for p in np.split(back, cut) if len(p)]
        yield _rows({"slice": pa.int64(), "t": pa.binary(), "hub": pa.binary(), "x": pa.binary()}, rows)

    def match(left: pa.Table, right: pa.Table) -> pa.Table:
        t, size = _postings(v for chunk in left.column("pre0").chunks for v in chunk)
        c, x = (np.repeat(left.column(name).to_numpy(), size) for name in ("c", "x"))
        known, hub, hub_x = (np.concatenate([np.zeros(0, dtype=kind)] + [
            np.frombuffer(v.as_buffer(), dtype=kind) for chunk in right.column(name).chunks for v in chunk])
            for name, kind in (("t", np.uint64), ("hub", np.int64), ("x", np.int64)))
        known, first = np.unique(known, return_index=True)
        hit = np.isin(t, known)
        t, c, x = t[hit], c[hit], x[hit]
        to = first[np.searchsorted(known, t)]
        return finish(t, c, x, hub[to], hub_x[to])

    rows = rows.select("slice", "c", "x", "pre0")
    asked = rows.mapInArrow(ask, "bucket int, slice binary, count binary, " + ", ".join(f"{a} binary" for a in arrays))
    answers = asked.repartitionById(buckets, F.col("bucket")).mapInArrow(answer, "slice long, t binary, hub binary, x binary")
    return rows.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(match, schema)


def hub_pairs(profile: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Distinct candidate pairs (a, b): a class and the hub of one of its
    prefix shingles, of sizes that can link."""
    def finish(t, c, n, hub, hub_n):
        near = (c != hub) & (np.minimum(n, hub_n) * 100 >= np.maximum(n, hub_n) * percent)
        pairs = np.unique(np.stack([hub[near], c[near]], axis=1), axis=0)
        return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})

    return meet(profile.withColumnRenamed("n", "x"), buckets, "c", finish, "a long, b long")


def split_postings(profile: DataFrame, roots: DataFrame, buckets: int) -> DataFrame:
    """t, c, root, hub: postings of shingles that classes of different
    components have."""
    def finish(t, c, root, hub, _):
        return pa.table({"t": t.view(np.int64), "c": c, "root": root, "hub": hub})

    rooted = _with_root(profile.select("slice", "c", "pre0"), roots).withColumnRenamed("root", "x")
    return meet(rooted, buckets, "x", finish, "t long, c long, root long, hub long")


def _meets(a: np.ndarray, b: np.ndarray) -> int:
    both = np.concatenate([a, b])
    both.sort()
    return int((both[1:] == both[:-1]).sum())


def _linked(n1: int, n2: int, a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    shared = _meets(a, b)
    return 100 * shared >= percent * (n1 + n2 - shared)


def verify_pairs(pairs: DataFrame, profile: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among candidate pairs (a, b): the filter of every order,
    then the sets."""
    def side(p: str) -> DataFrame:
        return profile.select(*[F.col(c).alias(p if c == "c" else f"{p}_{c}") for c in profile.columns])

    def run(batches):
        for b in (whole.slice(at, 256) for whole in batches for at in range(0, whole.num_rows, 256)):
            rows = []
            for r in b.to_pylist():
                if all(_meets(np.frombuffer(r[f"a_pre{i}"], np.uint64), np.frombuffer(r[f"b_pre{i}"], np.uint64))
                       for i in range(ORDERS)) and \
                        _linked(r["a_n"], r["b_n"], np.frombuffer(r["a_tokens"], np.uint64),
                                np.frombuffer(r["b_tokens"], np.uint64), percent):
                    rows.append((r["a"], r["b"]))
            yield _rows({"a": pa.int64(), "b": pa.int64()}, rows)

    return pairs.join(side("a"), "a").join(side("b"), "b").mapInArrow(run, "a long, b long")


def _unfinished(edges: DataFrame) -> int:
    """Nodes that keep the edges (a > b) from being stars, that is with two
    smaller neighbours, or with a smaller and a larger one."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("a").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("b").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    node = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return node.filter("up > 1 OR (up > 0 AND down > 0)").count()


def components(links: DataFrame) -> DataFrame:
    """c, root (smallest c of the component) of every node with a link."""
    edges = (links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
             .distinct())
    edges = stored(_few(edges), "edges")
    # a step moves every node to a smaller neighbour, so the steps end with
    # stars, which need no further step to tell
    while _unfinished(edges):
        # large star: larger neighbours of u go to the smallest around u
        around = edges.select(F.inline(F.array(
            F.struct(F.col("a").alias("u"), F.col("b").alias("v")), F.struct(F.col("b").alias("u"), F.col("a").alias("v")))))
        low = around.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = edges.select(F.col("b").alias("u"), F.col("a").alias("v")).join(low, "u").select(
            F.col("v").alias("a"), F.col("m").alias("b"))
        # small star: u and its smaller neighbours go to the smallest of them
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.inline(F.array(
            F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct(F.col("a"), F.col("m").alias("b")))))
        edges = stored(_few(small.filter("a <> b").distinct()), "edges")
    return edges.select(F.col("a").alias("c"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("c"), F.col("b").alias("root")).distinct())


def _with_root(df: DataFrame, roots: DataFrame) -> DataFrame:
    return df.join(roots, "c", "left").withColumn("root", F.coalesce("root", "c"))


def compare_blocks(profile: DataFrame, roots: DataFrame, buckets: int, percent: int) -> DataFrame:
    """Links between classes of different components that share a prefix
    shingle: block against block."""
    own = stored(split_postings(profile, roots, buckets), "postings")
    # a class lies with the smallest hub it met; large components apart
    place = own.groupBy("c", "root").agg(F.min("hub").alias("hub"))
    size = place.groupBy("hub", "root").agg(F.count(F.lit(1)).alias("members"))
    place = place.join(size, ["hub", "root"])
    big = F.col("members") > BLOCK // 4
    place = place.withColumn("family", F.when(big, F.col("root"))).withColumn("one", big)
    family = place.groupBy("hub", "family").agg(F.count(F.lit(1)).alias("total"))
    family = family.withColumnRenamed("hub", "h").withColumnRenamed("family", "f")
    place = place.join(family, (F.col("hub") == F.col("h")) & F.col("family").eqNullSafe(F.col("f")))
    part = F.pmod(F.xxhash64(F.when(F.col("one"), F.col("c")).otherwise(F.col("root"))),
                  F.ceil(F.col("total") / BLOCK))
    place = place.select("c", "root", F.xxhash64("hub", F.coalesce("family", F.lit(0)), F.col("one"), part).alias("block"))
    place = stored(place, "places")
    # blocks that share a shingle and are not of one component there
    met = (own.select("t", "c").join(place, "c").groupBy("t", "block")
           .agg(F.min("root").alias("lo"), F.max("root").alias("hi")))
    other = met.select("t", *[F.col(x).alias(f"{x}2") for x in ("block", "lo", "hi")])
    cells = stored(met.join(other, "t").filter("block <= block2 AND NOT (lo = hi AND lo2 = hi2 AND lo = lo2)")
                   .select("block", "block2").distinct(), "cells")
    left = cells.join(place, "block").select("block", "block2", "c", "root", F.lit(0).alias("side"))
    right = (cells.filter("block <> block2").join(place.withColumnRenamed("block", "own"), F.col("block2") == F.col("own"))
             .select("block", "block2", "c", "root", F.lit(1).alias("side")))
    dealt = left.unionByName(right).join(profile, "c")

    def compare(table: pa.Table) -> pa.Table:
        return pa.table(dict(zip(("a", "b"), _block_links(table, percent))), schema=pa.schema(
            [("a", pa.int64()), ("b", pa.int64())]))

    return dealt.groupBy("block", "block2").applyInArrow(compare, "a long, b long")


def _block_links(table: pa.Table, percent: int, within: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Links between classes of different components, or ``within`` one."""
    side = table.column("side").to_numpy()
    c, root, n = (table.column(x).to_numpy() for x in ("c", "root", "n"))

    def lists(name):
        return [np.frombuffer(x.as_buffer(), dtype=np.uint64) for chunk in table.column(name).chunks for x in chunk]

    mine = np.flatnonzero(side == 0)
    alone = not (side == 1).any()
    theirs = mine if alone else np.flatnonzero(side == 1)
    hope = (root[mine][:, None] == root[theirs][None]) == within
    if alone:
        hope &= c[mine][:, None] < c[theirs][None]
    lo, hi = np.minimum(n[mine][:, None], n[theirs][None]), np.maximum(n[mine][:, None], n[theirs][None])
    hope &= 100 * lo >= percent * hi
    for i in range(ORDERS):
        if not hope.any():
            break
        pre = lists(f"pre{i}")
        meets = np.zeros_like(hope)
        tokens = [np.concatenate([pre[j] for j in group]) for group in (mine, theirs)]
        owner = [np.repeat(np.arange(len(g)), [len(pre[j]) for j in g]) for g in (mine, theirs)]
        order = [np.argsort(t, kind="stable") for t in tokens]
        tokens, owner = [t[o] for t, o in zip(tokens, order)], [w[o] for w, o in zip(owner, order)]
        for x in np.intersect1d(*tokens):
            a, b = (w[np.searchsorted(t, x):np.searchsorted(t, x, side="right")] for w, t in zip(owner, tokens))
            meets[np.ix_(a, b)] = True
        hope &= meets
    out_a, out_b = [], []
    if hope.any():
        sets = lists("tokens")
        for i in np.flatnonzero(hope.any(1)):
            js = np.flatnonzero(hope[i])
            base = sets[mine[i]]
            flat = np.concatenate([sets[theirs[j]] for j in js])
            ptr = np.concatenate(([0], np.cumsum([len(sets[theirs[j]]) for j in js])))
            at = np.minimum(np.searchsorted(base, flat), len(base) - 1)
            shared = np.add.reduceat((base[at] == flat).astype(np.int64), ptr[:-1])
            good = 100 * shared >= percent * (n[mine[i]] + n[theirs[js]] - shared)
            out_a += [c[mine[i]]] * int(good.sum())
            out_b += c[theirs[js[good]]].tolist()
    return np.array(out_a, dtype=np.int64), np.array(out_b, dtype=np.int64)


def links_within(profile: DataFrame, roots: DataFrame, percent: int, counts: bool = False) -> DataFrame:
    """All links (a, b) between classes; with ``counts`` c, n instead: links
    of a class, one row per class and cell. A component larger than ``BLOCK``
    has blocks of its own, which all meet each other; smaller ones share."""
    size = roots.groupBy("root").agg(F.count(F.lit(1)).alias("members"))
    shared = max(1, -(-roots.count() // BLOCK))
    big = F.col("members") > BLOCK
    place = roots.join(size, "root").select(
        "c", "root", F.when(big, F.col("root")).alias("family"),
        F.when(big, F.ceil(F.col("members") / BLOCK)).otherwise(1).cast("long").alias("parts"),
        F.when(big, F.pmod(F.xxhash64("c"), F.ceil(F.col("members") / BLOCK)))
        .otherwise(F.pmod(F.xxhash64("root"), F.lit(shared))).cast("long").alias("part"))
    other = F.when(F.col("family").isNotNull(), F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).otherwise(F.array("part"))
    dealt = place.withColumn("other", F.explode(other)).select(
        "c", "root", "family", F.least("part", "other").alias("block"), F.greatest("part", "other").alias("block2"),
        F.when(F.col("part") <= F.col("other"), 0).otherwise(1).alias("side")).join(profile, "c")

    def compare(table: pa.Table) -> pa.Table:
        a, b = _block_links(table, percent, within=True)
        if counts:
            a, b = np.unique(np.concatenate([a, b]), return_counts=True)
        return pa.table({"c" if counts else "a": a, "n" if counts else "b": b.astype(np.int64)})

    return dealt.groupBy("family", "block", "block2").applyInArrow(compare, "c long, n long" if counts else "a long, b long")


def _joined(docs: DataFrame, id_col: str, text_col: str, k: int,
            percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Documents' sets, classes, profiles, and c, root of the classes with links."""
    spark = docs.sparkSession
    # a step is computed once (an eager checkpoint runs twice)
    sig = stored(_few(shingle_sets(docs, id_col, text_col, k).hint("rebalance")), "sets")
    classes = stored(sig.filter("n > 0").groupBy("c", "n").agg(F.min("doc_id").alias("rep")), "classes")
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // TOKENS_PER_BUCKET))
    shared = shared_counts(docs, buckets, k, text_col)
    able = stored(classes.filter("rep IS NOT NULL").join(shared, "c")
                  .filter(F.col("shared") * 100 >= F.col("n") * percent).select("c", "n", "rep"), "able")
    reps = able.select("rep", "c")
    n_able = able.count()
    reps = F.broadcast(reps) if n_able <= BROADCAST_ROWS else reps.hint("merge")
    base = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    profile = stored(_few(profiles(base.join(reps, "rep"), buckets, k, percent).hint("rebalance", "slice")), "profiles")
    links = stored(verify_pairs(hub_pairs(profile, buckets, percent), profile, percent), "links")
    roots = stored(_few(components(links)), "roots")
    more = stored(compare_blocks(profile, roots, buckets, percent), "links")
    star = roots.filter("c <> root").select(F.col("c").alias("a"), F.col("root").alias("b"))
    return sig, classes, profile, stored(_few(components(star.unionByName(more))), "roots")


def _named(sig: DataFrame, classes: DataFrame, roots: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id."""
    labelled = _with_root(classes, roots)
    ids = labelled.groupBy("root").agg(F.min("rep").alias("component_id"))
    named = labelled.select("c", "root").join(ids, "root").select("c", "component_id")
    return (sig.join(named, "c", "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("doc_id").isNull(), None)
                    .otherwise(F.coalesce("component_id", "doc_id")).alias("component_id"),
                    F.col("c").alias("class_id")))


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
                    percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, class_id (key of the shingle set),
    linked_classes (other classes that the document's class links with)."""
    sig, classes, profile, roots = _joined(docs, id_col, text_col, k, percent)
    linked = links_within(profile, roots, percent, counts=True).groupBy("c").agg(F.sum("n").alias("linked_classes"))
    found = _named(sig, classes, roots).join(linked.withColumnRenamed("c", "class_id"), "class_id", "left")
    return found.select("doc_id", "n_shingles", "component_id", "class_id",
                        F.coalesce("linked_classes", F.lit(0)).alias("linked_classes"))


def join_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = SHINGLE,
               percent: int = PERCENT) -> DataFrame:
    """a, b (a < b): all links, between the smallest ids of the classes."""
    _, classes, profile, roots = _joined(docs, id_col, text_col, k, percent)
    rep = classes.select("c", "rep")
    links = links_within(profile, roots, percent)
    links = (links.join(rep.select(F.col("c").alias("a"), F.col("rep").alias("x")), "a")
             .join(rep.select(F.col("c").alias("b"), F.col("rep").alias("y")), "b"))
    return links.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without near duplicates: of every component the document with
    the smallest id stays (of repeated rows one). Documents without words,
    and rows with a null id, stay."""
    sig, classes, _, roots = _joined(docs, id_col, text_col, SHINGLE, PERCENT)
    found = stored(_named(sig, classes, roots), "named")
    gone = found.filter("doc_id <> component_id").select(F.col("doc_id").alias("gone")).distinct()
    n = gone.count()
    gone = F.broadcast(gone) if n <= BROADCAST_ROWS else gone.hint("merge")
    kept = packed(docs, id=F.col(id_col)).join(gone, F.col("id") == F.col("gone"), "left_anti")
    again = stored(found.filter("doc_id = component_id AND n_shingles > 0").groupBy("doc_id").count()
                   .filter("count > 1").select(F.col("doc_id").alias("again")), "again")
    if not again.limit(1).collect():
        return unpacked(kept, docs.columns)
    # repeated rows of one id: one row of each id stays
    single = kept.join(again, F.col("id") == F.col("again"), "left_anti")
    repeated = kept.join(again, F.col("id") == F.col("again"), "left_semi")
    first = repeated.groupBy("id").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return unpacked(single.select("row").unionByName(first.select("row")), docs.columns)
