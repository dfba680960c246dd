"""Language-model scoring with a hierarchical Pitman-Yor model.

Words are dishes. Every context (the previous word; ``BEGIN`` before the
first) is a restaurant whose parent is the one root restaurant, whose base
is uniform over the known words and one unknown. Customers are the training
tokens; a customer that opens a table in a context sends one customer to the
root. Predictive probabilities depend on the seating only through the number
of tables of each dish, so Gibbs sampling draws these numbers: with all other
tables of the restaurant in place, t tables for c customers of a dish have
weight S_d(c, t) * prod(theta + d * (others + i), i < t) * P_parent(dish)^t,
where the generalised Stirling numbers S_d count the seatings. Up to
``EXACT`` customers t is drawn from all these weights; customers beyond are
seated after them, in growing groups, each opening tables with the
restaurant's weights. A sample is a sweep over all dishes of all customers.
Every sample's tables make that sample's root restaurant and, under it, that
sample's predictive probabilities; their average gives the score (log10, and
so perplexity). Each level has one discount.

How it is spread: all tokens are shuffled once, as binary blocks, to the
bucket of their context, and stay there for seating and for scoring. Each
bucket asks the owners of the words it holds: it sends its tokens and every
sample's tables per word, the owners seat the root restaurant and answer with
the word's count and each sample's share; scoring draws the same tables again
(the draw is a function of the counts and the bucket's number, so a lost task
repeats it too). While the root is not known, tables are drawn under the
words' frequencies: over all tokens for words that make up 1/``COMMON`` of
them, over the bucket's tokens for rarer ones. A context with more than
1/(8*buckets) of the tokens (and 1/``COMMON``) is dealt over all buckets by dish; a bucket takes
its tables for a random share of the context's, and the buckets exchange the
totals of every sample (a list bounded by 8*buckets contexts). Scores return
as sums per (document, bucket). Sizes of all exchanges follow the input;
buckets follow the number of tokens.

Words are identified by a 64-bit hash (a block holds its distinct words once
and an index per token), contexts by their bucket and 32 bits more.

Defined cases: a null text is the empty text: one end token; without any
training token every word is unknown and P = 1; a null id is scored like any
other (its hash is that of the empty text); repeated rows are scored one by
one; extra columns are ignored; empty table, empty result.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from .textops import Words, mix, release, slices

_U = np.uint64
BEGIN, END = (int(x) for x in mix(np.array([0xB0, 0xE0], dtype=np.uint64)))
THETA = 1.0
DISCOUNT, ROOT_DISCOUNT = 0.8, 0.6  # of contexts, of the root
SAMPLES = 3
BURN = 2  # sweeps before the first sample
EXACT = 64  # customers of a dish whose tables are drawn from the full posterior
GROUP = 8  # beyond, a group is 1/GROUP of those seated before
COMMON = 4096
HOT = 8  # a context with 1/HOT of a bucket's share of the tokens is dealt over all buckets
TOKENS_PER_BUCKET = 4_000_000
MAX_DOCS = 30_000  # documents of a slice (their number takes 15 bits)


def _tokens(column: pa.Array):
    """Context, word (64-bit hashes) and document of every token; the last
    token of a document is its end."""
    words = Words(column)
    size = words.counts() + 1
    ptr = np.concatenate(([0], np.cumsum(size)))
    w = np.empty(ptr[-1], dtype=np.uint64)
    w[ptr[1:] - 1] = END
    inside = np.ones(len(w), dtype=bool)
    inside[ptr[1:] - 1] = False
    w[inside] = words.hashes
    u = np.empty_like(w)
    u[1:] = w[:-1]
    u[ptr[:-1]] = BEGIN
    return u, w, np.repeat(np.arange(words.n_docs), size), size


def _slices(batches):
    # a slice's distinct words travel once to each bucket, so slices are large
    for part in slices(batches, "text", 2 << 20):
        for at in range(0, part.num_rows, MAX_DOCS):
            yield part.slice(at, MAX_DOCS)


def corpus_counts(docs: DataFrame) -> tuple[int, dict[int, int], dict[int, int]]:
    """Tokens in all; contexts and training words with at least 1/``COMMON`` of
    the tokens (a task reports those that reach half that share of its own)."""
    def run(batches):
        total, held = 0, ({}, {})
        for part in _slices(batches):
            u, w, doc, _ = _tokens(part.column(0))
            apart = np.array(part.column(1).to_pylist(), dtype=bool)
            total += len(u)
            for kind, x in ((0, u), (1, w[~apart[doc]])):
                who, n = np.unique(x, return_counts=True)
                many = n * 2 * COMMON >= len(u)
                for a, b in zip(who[many].tolist(), n[many].tolist()):
                    held[kind][a] = held[kind].get(a, 0) + b
        if total:
            rows = [(kind, k, n) for kind in (0, 1) for k, n in held[kind].items()] + [(2, 0, total)]
            kind, key, n = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(np.array(key, dtype=np.uint64).view(np.int64)),
                                              pa.array(n, pa.int64())], names=["kind", "key", "n"])

    rows = docs.select("text", "held").mapInArrow(run, "kind int, key long, n long").groupBy("kind", "key").agg(F.sum("n").alias("n"))
    total = rows.filter("kind = 2").agg(F.sum("n")).first()[0] or 0
    # at most COMMON rows of either kind reach the share
    found = rows.filter((F.col("kind") < 2) & (F.col("n") * COMMON >= total)).collect() if total else []

    def of(kind):
        return {int(np.int64(r["key"]).view(np.uint64)): r["n"] for r in found if r["kind"] == kind}
    return total, of(0), of(1)


def _owner(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((mix(h) >> _U(32)) * _U(buckets)) >> _U(32)).astype(np.int64)


def _coded(w: np.ndarray) -> tuple[bytes, bytes]:
    """Distinct words, and the index of every token's word among them."""
    words, index = np.unique(w, return_inverse=True)
    return words.tobytes(), index.astype(np.uint16 if len(words) <= 1 << 16 else np.uint32).tobytes()


def _decoded(words: list[np.ndarray], index: list[np.ndarray], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words of all blocks, and the index of every token's word."""
    distinct, place = np.unique(np.concatenate(words), return_inverse=True)
    place = np.split(place.astype(np.int32), np.cumsum([len(x) for x in words])[:-1])
    return distinct, np.concatenate([
        p[x.view(np.uint16 if len(x) == 2 * n else np.uint32)] for p, x, n in zip(place, index, lengths)])


_BLOCK = "bucket int, slice long, u binary, run binary, words binary, word binary, doc binary, ids array<long>, size array<long>, held array<boolean>"
_BLOCK_TYPES = [("bucket", pa.int32()), ("slice", pa.int64()), *[(x, pa.binary()) for x in ("u", "run", "words", "word", "doc")],
                ("ids", pa.list_(pa.int64())), ("size", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))]


def token_blocks(docs: DataFrame, buckets: int, hot: np.ndarray) -> DataFrame:
    """Tokens by bucket of their context. One row per slice and bucket; one
    more per slice names its documents."""
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        for part in _slices(batches):
            u, w, doc, size = _tokens(part.column(0))
            flag = np.array(part.column(2).to_pylist(), dtype=bool)
            code = doc.astype(np.uint16) | (flag[doc].astype(np.uint16) << np.uint16(15))
            spread = np.isin(u, hot)
            bucket = _owner(np.where(spread, u ^ mix(w), u), buckets)
            order = np.lexsort((u, bucket))
            bucket, u, w, code = bucket[order], mix(u[order]).astype(np.uint32), w[order], code[order]
            ends = np.searchsorted(bucket, np.arange(buckets + 1))
            rows = [(int(number % buckets), number, None, None, None, None, None, part.column(1).to_pylist(),
                     size.tolist(), flag.tolist())]
            for b in np.flatnonzero(ends[1:] > ends[:-1]):
                s = slice(ends[b], ends[b + 1])
                starts = np.flatnonzero(np.concatenate(([True], u[s][1:] != u[s][:-1])))
                run_length = np.diff(np.append(starts, ends[b + 1] - ends[b])).astype(np.uint32)
                rows.append((int(b), number, u[s][starts].tobytes(), run_length.tobytes(), *_coded(w[s]),
                             code[s].tobytes(), None, None, None))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), _BLOCK_TYPES)],
                                             names=[n for n, _ in _BLOCK_TYPES])
            number += 1

    return docs.select("text", "doc_id", "held").mapInArrow(run, _BLOCK)


def _column(table: pa.Table, name: str, dtype) -> list[np.ndarray]:
    return [np.frombuffer(x.as_buffer(), dtype=dtype) if x.is_valid else np.zeros(0, dtype=dtype)
            for chunk in table.column(name).chunks for x in chunk]


@functools.cache
def stirling(d: float, top: int = EXACT) -> np.ndarray:
    """log S_d(c, t) for c, t <= top (generalised Stirling numbers): in how
    many ways, weighted by the tables' sizes, c customers sit at t tables."""
    out = np.full((top + 1, top + 1), -np.inf)
    out[1, 1] = 0.0
    t = np.arange(1, top + 1)
    for c in range(1, top):
        stay = out[c, 1:] + np.log(np.maximum(c - d * t, 1e-300))
        out[c + 1, 1:] = np.logaddexp(np.where(t <= c, stay, -np.inf), out[c, :-1])
    return out


def draw_tables(count: np.ndarray, others: np.ndarray, parent: np.ndarray, d: float, rng) -> np.ndarray:
    """Tables of dishes with ``count`` customers, given the ``others``' tables
    of the restaurant and the dish's probability at its parent."""
    tables = np.minimum(count, 1).astype(np.int64)
    first = np.minimum(count, EXACT)
    order = np.argsort(first, kind="stable")
    order = order[np.searchsorted(first[order], 2):]  # one customer has one table
    edges = np.flatnonzero(np.diff(first[order], prepend=0, append=EXACT + 1))
    log_s = stirling(d)
    for a, b in zip(edges[:-1], edges[1:]):
        c = int(first[order[a]])
        step = max(1, (1 << 20) // c)
        for at in range(a, b, step):
            i = order[at:min(at + step, b)]
            grow = np.log(THETA + d * (others[i][:, None] + np.arange(c))) + np.log(parent[i])[:, None]
            weight = np.cumsum(grow, axis=1) + log_s[c, 1:c + 1]
            chance = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            tables[i] = 1 + (chance < rng.random(len(i))[:, None] * chance[:, -1:]).sum(axis=1)
    more = np.flatnonzero(count > EXACT)
    seated = np.full(len(more), EXACT, dtype=np.int64)
    while len(more):
        group = np.minimum(np.maximum(seated // GROUP, 1), count[more] - seated)
        new = (THETA + d * (others[more] + tables[more])) * parent[more]
        old = np.maximum(seated - d * tables[more], 1e-9)
        tables[more] += rng.binomial(group, new / (new + old))
        seated += group
        left = seated < count[more]
        more, seated = more[left], seated[left]
    return tables


def sample_tables(count: np.ndarray, room: np.ndarray, rooms: int, parent: np.ndarray, d: float, rng,
                  share: np.ndarray | float = 1.0) -> list[np.ndarray]:
    """Tables per dish of ``SAMPLES`` sweeps after ``BURN``. ``share``: part of a
    restaurant's dishes that is held here."""
    tables, out = np.minimum(count, 1).astype(np.int64), []
    for sweep in range(BURN + SAMPLES):
        whole = np.bincount(room, weights=tables, minlength=rooms) / share
        tables = draw_tables(count, np.maximum(whole[room] - tables, 0.0), parent, d, rng)
        if sweep >= BURN:
            out.append(tables)
    return out


class Bucket:
    """Counts of one bucket: distinct words, (context, word) pairs, contexts."""

    def __init__(self, table: pa.Table, hot32: np.ndarray, number: int, buckets: int):
        self.number = number
        code = _column(table, "doc", np.uint16)
        self.lengths = [len(x) for x in code]
        self.code = np.concatenate(code)
        self.words, word = _decoded(_column(table, "words", np.uint64), _column(table, "word", np.uint8), self.lengths)
        u = [np.repeat(a, b) for a, b in zip(_column(table, "u", np.uint32), _column(table, "run", np.uint32))]
        key = (np.concatenate(u).astype(np.uint64) << _U(32)) | word.astype(np.uint64)
        del u, word
        pairs, pair = np.unique(key, return_inverse=True)
        del key
        self.pair = pair.astype(np.int32)
        self.count = np.bincount(pair[self.code < 0x8000], minlength=len(pairs))
        del pair
        self.pair_word = (pairs & _U(0xFFFFFFFF)).astype(np.int32)
        self.contexts, room = np.unique(pairs >> _U(32), return_inverse=True)
        self.room = room.astype(np.int32)
        self.customers = np.bincount(self.room, weights=self.count, minlength=len(self.contexts))
        self.word_count = np.bincount(self.pair_word, weights=self.count, minlength=len(self.words)).astype(np.int64)
        self.hot = np.isin(self.contexts, hot32)
        self.buckets = buckets

    def samples(self, common: dict[int, int], n_train: int) -> list[np.ndarray]:
        """Tables per pair of every sample: the same on every call."""
        guess = (self.word_count + 0.5) / (self.word_count.sum() + 0.5 * (len(self.words) + 1))
        if n_train:
            keys = np.array(sorted(common), dtype=np.uint64)
            at = np.minimum(np.searchsorted(keys, self.words), max(0, len(keys) - 1))
            known = (keys[at] == self.words) if len(keys) else np.zeros(len(self.words), dtype=bool)
            share = np.array([common[int(k)] for k in keys]) / n_train
            guess[known] = share[at[known]]
        rng = np.random.default_rng(self.number)
        part = np.where(self.hot, 1.0 / self.buckets, 1.0)
        return sample_tables(self.count, self.room, len(self.contexts), guess[self.pair_word], DISCOUNT, rng, part)


_ASK = ("owner int, bucket int, words binary, count binary, tables binary, "
        "u array<long>, n array<double>, totals array<double>")
_ASK_TYPES = [("owner", pa.int32()), ("bucket", pa.int32()), *[(x, pa.binary()) for x in ("words", "count", "tables")],
              ("u", pa.list_(pa.int64())), ("n", pa.list_(pa.float64())), ("totals", pa.list_(pa.float64()))]
_TELL = ("bucket int, owner int, count binary, share binary, sums array<double>, "
         "u array<long>, n array<double>, totals array<double>")


def _table(rows: list, types: list) -> pa.Table:
    columns = list(zip(*rows)) if rows else [[] for _ in types]
    return pa.table([pa.array(c, t) for c, (_, t) in zip(columns, types)], names=[n for n, _ in types])


def score(docs: DataFrame, id_col: str, text_col: str, held: Column, buckets: int | None = None) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    ``held``: documents that are scored but not learned from."""
    base = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"), held.alias("held"))
    n_tokens, contexts, common = corpus_counts(base)
    buckets = buckets or max(8, -(-n_tokens // TOKENS_PER_BUCKET))
    hot = np.sort(np.array([u for u, n in contexts.items() if HOT * buckets * n >= n_tokens], dtype=np.uint64))
    hot32 = np.unique(mix(hot).astype(np.uint32).astype(np.uint64))
    # tables and counts travel as 64-bit numbers
    # one bucket to a task: by hash, several would share one, and its memory
    blocks = token_blocks(base, buckets, hot).repartitionById(buckets, F.col("bucket"))

    def seat(table: pa.Table) -> pa.Table:
        number = table.column("bucket")[0].as_py()
        b = _open(table, hot32, number, buckets)
        if b is None:
            return _table([], _ASK_TYPES)
        samples = b.samples(common, n_tokens)
        tables = [np.bincount(b.pair_word, weights=t, minlength=len(b.words)).astype(np.uint64) for t in samples]
        totals = [np.bincount(b.room, weights=t, minlength=len(b.contexts)) for t in samples]
        owner = _owner(b.words, buckets)
        hot_at = np.flatnonzero(b.hot)
        hot_owner = _owner(b.contexts[hot_at], buckets)
        rows = []
        for o in range(buckets):  # every owner, so that all hear of each other
            m, h = owner == o, hot_at[hot_owner == o]
            rows.append((o, number, b.words[m].tobytes(), b.word_count[m].astype(np.uint64).tobytes(),
                         np.concatenate([t[m] for t in tables]).tobytes(),
                         b.contexts[h].astype(np.int64).tolist(), b.customers[h].tolist(),
                         [float(t[i]) for i in h for t in totals]))
        del b, samples
        release()
        return _table(rows, _ASK_TYPES)

    asked = blocks.groupBy("bucket").applyInArrow(seat, _ASK).repartitionById(buckets, F.col("owner"))

    def root(table: pa.Table) -> pa.Table:
        number = table.column("owner")[0].as_py()
        froms = table.column("bucket").to_pylist()
        w = _column(table, "words", np.uint64)
        lengths = [len(x) for x in w]
        words, inverse = np.unique(np.concatenate(w), return_inverse=True)
        del w
        inverse = inverse.astype(np.int32)

        def total(parts):
            out = np.zeros(len(words), dtype=np.int64)
            np.add.at(out, inverse, np.concatenate(parts).astype(np.int64))
            return out
        count = total(_column(table, "count", np.uint64))
        known = int((count > 0).sum())
        drawn = [x.reshape(SAMPLES, -1) for x in _column(table, "tables", np.uint64)]
        # one owner sees 1/buckets of the known words and of the root's tables
        parent = np.full(len(words), 1.0 / (known * buckets + 1.0))
        rng, room = np.random.default_rng([number, 1]), np.zeros(len(words), dtype=np.int64)
        shares, sums = [], [float(known), float(count.sum())]
        for s in range(SAMPLES):
            customers = total([x[s] for x in drawn])
            tables = sample_tables(customers, room, 1, parent, ROOT_DISCOUNT, rng, 1.0 / buckets)[-1]
            shares.append((customers - ROOT_DISCOUNT * tables).astype(np.float32))
            sums += [float(customers.sum()), float(ROOT_DISCOUNT * tables.sum())]
        held: dict[int, np.ndarray] = {}
        for us, ns, ts in zip(*(table.column(x).to_pylist() for x in ("u", "n", "totals"))):
            for i, u in enumerate(us):
                held[u] = held.get(u, 0) + np.array([ns[i], *ts[i * SAMPLES:(i + 1) * SAMPLES]])
        hot_rows = (list(held), [float(v[0]) for v in held.values()], [float(x) for v in held.values() for x in v[1:]])
        rows, at, count = [], 0, count.astype(np.uint64)
        for b, n in zip(froms, lengths):
            pick = inverse[at:at + n]
            at += n
            rows.append((b, number, count[pick].tobytes(), np.concatenate([x[pick] for x in shares]).tobytes(), sums, *hot_rows))
        release()
        return _table(rows, _TELL_TYPES)

    answers = asked.groupBy("owner").applyInArrow(root, _TELL).repartitionById(buckets, F.col("bucket"))

    def final(blocks: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        if not blocks.num_rows:
            return _table(rows, _PART_TYPES)
        number = blocks.column("bucket")[0].as_py()
        for r in blocks.filter(blocks.column("ids").is_valid()).select(["slice", "ids", "size", "held"]).to_pylist():
            rows.append((r["slice"], None, None, None, None, None, r["ids"], r["size"], r["held"]))
        b = _open(blocks, hot32, number, buckets)
        if b is None:
            return _table(rows, _PART_TYPES)
        known, n_train, vocabulary, parents = _parents(b, answers, buckets)
        s = np.log10(_predict(b, b.samples(common, n_tokens), parents, answers))[b.pair]
        base_log = np.log10((known + 0.5) / (n_train + 0.5 * (vocabulary + 1)))
        base, k = base_log[b.pair_word][b.pair], (known > 0)[b.pair_word][b.pair]
        slices_of = [x for x, ok in zip(blocks.column("slice").to_pylist(), blocks.column("u").is_valid().to_pylist()) if ok]
        at = 0
        for sl, n in zip(slices_of, b.lengths):
            part = slice(at, at + n)
            at += n
            who, inverse = np.unique(b.code[part] & np.uint16(0x7FFF), return_inverse=True)
            rows.append((sl, who.astype(np.uint16).tobytes(), np.bincount(inverse, weights=s[part]).tobytes(),
                         np.bincount(inverse, weights=base[part]).tobytes(),
                         np.bincount(inverse, weights=k[part]).astype(np.uint32).tobytes(), int(n_train), None, None, None))
        del b, s, base, k
        release()
        return _table(rows, _PART_TYPES)

    parts = blocks.groupBy("bucket").cogroup(answers.groupBy("bucket")).applyInArrow(final, _PART)

    def finish(table: pa.Table) -> pa.Table:
        names = table.filter(table.column("ids").is_valid()).select(["ids", "size", "held"]).to_pylist()[0]
        n = len(names["ids"])
        total, base, known, trained = np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64), 0
        rest = table.filter(table.column("doc").is_valid()).sort_by("first")
        for who, s, q, k in zip(*[_column(rest, c, t) for c, t in (("doc", np.uint16), ("score", np.float64),
                                                                  ("base", np.float64), ("known", np.uint32))]):
            total[who] += s
            base[who] += q
            known[who] += k
        trained = max((x for x in rest.column("train").to_pylist()), default=0)
        return pa.table({"doc_id": pa.array(names["ids"], pa.int64()), "held_out": pa.array(names["held"]),
                         "n_tokens": pa.array(names["size"], pa.int64()), "n_known": known,
                         "train_tokens": np.full(n, trained, dtype=np.int64), "base_score": base, "score": total})

    parts = parts.withColumn("first", F.hash("doc", "score"))
    return parts.groupBy("slice").applyInArrow(
        finish, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


_TELL_TYPES = [("bucket", pa.int32()), ("owner", pa.int32()), ("count", pa.binary()), ("share", pa.binary()),
               ("sums", pa.list_(pa.float64())), ("u", pa.list_(pa.int64())), ("n", pa.list_(pa.float64())),
               ("totals", pa.list_(pa.float64()))]
_PART = "slice long, doc binary, score binary, base binary, known binary, train long, ids array<long>, size array<long>, held array<boolean>"
_PART_TYPES = [("slice", pa.int64()), *[(x, pa.binary()) for x in ("doc", "score", "base", "known")], ("train", pa.int64()),
               ("ids", pa.list_(pa.int64())), ("size", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_()))]


def _open(table: pa.Table, hot32: np.ndarray, number: int, buckets: int) -> Bucket | None:
    tokens = table.filter(table.column("u").is_valid())
    return Bucket(tokens, hot32, number, buckets) if tokens.num_rows else None


def _parents(b: Bucket, told: pa.Table, buckets: int):
    """Training count per word of the bucket; training tokens; known words;
    the words' root probabilities in every sample."""
    known, share = np.zeros(len(b.words), dtype=np.int64), np.zeros((SAMPLES, len(b.words)))
    owner = _owner(b.words, buckets)
    for o, c, s in zip(told.column("owner").to_pylist(), _column(told, "count", np.uint64), _column(told, "share", np.float32)):
        known[owner == o], share[:, owner == o] = c.astype(np.int64), s.reshape(SAMPLES, -1)
    sums = np.sum(told.column("sums").to_pylist(), axis=0)
    vocabulary, n_train = sums[:2]
    base = 1.0 / (vocabulary + 1.0)
    parents = [(np.maximum(share[s], 0.0) + (THETA + discounted) * base) / (THETA + customers)
               for s, (customers, discounted) in enumerate(sums[2:].reshape(SAMPLES, 2))]
    return known, n_train, vocabulary, parents


def _predict(b: Bucket, samples: list[np.ndarray], parents: list[np.ndarray], told: pa.Table) -> np.ndarray:
    """Probability of every pair, averaged over the samples; contexts dealt over
    all buckets with the totals of all of them."""
    out, customers = np.zeros(len(b.pair_word)), b.customers.copy()
    totals = [np.bincount(b.room, weights=t, minlength=len(b.contexts)) for t in samples]
    place = {int(b.contexts[i]): i for i in np.flatnonzero(b.hot)}
    for us, ns, ts in zip(*(told.column(x).to_pylist() for x in ("u", "n", "totals"))):
        for j, u in enumerate(us):
            if u in place:
                customers[place[u]] = ns[j]
                for s in range(SAMPLES):
                    totals[s][place[u]] = ts[j * SAMPLES + s]
    for tables, total, parent in zip(samples, totals, parents):
        own = np.maximum(b.count - DISCOUNT * tables, 0.0)
        out += (own + (THETA + DISCOUNT * total[b.room]) * parent[b.pair_word]) / (THETA + customers[b.room]) / SAMPLES
    return out
