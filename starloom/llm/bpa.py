"""Ranked lexical search by the Best Position Algorithm.

A document's score for an item is the sum over the item's distinct terms of
the term's impact in it: ``weight * ((10**9 * tf) div (1000 * tf + 20 * m))``
with ``m = 100 - 50 + ((50 * n * N) div L)``, in 64-bit integers.

1. *Index.* One map over all documents keeps, per block of them, the terms of
   the items with their frequencies (packed arrays, checkpointed). Document
   count N, term total L and document frequencies are summed from it.
2. *Search.* A task builds, per block, one impact list for each term, highest
   first. An item's lists are read in parallel by sorted access, the depth
   doubling from round to round. Every document met is looked up by direct
   access in all lists of the item, which gives its whole score and marks its
   positions there as seen. A list's best position is the end of the run of
   positions seen without a gap, by either kind of access; what stands just
   behind it bounds what an unseen document can get from that list. The sum
   of these bounds is the threshold: reading ends when it is strictly below
   the k-th score (at equality a smaller id could still enter). Best
   positions lie at or behind the last-read ones, so this ends no later than
   a threshold of last-read impacts. The k best found so far stay
   with the task, so later blocks start from their k-th score.
3. The tasks' rankings are merged by one window per item over at most k rows
   of each task.

Items are taken in blocks of at most ``block_terms`` terms (they are sent to
the tasks), each against all documents. Terms are 64-bit hashes.

Defined cases: a null or empty text (document or item) has no terms, so the
document is in no ranking and the item has none; a repeated row is a
document, or an item, of its own; equal scores rank by ascending doc_id, null
last; a document whose terms all weigh 0 scores 0 and is left out; extra
columns are ignored; without documents or items the result is empty.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from .textops import PUNCTUATION, Words, ranges, release, slices

BLOCK_TERMS = 1 << 20        # terms of the items sent to the tasks at once
BLOCK_POSTINGS = 1 << 21     # postings whose lists a task holds at once
TASK_POSTINGS = 1 << 26      # postings that one search task reads, block by block
FIRST_DEPTH = 32


def terms_of(column: pa.Array) -> tuple[Words, np.ndarray, np.ndarray, np.ndarray]:
    """(words, document, hash, frequency) of the distinct terms of each text."""
    w = Words(column, breaks=PUNCTUATION)
    doc = w.doc_of_word()
    order = np.lexsort((w.hashes, doc))
    doc, term = doc[order], w.hashes[order]
    first = np.ones(len(doc), dtype=bool)
    first[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(first)
    return w, doc[at], term[at], np.diff(np.append(at, len(doc)))


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """item_id, terms (distinct hashes) of every item with a term."""
    def run(batches):
        for b in slices(batches, "text"):
            w, doc, term, _ = terms_of(b.column("text"))
            ptr = np.searchsorted(doc, np.arange(w.n_docs + 1))
            lists = pa.ListArray.from_arrays(pa.array(ptr, pa.int32()), pa.array(term.view(np.int64)))
            yield pa.RecordBatch.from_arrays([b.column("item_id"), lists], names=["item_id", "terms"])

    items = items.select(F.col(id_col).alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return items.mapInArrow(run, f"item_id {items.dtypes[0][1]}, terms array<long>").filter("size(terms) > 0")


def item_blocks(rows: Iterator, block_terms: int) -> Iterator[list]:
    block, held = [], 0
    for r in rows:
        if block and held + len(r.terms) > block_terms:
            yield block
            block, held = [], 0
        block.append((r.item_id, np.array(r.terms, dtype=np.int64).view(np.uint64)))
        held += len(r.terms)
    if block:
        yield block


def build_index(docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
    """One row per slice of documents: ids, their term counts, and the
    postings (place of the term in ``wanted``, frequency) of each."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = (f"ids array<{docs.dtypes[0][1]}>, n_docs long, n_terms long, n_postings long, lengths binary, ptr binary, "
              "terms binary, tfs binary")

    def run(batches):
        for b in slices(batches, "text"):
            w, doc, term, tf = terms_of(b.column("text"))
            counts = w.counts().astype(np.int64)
            at = np.minimum(np.searchsorted(wanted, term), len(wanted) - 1)
            hit = wanted[at] == term
            doc, at, tf = doc[hit], at[hit].astype(np.int32), tf[hit].astype(np.int32)
            some = np.zeros(w.n_docs, dtype=bool)
            some[doc] = True  # the others are in no ranking
            ptr = np.append(np.searchsorted(doc, np.flatnonzero(some)), len(doc)).astype(np.int64)
            ids = b.column("doc_id").filter(pa.array(some))
            ids = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids)
            packed = [counts[some], ptr, at, tf]
            yield pa.RecordBatch.from_arrays(
                [ids] + [pa.array([x], pa.int64()) for x in (int((counts > 0).sum()), int(counts.sum()), len(doc))]
                + [pa.array([x.tobytes()], pa.binary()) for x in packed],
                names=["ids", "n_docs", "n_terms", "n_postings", "lengths", "ptr", "terms", "tfs"])

    return docs.mapInArrow(run, schema)


def document_frequencies(index: DataFrame, n: int) -> np.ndarray:
    """Documents holding each of the ``n`` wanted terms."""
    def run(batches):
        total = np.zeros(n, dtype=np.int64)
        for b in batches:
            for terms in b.column(0).to_pylist():
                total += np.bincount(np.frombuffer(terms, dtype=np.int32), minlength=n)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["term", "df"])

    out = np.zeros(n, dtype=np.int64)
    rows = index.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    for r in rows.collect():  # at most block_terms rows
        out[r.term] = r.df
    return out


class ImpactLists:
    """Impact lists of one block of documents and the direct access into them."""

    def __init__(self, n_docs: int, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_terms: int):
        order = np.lexsort((doc, -impact, term))
        self.doc, self.impact, self.term = doc[order], impact[order], term[order]
        self.starts = np.searchsorted(self.term, np.arange(n_terms + 1))
        self.by_doc = np.argsort(self.doc, kind="stable")
        self.ptr = np.searchsorted(self.doc[self.by_doc], np.arange(n_docs + 1))
        self.n_docs = n_docs
        self.sorted_accesses = self.direct_accesses = 0

    def lookup(self, docs: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of ``docs`` over the terms marked in ``mine``, and the
        positions of their postings."""
        sizes = self.ptr[docs + 1] - self.ptr[docs]
        at = self.by_doc[ranges(self.ptr[docs], self.ptr[docs + 1])]
        keep = mine[self.term[at]]
        at, row = at[keep], np.repeat(np.arange(len(docs)), sizes)[keep]
        total = np.zeros(len(docs), dtype=np.int64)
        np.add.at(total, row, self.impact[at])
        self.direct_accesses += len(at)
        return total, at

    def top(self, terms: np.ndarray, k: int, place: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the k best over ``terms``, ties by
        ``place``. Documents scoring below ``floor`` may be left out."""
        terms = terms[self.starts[terms + 1] > self.starts[terms]]
        pos, end = self.starts[terms].copy(), self.starts[terms + 1]
        best = pos.copy()
        mine = np.zeros(len(self.starts) - 1, dtype=bool)
        mine[terms] = True
        seen = np.zeros(len(self.doc), dtype=bool)
        done = np.zeros(self.n_docs, dtype=bool)
        docs, scores = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        depth = FIRST_DEPTH
        while len(terms):
            upto = np.minimum(pos + depth, end)
            at = ranges(pos, upto)
            self.sorted_accesses += len(at)
            new = self.doc[at]
            new = np.unique(new[~done[new]])
            if len(new):
                done[new] = True
                own, marked = self.lookup(new, mine)
                seen[marked] = True
                docs, scores = np.append(docs, new), np.append(scores, own)
                if len(docs) > k:
                    order = np.lexsort((place[docs], -scores))[:k]
                    docs, scores = docs[order], scores[order]
            pos, threshold = upto, 0
            for i in range(len(terms)):
                a, z = best[i], end[i]
                while a < z:
                    window = seen[a:min(a + 4096, z)]
                    gap = int(window.argmin())
                    if not window[gap]:
                        a += gap
                        break
                    a += len(window)
                best[i] = a
                if a < z:
                    threshold += int(self.impact[a])
            kth = max(floor, int(scores.min()) if len(scores) == k else 0)
            if threshold < kth or (pos >= end).all():
                break
            depth *= 2
        return docs, scores


def search_index(index: DataFrame, block: list, wanted: np.ndarray, weights: np.ndarray, n_docs: int, n_terms: int,
                 k: int, doc_type: str, block_postings: int) -> DataFrame:
    """item, doc_id, score: each task's k best documents of every item."""
    places = [np.searchsorted(wanted, terms) for _, terms in block]
    places = [p[weights[p] > 0] for p in places]

    def blocks(batches):
        held, size = [], 0
        for b in batches:
            for row in b.to_pylist():
                held.append(row)
                size += row["n_postings"]
                if size >= block_postings:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def order(pair):
        return -pair[0], pair[1] is None, pair[1]

    def run(batches):
        kept: list[list] = [[] for _ in places]
        kind = pa.null()

        def typed():
            nonlocal kind
            for b in batches:
                kind = b.schema.field("ids").type.value_type
                yield b

        for b in blocks(typed()):
            ids = [i for row in b for i in row["ids"]]
            if not ids:
                continue

            def joined(name, dtype):
                return np.concatenate([np.frombuffer(row[name], dtype=dtype) for row in b])
            n = joined("lengths", np.int64)
            sizes = np.concatenate([np.diff(np.frombuffer(row["ptr"], dtype=np.int64)) for row in b])
            doc = np.repeat(np.arange(len(ids)), sizes)
            term, tf = joined("terms", np.int32), joined("tfs", np.int32).astype(np.int64)
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
            lists = ImpactLists(len(ids), doc, term, impact, len(weights))
            place = np.empty(len(ids), dtype=np.int64)
            place[pc.sort_indices(pa.array(ids, kind), null_placement="at_end").to_numpy()] = np.arange(len(ids))
            for i, own in enumerate(places):
                floor = kept[i][-1][0] if len(kept[i]) == k else 0
                docs, scores = lists.top(own, k, place, floor)
                found = [(int(s), ids[d]) for d, s in zip(docs, scores) if s > 0 and s >= floor]
                if found:
                    kept[i] = sorted(kept[i] + found, key=order)[:k]
        rows = [(i, d, s) for i, found in enumerate(kept) for s, d in found]
        if rows:
            item, doc_id, score = zip(*rows)
            yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), pa.array(doc_id, kind),
                                              pa.array(score, pa.int64())], names=["item", "doc_id", "score"])
        release()

    return index.mapInArrow(run, f"item int, doc_id {doc_type}, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 50, id_col: str = "doc_id", text_col: str = "text",
           item_id_col: str = "item_id", item_text_col: str = "text", block_terms: int = BLOCK_TERMS,
           block_postings: int = BLOCK_POSTINGS, task_postings: int = TASK_POSTINGS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score of each item's k best documents."""
    spark = docs.sparkSession
    item_type, doc_type = items.select(item_id_col).dtypes[0][1], docs.select(id_col).dtypes[0][1]
    terms = item_terms(items, item_id_col, item_text_col).checkpoint(eager=True)
    parts = [spark.createDataFrame([], f"item_id {item_type}, rank int, doc_id {doc_type}, score long")]
    for block in item_blocks(terms.toLocalIterator(), block_terms):
        wanted = np.unique(np.concatenate([t for _, t in block]))
        index = build_index(docs, id_col, text_col, wanted).checkpoint(eager=True)
        n_docs, n_terms, postings = index.agg(F.sum("n_docs"), F.sum("n_terms"), F.sum("n_postings")).first()
        if not postings:
            continue
        df = document_frequencies(index, len(wanted))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df], dtype=np.int64)
        tasks = max(2 * spark.sparkContext.defaultParallelism, -(-postings // task_postings))
        found = search_index(index.coalesce(tasks), block, wanted, weights, n_docs, n_terms, k, doc_type,
                             block_postings)
        order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best = found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        names = spark.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(block)],
                                      f"item int, item_id {item_type}")
        parts.append(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"))
    return functools.reduce(DataFrame.unionByName, parts[1:] or parts)
