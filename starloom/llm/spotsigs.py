"""SpotSigs fingerprints of documents.

A signature is an anchor (a common word) with the chain of the next content
words after it, stepping over further common words. A document's fingerprint
is its set of signatures; likeness is the Jaccard similarity of two sets.
Common words are given by a list per language; texts in which no anchor
occurs fall back to anchors of at most three letters, and texts without any
signature are fingerprinted by all their words, so every text has one.

A fingerprint is written as ``size:`` and the base64 text of its sorted
signature hashes (32 bits each).

Near duplicates: a set of size a can reach Jaccard t only with sets of size
t*a .. a/t, so sets are partitioned by size class (powers of 1/t) and each
meets its own and the next class only; within them candidates must share one
of the first (1-t)*a + 1 hashes, rarest first, and the positions of the
shared hash must still allow the threshold. Equal fingerprints are compared
once, through one representative; a signature that many sets share is dealt
over several tasks. Pairs are as many as there are links between different
fingerprints.

Defined cases: a null text counts as empty; the empty text has the empty
fingerprint, likeness 1 to itself and 0 to others; equal texts have equal
fingerprints; repeated rows are handled one by one; extra columns are
ignored.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .textops import Words, extended, mix, slices

# Common words used as anchors, by language.
ANCHORS = {
    "en": "a an and are as at be by for from in is it of on or that the this to was with",
    "de": "als auf aus das dem den der des die ein eine für in ist mit nicht sich und von zu",
    "fr": "à au aux ce dans de des du elle en est et il la le les ne pas pour que qui sur un une",
    "es": "al con de del el en es la las lo los no para por que se su un una y",
}
CHAIN = 2  # content words after an anchor
PER_SLICE = 8192  # documents whose order is settled in one task, about
HOT_SIGNATURE = 2000  # sets with a signature that are compared in one task, about
_PUNCT = b".,;:!?\"'()[]{}"
_U = np.uint64


def _hash_words(words: list[str]) -> np.ndarray:
    return Words(pa.array([" ".join(words)])).hashes


_ANCHOR_HASHES = np.unique(_hash_words(sorted({w for v in ANCHORS.values() for w in v.split()})))
_STRIP = np.zeros(256, dtype=bool)
_STRIP[list(_PUNCT)] = True


def _bare(words: Words) -> None:
    """Take punctuation off the ends of words, so that 'the,' is an anchor;
    a word of punctuation alone stays as it is."""
    start, end = words.starts.copy(), words.ends.copy()
    for _ in range(3):
        trim = (end - start > 1) & _STRIP[words.data[end - 1]] if len(start) else np.zeros(0, dtype=bool)
        if not trim.any():
            break
        end[trim] -= 1
    for _ in range(3):
        trim = (end - start > 1) & _STRIP[words.data[start]] if len(start) else np.zeros(0, dtype=bool)
        if not trim.any():
            break
        start[trim] += 1
    words.starts, words.ends = start, end
    words.hashes = words._hash()


def signatures(column: pa.Array, chain: int = CHAIN) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 32-bit signature hashes, sorted within each document, and the
    pointer of documents into them."""
    words = Words(column, hashes=False)
    _bare(words)
    h = words.hashes
    anchor = np.isin(h, _ANCHOR_HASHES)
    doc = words.doc_of_word()
    # documents without a common word: very short words serve
    per_doc = np.bincount(doc[anchor], minlength=words.n_docs)
    anchor |= (per_doc[doc] == 0) & (words.ends - words.starts <= 3)
    content = np.flatnonzero(~anchor)
    at = np.flatnonzero(anchor)
    first = np.searchsorted(content, at)
    sig = h[at].copy()
    good = np.ones(len(at), dtype=bool)
    for j in range(chain):
        pos = first + j
        ok = pos < len(content)
        nxt = content[np.minimum(pos, max(len(content) - 1, 0))] if len(content) else np.zeros(len(at), dtype=np.int64)
        ok &= (doc[nxt] == doc[at]) if len(at) else ok
        good &= ok
        with np.errstate(over="ignore"):
            sig = mix(sig * _U(0x9E3779B97F4A7C15) + (h[nxt] if len(h) else sig))
    sig_doc, sig = doc[at][good], sig[good]
    # no signature at all: every word is one
    none = np.bincount(sig_doc, minlength=words.n_docs) == 0
    if none.any() and len(h):
        extra = none[doc]
        sig_doc, sig = np.concatenate([sig_doc, doc[extra]]), np.concatenate([sig, mix(h[extra])])
    key = np.unique((sig_doc.astype(np.uint64) << _U(32)) | (sig >> _U(32)))
    ptr = np.searchsorted(key, np.arange(words.n_docs + 1, dtype=np.uint64) << _U(32))
    return (key & _U(0xFFFFFFFF)).astype(np.uint32), ptr


def encode(sigs: np.ndarray) -> str:
    return f"{len(sigs)}:" + base64.b64encode(sigs.astype("<u4").tobytes()).decode("ascii")


def decode(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint.partition(":")[2]), dtype="<u4")


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets; two empty sets are alike."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return shared / (len(both) - shared)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint, n_signatures: a map without a shuffle."""
    def run(batches):
        for part in slices(batches, "text"):
            sigs, ptr = signatures(part.column(1))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([encode(sigs[a:b]) for a, b in zip(ptr, ptr[1:])], pa.string()),
                 pa.array(np.diff(ptr).astype(np.int64))], names=["doc_id", "fingerprint", "n_signatures"])

    base = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return base.mapInArrow(run, extended(base.select("doc_id").schema, fingerprint="string", n_signatures="long"))


def representatives(prints: DataFrame) -> DataFrame:
    """id, n_signatures, sigs: the smallest id of each distinct fingerprint that
    is not empty, with its set as (signed) integers: half of their text's bytes
    in every exchange, and cheaper to compare."""
    @F.pandas_udf("array<int>")
    def hashes(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: decode(t).view("<i4"))

    reps = (prints.filter("n_signatures > 0 AND doc_id IS NOT NULL").groupBy("fingerprint", "n_signatures")
            .agg(F.min("doc_id").alias("id")))
    return reps.select("id", "n_signatures", hashes("fingerprint").alias("sigs"))


def near_duplicates(prints: DataFrame, threshold: float = 0.8) -> DataFrame:
    """Pairs of distinct fingerprints with Jaccard of at least ``threshold``:
    a, b (fingerprint of the smaller and larger representative id as a_id,
    b_id) and likeness. ``prints``: rows of ``fingerprints``. Documents with
    equal fingerprints are represented by the smallest id."""
    n = F.col("n_signatures")
    # size class: sets that may reach the threshold lie in equal or adjacent classes
    width = float(-np.log(threshold))
    reps = (representatives(prints).select("id", n.alias("n"), "sigs", F.floor(F.log("n_signatures") / width).alias("class"))
            .checkpoint(eager=True))
    token = reps.select("id", "n", "class", F.explode("sigs").alias("sig"))
    often = token.groupBy("sig").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    rank = Window.partitionBy("id").orderBy(F.coalesce("df", F.lit(1)), "sig")
    prefix = (token.join(often, "sig", "left").withColumn("pos", F.row_number().over(rank))
              .filter(F.col("pos") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
              .filter("df > 1").select("id", "n", "class", "sig", "pos", "df"))
    # a common signature is dealt: the left sets over parts, the right ones to each part
    parts = F.ceil(F.col("df") / HOT_SIGNATURE).cast("long")
    left = (prefix.withColumn("part", F.pmod(F.xxhash64("id"), parts))
            .withColumn("meet", F.explode(F.array(F.col("class"), F.col("class") + 1))).drop("df"))
    right = prefix.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).select(
        F.col("id").alias("id2"), F.col("n").alias("n2"), F.col("class").alias("meet"), "sig", "part", F.col("pos").alias("pos2"))
    need = F.ceil((F.col("n") + F.col("n2")) * (threshold / (1 + threshold)) - 1e-9)
    room = 1 + F.least(F.col("n") - F.col("pos"), F.col("n2") - F.col("pos2"))
    pairs = (left.join(right, ["meet", "sig", "part"])
             .filter((F.col("class") < F.col("meet")) | (F.col("id") < F.col("id2")))
             .filter((F.least("n", "n2") >= F.greatest("n", "n2") * threshold - 1e-9) & (room >= need))
             .select(F.least("id", "id2").alias("a_id"), F.greatest("id", "id2").alias("b_id")).distinct())
    sets = reps.select("id", "sigs")
    full = (pairs.join(sets.toDF("a_id", "a"), "a_id").join(sets.toDF("b_id", "b"), "b_id")
            .withColumn("shared", F.size(F.array_intersect("a", "b"))))
    full = full.withColumn("likeness", F.col("shared") / (F.size("a") + F.size("b") - F.col("shared")))
    return full.filter(F.col("likeness") >= threshold - 1e-12).select("a_id", "b_id", "likeness")


def _slice_bounds(keys: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first (id, hash) of every slice but the first, where a range
    exchange of the keys alone would cut (any cut is right; its evenness only
    balances the work). One row per slice comes back."""
    if n <= 1:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    heads = (keys.repartitionByRange(n, "doc_id", "h").groupBy(F.spark_partition_id().alias("p"))
             .agg(F.min(F.struct("doc_id", "h")).alias("k")).select("k.*").orderBy("doc_id", "h").collect()[1:])
    return np.array([r.doc_id for r in heads], dtype=np.int64), np.array([r.h for r in heads], dtype=np.int64)


def _slice_of(ids: np.ndarray, hashes: np.ndarray, bound_ids: np.ndarray, bound_hashes: np.ndarray) -> np.ndarray:
    """Number of bounds at or below each (id, hash)."""
    low, high = (np.searchsorted(bound_ids, ids, side=s) for s in ("left", "right"))
    for i in np.unique(ids[high > low]):  # ids that are bounds: their rows are told apart by hash
        at = np.flatnonzero(ids == i)
        a, b = low[at[0]], high[at[0]]
        low[at] = a + np.searchsorted(bound_hashes[a:b], hashes[at], side="right")
    return np.where(high > low, low, high) if len(bound_ids) else low


def with_next(docs: DataFrame, per_slice: int = PER_SLICE) -> DataFrame:
    """Rows (slice, doc_id, text, last) of ``docs`` sliced by ranges of (id,
    hash of the text); each slice ends with the first document of the following
    one (marked ``last``; the first document of all after the end)."""
    docs = docs.withColumn("h", F.xxhash64("text"))
    null = F.lit(-(1 << 63)).cast("long")  # before all ids
    bounds = _slice_bounds(docs.select(F.coalesce(F.col("doc_id").cast("long"), null).alias("doc_id"), "h"),
                           max(1, -(-docs.count() // per_slice)))

    @F.pandas_udf("int")
    def place(ids: pd.Series, hashes: pd.Series) -> pd.Series:
        return pd.Series(_slice_of(ids.to_numpy(), hashes.to_numpy(), *bounds).astype(np.int32))

    sliced = docs.withColumn("slice", place(F.coalesce("doc_id", null), "h"))
    order = F.struct(F.col("doc_id"), F.col("h"), F.md5(F.coalesce("text", F.lit(""))).alias("m"))
    heads = sliced.groupBy("slice").agg(F.min(order).alias("k")).checkpoint(eager=True)
    # one row per slice: the head of each slice goes to the end of the one before
    after = Window.partitionBy(F.lit(0)).orderBy("slice")
    whole = Window.partitionBy(F.lit(0))
    goes = heads.select("k", F.coalesce(F.lag("slice").over(after), F.max("slice").over(whole)).alias("to"),
                        F.col("slice").alias("of"))
    first = (sliced.join(F.broadcast(goes), (F.col("slice") == F.col("of")) & order.eqNullSafe(F.col("k")))
             .groupBy("to", "doc_id", "text").count()
             .select(F.col("to").alias("slice"), "doc_id", "text", F.lit(True).alias("last")))
    return sliced.select("slice", "doc_id", "text", F.lit(False).alias("last")).unionByName(first), len(bounds[0]) + 1


def edited(text: str, following: str) -> str:
    """The last quarter of the code points gives way to the first as many (or
    all) of the following document."""
    m = len(text) // 4
    return text[:len(text) - m] + following[:m]


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; edited and next as in
    ``edited`` over ascending ids (after the last, the first)."""
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows, n_slices = with_next(base)
    dealt = rows.repartitionById(n_slices, F.col("slice")).sortWithinPartitions(
        "slice", "last", F.asc_nulls_first("doc_id"), F.xxhash64("text"), F.md5("text"))
    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")

    def finish(block):
        ids, texts, follow = zip(*block)
        changed = [edited(t, f) for t, f in zip(texts, follow)]
        flat = [*texts, *changed, follow[-1]]
        sigs, ptr = signatures(pa.array(flat, pa.large_string()))
        sets = [sigs[a:b] for a, b in zip(ptr, ptr[1:])]
        n = len(texts)
        own, other, nxt = sets[:n], sets[n:2 * n], [*sets[1:n], sets[2 * n]]
        return pa.RecordBatch.from_arrays([
            pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8")).hexdigest() for t in changed]),
            pa.array([encode(s) for s in own], pa.string()), pa.array([encode(s) for s in other], pa.string()),
            pa.array([1.0 if t == c else likeness(a, b) for t, c, a, b in zip(texts, changed, own, other)]),
            pa.array([likeness(a, b) for a, b in zip(own, nxt)])],
            names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches):
        held, block, size = None, [], 0
        for part in slices(batches, "text"):
            for s, i, t, last in zip(*(c.to_pylist() for c in part.columns)):
                if held and held[0] == s:
                    block.append((held[1], held[2], t))
                    size += len(held[2])
                    # a block's texts follow one another
                    if size > 1_000_000 or last:
                        yield finish(block)
                        block, size = [], 0
                held = None if last else (s, i, t)

    return dealt.mapInArrow(run, schema)
