"""Language identification by multilingual mixture inference.

Learning: byte 3-gram counts of the words of each language (hashed into
``BUCKETS`` classes), over all labelled documents, as one aggregation; the
result is languages * BUCKETS numbers, a bound that does not grow with the
corpus. Prediction: a document is a mixture of languages; a word's likelihood
under a language is the product of its 3-gram probabilities. Expectation
maximisation over the document's words gives the language proportions.
Nested language sets, in the order of those proportions, are then refitted
and the set with the best penalised likelihood (BIC) stays; a size is left
out only if a bound on the likelihood of any set shows that it cannot win. The
prediction is the set's largest language, the score that language's proportion.

Prediction is a map over the documents: no shuffle, memory bounded by one
slice of text.

Defined cases: a null text or one without any letter is ``und`` with score 0
(as is everything if nothing was learned); ties go to the smaller language
name; rows with null text or language teach nothing; repeated rows are
handled one by one; extra columns are ignored or carried.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .textops import Words, extended, segment_sum, slices

BITS = 16
BUCKETS = 1 << BITS
PARTS = 16
MAX_LANGUAGES = 500
EM_STEPS = 20
REFIT_STEPS = 6

_LETTER = np.zeros(256, dtype=bool)
_LETTER[97:123] = True
_LETTER[128:] = True


def _grams(words: Words, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """3-gram classes of the given words, and the pointer of words into them.
    A word of n bytes between two spaces has n 3-grams."""
    data, ptr = words.padded(index)
    wide = data.astype(np.uint32)
    code = (wide[:-2] << np.uint32(16)) | (wide[1:-1] << np.uint32(8)) | wide[2:] if len(wide) > 2 else wide[:0]
    lengths = np.diff(ptr) - 2
    gram_ptr = np.concatenate(([0], np.cumsum(lengths)))
    place = np.arange(gram_ptr[-1]) - np.repeat(gram_ptr[:-1], lengths) + np.repeat(ptr[:-1], lengths)
    code = code[place]
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64), gram_ptr


def _pairs(words: Words):
    """Distinct words with a letter: positions; and per document the distinct
    such words with their counts (document, index of the word, count)."""
    has = np.concatenate(([0], np.cumsum(_LETTER[words.data])))
    good = np.flatnonzero(has[words.ends] > has[words.starts])
    _, first, inverse = np.unique(words.hashes[good], return_index=True, return_inverse=True)
    if not len(good):
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty, empty
    key, count = np.unique(words.doc_of_word()[good] * len(first) + inverse, return_counts=True)
    return good[first], key // len(first), key % len(first), count


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and log probabilities [language, class]."""
    def run(batches):
        table: dict[str, np.ndarray] = {}
        for part in slices(batches, "text"):
            words = Words(part.column(0))
            at, doc, word, count = _pairs(words)
            if not len(at):
                continue
            names, label = np.unique(np.array(part.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
            grams, ptr = _grams(words, at)
            for i, name in enumerate(names):
                mine = label[doc] == i
                weight = np.bincount(word[mine], weights=count[mine], minlength=len(at))
                add = np.bincount(grams, weights=np.repeat(weight, np.diff(ptr)), minlength=BUCKETS)
                table[name] = table.get(name, 0) + add.astype(np.int64)
        rows = [(name, p, t[p::PARTS].tobytes()) for name, t in table.items() for p in range(PARTS)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)], schema=pa.schema(
                [("lang", pa.string()), ("part", pa.int64()), ("counts", pa.binary())]))

    def total(table: pa.Table) -> pa.Table:
        summed = sum(np.frombuffer(b, dtype=np.int64) for b in table.column("counts").to_pylist())
        return table.slice(0, 1).set_column(2, "counts", pa.array([summed.tobytes()], pa.binary()))

    base = docs.select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    base = base.filter("text IS NOT NULL AND lang IS NOT NULL")
    if base.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values; a table of {BUCKETS} counts is kept for each")
    schema = "lang string, part long, counts binary"
    # one row per language and part: languages * BUCKETS numbers in all
    rows = base.mapInArrow(run, schema).groupBy("lang", "part").applyInArrow(total, schema).collect()
    names = sorted({r["lang"] for r in rows})
    counts = np.zeros((len(names), BUCKETS))
    for r in rows:
        counts[names.index(r["lang"]), r["part"]::PARTS] = np.frombuffer(bytes(r["counts"]), dtype=np.int64)
    smooth = counts + 0.5
    return names, np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32)


def _em(like: np.ndarray, count: np.ndarray, ptr: np.ndarray, start: np.ndarray, steps: int):
    """EM for the proportions [document, language]; zeros stay zero. Also the
    log likelihood at the proportions returned (shifted as ``like`` is)."""
    doc = np.repeat(np.arange(len(ptr) - 1), np.diff(ptr))
    total = np.maximum(segment_sum(count, ptr), 1)[:, None]
    mix = start
    for _ in range(steps):
        joint = mix[doc] * like
        joint *= (count / joint.sum(axis=1))[:, None]
        mix = segment_sum(joint, ptr) / total
    return mix, segment_sum(count * np.log((mix[doc] * like).sum(axis=1)), ptr)


def infer(words: Words, table: np.ndarray) -> np.ndarray:
    """Proportions [document, language] over each document's chosen set."""
    n_lang = len(table)
    at, doc, word, count = _pairs(words)
    out = np.zeros((words.n_docs, n_lang), dtype=np.float64)
    if not len(at) or not n_lang:
        return out
    grams, gram_ptr = _grams(words, at)
    log_like = np.stack([np.add.reduceat(t[grams], gram_ptr[:-1]) for t in table], axis=1).astype(np.float64)
    log_like -= log_like.max(axis=1, keepdims=True)
    # a floor keeps every word possible under every language
    like = np.exp(np.maximum(log_like, -60.0))[word]
    count = count.astype(np.float64)
    ptr = np.searchsorted(doc, np.arange(words.n_docs + 1))
    n = segment_sum(count, ptr)
    full, top = _em(like, count, ptr, np.full((words.n_docs, n_lang), 1.0 / n_lang), EM_STEPS)
    order = np.argsort(-full, axis=1, kind="stable")
    rank = np.empty_like(order)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n_lang), order.shape).copy(), axis=1)
    # no proportions have a likelihood above this (Jensen's inequality)
    gain = segment_sum(like * (count / (full[doc] * like).sum(axis=1))[:, None], ptr).max(axis=1)
    top = top + n * np.log(np.maximum(gain / np.maximum(n, 1), 1.0))
    best = np.full(words.n_docs, -np.inf)
    for k in range(1, n_lang + 1):
        price = (k - 1) * np.log(np.maximum(n, 2))
        some = np.flatnonzero(top - price > best - 1e-6)
        if not len(some):
            break
        own = np.isin(doc, some) if len(some) < words.n_docs else slice(None)
        part = np.concatenate(([0], np.cumsum(np.diff(ptr)[some])))
        start = np.where(rank[some] < k, full[some] + 1e-6, 0.0)
        start /= start.sum(axis=1, keepdims=True)
        fit, ll = _em(like[own], count[own], part, start, REFIT_STEPS if k > 1 else 0)
        ll = ll - price[some]
        better = ll > best[some]
        out[some[better]], best[some[better]] = fit[better], ll[better]
    out[n == 0] = 0
    return out


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and lang_mix (language -> proportion of
    the chosen set), which take the place of columns of these names."""
    names, table = model
    docs = docs.drop("lang_pred", "score", "lang_mix")
    spread = docs.sparkSession.sparkContext.broadcast((names, table))
    schema = extended(docs.schema, lang_pred="string", score="double", lang_mix="map<string,double>")
    at = docs.columns.index(text_col)

    def run(batches):
        names, table = spread.value
        for part in slices(batches, text_col):
            column = part.column(at)
            mixes = infer(Words(column), table)
            lang, score, sets = [], [], []
            for text, m in zip(column.to_pylist(), mixes):
                top = int(m.argmax()) if len(m) else 0
                if not len(m) or not m[top] or not any(map(str.isalpha, text)):
                    lang.append("und"), score.append(0.0), sets.append([])
                else:
                    lang.append(names[top]), score.append(min(1.0, float(m[top])))
                    sets.append([(names[i], float(m[i])) for i in np.flatnonzero(m)])
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64()),
                 pa.array(sets, pa.map_(pa.string(), pa.float64()))],
                names=[*part.schema.names, "lang_pred", "score", "lang_mix"])

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column, part: int = 0, parts: int = 5) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text
    (a null id counts as the empty text)."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts)) == part
