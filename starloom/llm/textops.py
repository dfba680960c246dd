"""Vectorised text helpers used inside Arrow tasks.

A text is handled as its UTF-8 bytes. Words are the maximal runs of bytes
outside space and TAB..CR (`[^\\x20\\x09-\\x0D]+`), lower-cased in A-Z only;
neither rule touches multi-byte characters, so byte work is exact. All
functions take one Arrow string column, treat null as the empty text and
return NumPy arrays over all its documents at once.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

_U = np.uint64
_MULT = _U(0x9E3779B97F4A7C15)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
# ends a term: all of ASCII but letters and digits
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[48:58] = PUNCTUATION[65:91] = PUNCTUATION[97:123] = PUNCTUATION[128:] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a 64-bit word."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
        return x ^ (x >> _U(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _MULT)


def _powers(n: int) -> np.ndarray:
    p = np.full(max(n, 1), _MULT, dtype=np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


_POWERS = _powers(1 << 12)


_LIBC = ctypes.CDLL(None)


def release() -> None:
    """Give freed memory back to the system: Python workers outlive a task,
    and what the allocators keep would add up over the tasks of a job."""
    pa.default_memory_pool().release_unused()
    if hasattr(_LIBC, "malloc_trim"):
        _LIBC.malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that one slice holds about ``max_bytes`` of text
    (at least one row), which bounds the memory of the vectorised steps."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < n:
            base = ends[at - 1] if at else 0
            upto = max(at + 1, int(np.searchsorted(ends, base + max_bytes, side="right")))
            yield batch.slice(at, upto - at)
            at = upto
    release()


def raw(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, and where each text begins and ends in them."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs ``data[starts:ends]``, none empty."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    sizes = ends - starts
    ptr = np.cumsum(sizes) - sizes
    kind = np.int32 if len(data) < 1 << 31 else np.int64
    place = np.arange(ptr[-1] + sizes[-1], dtype=kind)
    inside = place - np.repeat(ptr.astype(kind), sizes)
    place += np.repeat((starts - ptr).astype(kind), sizes)
    longest = int(sizes.max())
    power = _POWERS if longest <= len(_POWERS) else _powers(longest)
    with np.errstate(over="ignore"):
        value = _BYTE.take(data.take(place))
        value *= power.take(inside)
        return mix(np.add.reduceat(value, ptr) + sizes.astype(np.uint64))


class Words:
    """All words of a column: ``starts``/``ends`` in ``data`` (lower-cased
    bytes), ``ptr`` (document i has words ptr[i]:ptr[i+1]), ``hashes``
    (64-bit, equal for equal words). ``breaks`` marks the bytes between words."""

    def __init__(self, column: pa.Array, hashes: bool = True, breaks: np.ndarray = _SPACE):
        data, offsets = raw(column)
        self.n_docs = len(offsets) - 1
        mask = ~breaks[data]
        n = len(data)
        before = np.empty(n, dtype=bool)
        after = np.empty(n, dtype=bool)
        if n:
            before[0], before[1:] = False, mask[:-1]
            after[-1], after[:-1] = False, mask[1:]
            cut = offsets[1:-1]
            before[cut[cut < n]] = False
            after[cut[cut > 0] - 1] = False
        self.starts = np.flatnonzero(mask & ~before)
        self.ends = np.flatnonzero(mask & ~after) + 1
        self.ptr = np.searchsorted(self.starts, offsets)
        self.data = LOWER[data]
        self.offsets = offsets
        if hashes:
            self.hashes = self._hash()

    def counts(self) -> np.ndarray:
        return np.diff(self.ptr)

    def doc_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_docs), self.counts())

    def _hash(self) -> np.ndarray:
        return run_hashes(self.data, self.starts, self.ends)

    def shingles(self, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
        """64-bit hashes of the distinct k-word runs, sorted within each
        document, and the pointer of documents into them. A document with
        1..k-1 words has its whole sequence as one shingle; without words it
        has none."""
        sizes = self.counts()
        h = self.hashes
        with np.errstate(over="ignore"):
            run = np.zeros(max(0, len(h) - k + 1), dtype=np.uint64)
            for j in range(k):
                run = run * _MULT + h[j:j + len(run)]
            run = mix(run + _U(k))
        out, ptr = [], np.zeros(self.n_docs + 1, dtype=np.int64)
        for i in range(self.n_docs):
            a, m = self.ptr[i], sizes[i]
            if m >= k:
                part = np.sort(run[a:a + m - k + 1])
                if len(part) > 1:
                    part = part[np.concatenate(([True], part[1:] != part[:-1]))]
            elif m:
                whole = _U(0)
                with np.errstate(over="ignore"):
                    for x in h[a:a + m]:
                        whole = whole * _MULT + x
                    part = mix(np.array([whole + _U(m)], dtype=np.uint64))
            else:
                part = run[:0]
            out.append(part)
            ptr[i + 1] = ptr[i] + len(part)
        return (np.concatenate(out) if out else run[:0]), ptr

    def padded(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of the words at ``index``, each between two spaces, joined;
        and the pointer of words into them."""
        starts, lengths = self.starts[index], (self.ends - self.starts)[index]
        ptr = np.zeros(len(index) + 1, dtype=np.int64)
        np.cumsum(lengths + 2, out=ptr[1:])
        out = np.full(ptr[-1], 32, dtype=np.uint8)
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        out[np.repeat(ptr[:-1] + 1, lengths) + inside] = self.data[np.repeat(starts, lengths) + inside]
        return out, ptr


def segment_sum(values: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (first axis) over the segments of ``ptr``; empty
    segments give 0."""
    total = np.zeros((len(ptr) - 1,) + values.shape[1:], dtype=values.dtype)
    full = ptr[1:] > ptr[:-1]
    if full.any():
        total[full] = np.add.reduceat(values, ptr[:-1][full], axis=0)
    return total


def ranges(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All integers of the half-open ranges, one range after the other."""
    sizes = ends - starts
    return np.repeat(starts - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


def extended(schema: StructType, **columns: str) -> StructType:
    """``schema`` and further columns, given as name=type."""
    return StructType([*schema.fields, *(StructField(n, _parse_datatype_string(t)) for n, t in columns.items())])


def packed(df: DataFrame, **own: Column) -> DataFrame:
    """``own`` columns beside ``row``, which holds all columns of ``df``: what
    a user's columns are called then clashes with nothing."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *[v.alias(k) for k, v in own.items()])


def unpacked(df: DataFrame, columns: list[str], **changed: Column) -> DataFrame:
    """The user's ``columns`` again, those in ``changed`` with new values."""
    return df.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in columns])
