"""Harmonic packing of tokenised documents into fixed-length sequences.

A piece of length n belongs to class k = floor(capacity / n), that is to the
lengths in (capacity/(k+1), capacity/k]; a bin of class k is closed as soon
as it holds k pieces, whatever their exact lengths, so no search over bins
is needed and every worker fills its own bins. Documents may be cut: whole
sequences are cut off first, and a remainder that would leave too much of
its slot empty gives up a head of exactly floor(capacity/(k+1)) tokens,
which fills a slot of the next class, before the rest is classed again.
When a worker ends, the pieces of its unfinished bins are laid end to end
into full sequences, and the last few tokens into sequences of power-of-two
lengths, which need no padding.

The job has no shuffle: a partition of documents gives a partition of
sequences, and a lost task is rerun with the same result. Memory per worker:
the open bins (under one sequence per class) and the bounded word cache.

Defined cases: a null or empty text has the end id alone; a null or repeated
document id is carried as it is; equal rows are packed separately; extra
columns of the input are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import json
import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from .textops import Words, ranges, raw, release, run_hashes, slices

# Distinct words whose ids one Python worker remembers, in packed arrays (some
# 30 bytes a word). Beyond, the half seen least often is forgotten and encoded
# again where it returns, so a vocabulary of any size costs bounded memory.
WORD_CACHE = 800_000

_ALPHA = np.zeros(256, dtype=bool)  # ASCII letters
_ALPHA[65:91] = _ALPHA[97:123] = True


class WordIds:
    """Ids of texts, by a cache of the ids of words.

    Valid for tokenizers that drop white space and never join text across it
    (``splits`` tells): a text's ids are then the ids of its words, one after
    the other. A comma or full stop behind a letter is a word of its own, and
    words of ASCII letters are lower-cased first, if the tokenizer treats them
    so. New words are encoded in one call for many; where a word is surely one
    unit of the tokenizer (Latin letters only) several words share an
    encoding, cut again at the ids that end a word."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        probe = ["Ab", "c,", "don't", "\u00e9t\u00e9", "12", "<|endoftext|>x"]
        self.splits = self._ids(" \n".join(probe)) == b"".join(map(self._ids, probe))
        self.splits = self.splits and self._ids("Ab, d.") == b"".join(map(self._ids, ["ab", ",", "d", "."]))
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.ends_word = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        self.marked = bool(suffix)
        if suffix:
            self.ends_word[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        self.keys = np.zeros(0, dtype=np.uint64)     # hashes of the known words, ascending
        self.check = np.zeros(0, dtype=np.uint32)    # a second hash of each
        self.start = np.zeros(0, dtype=np.int64)     # where its ids begin in ``ids``
        self.size = np.zeros(0, dtype=np.int32)
        self.hits = np.zeros(0, dtype=np.int32)
        self.ids = np.zeros(0, dtype=np.uint32)

    def _ids(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def text_ids(self, texts: list[bytes]) -> list[bytes]:
        if not self.splits:
            return [self._ids(t.decode("utf-8")) for t in texts]
        flat, ptr = self._text_ids(pa.array(texts, pa.large_binary()).cast(pa.large_string()))
        return [flat[a:b].tobytes() for a, b in zip(ptr[:-1].tolist(), ptr[1:].tolist())]

    def _text_ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, and the pointer of texts into them."""
        words = Words(column, hashes=False)
        data, _ = raw(column)
        starts, ends = words.starts, words.ends
        tail = (ends - starts > 1) & ((data[ends - 1] == 44) | (data[ends - 1] == 46)) & _ALPHA[data[ends - 2]]
        # a tail is a word behind its word
        place = np.arange(len(starts)) + np.cumsum(tail) - tail
        n = len(starts) + int(tail.sum())
        first, last = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
        first[place], last[place] = starts, ends - tail
        first[place[tail] + 1], last[place[tail] + 1] = ends[tail] - 1, ends[tail]
        letters = np.append(0, np.cumsum(_ALPHA[data], dtype=np.int32))
        plain = letters[last] - letters[first] == last - first
        edge = np.zeros(len(data) + 1, dtype=np.int8)
        edge[first[plain]] += 1
        edge[last[plain]] -= 1
        data = np.where(np.cumsum(edge[:-1], dtype=np.int8) > 0, words.data, data)
        key, at, word = np.unique(run_hashes(data, first, last), return_index=True, return_inverse=True)
        start, size = self._known(data, key, first[at], last[at])
        size = size[word]
        flat = self.ids[ranges(start[word], start[word] + size)]
        total = np.append(0, np.cumsum(size))
        return flat, total[np.searchsorted(first, words.offsets)]

    def _known(self, data: np.ndarray, key: np.ndarray, first: np.ndarray, last: np.ndarray):
        """Start and size of the ids of the distinct words ``data[first:last]``."""
        if len(self.keys) > WORD_CACHE:
            self._forget()
        sums = np.append(0, np.cumsum(data, dtype=np.int64))
        check = ((sums[last] - sums[first]) + (last - first) * 65_537).astype(np.uint32)
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, max(0, len(self.keys) - 1))
        held = (self.keys[near] == key) if len(self.keys) else np.zeros(len(key), dtype=bool)
        new = np.flatnonzero(~held)
        if len(new):
            ids, size = self._encode([data[a:b].tobytes() for a, b in zip(first[new].tolist(), last[new].tolist())])
            start = len(self.ids) + np.cumsum(size) - size
            self.ids = np.concatenate([self.ids, ids])
            self.keys, self.check, self.start, self.size, self.hits = (
                np.insert(old, at[new], more) for old, more in (
                    (self.keys, key[new]), (self.check, check[new]), (self.start, start), (self.size, size), (self.hits, 0)))
            at = np.searchsorted(self.keys, key)
        self.hits[at] += 1
        start, size = self.start[at], self.size[at]
        other = np.flatnonzero(self.check[at] != check)  # another word of the same hash
        if len(other):
            ids, more = self._encode([data[a:b].tobytes() for a, b in zip(first[other].tolist(), last[other].tolist())])
            start[other], size[other] = len(self.ids) + np.cumsum(more) - more, more
            self.ids = np.concatenate([self.ids, ids])
        return start, size

    def _forget(self) -> None:
        keep = np.zeros(len(self.keys), dtype=bool)
        keep[np.argpartition(-self.hits, WORD_CACHE // 2)[:WORD_CACHE // 2]] = True
        self.ids = self.ids[ranges(self.start[keep], self.start[keep] + self.size[keep])]
        self.keys, self.check, self.size = self.keys[keep], self.check[keep], self.size[keep]
        self.hits = self.hits[keep] >> 1  # what was common long ago counts less
        self.start = np.cumsum(self.size, dtype=np.int64) - self.size

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, one word after the other, and each word's number."""
        plain, rest, texts = [], [], []
        for i, word in enumerate(words):
            text = word.decode("utf-8")
            texts.append(text)
            whole = word.isalpha() or (text.isalpha() and max(text) <= "\u017f" and "\u0130" not in text)
            (plain if whole and self.marked else rest).append(i)
        found: list[np.ndarray] = []
        order: list[int] = []
        sizes: list[np.ndarray] = []
        groups = [plain[i:i + 200] for i in range(0, len(plain), 200)]
        joined = self.tokenizer.encode_batch_fast([" ".join([texts[i] for i in g]) for g in groups], add_special_tokens=False)
        for group, code in zip(groups, joined):
            ids = np.array(code.ids, dtype=np.uint32)
            at = np.flatnonzero(self.ends_word[ids]) + 1
            if len(at) != len(group) or at[-1] != len(ids):  # not one unit each after all
                rest += group
                continue
            found.append(ids)
            order += group
            sizes.append(np.diff(at, prepend=0))
        for i, code in zip(rest, self.tokenizer.encode_batch_fast([texts[i] for i in rest], add_special_tokens=False)):
            found.append(np.array(code.ids, dtype=np.uint32))
            order.append(i)
            sizes.append(np.array([len(code.ids)]))
        size = np.concatenate(sizes)
        start = np.cumsum(size) - size
        back = np.empty(len(words), dtype=np.int64)
        back[order] = np.arange(len(words))
        ids = np.concatenate(found)
        return ids[ranges(start[back], start[back] + size[back])], size[back].astype(np.int32)


_CODERS: dict[str, WordIds] = {}


def coder(path: str) -> WordIds:
    """One coder per worker process and vocabulary file."""
    if path not in _CODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _CODERS[path] = WordIds(path)
    return _CODERS[path]


def cuts(n: int, capacity: int, slack: int) -> list[tuple[int, int]]:
    """(length, class) of the pieces of a document of n tokens, in order.
    ``slack``: a piece may leave 1/slack of its slot empty."""
    out = [(capacity, 1)] * (n // capacity)
    rest = n % capacity
    while rest:
        k = capacity // rest
        if (capacity // k - rest) * slack <= rest:
            out.append((rest, k))
            break
        head = capacity // (k + 1)
        out.append((head, k + 1))
        rest -= head
    return out


class Packer:
    """Open bins of one worker. ``add`` and ``finish`` yield closed sequences
    as lists of (doc_id, start, ids bytes, doc_tokens)."""

    def __init__(self, capacity: int, slack: int):
        self.capacity, self.slack, self.open = capacity, slack, {}

    def add(self, doc_id, ids: bytes) -> Iterator[list]:
        n, at = len(ids) // 4, 0
        for length, k in cuts(n, self.capacity, self.slack):
            piece = (doc_id, at, ids[4 * at:4 * (at + length)], n)
            at += length
            if k == 1:
                yield [piece]
                continue
            pieces = self.open.setdefault(k, [])
            pieces.append(piece)
            if len(pieces) == k:
                del self.open[k]
                yield pieces

    def finish(self) -> Iterator[list]:
        left = [p for k in sorted(self.open) for p in self.open[k]]
        self.open = {}
        total = sum(len(p[2]) // 4 for p in left)
        sizes = [self.capacity] * (total // self.capacity)
        rest = total % self.capacity
        sizes += [1 << b for b in reversed(range(rest.bit_length())) if rest >> b & 1]
        left.reverse()
        for size in sizes:
            pieces, room = [], size
            while room:
                doc_id, start, ids, n = left.pop()
                length = len(ids) // 4
                if length > room:
                    left.append((doc_id, start + room, ids[4 * room:], n))
                    ids, length = ids[:4 * room], room
                pieces.append((doc_id, start, ids, n))
                room -= length
            yield pieces


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
         capacity: int = 4096, end_id: int = 2, slack: int = 64, with_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset and, with ``with_ids``, the ids themselves.

    A document's ids are those of its text, then ``end_id``. ``sequence_id``
    is unique over the table (partition number in the high bits)."""
    schema = ("doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "`offset` long").format(docs.select(F.col(id_col)).dtypes[0][1])
    if with_ids:
        schema += ", ids binary"
    end = array("I", [end_id]).tobytes()

    def run(batches):
        words, packer = coder(tokenizer_path), Packer(capacity, slack)
        number = TaskContext.get().partitionId() << 40
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] + ["ids"] * with_ids
        types = None

        def rows(sequences, out):
            nonlocal number
            for pieces in sequences:
                at = 0
                for doc_id, start, ids, n in pieces:
                    length = len(ids) // 4
                    out.append((doc_id, start, length, zlib.crc32(ids), n, number, at) + ((ids,) if with_ids else ()))
                    at += length
                number += 1

        def batch(out):
            columns = list(zip(*out))
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(columns, types)], names=names)

        for b in batches:
            types = [b.column(0).type] + [pa.int64()] * 6 + [pa.binary()] * with_ids
            out = []
            for part in slices([b], "text"):
                texts = words.text_ids([t or b"" for t in part.column(1).cast(pa.large_binary()).to_pylist()])
                for doc_id, ids in zip(part.column(0).to_pylist(), texts):
                    rows(packer.add(doc_id, ids + end), out)
            if out:
                yield batch(out)
        if types:
            out = []
            rows(packer.finish(), out)
            if out:
                yield batch(out)
        release()

    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)
