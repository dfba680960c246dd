"""Spelling variant grouping with k-d trees over letter-count vectors.

Two words are near if one inserted, deleted or replaced letter turns one into
the other. Then their letter counts differ by at most two in sum: an insertion
adds one letter, a replacement moves one count to another letter. So near
words are found by box-pruned range searches in k-d trees over the count
vectors, one tree per word length, and each hit is verified letter by letter.

1. *Words* are counted by a map with partial sums.
2. *Cells.* The words of a length (all of them counted) are cut by the top of
   a k-d tree into cells of about ``cell_words``. Its splits (letter, count)
   are fitted on a bounded sample per length (``sample_words``); the sample
   decides only the shape, every word goes to its cell. Cells that
   nevertheless hold more, such as anagrams of one another, which no split
   parts, are dealt over several blocks.
3. *Search.* A word goes to its own cell, and as a search to every cell its
   near words may lie in: of its own length with one letter more and one, of
   higher rank, less, of the next length with one letter more. So a pair is
   found from one side only. Within a cell the words form a k-d tree, and all
   searches descend together; a box is left as soon as the letters it lacks
   or has too many exceed that budget. Words meet only in leaves.
4. Links give every word its number of near words and its form, the commonest
   near word that is at least ``ratio`` times as common. Forms become strictly
   commoner, so following them ends; pointers are doubled until none moves.

Letters are A-Z a-z (lower-cased) and U+00C0..U+00FF: a word is a Latin-1
byte string, whose byte order is code-point order.

Defined cases: null and empty texts have no words; a null document id leaves
words as they are (the typing errors of the contract need one); equal rows
count repeatedly; words of any length take part; equal counts choose the
smallest word; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .textops import LOWER, raw, release, slices

LETTERS = [*range(97, 123), *range(0xC0, 0x100)]
CELL_WORDS = 30_000     # words of one cell of the top tree, about
BLOCK_WORDS = 60_000    # words one search task holds as a tree at most
BLOCK_SEARCHES = 500_000  # searches it sends down that tree at most
SAMPLE_WORDS = 20_000   # words per length on which the top splits are fitted (more with many cells, up to
MOST_SAMPLED = 1_000_000  # this number)
LEAF = 24
SHORT = 64              # bytes up to which checksums are taken column by column

_RANK = np.full(256, -1, dtype=np.int64)
_RANK[LETTERS] = np.arange(len(LETTERS))
# a letter's place in the parity signature of a word
_BIT = np.where(_RANK >= 0, np.uint64(1) << (_RANK % 64).astype(np.uint64), np.uint64(0))


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, c >> 1 ^ np.uint32(0xEDB88320), c >> 1)
    return c


_CRC = _crc_table()


class Runs:
    """Letter runs of a column of texts: ``data`` (lower-cased UTF-8 bytes),
    ``starts``, ``ends`` and ``doc`` of each run."""

    def __init__(self, column: pa.Array):
        data, offsets = raw(column)
        data = LOWER[data]
        lead = data == 0xC3  # U+00C0..U+00FF are C3 80 .. C3 BF
        letter = (data >= 97) & (data <= 122) | lead
        letter[1:] |= lead[:-1]
        n = len(data)
        before, after = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
        before[1:], after[:-1] = letter, letter
        edge = np.zeros(n + 1, dtype=bool)
        edge[offsets] = True
        self.starts = np.flatnonzero(letter & (~before[:-1] | edge[:-1]))
        self.ends = np.flatnonzero(letter & (~after[1:] | edge[1:])) + 1
        self.doc = np.searchsorted(offsets, self.starts, side="right") - 1
        self.data, self.lead = data, lead

    def checksums(self, prefixes: list[bytes]) -> np.ndarray:
        """crc32 of each run's UTF-8 bytes behind its document's prefix."""
        first = np.array([zlib.crc32(p) for p in prefixes], dtype=np.uint32)
        sizes = self.ends - self.starts
        out = np.zeros(len(sizes), dtype=np.uint32)
        order = np.argsort(-sizes, kind="stable")
        order = order[np.searchsorted(-sizes[order], -SHORT):]
        state = ~first[self.doc[order]]
        at, size = self.starts[order], sizes[order]
        m, j = len(order), 0
        while m:
            state[:m] = _CRC[(state[:m] ^ self.data[at[:m] + j]) & 0xFF] ^ (state[:m] >> 8)
            j += 1
            m = int(np.searchsorted(-size, -j))
        out[order] = ~state
        for i in np.flatnonzero(sizes > SHORT):
            out[i] = zlib.crc32(self.data[self.starts[i]:self.ends[i]].tobytes(), int(first[self.doc[i]]))
        return out

    def latin(self) -> tuple[np.ndarray, np.ndarray]:
        """Latin-1 bytes of all runs one after the other, and the pointer of
        runs into them."""
        keep = ~self.lead
        code = self.data.copy()
        code[1:][self.lead[:-1]] += 0x40
        total = np.zeros(len(keep) + 1, dtype=np.int64)
        np.cumsum(keep, out=total[1:])
        sizes = total[self.ends] - total[self.starts]
        ptr = np.append(0, np.cumsum(sizes))
        at = np.repeat(total[self.starts] - ptr[:-1], sizes) + np.arange(ptr[-1])
        return code[keep][at], ptr


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typos: int = 0,
                min_length: int = 5, min_count: int = 3) -> DataFrame:
    """word (Latin-1 bytes), n. With ``typos``, a run whose crc32 of
    ``<doc_id>:<run>`` it divides loses the letter at crc32 % length."""
    def run(batches):
        for b in slices(batches, "text"):
            r = Runs(b.column("text"))
            data, ptr = r.latin()
            size = np.diff(ptr)
            if typos:
                ids = b.column("doc_id").to_pylist()
                h = r.checksums([b"" if i is None else f"{i}:".encode() for i in ids])
                known = np.array([i is not None for i in ids], dtype=bool)
                hit = np.flatnonzero((h % typos == 0) & known[r.doc]) if len(h) else np.zeros(0, dtype=np.int64)
                keep = np.ones(len(data), dtype=bool)
                keep[ptr[hit] + h[hit] % size[hit]] = False
                size[hit] -= 1
                data, ptr = data[keep], np.append(0, np.cumsum(size))
            long = np.flatnonzero(size >= min_length)
            words = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ptr.tobytes()),
                                                                         pa.py_buffer(data.tobytes())])
            counted = words.take(pa.array(long)).value_counts()
            yield pa.RecordBatch.from_arrays([counted.field(0).cast(pa.binary()), counted.field(1)], names=["word", "n"])

    docs = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return (docs.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= min_count))


def letter_matrix(words: np.ndarray) -> np.ndarray:
    """Letter counts of words given as rows of bytes padded with 0; one row
    of counts per letter."""
    n, width = words.shape
    out = np.empty((len(LETTERS), n), dtype=np.int16 if width < 30_000 else np.int32)
    step = max(1, (1 << 22) // (width + len(LETTERS)))
    for at in range(0, n, step):
        part = words[at:at + step]
        inside = part > 0
        flat = np.repeat(np.arange(len(part)), inside.sum(axis=1)) * len(LETTERS) + _RANK[part[inside]]
        out[:, at:at + step] = np.bincount(flat, minlength=len(part) * len(LETTERS)).reshape(len(part), -1).T
    return out


def signatures(words: np.ndarray) -> np.ndarray:
    """Parity of the letters' counts, one bit per letter (modulo 64): near
    words differ in at most two bits."""
    return np.bitwise_xor.reduce(_BIT[words], axis=1)


def best_split(counts: np.ndarray) -> tuple[int, int] | None:
    """(letter, count): the cut ``<= count`` that halves the words best; none
    where all count vectors are equal."""
    n, best, found = counts.shape[1], 0, None
    c, top = int(counts.min(initial=0)), int(counts.max(initial=0))
    while c < top and best < n // 2:
        low = (counts <= c).sum(axis=1)
        even = np.minimum(low, n - low)
        letter = int(even.argmax())
        if even[letter] > best:
            best, found = int(even[letter]), (letter, c)
        if c > 8 and found:
            break
        c += 1
    return found


class Searches:
    """Searches on their way down a tree. ``counts`` are the letter counts of
    all words; of each search its word (``row``), the letter it has gained
    (``up``) or lost (``down``) to get into the box (-1 for none), and whether
    it may ``replace``. A replacement gains one letter and loses one of higher
    rank, an insertion only gains; a box that asks for more is pruned."""

    def __init__(self, counts: np.ndarray, row: np.ndarray, replace: np.ndarray, up=None, down=None):
        none = np.full(len(row), -1, dtype=np.int16)
        self.counts, self.row, self.replace = counts, row, replace
        self.up, self.down = none if up is None else up, none if down is None else down

    def parted(self, letter: int, c: int) -> tuple[Searches, Searches]:
        """The searches that go on to ``<= c``, and those to ``> c``."""
        own, up, down = self.counts[letter][self.row], self.up, self.down
        gained, lost = up == letter, down == letter
        now = own + gained - lost
        free = ~(gained | lost)
        stays = now <= c
        loses = free & (own == c + 1) & self.replace & (down < 0) & (up < letter)
        gains = free & (own == c) & (up < 0) & ((down < 0) | (down > letter))
        return self._take(stays | loses, None, np.where(loses, letter, down)), self._take(
            ~stays | gains, np.where(gains, letter, up), None)

    def _take(self, keep: np.ndarray, up, down) -> Searches:
        up, down = self.up if up is None else up, self.down if down is None else down
        return Searches(self.counts, self.row[keep], self.replace[keep], up[keep].astype(np.int16),
                        down[keep].astype(np.int16))


class TopTree:
    """Splits of one length's words into cells."""

    def __init__(self, counts: np.ndarray, leaves: int, numbers: Iterator[int]):
        self.split = best_split(counts) if leaves > 1 else None
        if self.split is None:
            self.cell = next(numbers)
            return
        letter, c = self.split
        low = counts[letter] <= c
        left = max(1, min(leaves - 1, round(leaves * float(low.mean()))))
        self.low = TopTree(counts[:, low], left, numbers)
        self.high = TopTree(counts[:, ~low], leaves - left, numbers)

    def place(self, counts: np.ndarray, rows: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, its words)."""
        if not len(rows):
            return
        if self.split is None:
            yield self.cell, rows
            return
        letter, c = self.split
        low = counts[letter][rows] <= c
        yield from self.low.place(counts, rows[low])
        yield from self.high.place(counts, rows[~low])

    def search(self, s: Searches) -> Iterator[tuple[int, np.ndarray]]:
        """(cell, words that search in it)."""
        if not len(s.row):
            return
        if self.split is None:
            yield self.cell, s.row
            return
        low, high = s.parted(*self.split)
        yield from self.low.search(low)
        yield from self.high.search(high)


def padded(words: list[bytes], width: int) -> np.ndarray:
    """Words as rows of bytes, padded with 0."""
    return np.array(words, dtype=f"S{width}").reshape(-1, 1).view(np.uint8).reshape(len(words), width)


def fit_cells(words: DataFrame, cell_words: int, sample_words: int) -> dict[int, TopTree]:
    """A top tree for every word length."""
    sizes = {r.size: r.n for r in words.groupBy(F.octet_length("word").alias("size"))
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    leaves = {size: -(-n // cell_words) for size, n in sizes.items()}
    split = [size for size in sizes if leaves[size] > 1]
    samples: dict[int, list] = {size: [] for size in split}
    if split:
        # a fixed share of each length, by hash
        share = F.lit(0.0)
        for size in split:
            wanted = min(max(sample_words, 32 * leaves[size]), MOST_SAMPLED)
            share = F.when(F.octet_length("word") == size, F.lit(min(1.0, wanted / sizes[size]))).otherwise(share)
        drawn = F.pmod(F.xxhash64("word"), F.lit(1 << 20)) < share * (1 << 20)
        for r in words.filter(drawn).select("word").collect():
            samples[len(r.word)].append(bytes(r.word))
    numbers = itertools.count()
    return {size: TopTree(letter_matrix(padded(sorted(samples.get(size, [])), size)), leaves[size], numbers)
            for size in sorted(sizes)}


def deal(words: list[bytes], trees: dict[int, TopTree]) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """(cell, length in the cell, kind, rows): 0 words of the cell, 1 searches
    for replacements, 2 for insertions."""
    sizes = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        counts = letter_matrix(padded([words[i] for i in rows], size))
        own = np.arange(len(rows))
        for cell, at in trees[size].place(counts, own):
            yield cell, size, 0, rows[at]
        for cell, at in trees[size].search(Searches(counts, own, np.ones(len(own), dtype=bool))):
            yield cell, size, 1, rows[at]
        if size + 1 in trees:
            for cell, at in trees[size + 1].search(Searches(counts, own, np.zeros(len(own), dtype=bool))):
                yield cell, size + 1, 2, rows[at]


class Matches:
    """Pairs (search, word) of one block: candidates from the leaves of a k-d
    tree over the words, verified letter by letter."""

    MOST = 1 << 20

    def __init__(self, points: np.ndarray, searches: np.ndarray, replace: np.ndarray):
        self.points, self.searches, self.replace = points, searches, replace
        self.counts = letter_matrix(points)
        self.sign, self.own = signatures(points), signatures(searches)
        self.found, self.held, self.size = [], [], 0
        self._descend(np.arange(len(points)), Searches(letter_matrix(searches), np.arange(len(searches)), replace))
        self._verify()

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.found:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        return np.concatenate([a for a, _ in self.found]), np.concatenate([b for _, b in self.found])

    def _descend(self, rows: np.ndarray, s: Searches) -> None:
        if not len(rows) or not len(s.row):
            return
        split = best_split(self.counts[:, rows]) if len(rows) > LEAF else None
        if split is None:
            step = max(1, self.MOST // len(rows))
            for at in range(0, len(s.row), step):
                self._leaf(rows, s.row[at:at + step])
            return
        low = self.counts[split[0]][rows] <= split[1]
        below, above = s.parted(*split)
        self._descend(rows[low], below)
        self._descend(rows[~low], above)

    def _leaf(self, rows: np.ndarray, mine: np.ndarray) -> None:
        a, b = np.nonzero(np.bitwise_count(self.own[mine][:, None] ^ self.sign[rows][None, :]) <= 2)
        if len(a):
            self.held.append((mine[a], rows[b]))
            self.size += len(a)
            if self.size * self.points.shape[1] > 1 << 25:
                self._verify()

    def _verify(self) -> None:
        if not self.held:
            return
        a, b = (np.concatenate(x) for x in zip(*self.held))
        self.held, self.size = [], 0
        step = max(1, (1 << 25) // self.points.shape[1])
        for at in range(0, len(a), step):
            s, p = a[at:at + step], b[at:at + step]
            for kind, check in ((True, self._replaced), (False, self._inserted)):
                mine = self.replace[s] == kind
                ok = check(self.searches[s[mine]], self.points[p[mine]])
                self.found.append((s[mine][ok], p[mine][ok]))

    @staticmethod
    def _replaced(search: np.ndarray, word: np.ndarray) -> np.ndarray:
        other = search != word
        at = other.argmax(axis=1)[:, None] if len(other) else np.zeros((0, 1), dtype=np.int64)
        lower = np.take_along_axis(word, at, 1) < np.take_along_axis(search, at, 1)
        return (other.sum(axis=1) == 1) & lower[:, 0]

    @staticmethod
    def _inserted(search: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Equal up to a place, and shifted by one behind it."""
        n = word.shape[1] - 1
        ahead, behind = search[:, :n] != word[:, :n], search[:, :n] != word[:, 1:]
        first = np.where(ahead.any(axis=1), ahead.argmax(axis=1) if n else 0, n)
        last = np.where(behind.any(axis=1), n - 1 - behind[:, ::-1].argmax(axis=1) if n else 0, -1)
        return last < first


def near_words(words: DataFrame, trees: dict[int, TopTree], block_words: int, block_searches: int) -> DataFrame:
    """word, n_near, form_n, form of every word with a near word: their
    number, and the commonest (smallest of equals)."""
    def sizes(batches):
        for b in batches:
            rows = [(cell, kind, len(at)) for cell, _, kind, at in deal(b.column("word").to_pylist(), trees)]
            cell, kind, n = zip(*rows) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int64()), pa.array([k > 0 for k in kind], pa.bool_()),
                                              pa.array(n, pa.int64())], names=["cell", "searches", "n"])

    limit = F.when(F.col("searches"), block_searches).otherwise(block_words)
    over = (words.select("word").mapInArrow(sizes, "cell long, searches boolean, n long").groupBy("cell", "searches")
            .agg(F.sum("n").alias("n")).filter(F.col("n") > limit).collect())
    parts = {(r.cell, r.searches): -(-r.n // (block_searches if r.searches else block_words)) for r in over}

    def dealt(batches):
        """Words and searches of each block, packed. A cell above a limit has
        several blocks: each word in one, each search with each of them."""
        for b in batches:
            names = b.column("word").to_pylist()
            n = b.column("n").to_numpy(zero_copy_only=False)
            out = []
            for cell, size, kind, rows in deal(names, trees):
                own, other = parts.get((cell, kind > 0), 1), parts.get((cell, kind == 0), 1)
                mine = np.array([zlib.crc32(names[i]) % own for i in rows]) if own > 1 else np.zeros(len(rows), dtype=int)
                for i in range(own):
                    at = rows[mine == i]
                    if len(at):
                        packed = padded([names[j] for j in at], size).tobytes(), n[at].tobytes()
                        out += [(cell, *((j, i) if kind else (i, j)), size, kind, *packed) for j in range(other)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 5 + [pa.binary()] * 2)],
                    names=["cell", "block", "part", "size", "kind", "words", "counts"])
        release()

    def searched(table):
        size = table.column("size")[0].as_py()
        kind = table.column("kind").to_numpy()
        words = [np.frombuffer(w.as_buffer(), dtype=np.uint8).reshape(-1, size) for w in table.column("words")]
        counts = [np.frombuffer(c.as_buffer(), dtype=np.int64) for c in table.column("counts")]

        def of(chosen):
            at = np.flatnonzero(chosen)
            if not len(at):
                return np.zeros((0, size), dtype=np.uint8), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=bool)
            return (np.concatenate([words[i] for i in at]), np.concatenate([counts[i] for i in at]),
                    np.repeat(kind[at] == 1, [len(words[i]) for i in at]))
        points, n_points, _ = of(kind == 0)
        own, n_own, replace = of(kind > 0)
        if len(points) and len(own):
            a, b = Matches(points, own, replace).pairs()
        else:
            a = b = np.zeros(0, dtype=np.int64)
        # both ends of each link, in one numbering: words first, then searches
        every, n = np.concatenate([points, own]), np.concatenate([n_points, n_own])
        text = np.ascontiguousarray(every).view(f"S{size}").ravel()
        x, y = np.concatenate([b, a + len(points)]), np.concatenate([a + len(points), b])
        used = np.unique(x)
        rank = np.zeros(len(every), dtype=np.int64)
        rank[used[np.argsort(text[used], kind="stable")]] = np.arange(len(used))
        order = np.lexsort((rank[y], -n[y], x))
        x, y = x[order], y[order]
        at = np.searchsorted(x, used)
        names = ["word", "n_near", "form_n", "form"]
        columns = [pa.array(text[used].tolist(), pa.binary()), pa.array(np.diff(np.append(at, len(x))), pa.int64()),
                   pa.array(n[y[at]] if len(at) else [], pa.int64()),
                   pa.array(text[y[at]].tolist() if len(at) else [], pa.binary())]
        release()
        return pa.Table.from_arrays(columns, names=names)

    blocks = words.select("word", "n").mapInArrow(dealt, "cell long, block long, part long, size long, kind long, words binary, counts binary")
    found = blocks.groupBy("cell", "block", "part").applyInArrow(searched, "word binary, n_near long, form_n long, form binary")
    best = F.min(F.struct((-F.col("form_n")).alias("n"), "form"))
    return (found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best"))
            .select("word", "n_near", (-F.col("best.n")).alias("form_n"), F.col("best.form").alias("form")))


def roots(links: DataFrame) -> DataFrame:
    """word, root: ends of the pointers word -> form, by doubling."""
    now = links.select("word", F.col("form").alias("root"))
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        now = (now.join(ahead, "root", "left")
               .select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("moved"))
               .checkpoint(eager=True))
        if not now.filter("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def group_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", typos: int = 0, min_length: int = 5,
                   min_count: int = 3, ratio: int = 2, cell_words: int = CELL_WORDS, block_words: int = BLOCK_WORDS,
                   block_searches: int = BLOCK_SEARCHES, sample_words: int = SAMPLE_WORDS) -> DataFrame:
    """word, n, n_near, form, form_n, root of all words of at least
    ``min_length`` letters and ``min_count`` occurrences."""
    words = word_counts(docs, id_col, text_col, typos, min_length, min_count).checkpoint(eager=True)
    trees = fit_cells(words, cell_words, sample_words)
    near = near_words(words, trees, block_words, block_searches)
    both = words.join(near, "word", "left").withColumn("form_n", F.expr(f"CASE WHEN form_n >= {ratio} * n THEN form_n END"))
    both = both.withColumn("form", F.expr("CASE WHEN form_n IS NOT NULL THEN form END")).checkpoint(eager=True)
    ends = roots(both.filter("form IS NOT NULL"))

    def text(c):
        return F.decode(c, "ISO-8859-1")
    return both.join(ends, "word", "left").select(
        text(F.col("word")).alias("word"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        text(F.col("form")).alias("form"), "form_n", text(F.coalesce("root", "word")).alias("root"))
