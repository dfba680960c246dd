"""Quality classifier by co-training.

Two views of a document: its text (hashed words and character statistics)
and its page metadata (source, language, stated length). Each view has its own
classifier, a ridge logistic regression. They learn from a bounded sample of
labelled documents and exchange pseudo-labels over rounds: in every round each
view scores all unlabelled documents and hands the other, of each class, the
share that it is surest of (growing with the rounds) and all others that it is
confident of (odds of nine to one), weighted so that the classes keep the
shares they have among the labels. So both views teach in every round; one
that gives all documents the same score hands over none. A view keeps what it
has learned only if it tells labelled documents that it has not learned from
apart at least as well as before; rounds end when neither view gains. Each
view is then calibrated on those documents, the calibrated views are combined
there, and all documents are scored in one map.

How it is spread: the features of the unlabelled documents are written once.
A round's cuts come from one pass that counts all scores in ``BINS`` bins.
A Newton step of both views is one pass over them: every task sums loss,
gradient and curvature of its confident documents (numbers of fixed length, as
integers, so the order of adding does not matter), tasks add them up by parts,
and the driver gets one such sum. A step that raises the loss is halved.

Bounds: at most about ``max_labelled`` labelled documents (chosen by a hash of
the id, one row per id) reach the driver, as feature vectors of fixed width.
Nothing else is sampled.

Defined cases: a null or empty text has zero features; null metadata is a
value of its own; several labels of one document count as the worst; null
labels and ids are no labels; without labels of both classes every score is
the share of good labels (1 without labels); repeated rows score alike, and
a labelled id with several texts teaches its smallest row; extra columns are ignored; empty table, empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import uuid
import zlib
from pyspark.sql import DataFrame, functions as F

from starloom.session import ensure_checkpoint_dir
from starloom.sinks.publish import delete

from .textops import Words, raw, segment_sum, slices

WORD_BUCKETS = 512
SOURCE_BUCKETS = 64
LANG_BUCKETS = 16
_CLASS = np.zeros(256, dtype=np.int64)  # character classes of bytes
_CLASS[48:58] = 1
_CLASS[65:91] = 2
_CLASS[97:123] = 3
_CLASS[128:] = 4
_CLASS[[32, 9, 10, 11, 12, 13]] = 5
_CLASS[[ord(c) for c in ".,;:'\"-?"]] = 6
_CLASS[[ord(c) for c in "#$%&*!|@^~+=<>_/\\{}[]()`"]] = 7
CLASSES = 8
WIDTHS = WORD_BUCKETS + CLASSES + 4, SOURCE_BUCKETS + LANG_BUCKETS + 3
CONFIDENT = float(np.log(9))  # log odds
SHARES = (0.05, 0.1, 0.2, 0.3, 0.4)  # of each class, by round
BINS = 4096
GAIN = 1e-3  # fall of the held-out loss by which a view gains
STEPS = 12  # Newton steps of a round
SMALL = 1e-3  # change of a coefficient that ends the steps, and the rounds
PARTS = 16
SCALE = float(1 << 24)  # sums travel as integers of this fraction


def content_features(column: pa.Array) -> np.ndarray:
    """[documents, WORD_BUCKETS + CLASSES + 4]: square roots of word shares,
    shares of character classes, repeated neighbours, word length, size."""
    words = Words(column)
    data, offsets = raw(column)
    n, size = words.n_docs, np.maximum(words.counts(), 1)[:, None]
    doc = words.doc_of_word()
    bucket = (words.hashes % np.uint64(WORD_BUCKETS)).astype(np.int64)
    share = np.bincount(doc * WORD_BUCKETS + bucket, minlength=n * WORD_BUCKETS).reshape(n, -1) / size
    length = np.diff(offsets)
    kind = _CLASS[data] + np.repeat(np.arange(n), length) * CLASSES
    kinds = np.bincount(kind, minlength=n * CLASSES).reshape(n, -1) / np.maximum(length, 1)[:, None]
    h, extra = words.hashes, np.zeros((n, 4))
    for k in (1, 2):
        same = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
        extra[:, k - 1] = np.bincount(doc[k:][same], minlength=n) / size[:, 0]
    extra[:, 2] = segment_sum((words.ends - words.starts).astype(float), words.ptr) / size[:, 0] / 10
    extra[:, 3] = np.log1p(words.counts()) / 10
    return np.hstack([np.sqrt(share), kinds, extra]).astype(np.float32)


def metadata_features(source: list, lang: list, n_chars: list) -> np.ndarray:
    """[documents, ...]: hashed source and language, stated length."""
    n = len(source)
    out = np.zeros((n, SOURCE_BUCKETS + LANG_BUCKETS + 3), dtype=np.float32)
    for i, (s, g, c) in enumerate(zip(source, lang, n_chars)):
        out[i, zlib.crc32((s or "\0").encode()) % SOURCE_BUCKETS] = 1
        out[i, SOURCE_BUCKETS + zlib.crc32((g or "\0").encode()) % LANG_BUCKETS] = 1
        size = np.log1p(max(c, 0)) / 10 if c is not None else 0.0
        out[i, -3:] = size, size * size, c is None
    return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Logistic regression by Newton steps; last coefficient is the bias."""
    x = np.hstack([x.astype(np.float64), np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    weight = np.ones(len(x)) if weight is None else weight
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (weight * (p - y)) + penalty * w
        curve = (x * (weight * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def logit(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return np.clip(x @ w[:-1] + w[-1], -30, 30)


def _sigmoid(z):
    return 1 / (1 + np.exp(-z))


@dataclass
class Model:
    """Classifier weights and calibration (slope, bias) of each view, and the
    weights of the combination; or a constant."""
    views: list | None = None
    calibration: list | None = None
    combine: np.ndarray | None = None
    constant: float = 1.0
    labelled: int = 0  # labelled documents learned from or calibrated on
    taken: tuple = (0, 0)  # documents that each view was handed in the last round that taught it

    def scores(self, xs: list[np.ndarray]) -> np.ndarray:
        """[documents, 3]: calibrated content, metadata, combined."""
        if self.views is None:
            return np.full((len(xs[0]), 3), self.constant)
        z = [a * logit(x, w) + b for x, w, (a, b) in zip(xs, self.views, self.calibration)]
        return np.stack([_sigmoid(z[0]), _sigmoid(z[1]), _sigmoid(logit(np.stack(z, 1), self.combine))], axis=1)


def _sums(x: np.ndarray, y: float | np.ndarray, w: np.ndarray) -> np.ndarray:
    """Number, loss, gradient and upper curvature of rows with label ``y``."""
    z = logit(x, w)
    p = _sigmoid(z)
    one = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    curve = (one * np.maximum(p * (1 - p), 1e-6).astype(x.dtype)[:, None]).T @ one
    loss = np.logaddexp(0, z).sum() - (y * z).sum()
    return np.concatenate([[len(x), loss], (p - y) @ one, curve[np.triu_indices(len(w))].astype(np.float64)])


def _opened(v: np.ndarray, width: int) -> tuple[float, np.ndarray, np.ndarray]:
    """Loss, gradient and full curvature of sums as in ``_sums``."""
    n = width + 1
    curve = np.zeros((n, n))
    curve[np.triu_indices(n)] = v[2 + n:]
    return v[1], v[2:2 + n], curve + np.triu(curve, 1).T


_PACKED = [2 + (w + 1) + (w + 1) * (w + 2) // 2 for w in WIDTHS for _ in (0, 1)]  # view 0 by label, view 1 by label


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    n, at = len(column), column.offset
    if not n:
        return np.zeros((0, width), dtype=np.float32)
    ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[at:at + n + 1]
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0]:ends[-1]].view(np.float32).reshape(n, width)


def _bin(z: np.ndarray) -> np.ndarray:
    return np.clip(((z + 30) * (BINS / 60)).astype(np.int64), 0, BINS - 1)


def _cuts(rows: DataFrame, weights: list[np.ndarray], good: float, share: float) -> list[tuple[float, float]]:
    """Per view the log odds up to which a document is handed over as bad, and
    from which as good (no document where the two meet)."""
    spread = rows.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        total = np.zeros((2, BINS), dtype=np.int64)
        for b in batches:
            for view, w in enumerate(spread.value):
                total[view] += np.bincount(_bin(logit(_matrix(b.column(view), WIDTHS[view]), w)), minlength=BINS)
        view, at = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(view, pa.int32()), pa.array(at, pa.int32()), pa.array(total[view, at])],
                                         names=["view", "bin", "n"])

    hist = np.zeros((2, BINS), dtype=np.int64)
    for r in rows.mapInArrow(run, "view int, bin int, n long").groupBy("view", "bin").agg(F.sum("n").alias("n")).collect():
        hist[r["view"], r["bin"]] = r["n"]  # at most 2 * BINS rows
    spread.destroy()
    out = []
    for h in hist:
        n = h.sum()
        low = np.searchsorted(np.cumsum(h), share * (1 - good) * n)
        high = BINS - 1 - np.searchsorted(np.cumsum(h[::-1]), share * good * n)
        bad_to, good_from = max((low + 1) * 60 / BINS - 30, -CONFIDENT), min(high * 60 / BINS - 30, CONFIDENT)
        out.append((bad_to, good_from) if n and low < high else (-np.inf, np.inf))
    return out


def _pass(rows: DataFrame, label_by: list[np.ndarray], cuts: list[tuple[float, float]], at: list[np.ndarray]) -> list[np.ndarray]:
    """``_sums`` at the weights ``at`` over all documents that the other view
    hands over by the weights ``label_by`` and its ``cuts``: view 0 with label 0
    and 1, view 1 with label 0 and 1."""
    spread = rows.sparkSession.sparkContext.broadcast((label_by, at))
    schema = pa.schema([("part", pa.int32()), ("sums", pa.binary())])

    def run(batches):
        label_by, at = spread.value
        total = None
        for b in batches:
            xs = [_matrix(b.column(i), w) for i, w in enumerate(WIDTHS)]
            zs = [logit(x, w) for x, w in zip(xs, label_by)]
            own = np.concatenate([_sums(xs[view][chosen], label, at[view]) for view in (0, 1) for label, chosen in (
                (0.0, zs[1 - view] < cuts[1 - view][0]), (1.0, zs[1 - view] >= cuts[1 - view][1]))])
            total = own if total is None else total + own
        if total is not None:
            fixed = np.rint(total * SCALE).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(
                [fixed[p::PARTS].tobytes() for p in range(PARTS)], pa.binary())], schema=schema)

    def add(batches):
        total = {}
        for b in batches:
            for part, sums in zip(b.column(0).to_pylist(), b.column(1)):
                total[part] = total.get(part, 0) + np.frombuffer(sums.as_buffer(), dtype=np.int64)
        if total:
            yield pa.RecordBatch.from_arrays([pa.array(total, pa.int32()), pa.array(
                [t.tobytes() for t in total.values()], pa.binary())], schema=schema)

    found = rows.mapInArrow(run, "part int, sums binary").repartition(PARTS, "part").mapInArrow(
        add, "part int, sums binary").collect()
    out = np.zeros(sum(_PACKED))
    for r in found:
        out[r["part"]::PARTS] = np.frombuffer(bytes(r["sums"]), dtype=np.int64) / SCALE
    spread.destroy()
    return np.split(out, np.cumsum(_PACKED)[:-1])


def _round(rows: DataFrame, xs: list[np.ndarray], y: np.ndarray, weights: list[np.ndarray], share: float,
           ridge: float = 1.0):
    """Weights of both views fitted to the labelled documents and to the
    unlabelled ones that the other view hands over by ``weights``; and the
    numbers of these."""
    cuts = _cuts(rows, weights, float(y.mean()), share)
    good, now, best, low, taken = y.mean(), list(weights), [None, None], [np.inf, np.inf], (0, 0)
    for _ in range(STEPS):
        sums, moved, taken = _pass(rows, weights, cuts, now), 0.0, []
        for view in (0, 1):
            bad_sums, good_sums = sums[2 * view:2 * view + 2]
            n0, n1 = bad_sums[0], good_sums[0]
            whole = min(n1 / good, n0 / (1 - good))
            taken.append(int(n0 + n1) if whole else 0)
            mine = _sums(xs[view].astype(np.float64), y, now[view])
            if whole:
                mine = mine + (1 - good) * whole / n0 * bad_sums + good * whole / n1 * good_sums
            loss, slope, curve = _opened(mine, WIDTHS[view])
            penalty = np.append(np.full(WIDTHS[view], ridge), 1e-6)
            loss += 0.5 * (penalty * now[view] ** 2).sum()
            if loss > low[view] + 1e-9 * abs(low[view]) + 1e-4:
                step = (now[view] - best[view]) / 2
                now[view] = best[view] + step
            else:
                best[view], low[view] = now[view], loss
                step = np.linalg.solve(curve + np.diag(penalty), slope + penalty * now[view])
                now[view] = now[view] - step
            moved = max(moved, np.abs(step).max())
        if moved < SMALL or not any(taken):
            break
    return now, tuple(taken)


def _held_loss(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> float:
    """Mean log loss of a view's calibrated scores on documents it has not
    learned from."""
    z = logit(x, w)
    a, b = fit(z[:, None], y, ridge=0.1)
    z = max(float(a), 0.0) * z + b
    return float(np.mean(np.logaddexp(0, z) - y * z))


def cotrain(xs: list[np.ndarray], y: np.ndarray, order: np.ndarray, rows, rounds: int = 5) -> Model:
    """``xs``: the two views of labelled documents, ``rows`` (called when
    needed) the table of those of the unlabelled; every fifth document by
    ``order`` is kept apart for gains and calibration."""
    if len(y) == 0 or y.min() == y.max():
        return Model(constant=float(y.mean()) if len(y) else 1.0, labelled=len(y))
    apart = np.argsort(np.argsort(order, kind="stable")) % 5 == 0
    learn = ~apart
    if y[learn].min() == y[learn].max() or y[apart].min() == y[apart].max():
        apart, learn = np.ones(len(y), bool), np.ones(len(y), bool)
    weights, taken = [fit(x[learn], y[learn]) for x in xs], (0, 0)
    pool = rows() if rounds else None
    loss = [_held_loss(x[apart], y[apart], w) for x, w in zip(xs, weights)]
    for i in range(rounds):
        new, n = _round(pool, [x[learn] for x in xs], y[learn], weights, SHARES[min(i, len(SHARES) - 1)])
        now = [_held_loss(x[apart], y[apart], w) for x, w in zip(xs, new)]
        gains = [a - b for a, b in zip(loss, now)]
        # no worse is kept too: what was learned is agreed with
        keep = [m > 0 and g >= 0 for m, g in zip(n, gains)]
        moved = max([np.abs(a - b).max() for a, b, k in zip(new, weights, keep) if k], default=0.0)
        weights, loss = [a if k else b for a, b, k in zip(new, weights, keep)], [b if k else a for a, b, k in zip(loss, now, keep)]
        taken = tuple(m if k else t for m, t, k in zip(n, taken, keep))
        if moved < SMALL or (i and max(gains) < GAIN):
            break
    calibration = []
    for x, w in zip(xs, weights):
        a, b = fit(logit(x[apart], w)[:, None], y[apart], ridge=0.1)
        calibration.append((max(float(a), 0.0), float(b)))
    z = np.stack([a * logit(x[apart], w) + b for x, w, (a, b) in zip(xs, weights, calibration)], axis=1)
    return Model(weights, calibration, fit(z, y[apart], ridge=0.1), labelled=len(y), taken=taken)


def _features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """Columns ``keep`` and the two views as float32 bytes."""
    def run(batches):
        for part in slices(batches, "text"):
            views = [content_features(part.column(0)),
                     metadata_features(*(part.column(i).to_pylist() for i in (1, 2, 3)))]
            yield pa.RecordBatch.from_arrays(
                [*part.columns[4:], *(pa.array([r.tobytes() for r in v], pa.binary()) for v in views)],
                names=[*keep, "content", "metadata"])

    types = dict(docs.dtypes)
    return docs.select("text", "source", "lang", "n_chars", *keep).mapInArrow(
        run, ", ".join([*(f"{k} {types[k]}" for k in keep), "content binary", "metadata binary"]))


def _share(key, wanted: int, total: int):
    """Rows whose hash lies in the lowest ``wanted / total``."""
    if wanted >= total:
        return F.lit(True)
    return F.shiftrightunsigned(F.xxhash64(key, F.lit("sample")), 11) < int((1 << 53) * wanted / total)


def _base(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                       F.col("source").cast("string").alias("source"), F.col("lang").cast("string").alias("lang"),
                       F.col("n_chars").cast("double").alias("n_chars"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", max_labelled: int = 8000, rounds: int = 5) -> Model:
    """The classifiers, from at most about ``max_labelled`` labelled documents
    and all others."""
    base = _base(docs, id_col, text_col)
    known = (labels.select(F.col("doc_id").alias("id"), F.col(label_col).cast("int").alias("y"))
             .filter("id IS NOT NULL AND y IS NOT NULL").groupBy("id").agg(F.min("y").alias("y")))
    # at most about max_labelled rows: the share was chosen from the count
    some = known.filter(_share(F.col("id"), max_labelled, known.count()))
    one = F.struct("text", "source", "lang", "n_chars", "y")
    sample = (base.join(F.broadcast(some), F.col("doc_id") == F.col("id")).groupBy("doc_id").agg(F.min(one).alias("one"))
              .select("one.*", F.xxhash64("doc_id").alias("o")))
    rows = _features(sample, ["y", "o"]).toArrow()
    y, order = (rows.column(c).to_numpy() for c in ("y", "o"))
    sort = np.lexsort((y, order))
    views = [np.array([np.frombuffer(x, dtype=np.float32) for x in rows.column(c).to_pylist()]).reshape(-1, w)[sort]
             for c, w in zip(("content", "metadata"), WIDTHS)]

    spark = docs.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cotrain-{uuid.uuid4().hex}"

    def pool() -> DataFrame:
        rest = base.join(F.broadcast(some), F.col("doc_id") == F.col("id"), "left_anti")
        _features(rest, []).write.option("compression", "zstd").parquet(path)
        return spark.read.parquet(path)

    try:
        return cotrain(views, (y[sort] > 0).astype(float), order[sort], pool, rounds)
    finally:
        delete(spark, path)


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             label_col: str = "quality", max_labelled: int = 8000, rounds: int = 5,
             threshold: float = 0.5) -> DataFrame:
    """doc_id, p_content, p_metadata, score (probability of good quality), keep."""
    base = _base(docs, id_col, text_col)
    model = train(docs, labels, id_col, text_col, label_col, max_labelled, rounds)

    def run(batches):
        for part in slices(batches, "text"):
            s = model.scores([content_features(part.column(1)),
                              metadata_features(*(part.column(i).to_pylist() for i in (2, 3, 4)))])
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(s[:, i], pa.float64()) for i in range(3)), pa.array(s[:, 2] >= threshold)],
                names=["doc_id", "p_content", "p_metadata", "score", "keep"])

    return base.mapInArrow(run, f"doc_id {dict(base.dtypes)['doc_id']}, p_content double, p_metadata double, score double, keep boolean")
