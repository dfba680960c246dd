"""Exact top-k inner-product search with multi-resolution segment statistics.

Every vector is cut into segments, at several resolutions, and each segment
keeps its mean and deviation. With q, x over a segment of length L,
    |q - x|^2 >= L * ((mean_q - mean_x)^2 + (dev_q - dev_x)^2),
so coarse statistics bound the distance from below, and with the exact
lengths of q and x the score from above. Bounds are taken coarse to fine, per
pair: a candidate whose bound cannot reach a query's k-th score found so far
is dropped for that query, and only surviving pairs get their exact integer
score. Vectors without structure leave coarse segments little to prune (the
README has the measured shares); the finest level does most there.

Vectors are dealt into blocks of bounded size and every query block meets
every candidate block in one task (queries are a stated set against all
rows); each meeting returns at most k rows per query, and a second, partially
aggregated step merges them. Nothing is collected or broadcast.

Defined cases: a vector that is null, empty, or holds a null or non-finite
component takes no part, nor does a null id; a vector meets only vectors of
its own dimension; rows with the same id are rows of their own (as queries
with a ranking each, as candidates of every other row, their twins included);
ties go to the smaller id; extra columns are ignored; empty table, no rows.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK = 32_768  # candidates of a block, about
QUERY_BLOCK = 1024  # queries of a block, about
CHUNK = 512  # candidates bounded at once
PAIRS = 1 << 16  # exact products taken at once
LEVELS = (1, 8, 32)  # segments per vector, coarse to fine


def quantised(embedding: Column, scale: float = 64.0) -> Column:
    """floor(scale * x) per component, as long; null where the vector is
    null, empty, or has a null or non-finite component."""
    good = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ints = F.transform(embedding, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return F.when((F.size(embedding) > 0) & good, ints)


def _statistics(v: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lengths, means and deviations of ``segments`` nearly equal parts."""
    edges = np.unique(np.linspace(0, v.shape[1], min(segments, v.shape[1]) + 1).astype(int))
    size = np.diff(edges)
    mean = np.add.reduceat(v, edges[:-1], axis=1) / size
    square = np.add.reduceat(v * v, edges[:-1], axis=1) / size
    return size, mean, np.sqrt(np.maximum(square - mean * mean, 0.0))


def _bound(size, q, x, q_norm, x_norm):
    """Upper bounds of the scores [query, candidate], with room for rounding."""
    (qm, qd), (xm, xd) = q, x
    w = np.sqrt(size)
    qs, xs = np.hstack([qm * w, qd * w]), np.hstack([xm * w, xd * w])
    distance = (qs * qs).sum(1)[:, None] + (xs * xs).sum(1)[None] - 2 * qs @ xs.T
    bound = (q_norm[:, None] + x_norm[None] - distance) / 2
    return bound + 1e-9 * (q_norm[:, None] + x_norm[None]) + 1e-6


def _scores(q: np.ndarray, x: np.ndarray, exact_float: bool) -> np.ndarray:
    """Exact integer products of pairs of rows; floats are exact below 2**53."""
    if exact_float:
        return np.rint(np.einsum("ij,ij->i", q, x)).astype(np.int64)
    return np.einsum("ij,ij->i", q.astype(np.int64), x.astype(np.int64))


def _merge(best: tuple, rows: np.ndarray, score: np.ndarray, place: np.ndarray) -> None:
    """Put pairs (query row, score, candidate) into the k best of their rows.
    ``rows`` ascend; ties go to the smaller ``place``."""
    best_score, best_place = best
    k = best_score.shape[1]
    touched, at = np.unique(rows, return_index=True)
    size = np.diff(np.append(at, len(rows)))
    width = k + int(size.max())
    every_score = np.full((len(touched), width), np.iinfo(np.int64).min)
    every_place = np.full((len(touched), width), np.iinfo(np.int64).max)
    every_score[:, :k], every_place[:, :k] = best_score[touched], best_place[touched]
    line = np.repeat(np.arange(len(touched)), size)
    column = k + np.arange(len(rows)) - np.repeat(at, size)
    every_score[line, column], every_place[line, column] = score, place
    top = np.lexsort((every_place, ~every_score), axis=1)[:, :k]
    best_score[touched] = np.take_along_axis(every_score, top, 1)
    best_place[touched] = np.take_along_axis(every_place, top, 1)


def search_block(q_row, q, x_row, x_id, x, k: int, levels=LEVELS, seen: list | None = None):
    """Top k of one query block against one candidate block, as arrays (row of
    the query in ``q``, row of the candidate in ``x``, score). ``seen``, a list of
    len(levels) + 1 numbers, is raised by the pairs met and the pairs left
    after each level; the last are the exact products taken."""
    seen = [0] * (len(levels) + 1) if seen is None else seen
    place = np.lexsort((x_row, x_id))  # ties: by id, rows of one id in any fixed order
    x, x_row = x[place], x_row[place]
    qf, xf = q.astype(np.float64), x.astype(np.float64)
    biggest = max(np.abs(qf).max(), np.abs(xf).max())
    exact_float = biggest * biggest * q.shape[1] < 2.0**52
    q_norm, x_norm = (qf * qf).sum(1), (xf * xf).sum(1)
    # the longest vectors first: they tend to hold the high scores
    order = np.argsort(-x_norm, kind="stable")
    q_stats = [_statistics(qf, s) for s in levels]
    x_stats = [_statistics(xf, s) for s in levels]
    best = np.full((len(q), k), np.iinfo(np.int64).min), np.full((len(q), k), np.iinfo(np.int64).max)
    edges = np.append(np.arange(0, min(len(x), CHUNK), 4 * k), np.arange(CHUNK, len(x), CHUNK))
    for part in np.split(order, edges[1:]):  # small at first, while few bounds are known
        least = best[0][:, -1]
        known = least > np.iinfo(np.int64).min  # k candidates scored: their last is a lower bound
        least = np.where(known, least.astype(np.float64), -np.inf)
        alive = q_row[:, None] != x_row[part][None]
        seen[0] += int(alive.sum())
        for i, ((size, qm, qd), (_, xm, xd)) in enumerate(zip(q_stats, x_stats)):
            rows = np.flatnonzero(known & alive.any(1))
            if len(rows):
                bound = _bound(size, (qm[rows], qd[rows]), (xm[part], xd[part]), q_norm[rows], x_norm[part])
                alive[rows] &= bound >= least[rows, None]
            seen[i + 1] += int(alive.sum())
        a, b = np.nonzero(alive)
        for i in range(0, len(a), PAIRS):
            r, c = a[i:i + PAIRS], part[b[i:i + PAIRS]]
            score = _scores(qf[r], xf[c], True) if exact_float else _scores(q[r], x[c], False)
            use = score >= best[0][r, -1]
            if use.any():
                _merge(best, r[use], score[use], c[use])
    keep = best[1] < np.iinfo(np.int64).max
    rows, _ = np.nonzero(keep)
    return rows, place[best[1][keep]], best[0][keep]


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "vector",
          k: int = 20, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score. ``vector_col``: array<long>, null where
    a row takes no part; ``is_query`` picks the queries by columns of
    ``vectors``."""
    own = vectors.filter(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
    own = own.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), is_query.alias("is_query"))
    # a row's number is stored with it, so rows of one id stay apart
    own = (own.withColumn("dim", F.size("v")).withColumn("row", F.monotonically_increasing_id())
           .checkpoint(eager=True))
    count = own.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("is_query").cast("long")), F.lit(0))).first()
    n_x, n_q = max(1, -(-count[0] // block)), max(1, -(-count[1] // query_block))
    deal = F.xxhash64("row")
    queries = (own.filter("is_query").withColumn("qb", F.pmod(deal, F.lit(n_q)))
               .withColumn("xb", F.explode(F.expr(f"sequence(0L, {n_x - 1}L)"))))
    items = (own.withColumn("xb", F.pmod(deal, F.lit(n_x)))
             .withColumn("qb", F.explode(F.expr(f"sequence(0L, {n_q - 1}L)"))))

    def meet(q: pd.DataFrame, x: pd.DataFrame) -> pd.DataFrame:
        if not len(q) or not len(x):
            return pd.DataFrame({"query": [], "query_id": [], "row": [], "vec_id": [], "score": []}, dtype="int64")
        q_id, q_row, x_id, x_row = (d[c].to_numpy() for d in (q, x) for c in ("id", "row"))
        a, b, score = search_block(q_row, np.stack(q["v"].to_numpy()), x_row, x_id, np.stack(x["v"].to_numpy()), k)
        return pd.DataFrame({"query": q_row[a], "query_id": q_id[a], "row": x_row[b], "vec_id": x_id[b], "score": score})

    keys, columns = ["qb", "xb", "dim"], ["id", "row", "v"]
    parts = (queries.select(*keys, *columns).groupBy(*keys).cogroup(items.select(*keys, *columns).groupBy(*keys))
             .applyInPandas(meet, "query long, query_id long, row long, vec_id long, score long"))
    # at most k rows per query and block meet in a window group
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id", "row"))
    return parts.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
