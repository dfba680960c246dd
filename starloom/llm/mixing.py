"""Mixing sources to target weights by entropy balancing.

Every document starts with rate 1. The rates that change least (smallest
Kullback-Leibler distance) while the tokens of each source meet its target,
and while no rate exceeds ``max_copies``, are exponentially tilted:
rate = min(max_copies, exp(lambda_source * x)), with x the document's size
over the mean size of its source. The multipliers solve the convex dual,
whose gradient for a source is (tokens at these rates) - target. Newton steps
are guarded by a bracket, because the cap makes the gradient only piecewise
smooth. Each iteration is one aggregation over the table of distinct
(source, size) pairs, which holds all the dual depends on.

Rates become whole copies. The integer part is kept; who gets one more copy
is decided by ``hash / fraction`` below a threshold of the (source, size
class). The threshold is chosen so that the taken tokens follow the wanted
ones, going from the largest size class to the smallest and carrying what a
class missed, so that the smallest documents settle the rest. Thresholds come
from a histogram of bounded size per source; a document's own decision needs
only its row, so reruns agree.

Sources are ranked in one window over one row per source: the number of
sources, never the number of documents, bounds that task.

Defined cases: a null or empty text has size 0 and one copy (it adds no
tokens); a null source is a source of its own, last in order; repeated rows
and null ids are documents like any others (equal id and text: equal
decision); a source without tokens has target 0; empty input, empty output;
other columns are carried by ``apply_mix`` and ignored by ``mix``.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from starloom.functions.plan import bounded_broadcast

from .textops import Words, extended, packed, slices, unpacked

BINS = 4096  # histogram bins of hash / fraction, per source and size class
MAX_STEPS = 200  # Newton steps or halvings; beyond, the multipliers count as unsolved


def sizes(docs: DataFrame, text_col: str) -> DataFrame:
    """``docs`` with ``__size`` (words of the whole text) and ``__hash``."""
    schema = extended(docs.schema, __size="long", __hash="long")
    at = docs.columns.index(text_col)

    def run(batches):
        for part in slices(batches, text_col):
            words = Words(part.column(at))
            with np.errstate(over="ignore"):
                total = np.zeros(words.n_docs, dtype=np.uint64)
                place = np.arange(1, len(words.hashes) + 1, dtype=np.uint64)
                place -= np.repeat(words.ptr[:-1], words.counts()).astype(np.uint64)
                np.add.at(total, words.doc_of_word(), words.hashes * (place * np.uint64(2) + np.uint64(1)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(words.counts().astype(np.int64)), pa.array(total.view(np.int64))],
                names=[*part.schema.names, "__size", "__hash"])

    return docs.mapInArrow(run, schema)


def source_targets(per_source: DataFrame, weights: Sequence[float], max_copies: float) -> DataFrame:
    """One row per source (columns source, source_size) -> with ``target``:
    all tokens shared by the repeating weights, at most ``max_copies`` times
    the source's size, the excess reshared by weight until none is above.

    Sources are full exactly for the smallest size/weight ratios, so the
    resharing is a running total in that order."""
    every = Window.partitionBy(F.lit(0))
    order = every.orderBy(F.col("source").isNull(), F.col("source"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = per_source.withColumn("weight", w).withColumn("limit", F.col("source_size") * float(max_copies))
    fill = every.orderBy(F.col("limit") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    free = F.sum("source_size").over(every) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    heavy = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    t = t.withColumn("level", free / heavy)
    t = t.withColumn("full", F.col("limit") <= F.col("level") * F.col("weight"))
    open_level = F.min(F.when(~F.col("full"), F.struct(F.col("limit") / F.col("weight"), F.col("level")))).over(every)
    return t.select("source", F.col("source_size").cast("long").alias("source_size"),
                    F.when(F.col("full"), F.col("limit")).otherwise(open_level["level"] * F.col("weight"))
                    .alias("target"))


def _rate(lam, x, cap):
    return F.least(F.exp(F.least(lam * x, F.lit(50.0))), F.lit(float(cap)))


def tilts(pairs: DataFrame, targets: DataFrame, max_copies: float, tolerance: float = 1e-9) -> DataFrame:
    """Newton on the dual. ``pairs``: source, size, n. Returns source,
    source_size, target, mean, lam (null where every rate is at the cap)."""
    cap = float(max_copies)
    means = pairs.groupBy("source").agg((F.sum(F.col("size") * F.col("n")) / F.sum("n")).alias("mean"))
    state = (targets.join(means, targets.source.eqNullSafe(means.source)).drop(means.source)
             .withColumn("lam", F.lit(0.0)).withColumn("lo", F.lit(float("-inf"))).withColumn("hi", F.lit(float("inf")))
             .withColumn("full", F.col("target") >= F.col("source_size") * cap * (1 - tolerance))
             .withColumn("done", F.col("full") | (F.col("target") <= 0))).checkpoint(eager=True)
    for step in range(MAX_STEPS + 1):
        if not state.filter(~F.col("done")).limit(1).collect():
            break
        if step == MAX_STEPS:
            raise RuntimeError(f"multipliers unsolved after {MAX_STEPS} steps")
        joined = pairs.join(state.filter(~F.col("done")).withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
        x = F.col("size") / F.col("mean")
        rate = _rate(F.col("lam"), x, cap)
        sums = joined.groupBy("s").agg(
            F.sum(F.col("n") * F.col("size") * rate).alias("tokens"),
            F.sum(F.when(rate < cap, F.col("n") * F.col("size") * x * rate).otherwise(0.0)).alias("slope"))
        gap = F.col("tokens") - F.col("target")
        lo = F.when(gap < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(gap > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - gap / F.col("slope")
        inside = (F.col("slope") > 0) & (newton > F.col("lo2")) & (newton < F.col("hi2"))
        # outside the bracket: its middle, or twice as far while it is open
        middle = (F.when(F.col("hi2") == float("inf"), F.greatest(F.col("lam") * 2, F.col("lam") + 1))
                  .when(F.col("lo2") == float("-inf"), F.least(F.col("lam") * 2, F.col("lam") - 1))
                  .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        met = F.abs(gap) <= F.col("target") * tolerance + 1e-9
        new = (state.join(sums, state.source.eqNullSafe(sums.s), "left").drop("s")
               .withColumn("lo2", lo).withColumn("hi2", hi)
               .withColumn("next", F.when(inside, newton).otherwise(middle))
               .withColumn("was", F.col("done"))
               .withColumn("done", F.col("was") | F.coalesce(met, F.lit(True)))
               .withColumn("lam", F.when(F.col("done"), F.col("lam")).otherwise(F.col("next")))
               .withColumn("lo", F.coalesce("lo2", "lo")).withColumn("hi", F.coalesce("hi2", "hi")))
        state = new.select("source", "source_size", "target", "mean", "lam", "lo", "hi", "full", "done").checkpoint(eager=True)
    # rounded, so that the order in which sums were added leaves no trace
    return state.select("source", "source_size", "target", "mean",
                        F.when(~F.col("full"), F.round("lam", 9)).alias("lam"))


def _with_rates(sized: DataFrame, tilt: DataFrame, source_col: str, id_col: str, cap: float) -> DataFrame:
    """Adds __rate, __whole, __part (fraction), __class, __key = hash/fraction."""
    t = tilt.select(F.col("source").alias("__s"), F.col("source_size").alias("__source_size"),
                    F.col("target").alias("__target"), F.col("mean").alias("__mean"), F.col("lam").alias("__lam"))
    t = bounded_broadcast(t, t.count())
    d = sized.join(t, F.col(source_col).eqNullSafe(F.col("__s")), "left").drop("__s")
    # the mean is 0 only where every size is 0
    x = F.when(F.col("__mean") > 0, F.col("__size") / F.col("__mean")).otherwise(0.0)
    rate = F.when(F.col("__size") == 0, 1.0).when(F.col("__lam").isNull(), F.lit(cap)).otherwise(
        _rate(F.col("__lam"), x, cap))
    u = (F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col("__hash")), 11) + 0.5) / float(1 << 53)
    return (d.withColumn("__rate", rate).withColumn("__whole", F.floor("__rate"))
            .withColumn("__part", F.col("__rate") - F.col("__whole"))
            .withColumn("__class", F.length(F.bin("__size")))
            .withColumn("__key", F.when(F.col("__part") > 0, u / F.col("__part"))))


def _bin(key):
    # keys up to 2 in equal bins, the long tail beyond in the last
    return F.least(F.floor(key * (BINS // 2)), F.lit(BINS - 1))


def _thresholds(hist: DataFrame) -> DataFrame:
    """Per source: walk classes from large to small documents; the bound of
    bins taken in a class brings its tokens nearest to the wanted tokens plus
    what larger classes left over."""
    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        out, carry = [], 0.0
        for c, g in pdf.sort_values(["__class", "bin"], ascending=[False, True]).groupby("__class", sort=False):
            want = float(g["want"].sum()) + carry
            run = np.concatenate(([0.0], np.cumsum(g["tokens"].to_numpy(dtype=float))))
            best = int(np.argmin(np.abs(run - want)))
            carry = want - run[best]
            out.append((g["source"].iloc[0], int(c), int(g["bin"].iloc[best - 1]) if best else -1))
        return pd.DataFrame(out, columns=["source", "__class", "last_bin"])

    return hist.groupBy("source").applyInPandas(solve, "source string, __class int, last_bin long")


def _decided(docs: DataFrame, id_col: str, text_col: str, source_col: str, weights: Sequence[float],
             max_copies: int) -> DataFrame:
    cap = float(max_copies)
    source = F.col(source_col).cast("string")
    thin = sizes(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), source.alias("source")),
                 "text").drop("text").checkpoint(eager=True)
    pairs = thin.groupBy("source", F.col("__size").alias("size")).agg(F.count(F.lit(1)).alias("n")).checkpoint(eager=True)
    per_source = pairs.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    tilt = tilts(pairs, source_targets(per_source, weights, cap), cap)
    rated = _with_rates(thin, tilt, "source", "doc_id", cap)
    hist = (rated.filter("__part > 0").withColumn("bin", _bin(F.col("__key")))
            .groupBy("source", "__class", "bin")
            .agg(F.sum("__size").alias("tokens"), F.sum(F.col("__size") * F.col("__part")).alias("want")))
    cut = _thresholds(hist).checkpoint(eager=True)
    return thin, tilt, cut


def _copies(rated: DataFrame, cut: DataFrame, source_col: str) -> DataFrame:
    c = cut.select(F.col("source").alias("__cs"), F.col("__class").alias("__cc"), "last_bin")
    c = bounded_broadcast(c, c.count())
    extra = F.when((F.col("__part") > 0) & (_bin(F.col("__key")) <= F.col("last_bin")), 1).otherwise(0)
    return (rated.join(c, F.col(source_col).eqNullSafe(F.col("__cs")) & (F.col("__class") == F.col("__cc")), "left")
            .withColumn("__copies", (F.col("__whole") + extra).cast("long")))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: Sequence[float] = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, rate,
    copies, taken (copies * size)."""
    thin, tilt, cut = _decided(docs, id_col, text_col, source_col, weights, max_copies)
    out = _copies(_with_rates(thin, tilt, "source", "doc_id", float(max_copies)), cut, "source")
    return out.select("doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"),
                      F.col("__target").alias("target"), F.col("__rate").alias("rate"),
                      F.col("__copies").alias("copies"), (F.col("__copies") * F.col("__size")).alias("taken"))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: Sequence[float] = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as many times as it is taken,
    with the columns of ``docs``. The decision is worked out again from each
    row, so texts are neither joined nor shuffled."""
    _, tilt, cut = _decided(docs, id_col, text_col, source_col, weights, max_copies)
    rows = packed(docs, doc_id=F.col(id_col), text=F.col(text_col), source=F.col(source_col).cast("string"))
    rated = _with_rates(sizes(rows, "text"), tilt, "source", "doc_id", float(max_copies))
    out = _copies(rated, cut, "source").filter("__copies > 0")
    return unpacked(out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int")))), docs.columns)
