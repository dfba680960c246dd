"""Fixity audit of WARC replicas with Merkle trees.

An archive is an ordered run of records; a record occupies
[offset, offset + length) of it. Records are hashed; the tree's leaves are
ordered ranges of ``fanout`` neighbouring records, and each further level
hashes ``fanout`` neighbouring nodes, up to one root per archive. A node's
digest covers the offset range and the digests below it, so a changed,
missing, added or moved record changes every node above it.

An audit compares roots first and then descends: at each level only the
children of nodes that differ are compared, until the differing records
remain. Trees are stored once per replica and read level by level; equal
archives cost one row of comparison. By default nodes are ranges of record_id
and records are aligned by it; with ``by_position`` they are ranges of
places, and a lost record shifts all behind it.

All steps are DataFrame operations. An archive holds ``per_archive`` ids by
construction (``archives_by_id``). Null ids, or one id repeated, may still
hold any number of records: equal ones are counted, and windows and lists run
over chunks of an id's records and then over the chunks, so no group grows
with the input. Trees by position are for archives of bounded size.

Defined cases: null bytes hash as a record of length 0 that differs from an
empty one; null ids form archives of their own (ordered by digest); repeated rows are
records of their own (equal id: ordered by digest); extra columns are
ignored; empty replicas have no roots, so a lost archive shows as missing.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window, functions as F

FANOUT = 16
PER_ARCHIVE = 1024
PREFIX = 3  # digits of a digest that make a chunk of an id's records: 4,096 chunks
CHUNK = 4096  # places of a chunk of differing records


def warc_record(url: Column, payload: Column) -> Column:
    """Bytes of a WARC response record: header block, blank line, payload."""
    body = F.coalesce(payload.cast("string"), F.lit(""))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")),
                    F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.when(payload.isNotNull(), F.concat(head, body, F.lit("\r\n\r\n")).cast("binary"))


def archives_by_id(record_id: Column, per_archive: int = PER_ARCHIVE) -> Column:
    """Archive number: runs of ``per_archive`` consecutive ids."""
    return _cell(record_id.cast("long"), per_archive)


def _same(columns: list[str], other: str) -> Column:
    """Null-safe equality of ``columns`` with those renamed by a prefix."""
    return functools.reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(other + c)) for c in columns])


def _running(df: DataFrame, group: list[str], chunk: list[str], order: list[str], **sums: Column) -> DataFrame:
    """``df`` with running sums over the rows of its ``group`` that come before
    in the order of (chunk, order). Rows are summed within their chunk, and
    chunks within the group, so a group may hold any number of rows."""
    before = Window.unboundedPreceding, -1
    inner = Window.partitionBy(*group, *chunk).orderBy(*order).rowsBetween(*before)
    outer = Window.partitionBy(*group).orderBy(*chunk).rowsBetween(*before)
    whole = df.groupBy(*group, *chunk).agg(*[F.sum(v).alias(k) for k, v in sums.items()])
    whole = whole.select(*[F.col(c).alias(f"whole_{c}") for c in group + chunk],
                         *[F.coalesce(F.sum(k).over(outer), F.lit(0)).alias(f"before_{k}") for k in sums])
    df = df.select("*", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"inner_{k}") for k, v in sums.items()])
    joined = df.join(whole, _same(group + chunk, "whole_"))
    return joined.select(*df.drop(*[f"inner_{k}" for k in sums]).columns,
                         *[(F.col(f"before_{k}") + F.col(f"inner_{k}")).cast("long").alias(k) for k in sums])


def records(df: DataFrame, record_id: Column, payload: Column, archive: Column) -> DataFrame:
    """The leaves' input: archive, n (position), record_id, offset, length,
    digest. Equal records are placed as one with a count; an id with many
    records (or none) is placed in chunks by digest."""
    base = df.select(archive.alias("archive"), record_id.alias("record_id"),
                     F.coalesce(F.octet_length(payload), F.lit(0)).cast("long").alias("length"),
                     F.sha2(F.coalesce(payload, F.lit("null record").cast("binary")), 256).alias("digest"))
    base = base.groupBy("archive", "record_id", "length", "digest").agg(F.count(F.lit(1)).alias("copies"))
    placed = _running(base.withColumn("chunk", F.substring("digest", 1, PREFIX)), ["archive"], ["record_id", "chunk"],
                      ["digest", "length"], n=F.col("copies"), offset=F.col("copies") * F.col("length"))
    return (placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
            .select("archive", (F.col("n") + F.col("copy")).alias("n"), "record_id",
                    (F.col("offset") + F.col("copy") * F.col("length")).alias("offset"), "length", "digest"))


def _parents(nodes: DataFrame, level: int, fanout: int) -> DataFrame:
    parts = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("n", "start", "end", "digest"))),
        lambda x: F.concat_ws(":", x["start"].cast("string"), x["end"].cast("string"), x["digest"])), "|")
    return (nodes.groupBy("archive", F.floor(F.col("n") / fanout).cast("long").alias("p"))
            .agg(F.sha2(parts.cast("binary"), 256).alias("digest"), F.min("start").alias("start"), F.max("end").alias("end"))
            .select("archive", F.lit(level).alias("level"), F.col("p").alias("n"), "start", "end", "digest"))


def tree(recs: DataFrame, fanout: int = FANOUT, height: int | None = None) -> DataFrame:
    """All nodes: archive, level (0 = records), n, start, end, digest,
    record_id (level 0). The top level has one node per archive. ``height``:
    levels above the records; by default as many as the largest archive
    needs (one aggregation)."""
    leaf = recs.select("archive", F.lit(0).alias("level"), "n", F.col("offset").alias("start"),
                       (F.col("offset") + F.col("length")).alias("end"), "digest", "record_id")
    if height is None:
        height = tree_height(recs, fanout)
    out, below = leaf, leaf
    for level in range(1, height + 1):
        below = _parents(below, level, fanout)
        out = out.unionByName(below, allowMissingColumns=True)
    return out


def tree_height(recs: DataFrame, fanout: int = FANOUT) -> int:
    largest = (recs.agg(F.max("n")).first()[0] or 0) + 1
    height = 1
    while fanout ** height < largest:
        height += 1
    return height


def audit(primary: DataFrame, replica: DataFrame, height: int, fanout: int = FANOUT) -> DataFrame:
    """Differing records of two trees of equal ``height``: archive, n,
    start, end, record_id, status ('corrupt', 'missing', 'extra'), digest,
    replica_digest. Top-down: the comparison of a level is joined only with
    the children of nodes that differ."""
    def level(t: DataFrame, k: int, side: str) -> DataFrame:
        return t.filter(F.col("level") == k).select(
            "archive", "n", *[F.col(c).alias(f"{side}_{c}") for c in ("start", "end", "digest", "record_id")])

    open_nodes = None
    for k in range(height, -1, -1):
        a, b = level(primary, k, "a"), level(replica, k, "b")
        if open_nodes is not None:
            keep = open_nodes.withColumnRenamed("archive", "ka").withColumnRenamed("n", "kn")
            match = F.col("archive").eqNullSafe(F.col("ka")) & (F.floor(F.col("n") / fanout) == F.col("kn"))
            a, b = a.join(keep, match, "left_semi"), b.join(keep, match, "left_semi")
        b = b.withColumnRenamed("archive", "b_archive").withColumnRenamed("n", "b_n")
        both = a.join(b, F.col("archive").eqNullSafe(F.col("b_archive")) & (F.col("n") == F.col("b_n")), "full")
        apart = both.filter(~F.struct("a_start", "a_end", "a_digest").eqNullSafe(F.struct("b_start", "b_end", "b_digest")))
        # present on one side only: the missing side's key is null throughout
        mine = F.col("a_digest").isNotNull()
        open_nodes = apart.select(F.when(mine, F.col("archive")).otherwise(F.col("b_archive")).alias("archive"),
                                  F.coalesce("n", "b_n").alias("n"),
                                  *[c for c in apart.columns if c[:2] in ("a_", "b_") and c not in ("b_archive", "b_n")])
        found = open_nodes
        open_nodes = open_nodes.select("archive", "n")
    status = (F.when(F.col("b_digest").isNull(), "missing").when(F.col("a_digest").isNull(), "extra").otherwise("corrupt"))
    return found.select("archive", "n", F.coalesce("a_start", "b_start").alias("start"),
                        F.coalesce("a_end", "b_end").alias("end"),
                        F.coalesce("a_record_id", "b_record_id").alias("record_id"), status.alias("status"),
                        F.col("a_digest").alias("digest"), F.col("b_digest").alias("replica_digest"))


def _cell(c: Column, fanout: int) -> Column:
    """Floor of whole number ``c`` / ``fanout``, without doubles."""
    f = F.lit(fanout).cast("long")
    return F.call_function("div", c, f) - F.when(c % f < 0, 1).otherwise(0).cast("long")


def _parent_cell(c: Column, level: int, fanout: int, height: int) -> Column:
    return F.lit(0).cast("long") if level + 1 == height else _cell(c, fanout)


def _digest_of(rows: DataFrame, key: list[str]) -> DataFrame:
    """One digest per key of the ordered digests below it."""
    below = F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("part", "digest"))),
        lambda x: F.concat_ws(":", F.coalesce(x["part"].cast("string"), F.lit("null")), x["digest"])), "|")
    return rows.groupBy(*key).agg(F.sha2(below.cast("binary"), 256).alias("digest"))


def id_tree(recs: DataFrame, fanout: int, height: int) -> DataFrame:
    """Nodes over ranges of record_id: archive, level (1 to ``height``), cell,
    digest. Offsets are not hashed, so a record that is lost or added changes
    no node but those above it. The records of one id, however many, are
    hashed as counted distinct ones, in chunks by digest."""
    rows = (recs.groupBy("archive", F.col("record_id").cast("long").alias("cell"), "length", "digest")
            .agg(F.count(F.lit(1)).alias("copies"))
            .select("archive", "cell", F.substring("digest", 1, PREFIX).alias("chunk"), F.col("digest").alias("part"),
                    F.concat_ws(":", F.col("length").cast("string"), F.col("copies").cast("string")).alias("digest")))
    below = _digest_of(_digest_of(rows, ["archive", "cell", "chunk"]).withColumnRenamed("chunk", "part"), ["archive", "cell"])
    out = None
    for level in range(1, height + 1):
        up = _parent_cell(F.col("cell"), level - 1, fanout, height)
        below = _digest_of(below.select("archive", up.alias("up"), F.col("cell").alias("part"), "digest"), ["archive", "up"])
        below = below.withColumnRenamed("up", "cell")
        nodes = below.select("archive", F.lit(level).alias("level"), "cell", "digest")
        out = nodes if out is None else out.unionByName(nodes)
    return out


def id_height(recs: DataFrame, fanout: int) -> int:
    """Levels that the widest range of ids of an archive needs."""
    ids = F.col("record_id").cast("decimal(20,0)")
    span = recs.groupBy("archive").agg((F.max(ids) - F.min(ids)).alias("s")).agg(F.max("s")).first()[0] or 0
    height = 1
    while fanout ** height <= span:
        height += 1
    return height


def _in_cells(rows: DataFrame, cells: DataFrame, up: Column) -> DataFrame:
    keep = cells.select(F.col("archive").alias("ka"), F.col("cell").alias("kc"))
    return rows.join(keep, F.col("archive").eqNullSafe(F.col("ka")) & up.eqNullSafe(F.col("kc")), "left_semi")


def align(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Differing records by record_id: equal records (id, length, digest) of
    the two sides cancel out one by one; what is left of an id on both sides
    pairs up as 'corrupt', on one side it is 'missing' or 'extra'."""
    def counted(recs: DataFrame, side: int) -> DataFrame:
        # copies of a record stand side by side, so the first place and a count tell them all
        return recs.groupBy("archive", "record_id", "length", "digest").agg(
            F.count(F.lit(1)).alias("copies"), F.min("n").alias("n"), F.min("offset").alias("offset")).withColumn("side", F.lit(side))

    every = counted(primary, 0).unionByName(counted(replica, 1))
    one = F.struct("side", "n", "offset", "copies")
    alone = (every.groupBy("archive", "record_id", "length", "digest")
             .agg(F.max(F.when(F.col("side") == 0, one)).alias("a"), F.max(F.when(F.col("side") == 1, one)).alias("b"))
             .withColumn("most", F.greatest("a.copies", "b.copies"))
             .withColumn("least", F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.least("a.copies", "b.copies"))
                         .otherwise(F.lit(0)).cast("long"))
             .filter("most > least")
             .withColumn("own", F.when(F.coalesce(F.col("a.copies"), F.lit(0)) > F.coalesce(F.col("b.copies"), F.lit(0)),
                                       F.col("a")).otherwise(F.col("b")))
             .withColumn("copy", F.explode(F.sequence("least", F.col("most") - 1)))
             .select("archive", "record_id", "own.side", (F.col("own.n") + F.col("copy")).alias("n"),
                     (F.col("own.offset") + F.col("copy") * F.col("length")).alias("offset"), "length", "digest",
                     F.floor((F.col("own.n") + F.col("copy")) / CHUNK).alias("chunk")))
    ranked = _running(alone, ["side", "archive", "record_id"], ["chunk"], ["n"], r=F.lit(1))
    one = F.struct("n", "offset", "length", "digest")
    rows = (ranked.groupBy("archive", "record_id", "r")
            .agg(F.max(F.when(F.col("side") == 0, one)).alias("a"), F.max(F.when(F.col("side") == 1, one)).alias("b")))
    at = F.coalesce("a", "b")
    status = F.when(F.col("b").isNull(), "missing").when(F.col("a").isNull(), "extra").otherwise("corrupt")
    return rows.select("archive", at["n"].alias("n"), at["offset"].alias("start"),
                       (at["offset"] + at["length"]).alias("end"), "record_id", status.alias("status"),
                       F.col("a.digest").alias("digest"), F.col("b.digest").alias("replica_digest"))


def audit_by_id(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Audit of two record tables whose nodes are ranges of record_id (whole
    numbers): roots first, then the children of nodes that differ, then the
    records of the lowest such ranges, aligned by id."""
    height = max(id_height(primary, fanout), id_height(replica, fanout))
    a, b = (id_tree(r, fanout, height).checkpoint(eager=True) for r in (primary, replica))
    nodes = a.withColumn("side", F.lit(0)).unionByName(b.withColumn("side", F.lit(1)))
    cells = None
    for level in range(height, 0, -1):
        here = nodes.filter(F.col("level") == level)
        if cells is not None:
            here = _in_cells(here, cells, _parent_cell(F.col("cell"), level, fanout, height))
        mine, theirs = (F.max(F.when(F.col("side") == i, F.col("digest"))) for i in (0, 1))
        cells = (here.groupBy("archive", "cell").agg(mine.alias("a"), theirs.alias("b"))
                 .filter(~F.col("a").eqNullSafe(F.col("b"))).select("archive", "cell"))
    up = _parent_cell(F.col("record_id").cast("long"), 0, fanout, height)
    return align(_in_cells(primary, cells, up), _in_cells(replica, cells, up))


def fixity_audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT, by_position: bool = False) -> DataFrame:
    """Audit of two record tables (see ``records``): by record_id, so that a
    lost or added record is the only row reported for it; ``by_position``
    compares place with place, so that every record behind it differs too.
    Trees are written once, so descending reads them instead of hashing again."""
    if not by_position:
        return audit_by_id(primary, replica, fanout)
    height = max(tree_height(primary, fanout), tree_height(replica, fanout))
    return audit(tree(primary, fanout, height).checkpoint(eager=True),
                 tree(replica, fanout, height).checkpoint(eager=True), height, fanout)
