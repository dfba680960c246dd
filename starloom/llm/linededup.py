"""Line de-duplication by site-relative frequency.

For each host: the share of its pages that contain a line. A line whose
share exceeds ``ratio`` is boilerplate of that host and is dropped from its
pages, whatever the host's size; only lines of a single distinct page are left
out of it (``min_pages`` = 2). Copies of a page
count as one page on both sides of the division, so a page that was crawled
a thousand times does not turn its own prose into boilerplate.

Shuffled are 16-byte digests of (line, page), partially aggregated, never
texts; a hot host is counted in two steps (pages of a line, then lines), so
it meets in no single task. A host has at most (lines per page) / ratio
boilerplate lines. They reach the pages by a broadcast behind a check of
their number, else by a join that deals each host over parts by its size.

Defined cases: a null text stays null, an empty one empty; a null host is a
host of its own; empty lines are never dropped; repeated rows are all kept,
each cleaned alike; extra columns are carried, whatever their names; empty
table, empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

BROADCAST_LINES = 100_000


def _digest(c: Column) -> Column:
    return F.unhex(F.md5(c.cast("binary")))


def _line_key(line: Column) -> Column:
    return _digest(F.trim(line))


def boilerplate(pages: DataFrame, text_col: str = "text", host_col: str = "host", ratio: float = 0.1,
                min_pages: int = 2, sep: str = "\n") -> DataFrame:
    """host, line_key, n_pages, host_pages of every boilerplate line."""
    base = pages.select(F.col(host_col).alias("host"), F.col(text_col).alias("text")).filter("text IS NOT NULL")
    base = base.withColumn("page", _digest(F.col("text")))
    # the empty key stands for the page itself: one pass counts lines and pages
    lines = F.filter(F.split("text", sep), lambda x: F.trim(x) != "")
    keys = F.concat(F.transform(lines, _line_key), F.array(F.lit("").cast("binary")))
    # the kind is an aggregate, so that no filter moves below the exchange and both sides read the same one
    counts = (base.select("host", "page", F.explode(keys).alias("line_key")).distinct()
              .groupBy("host", "line_key")
              .agg(F.count(F.lit(1)).alias("n_pages"), F.max(F.octet_length("line_key") == 0).alias("is_page")))
    hosts = counts.filter("is_page").select(F.col("host").alias("h"), F.col("n_pages").alias("host_pages"))
    found = counts.filter(~F.col("is_page") & (F.col("n_pages") >= min_pages)).drop("is_page")
    return (found.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
            .filter(F.col("n_pages") > F.col("host_pages") * ratio))


def _salted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` and the keys of their host. A host with more rows than an even
    share of a shuffle partition is dealt over as many parts as it has shares;
    there are at most as many such hosts as partitions."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sizes = rows.groupBy("host").agg(F.count(F.lit(1)).alias("size")).checkpoint(eager=True)
    share = max(1, (sizes.agg(F.sum("size")).first()[0] or 0) // n)
    hot = F.broadcast(sizes.filter(F.col("size") > share).select(
        F.col("host").alias("hot"), F.ceil(F.col("size") / share).cast("long").alias("parts")))
    parts = F.coalesce("parts", F.lit(1).cast("long"))
    rows = (rows.join(hot, F.col("host").eqNullSafe(F.col("hot")), "left")
            .withColumn("part", F.pmod(F.monotonically_increasing_id(), parts)).drop("hot", "parts"))
    keys = (keys.join(hot, F.col("h").eqNullSafe(F.col("hot")), "left")
            .withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1))).drop("hot", "parts"))
    return rows.join(keys, F.col("host").eqNullSafe(F.col("h")) & (F.col("part") == F.col("salt")), "left")


def drop_boilerplate(pages: DataFrame, text_col: str = "text", host_col: str = "host", ratio: float = 0.1,
                     min_pages: int = 2, sep: str = "\n", counts: bool = False,
                     broadcast_lines: int = BROADCAST_LINES) -> DataFrame:
    """``pages`` with the boilerplate lines of their host taken out of
    ``text_col``; with ``counts`` also n_lines and n_dropped (in place of
    columns of these names)."""
    found = boilerplate(pages, text_col, host_col, ratio, min_pages, sep).checkpoint(eager=True)
    keys = found.groupBy(F.col("host").alias("h")).agg(F.collect_set("line_key").alias("keys"))
    # the rows travel as one column, so that no name of theirs can clash
    rows = pages.select(F.struct(*[F.col(f"`{c}`") for c in pages.columns]).alias("row"),
                        F.col(host_col).alias("host"), F.col(text_col).alias("text"))
    if found.count() <= broadcast_lines:
        joined = rows.join(F.broadcast(keys), F.col("host").eqNullSafe(F.col("h")), "left")
    else:
        joined = _salted(rows, keys)
    text, keys_of = F.col("text"), F.col("keys")
    lines = F.split(text, sep)
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(keys_of, _line_key(x)))
    clean = F.when(keys_of.isNull() | text.isNull(), text).otherwise(F.array_join(F.col("kept"), sep))
    out = joined.withColumn("kept", F.when(keys_of.isNotNull() & text.isNotNull(), kept)).withColumn("clean", clean)
    own = ("n_lines", "n_dropped") if counts else ()
    columns = [(F.col("clean") if c == text_col else F.col("row").getField(c)).alias(c) for c in pages.columns if c not in own]
    if counts:
        n = F.coalesce(F.size(lines), F.lit(0)).cast("long")
        n = F.when(text.isNull(), 0).otherwise(n)
        columns += [n.alias("n_lines"), F.when(F.col("kept").isNull(), 0)
                    .otherwise(n - F.size("kept")).cast("long").alias("n_dropped")]
    return out.select(*columns)


def page_host(url: Column) -> Column:
    """Host of a URL, lower case; empty where there is none, null for null."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def html_lines(html: Column) -> Column:
    """Text of a page with one line per run of text between tags."""
    return F.regexp_replace(F.regexp_replace(html, r"<[^>]*>", "\n"), r"[ \t\r\n]*\n[ \t\r\n]*", "\n")
