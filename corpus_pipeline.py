"""Corpus pipeline: documents -> packed training sequences.

Every stage takes the documents its predecessor kept and is written as
Parquet below the shared checkpoint folder before the next one reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starloom.llm import jaccard, langid, linededup, mixing, packing
from starloom.llm.queries import tokenizer_path
from starloom.llm.ship import ready
from starloom.llm.textops import packed, unpacked
from starloom.session import scratch_dir
from starloom.sinks.publish import delete
from starloom.sources.tables import table_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9. Rejects documents without a language (null or empty text, no
    letter); a missing ``lang`` is filled with the inferred one. Null ids and
    repeated rows are judged by their text alone; other columns are carried
    whatever their names; an empty table stays empty."""
    ready(spark)
    model = langid.learn(docs.filter(~langid.held_out(F.col("doc_id"))))
    found = langid.predict(packed(docs, text=F.col("text")), model).filter("lang_pred <> 'und'")
    return unpacked(found, docs.columns, lang=F.coalesce(F.col("row.lang"), F.col("lang_pred")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8, with the source as the site (null: a site of its own).
    Texts lose the boilerplate lines of their source; ``n_chars`` follows. Null
    and empty texts stay as they are, repeated rows are cleaned alike, other
    columns are carried; an empty table stays empty."""
    ready(spark)
    clean = linededup.drop_boilerplate(docs, "text", "source")
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*[F.col(f"`{c}`") for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3. Of each group of linked documents the one with the
    smallest id stays, of repeated rows one. Documents without words and rows
    without an id stay; other columns are carried; an empty table stays empty."""
    ready(spark)
    return jaccard.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5. A document appears as often as the mix takes it, at most
    three times; without words, once. A null source is a source; equal rows
    share a decision; other columns are carried; an empty table stays empty."""
    ready(spark)
    return mixing.apply_mix(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10. One row per piece of a packed sequence, with its ids. A null
    or empty text is the end id alone; copies are packed separately; an empty
    table gives no pieces."""
    ready(spark)
    return packing.pack(docs, tokenizer_path())


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# Expectation maximisation, Newton steps and tokenising are beyond SQL; the
# stages are tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again; what a stage
    has read is removed once its own rows are written."""
    ready(spark)
    root = scratch_dir(spark, "pipeline")
    docs, before = spark.read.parquet(table_path(sf_dir, "documents")), None
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{root}/{name}")
        docs = spark.read.parquet(f"{root}/{name}")
        if before:
            delete(spark, before)
        before = f"{root}/{name}"
    return docs
