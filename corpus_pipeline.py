"""From documents to packed training sequences: quality, line dedup, near copies, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import line_dedup, mixing, ngram_join, packing, quality
from tillstream.llm.common import as_read, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule, or whose posterior is low, go."""
    return quality.keep_good(docs)


def deduplicate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that another document, or the same one, has already go; so do documents left without any."""
    clean = line_dedup.dedup(docs).select(*[F.col(f"`{c}`") for c in docs.columns])
    return clean.where(F.trim(F.translate("text", "\n", "")) != "").withColumn("n_chars", F.length("text").cast("long"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of documents with similar word n-grams, the one with the smallest doc_id stays."""
    return ngram_join.keep_first(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, in the order of the mix; a source that has run out leaves its slots to the others.
    Written to files, the parts and their rows keep that order."""
    mixed = mixing.mix(docs).orderBy("slot", "place")
    return mixed.select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence. Sequences are filled and numbered in
    the order in which the mix was written."""
    ordered = as_read(docs, "_place")
    return packing.pack(docs) if ordered is None else packing.pack(ordered, order=("_place",))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", deduplicate_lines),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing sources", mix_sources),
    ("best-fit packing", pack_sequences),
]

#: The stages hash words, fit a model and tokenize: no SQL gives these rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what each keeps is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
