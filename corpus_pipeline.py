"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, folder) and works on all documents that the one
before kept. Its result is written as Parquet and read again for the next, so a
lost executor costs tasks and not stages. All but the last return the columns of
``documents``.

1. quality: documents that the classifier rejects go (score below ``MIN_QUALITY``).
2. near_dedup: of each component of near copies one document stays, the one
   with the smallest id; an id says nothing about copies, so texts that differ
   stay under one id.
3. substring_dedup: words under repeated windows go; a document that has words
   and loses all of them goes as well.
4. decontamination: documents that hold a benchmark item go.
5. packing: what is left becomes sequences of ids.

Defined cases: documents with a null text are scored as empty ones and pass like
them; a document with a null id counts as one of a component like any other, and
stays only where the component has no document with an id; of several documents
of a component with one id, or all without, the first by a digest of the row stays;
without labels nothing is rejected; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stocktide.llm import decontam, packing, quality, simhash, substrings
from stocktide.session import materialize
from stocktide.sources.tables import read_table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
MIN_QUALITY = 0.3
#: Fixed value: the tokenizer of the packing stage, by its name among the public ones.
TOKENIZER = "word_bpe_49k.json"


def by_quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.fit(docs, read_table(spark, folder, "labels"))
    return docs.select(*COLUMNS).where(model.score("text") >= MIN_QUALITY)


def _row_digest() -> Column:
    """Equal for rows with the same values in all columns only: each value goes in with its length."""
    value = lambda c: F.concat(F.octet_length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))
    return F.sha2(F.concat(*[F.coalesce(value(c), F.lit("-")) for c in COLUMNS]), 256)


def near_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each component of near copies."""
    docs = docs.select(*COLUMNS, _row_digest().alias("row"))
    # Keys that are never null, in the order in which a component keeps its documents.
    keyed = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row").alias("key"), "text")
    kept = simhash.near_duplicates(keyed, key="key").select(F.col("component_id.row").alias("row")).distinct()
    return docs.dropDuplicates(["row"]).join(kept, "row", "left_semi").select(*COLUMNS)


def substring_dedup(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without the word windows that occur more than once."""
    cut = substrings.remove_repeats(docs, keep=("lang", "source", "n_chars"))
    kept = cut.where("n_removed = 0 or n_removed < n_words")
    n_chars = F.when(F.col("n_removed") > 0, F.length("kept_text").cast("long")).otherwise(F.col("n_chars"))
    return kept.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", n_chars.alias("n_chars"))


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs.select(*COLUMNS), read_table(spark, folder, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Pieces of documents, with their ids and places in sequences."""
    import public_tokenizers

    return packing.pack(docs, str(public_tokenizers.path(TOKENIZER)))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", by_quality),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: SQL cannot express the classifier, the fingerprints or the tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """All stages on the table ``documents``."""
    docs = read_table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, folder)
