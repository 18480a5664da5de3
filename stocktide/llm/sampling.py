"""Labelled samples that classifiers learn from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``place`` (a hash of the id), ``text`` and ``label`` of up to ``rows`` labelled documents.

    The labels with the smallest hashes are taken. Labels of one document are
    averaged; null labels and null ids are ignored. Of rows with one id the
    smallest text counts.
    """
    place = F.xxhash64("__id", F.lit("sample"))
    known = labels.select(F.col(key).alias("__id"), F.col(label).cast("double").alias("__y")).dropna()
    known = known.groupBy("__id").agg(F.avg("__y").alias("label")).orderBy(place, "__id").limit(rows)
    texts = docs.select(F.col(key).alias("__id"), F.col(text).alias("__text"))
    # The limit bounds the broadcast side whatever the tables hold.
    found = texts.join(F.broadcast(known), "__id").groupBy("__id", "label").agg(F.min("__text").alias("text"))
    return found.select(place.alias("place"), "__id", "text", "label")
