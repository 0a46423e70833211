"""Bounded labelled samples for the learning operators: which documents, never their texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def labelled_ids(labels: DataFrame, label: str, learn: Column, per_class: int, seed: int) -> DataFrame:
    """(doc_id, y) of at most ``per_class`` documents of each class, those with the smallest hashes
    of their id, from the rows that ``learn`` (a condition on doc_id) allows.

    The ids are picked from the narrow label table. Labels other than 0 and 1 and null ids are left
    out. Repeated labels of a document count once per class.
    """
    narrow = labels.select("doc_id", F.col(label).cast("int").alias("y")).where(
        learn & F.col("y").isin(0, 1)).distinct()
    order = [F.xxhash64(F.lit(seed), "doc_id"), F.col("doc_id")]
    picked = [narrow.where(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    return picked[0].unionAll(picked[1])


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int,
                  seed: int) -> DataFrame:
    """The documents of ``labelled_ids`` with their y. The ids, 2 * per_class at most, are broadcast
    to the documents, so that only picked documents move."""
    ids = labelled_ids(labels, label, learn, per_class, seed)
    return docs.join(F.broadcast(ids), "doc_id")
