"""Bounded samples of labelled rows, for fitting classifiers on the driver."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def remainder(id_column: str, modulus: int) -> Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % modulus


def label_sample(labels: DataFrame, label: str, learn: Column, bound: int, id_column: str = "doc_id", balanced: bool = True) -> DataFrame:
    """(id, y, weight) of at most about ``bound`` labelled rows, chosen by a hash of the id; if ``balanced``,
    at most half of the bound is taken from each class. The weight is the number of usable labelled
    rows that a sampled one stands for: weighted sums estimate those of all, whatever the bound.

    Rows with a null id, a null label or ``learn`` not true are left out; an id labelled
    more than once counts once, with its largest label. The result is small enough to broadcast.
    """
    usable = labels.filter(learn & F.col(id_column).isNotNull() & F.col(label).isNotNull())
    usable = usable.groupBy(id_column).agg(F.max(F.col(label).cast("int")).alias("y"))
    sizes = {row["y"]: row["count"] for row in usable.groupBy("y").count().collect()}  # two rows
    share = F.lit(0.0)
    for y, count in sizes.items():
        share = F.when(F.col("y") == y, F.lit(min(1.0, bound / (2 * count if balanced else sum(sizes.values()))))).otherwise(share)
    taken = usable.withColumn("_share", share).filter(F.pmod(F.xxhash64(id_column), F.lit(1_000_000)) < F.col("_share") * 1_000_000)
    return taken.withColumn("weight", 1 / F.col("_share")).drop("_share")


def labelled_texts(docs: DataFrame, sample: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(text, y, weight) of the sampled documents; the sample's bound makes it fit for broadcasting."""
    right = sample.select(F.col(id_column).alias("_id"), "y", "weight")
    return docs.join(F.broadcast(right), docs[id_column] == right["_id"]).select(F.coalesce(docs[text], F.lit("")).alias("text"), "y", "weight")


def scored(docs: DataFrame, scores: Callable[[list[str]], np.ndarray], text: str = "text", id_column: str = "doc_id", at_once: int = 500) -> DataFrame:
    """(id, score) of every row; null text counts as empty, ids pass through as they are."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, at_once):
                part = batch.slice(start, at_once)
                found = scores(part.column(1).to_pylist()).astype(np.float64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found)], ["id", "score"])

    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, score double").withColumnRenamed("id", id_column)
