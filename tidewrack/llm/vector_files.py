"""Exact top-k by inner product over a vector-approximation file.

Every vector is kept twice: as one small cell number per dimension and exactly. A scan of
the cells bounds each score from below and above (cell centre times query, plus or minus
half a cell's width times the query's size). The kth best lower bound rules most vectors
out. What is left is read exactly in order of falling upper bounds, until the kth exact
score is at least every bound still to come. Scores are whole numbers, so results are exact.

Spark deals the vectors out in blocks; each block answers for itself, and the blocks'
answers are reduced per query. Queries come in fixed-size blocks as well, so that what a
task holds of them is bounded.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import stored

QUERY_BLOCK = 2048
CELL_BITS = 8


def integer_vectors(frame: DataFrame, id_column: str, vector: str, scale: int = 256) -> DataFrame:
    """(id, v array<long>): floor(scale * x) per component; unusable vectors and null ids go."""
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = ~F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = frame.filter(F.col(id_column).isNotNull() & F.col(vector).isNotNull() & finite)
    return usable.select(F.col(id_column).cast("long").alias("id"), F.transform(whole, lambda x: F.floor(x * scale)).alias("v"))


def approximate(exact: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of each component, with the lowest value and the cell width per dimension."""
    low, high = exact.min(0), exact.max(0)
    width = np.maximum((high - low) / (1 << bits), 1e-12)
    cells = np.minimum((exact - low) / width, (1 << bits) - 1).astype(np.uint16 if bits > 8 else np.uint8)
    return cells, low, width


def search_block(ids: np.ndarray, exact: np.ndarray, query_ids: np.ndarray, queries: np.ndarray, k: int, bits: int = CELL_BITS) -> tuple[list, int]:
    """Best k of one block for each query as (query, id, score), and how many exact vectors were read."""
    cells, low, width = approximate(exact.astype(np.float64), bits)
    centre = low + (cells + 0.5) * width
    found, read = [], 0
    for first in range(0, len(queries), 128):
        some = queries[first : first + 128]
        reach = np.abs(some) @ (width / 2 * 1.001) + 1.0
        bounds = some @ centre.T + reach[:, None]
        for upper, query, own, slack in zip(bounds, some.astype(np.int64), query_ids[first : first + 128], reach):
            usable = np.flatnonzero(ids != own)
            if len(usable) > k:  # kth best lower bound: below it, an upper bound rules out
                kth = np.partition(upper[usable], len(usable) - k)[len(usable) - k] - 2 * slack
                usable = usable[upper[usable] >= kth]
            order = usable[np.argsort(-upper[usable], kind="stable")]
            best: list[tuple[int, int]] = []
            for start in range(0, len(order), 32):
                if len(best) == k and -best[-1][0] > upper[order[start]]:
                    break
                part = order[start : start + 32]
                read += len(part)
                scores = exact[part] @ query
                best = sorted([*best, *((-int(s), int(i)) for s, i in zip(scores, ids[part]))])[:k]
            found += [(int(own), i, -s) for s, i in best]
    return found, read


def _search(query_ids: np.ndarray, queries: np.ndarray, k: int, bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for size, part in batch.groupby(batch["v"].map(len)):
                mine = np.array([len(q) == size for q in queries])
                if size == 0 or not mine.any():
                    continue
                exact = np.stack(part["v"].to_list()).astype(np.int64)
                block = np.stack([q for q, m in zip(queries, mine) if m]).astype(np.float64)
                found, _ = search_block(part["id"].to_numpy(), exact, query_ids[mine], block, k, bits)
                if found:
                    yield pd.DataFrame(found, columns=["query_id", "id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, id_column: str = "vec_id", vector: str = "embedding", scale: int = 256, bits: int = CELL_BITS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, id, score: each query's k best by integer inner product, ties to the smaller id.

    ``is_query`` is a condition on ``id``. Null vectors, vectors with null or non-finite
    components and null ids take no part; a query never meets a row of its own id, and
    vectors of another length. Of a repeated query id, the smallest vector asks; a
    repeated candidate counts once per different vector. Fewer than k candidates give fewer
    rows. Candidates are read once per ``query_block`` queries.
    """
    usable = stored(integer_vectors(vectors, id_column, vector, scale).distinct(), "integer-vectors")
    asking = usable.filter(is_query).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, -(-asking.count() // query_block))
    asking = stored(asking.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(blocks))), "query-vectors")
    answers = None
    for block in range(blocks):
        mine = asking.filter(F.col("block") == block).toPandas()  # about query_block rows
        work = _search(mine["id"].to_numpy(), np.array([np.asarray(v) for v in mine["v"]] + [None], dtype=object)[:-1], k, bits)
        part = usable.mapInPandas(work, "query_id long, id long, score long")
        answers = part if answers is None else answers.unionByName(part)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return answers.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "id", "score")
