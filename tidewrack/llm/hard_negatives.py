"""Hard negatives by threshold joins in the manner of L2AP.

An anchor asks for the best ``k`` rows whose score lies in a window. Scores are integer
inner products. A block of anchors meets a chunk of rows in one task:

* The chunk's inverted index lists, per group of dimensions (those with the most energy
  first), the rows that need it. A row is left out of all groups from which on its suffix
  norm times the anchor's norm can't reach the threshold.
* Partial scores are accumulated group by group. A pair is given up as soon as its partial score plus
  the product of both remaining norms is below the threshold. What survives is scored exactly.
* The threshold starts near the windows' upper ends and is lowered until every window of an
  anchor holds ``k`` rows of the chunk, or the windows' lower ends are reached.

One chunk is asked first. Its k-th best score in a window is a bound that no answer of the
whole table can be below, so it raises the window's lower end for all other chunks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import stored

#: Rows of a chunk and anchors of a block: what one task holds at a time.
CHUNK_ROWS, BLOCK_ANCHORS = 8_192, 4_096
#: Dimensions of an index group, anchors that accumulate together.
GROUP, TOGETHER = 8, 128
#: How far the threshold is lowered, as shares of the way from a window's upper to its lower end.
LOWERED = (0.15, 0.35, 0.6, 1.0)
#: Squared norms from here on would make scores inexact.
LIMIT = 2.0**53
NONE = -(1 << 62)


def _rests(rows: np.ndarray) -> np.ndarray:
    """Norm of what each group of dimensions and all after it hold; the last column is zero."""
    edges = np.arange(0, rows.shape[1], GROUP)
    if not len(edges):
        return np.zeros((len(rows), 1))
    energy = np.add.reduceat(rows * rows, edges, axis=1)
    rest = np.sqrt(np.cumsum(energy[:, ::-1], axis=1)[:, ::-1])
    return np.hstack([rest, np.zeros((len(rows), 1))])


class ChunkIndex:
    """A chunk's rows with dimensions in falling order of energy, and their suffix norms."""

    def __init__(self, rows: np.ndarray) -> None:
        self.order = np.argsort(-np.square(rows).sum(0), kind="stable")
        self.rows = np.ascontiguousarray(rows[:, self.order])
        self.rest = _rests(self.rows)
        #: partial sums made, one per anchor, row and group
        self.sums = 0

    def pairs(self, asking: np.ndarray, rest: np.ndarray, least: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, score) of the allowed pairs that score ``least`` (one per anchor) or more."""
        slack = 1.0 + 1e-9 * rest[:, 0] * (self.rest[:, 0].max() if len(self.rows) else 0.0)
        need = least - slack
        # groups a row is listed in: while its suffix norm can still lift the neediest anchor over its threshold
        tau = (need / np.maximum(rest[:, 0], 1e-12)).min()
        listed = (self.rest[:, :-1] >= tau).sum(1)
        partial = np.zeros((len(asking), len(self.rows)))
        live = np.flatnonzero(allowed.any(0))
        done = []
        for group in range(self.rest.shape[1] - 1):
            done.append(live[listed[live] <= group])
            live = live[listed[live] > group]
            if not len(live):
                break
            dims = slice(group * GROUP, (group + 1) * GROUP)
            partial[:, live] += asking[:, dims] @ self.rows[live, dims].T
            self.sums += len(asking) * len(live)
            upper = partial[:, live] + rest[:, group + 1, None] * self.rest[live, group + 1]
            live = live[((upper >= need[:, None]) & allowed[:, live]).any(0)]
        rows = np.concatenate([*done, live])
        at = listed[rows]
        upper = partial[:, rows] + rest[:, at] * self.rest[rows, at]
        anchor, row = np.nonzero((upper >= need[:, None]) & allowed[:, rows])
        row = rows[row]
        scores = np.empty(len(row))
        for start in range(0, len(row), 100_000):
            part = slice(start, start + 100_000)
            scores[part] = np.einsum("ij,ij->i", asking[anchor[part]], self.rows[row[part]])
        keep = scores >= least[anchor]
        return anchor[keep], row[keep], scores[keep].astype(np.int64)


def best_in_windows(index: ChunkIndex, ids: np.ndarray, asking: np.ndarray, low: np.ndarray, high: np.ndarray, allowed: np.ndarray, k: int) -> list[tuple[int, int, int, int]]:
    """(anchor, window, id, score): the k best rows of each window ``low <= score <= high``.

    ``low`` and ``high`` have a row per anchor and a column per window; a window with
    ``low > high`` is empty. Ties go to the smaller id.
    """
    asking = asking[:, index.order]
    rest = _rests(asking)
    real = low <= high
    top = np.where(real, high, NONE).max(1, initial=NONE)
    most = np.ceil(rest[:, 0] * (index.rest[:, 0].max() if len(ids) else 0.0)) + 1
    top = np.minimum(top, most)
    floor = np.maximum(np.where(real, low, -NONE).min(1, initial=-NONE), -most)
    open_ = np.flatnonzero(real.any(1) & (floor <= top))
    found = []
    for share in LOWERED:
        if not len(open_):
            break
        least = floor[open_] if share == 1.0 else np.maximum(floor[open_], np.floor(top[open_] - share * (top[open_] - floor[open_])))
        anchor, row, score = index.pairs(asking[open_], rest[open_], least, allowed[open_])
        edges = np.searchsorted(anchor, np.arange(len(open_) + 1))
        wait = []
        for i, a in enumerate(open_):
            own_rows, own = row[edges[i] : edges[i + 1]], score[edges[i] : edges[i + 1]]
            order = np.lexsort((ids[own_rows], -own))
            own_rows, own = own_rows[order], own[order]
            # scores fall, so a window is a stretch
            starts = np.searchsorted(-own, -high[a], "left")
            stops = np.searchsorted(-own, -low[a], "right")
            if least[i] > floor[a] and (real[a] & (stops - starts < k)).any():
                wait.append(a)
                continue
            for w in np.flatnonzero(real[a]):
                for at in range(starts[w], min(stops[w], starts[w] + k)):
                    found.append((int(a), int(w), int(ids[own_rows[at]]), int(own[at])))
        open_ = np.array(wait, np.int64)
    return found


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), width)


def _answers(k: int, same: bool):
    """Task of a (dimensions, chunk, block): anchors (id, label, v, low, high) meet rows (id, label, v)."""

    def run(key: tuple, asks: pa.Table, rows: pa.Table) -> pa.Table:
        found: list[tuple[int, int, int, int]] = []
        if asks.num_rows and rows.num_rows:
            width = key[0].as_py()
            asks = asks.sort_by([("label", "ascending"), ("id", "ascending")])
            ids, labels, vectors = rows["id"].to_numpy(), rows["label"].to_numpy(), _matrix(rows["v"], width)
            own_ids, own_labels, asking = asks["id"].to_numpy(), asks["label"].to_numpy(), _matrix(asks["v"], width)
            windows = len(asks["low"][0])
            low, high = (asks[name].combine_chunks().flatten().to_numpy().reshape(-1, windows) for name in ("low", "high"))
            whole = None if same else ChunkIndex(vectors)
            for start in range(0, len(own_ids), TOGETHER):
                part = slice(start, start + TOGETHER)
                use = np.flatnonzero(np.isin(labels, own_labels[part])) if same else np.arange(len(ids))
                if not len(use):
                    continue
                index = ChunkIndex(vectors[use]) if same else whole
                alike = own_labels[part, None] == labels[use]
                allowed = (alike if same else ~alike) & (own_ids[part, None] != ids[use])
                best = best_in_windows(index, ids[use], asking[part], low[part], high[part], allowed, k)
                found += [(int(own_ids[start + a]), w, i, s) for a, w, i, s in best]
        columns = list(zip(*found)) if found else [[], [], [], []]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.int64()), pa.array(columns[3], pa.int64())], names=["anchor_id", "window", "id", "score"])

    return run


def _asked(asks: DataFrame, rows: DataFrame, chunks: int, blocks: int, k: int, same: bool) -> DataFrame:
    """(anchor_id, window, id, score): the k best of ``rows``, chunk by chunk, then over all."""
    block = F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int")
    sent = asks.select("dim", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), block.alias("block"), "id", "label", "v", "low", "high")
    met = rows.select("dim", "chunk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "id", "label", "v")
    keys = ("dim", "chunk", "block")
    answers = sent.groupBy(*keys).cogroup(met.groupBy(*keys)).applyInArrow(_answers(k, same), "anchor_id long, window int, id long, score long")
    best = Window.partitionBy("anchor_id", "window").orderBy(F.desc("score"), "id")
    return answers.withColumn("rank", F.row_number().over(best).cast("int")).filter(F.col("rank") <= k)


def best_rows(asks: DataFrame, rows: DataFrame, chunks: int, blocks: int, k: int, same: bool, label: str) -> DataFrame:
    """(anchor_id, window, rank, id, score) of the windows of ``asks`` over ``rows``.

    The first chunk's k-th best of a window raises the window's lower end for the whole search.
    """
    first = _asked(asks, rows.filter("chunk = 0"), 1, blocks, k, same)
    reached = first.filter(F.col("rank") == k).groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("window", "score"))).alias("reached"))
    raised = F.transform("low", lambda x, w: F.greatest(x, F.coalesce(F.try_element_at("reached", w), x)))
    asks = asks.join(reached.withColumnRenamed("anchor_id", "id"), "id", "left").withColumn("low", raised).drop("reached")
    return stored(_asked(stored(asks, f"{label}-asks"), rows, chunks, blocks, k, same), f"{label}-best")


def integer_rows(frame: DataFrame, label: Column, id_column: str, vector: str, scale: int) -> DataFrame:
    """(id, label, dim, v array<int>): floor(scale * x) per component, of the rows that take part.

    Raises where a score might not be exact in 53 bits.
    """
    whole = F.transform(F.col(vector), lambda x: x.cast("double"))
    finite = ~F.exists(whole, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    scaled = F.transform(whole, lambda x: F.floor(x * scale))
    usable = frame.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), F.when(finite, scaled).alias("w"))
    usable = usable.filter("id IS NOT NULL AND label IS NOT NULL AND w IS NOT NULL")
    energy = F.aggregate("w", F.lit(0.0), lambda total, x: total + x.cast("double") * x.cast("double"))
    largest = usable.agg(F.max(energy)).first()[0]
    if largest is not None and largest >= LIMIT:
        raise ValueError(f"scores of vectors with a squared norm of {largest:g} aren't exact; scale them down")
    return usable.select("id", "label", F.size("w").alias("dim"), F.transform("w", lambda x: x.cast("int")).alias("v"))


def hard_negatives(
    frame: DataFrame, is_anchor: Column, label: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90,
    id_column: str = "vec_id", vector: str = "embedding", scale: int = 256, chunk_rows: int = CHUNK_ROWS, block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Rows with ``is_anchor`` (a condition on ``id``) are anchors. An anchor's positives are its
    best other rows of the same ``label``; for each, the best rows of other labels
    that score from ``least`` to ``most`` percent of the positive are returned. Better means a higher
    score, then a smaller id. Where there are fewer, all are returned.

    Rows with a null id, label or vector, or a null or non-finite component take no part.
    Vectors of another length never meet, nor do rows that share an id; exact repeats of a
    row count once. Of an anchor id with different rows the smallest (label, vector) asks.
    Empty vectors score zero with each other. Integer vectors whose squared norm is 2^53 or more raise.
    """
    rows = stored(integer_rows(frame, label, id_column, vector, scale).distinct(), "negative-rows")
    chunks = max(1, -(-rows.count() // chunk_rows))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
    anchors = rows.filter(is_anchor).groupBy("id").agg(F.min(F.struct("label", "dim", "v")).alias("x"))
    anchors = stored(anchors.select("id", "x.label", "x.dim", "x.v"), "negative-anchors")
    blocks = max(1, -(-anchors.count() // block_anchors))
    ends = [F.array(F.lit(end).cast("long")).alias(name) for name, end in (("low", NONE), ("high", -NONE))]
    near = best_rows(anchors.select("*", *ends), rows, chunks, blocks, positives, True, "positive").withColumn("window", F.col("rank") - 1)
    windows = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("window", F.col("score").alias("p")))).alias("p"))
    # 100 * score lies in [least * p, most * p]: the lower end is rounded up, the upper one down, also below zero
    wide = windows.select(
        F.col("anchor_id").alias("id"),
        F.expr(f"transform(p, x -> (x.p * {least} + pmod(-x.p * {least}, 100)) div 100)").alias("low"),
        F.expr(f"transform(p, x -> (x.p * {most} - pmod(x.p * {most}, 100)) div 100)").alias("high"),
    )
    # of equal width for all anchors; a window that is not there is empty
    padded = [F.slice(F.concat(name, F.array_repeat(F.lit(end).cast("long"), positives)), 1, positives).alias(name) for name, end in (("low", 1), ("high", 0))]
    asks = stored(anchors.join(wide, "id").select("id", "label", "dim", "v", *padded), "negative-asks")
    found = best_rows(asks, rows, chunks, blocks, negatives, False, "negative")
    listed = near.select("anchor_id", "window", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return found.join(listed, ["anchor_id", "window"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
