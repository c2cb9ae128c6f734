"""Packing tokenised documents into fixed-length sequences by cutting-stock column generation.

Documents are cut into whole sequences and one remainder. The remainders' length histogram
is a cutting-stock problem: a linear program chooses how often to use each pattern of
lengths; a knapsack dynamic program, fed with the program's dual prices, finds the next
pattern worth adding. Rounded down, the patterns say which ranks of each length go into
which sequence. What rounding leaves over, a number bounded by the histogram's size, is laid
end to end and cut; its last sequence is cut at powers of two, which need no padding.

Only the histogram reaches the driver. Ranks, sequences and offsets are found by Spark.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import gapless_ranks, stored

LENGTH = 2048
#: Tokens per histogram class; a remainder fits a pattern by its class's upper end.
GRAIN = 4
END_ID = 1
VOCABULARY = "byte_bpe_50k.json"


class Encoder:
    """Token ids as little-endian 32-bit numbers, as the tokenizer file ``name`` gives them.

    The file's vocabulary also comes as ranks, which a faster library reads; it serves texts in
    Latin letters, where both cut words alike. All other texts go through the file itself, and
    so do those that hold an added token's content, which the file gives an id of its own.
    """

    LATIN = re.compile("[^\x00-ɏ‐-‧]")

    def __init__(self, name: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(public_tokenizers.path(name))
        self.added = [token.content for token in self.whole.get_added_tokens_decoder().values()]
        self.ranks = None
        if name == VOCABULARY:
            with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.ranks = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.ranks is not None and not self.LATIN.search(text) and not any(a in text for a in self.added):
            return self.ranks.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def tokenised(docs: DataFrame, text: str = "text", id_column: str = "doc_id", vocabulary: str = VOCABULARY, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """One row per piece of at most ``length`` ids: id, doc_tokens, start, length, ids (binary).

    Null text counts as empty; every document ends with ``end_id``. Only a document's last
    piece can be shorter than ``length``.
    """
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, end, cut = Encoder(vocabulary), np.array([end_id], "<u4").tobytes(), 4 * length
        for batch in batches:
            at, total, start, ids, held = [], [], [], [], 0
            texts = batch.column(1)
            for row in range(batch.num_rows):
                data = encoder.encode(texts[row].as_py() or "") + end
                for first in range(0, len(data), cut):
                    at.append(row), total.append(len(data) // 4), start.append(first // 4), ids.append(data[first : first + cut])
                held += len(data)
                if held > 1 << 23 or row == batch.num_rows - 1:
                    size = pa.array([len(x) // 4 for x in ids], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(at, pa.int64())), pa.array(total, pa.int64()), pa.array(start, pa.int64()), size, pa.array(ids, pa.binary())],
                        ["id", "doc_tokens", "start", "length", "ids"],
                    )
                    at, total, start, ids, held = [], [], [], [], 0

    rows = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, doc_tokens long, start long, length long, ids binary")


def best_patterns(sizes: np.ndarray, prices: np.ndarray, capacity: int, most: int = 16) -> tuple[float, list[np.ndarray]]:
    """Unbounded knapsack: the value of the best pattern of ``sizes`` within ``capacity``, and the
    best patterns (as counts) that hold each of the sizes, the most valuable first.
    ``sizes`` must rise.
    """
    value, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fits = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(1, capacity + 1):
        value[room] = value[room - 1]
        if fits[room]:
            some = value[room - sizes[: fits[room]]] + prices[: fits[room]]
            best = int(some.argmax())
            if some[best] > value[room] + 1e-12:
                value[room], choice[room] = some[best], best
    holding = value[capacity - sizes] + prices
    found = {}
    for i in np.argsort(-holding, kind="stable")[:most]:
        counts, room = np.zeros(len(sizes), np.int64), capacity - int(sizes[i])
        counts[i] = 1
        while room > 0:
            if choice[room] < 0:
                room -= 1
            else:
                counts[choice[room]] += 1
                room -= int(sizes[choice[room]])
        found.setdefault(counts.tobytes(), counts)
    return float(value[capacity]), list(found.values())


def first_basis(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pattern per size: the fullest one of the sizes that are left, large ones preferred,
    used until a size runs out. Each pattern lacks the sizes that ran out before, so the
    basis is triangular in the order in which they do, and inverted row by row.
    Returns patterns, their use, and the inverse.
    """
    m, left, alive = len(sizes), demand.astype(np.float64), np.ones(len(sizes), bool)
    patterns, use = np.zeros((m, m)), np.zeros(m)
    order = []
    for _ in range(m):
        rest = np.flatnonzero(alive)
        counts = np.zeros(m)
        counts[rest] = best_patterns(sizes[rest], (sizes[rest] / capacity) ** 1.01, capacity, 1)[1][0]
        some = np.flatnonzero(counts)
        gone = int(some[(left[some] / counts[some]).argmin()])
        patterns[gone], use[gone], alive[gone] = counts, left[gone] / counts[gone], False
        left = np.maximum(left - use[gone] * counts, 0)
        order.append(gone)
    lower = patterns[np.ix_(order, order)].T
    inverse = np.zeros((m, m))
    for i in range(m):
        inverse[i, i] = 1
        inverse[i] = (inverse[i] - (lower[i, :i, None] * inverse[:i]).sum(0)) / lower[i, i]
    back = np.argsort(order)
    return patterns, use, inverse[np.ix_(back, back)]


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int, gap: float = 1e-4, limit: int = 300) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (rows of counts) and how often to use each, from the linear program.

    The basis is improved by the patterns that the knapsack finds worth most at the current
    prices, until none is worth more than a sequence, the lower bound is within ``gap``, or
    ``limit`` rounds are over (what is used is always a whole solution).
    """
    m = len(sizes)
    patterns, use, inverse = first_basis(sizes, demand, capacity)
    bound = float((sizes * demand).sum()) / capacity
    for _ in range(limit):
        if use.sum() - bound <= gap * use.sum():
            break
        worth, columns = best_patterns(sizes, inverse.sum(0), capacity)
        bound = max(bound, use.sum() / max(worth, 1))
        if worth <= 1 + 1e-9:
            break
        for counts in columns:
            if (inverse.sum(0) * counts).sum() <= 1 + 1e-9:
                continue
            step = (inverse * counts).sum(1)
            up = step > 1e-9
            ratio = np.full(m, np.inf)
            ratio[up] = np.maximum(use[up], 0) / step[up]
            leaves = int(ratio.argmin())
            use = use - ratio[leaves] * step
            use[leaves] = ratio[leaves]
            patterns[leaves] = counts
            inverse[leaves] /= step[leaves]
            rest = step.copy()
            rest[leaves] = 0
            inverse -= np.outer(rest, inverse[leaves])
    return patterns.astype(np.int64), np.maximum(use, 0)


@dataclass
class Plan:
    """Which ranks of each class go where; size bounded by the number of classes squared.

    For each class: rising first ranks of its runs, and each run's pattern, copies per
    sequence and place of the first copy. ``covered`` ranks are placed, the rest left over.
    """

    runs: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    covered: dict[int, int]
    first_sequence: np.ndarray
    sequences: int


def plan(histogram: dict[int, int], length: int, grain: int) -> Plan:
    """Round the linear program's patterns down and deal ranks of each class to them."""
    if not histogram:
        return Plan({}, {}, np.zeros(0, np.int64), 0)
    classes = np.array(sorted(histogram))
    demand = np.array([histogram[c] for c in classes], np.float64)
    patterns, use = column_generation(classes, demand, -(-length // grain))
    times = np.floor(use + 1e-6).astype(np.int64)
    while (over := (patterns * times[:, None]).sum(0) > demand).any():  # after rounding errors
        times[(patterns[:, over].sum(1) > 0) & (times > 0)] -= 1
    first = np.r_[0, np.cumsum(times)[:-1]]
    runs, covered = {}, {}
    for i, c in enumerate(classes):
        with_class = np.flatnonzero((patterns[:, i] > 0) & (times > 0))
        copies = patterns[with_class, i]
        ends = np.cumsum(copies * times[with_class])
        place = patterns[with_class, :i].sum(1)
        runs[int(c)] = (np.r_[0, ends[:-1]] if len(ends) else ends, with_class, copies, place)
        covered[int(c)] = int(ends[-1]) if len(ends) else 0
    return Plan(runs, covered, first, int(times.sum()))


def _place(made: Plan):
    """Sequence and place for ranked remainders (class ``c``, ``rank`` in it)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for c, part in batch.groupby("c"):
                starts, pattern, copies, place = made.runs[c]
                rank = part["rank"].to_numpy()
                at = np.searchsorted(starts, rank, side="right") - 1
                inside = rank - starts[at]
                sequence = made.first_sequence[pattern[at]] + inside // copies[at]
                yield pd.DataFrame({"uid": part["uid"], "length": part["length"], "sequence": sequence, "place": place[at] + inside % copies[at]})

    return run


@dataclass
class Packed:
    """``placed``: a row per piece (id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, uid); ``pieces``: their token ids by (uid, start) before the last cut."""

    placed: DataFrame
    pieces: DataFrame

    def with_ids(self) -> DataFrame:
        """``placed`` with each piece's token ids as a binary of little-endian 32-bit numbers."""
        from_piece = self.pieces.select("uid", F.col("start").alias("_from"), "ids")
        ids = F.substring(F.col("ids"), (4 * (F.col("start") - F.col("_from")) + 1).cast("int"), (4 * F.col("length")).cast("int"))
        return self.placed.join(from_piece, "uid").withColumn("ids", ids).drop("_from")


def pack(docs: DataFrame, text: str = "text", id_column: str = "doc_id", length: int = LENGTH, grain: int = GRAIN, vocabulary: str = VOCABULARY, end_id: int = END_ID) -> Packed:
    """Pack every row of ``docs``; repeated rows are packed as often as they stand there.

    Each token id lies in exactly one piece; a sequence's pieces are gapless from offset 0
    and hold at most ``length`` ids. Empty and null texts are one piece of the end id. An
    empty table gives no pieces. Sequence ids are unique and not gapless.
    """
    cut = tokenised(docs, text, id_column, vocabulary, end_id, length)
    pieces = stored(cut.withColumn("uid", F.monotonically_increasing_id()).withColumn("ids_crc32", F.crc32("ids")), "token-pieces")
    facts = pieces.drop("ids")
    short = facts.filter(F.col("length") < length).withColumn("c", F.ceil(F.col("length") / grain).cast("long"))
    histogram = {row["c"]: row["count"] for row in short.groupBy("c").count().collect()}  # length / grain rows
    made = plan(histogram, length, grain)
    ranked = gapless_ranks(short.select("uid", "c", "length"), ["c"], [F.desc("length")], "rank", "piece-ranks")
    covered = F.lit(0)
    limits = F.create_map(*(F.lit(int(x)) for pair in made.covered.items() for x in pair)) if made.covered else None
    if limits is not None:
        covered = F.coalesce(limits[F.col("c").cast("int")], F.lit(0))
    ranked = stored(ranked.withColumn("fits", F.col("rank") < covered), "ranked-pieces")

    def offsets(frame: DataFrame) -> DataFrame:
        before = Window.partitionBy("sequence").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
        return frame.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))

    pattern = offsets(ranked.filter("fits").mapInPandas(_place(made), "uid long, length long, sequence long, place long")) if made.sequences else None
    # left over: at most one pattern's worth for each class, so one window may hold them
    ends = Window.orderBy(F.desc("length"), "uid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rest = stored(ranked.filter("not fits").withColumn("end", F.sum("length").over(ends)), "left-over")
    total = rest.agg(F.coalesce(F.max("end"), F.lit(0))).first()[0]
    whole, tail, marks = total // length, total % length, []
    bounds = []
    while tail:  # the last, short sequence: falling powers of two
        step = 1 << (tail.bit_length() - 1)
        bounds.append(step)
        tail -= step
    for step in bounds:
        marks.append((marks[-1] if marks else whole * length) + step)
    inner = F.transform(F.sequence(F.floor((F.col("end") - F.col("length")) / length), F.floor(F.col("end") / length)), lambda i: i * length)
    tails = F.array(*(F.lit(m).cast("long") for m in marks)) if marks else F.array().cast("array<long>")
    start = F.col("end") - F.col("length")
    knives = F.array_sort(F.array_distinct(F.filter(F.concat(inner, tails), lambda x: (x > start) & (x < F.col("end")))))
    edges = F.concat(F.array(start), knives)
    stops = F.concat(knives, F.array(F.col("end")))
    laid = rest.select("uid", start.alias("begin"), F.explode(F.arrays_zip(edges.alias("lo"), stops.alias("hi"))).alias("x"))
    laid = laid.select("uid", (F.col("x.lo") - F.col("begin")).alias("skip"), (F.col("x.hi") - F.col("x.lo")).alias("length"), F.col("x.lo").alias("lo"))
    number = F.floor(F.col("lo") / length)
    origin = number * length
    for mark in marks[:-1]:
        number = F.when(F.col("lo") >= mark, F.lit(whole + marks.index(mark) + 1)).otherwise(number)
        origin = F.when(F.col("lo") >= mark, F.lit(mark)).otherwise(origin)
    laid = laid.select("uid", "skip", "length", (number + made.sequences).cast("long").alias("sequence"), (F.col("lo") - origin).cast("long").alias("offset"))
    crc = F.crc32(F.substring(F.col("ids"), (4 * F.col("skip") + 1).cast("int"), (4 * F.col("piece")).cast("int")))
    cut_again = (
        pieces.join(F.broadcast(laid.withColumnRenamed("length", "piece")), "uid")  # bounded, as said above
        .select("id", (F.col("start") + F.col("skip")).alias("start"), F.col("piece").alias("length"), crc.alias("ids_crc32"), "doc_tokens", F.col("sequence").alias("sequence_id"), "offset", "uid")
    )
    base = made.sequences + whole + len(marks)
    columns = ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "uid")
    full = facts.filter(F.col("length") == length).withColumn("sequence_id", F.col("uid") + base).withColumn("offset", F.lit(0).cast("long")).select(*columns)
    placed = full.unionByName(cut_again)
    if pattern is not None:
        placed = placed.unionByName(facts.join(pattern.select("uid", F.col("sequence").alias("sequence_id"), "offset"), "uid").select(*columns))
    return Packed(placed.withColumnRenamed("id", id_column), pieces)
