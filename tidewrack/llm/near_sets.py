"""Near copies by the Jaccard similarity of word-shingle sets: prefix lists, SimHash distance, exact sets.

Put every set's shingles into one common order. Two sets of similarity t or more share a
shingle among the first n - ceil(t n) + 1 of each, so only those are listed. Any common order
is right; shingles that are frequent in a sample come last, which keeps frequent ones out of
the lists. To spare large groups of near copies all their pairs, members of a list meet its
first one at first, then each text meets the few nearest to it by fingerprint in other components; of
the rest, only pairs that are not in one component yet are tried.

Most pairs that meet share a passage and nothing else. Their SimHash fingerprints (256 bits over the sets) are
far apart, while those of similar sets are close: at a similarity of 0.8 they differ by 39 bits on
average, unrelated ones by 128. Pairs further apart than ``REACH`` go. A similar pair is that far apart with a
probability of about one in a million for sets of four and five shingles, and far less for larger ones. Marks
rule out more, without any error: they hold for each of a number of cells whether an odd number of a set's shingles
falls into it, so the marks of two sets differ in at most as many cells as the sets do in shingles. Lists use marks of
256 cells, pairs marks of 1,024 before they are verified. Only what is left is verified, on sets that are made once
for each text and travel instead of texts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tables import components, discard, stored

WORDS, SIMILARITY = 5, 0.8
#: Most bits that the fingerprints of a pair may differ by to be verified.
REACH = 80
#: Columns of a fingerprint, 64 bits each.
PRINT = ("p", "q", "u", "v")
#: Columns of a text's marks in lists, 64 cells each, and their number for pairs.
MARKS, PAIR_MARKS = ("w", "x", "y", "z"), 16
#: Leaders that a text is held against at first.
LEADERS = 3
#: The most texts of other components that a text meets for being nearest.
NEAREST = 3
#: Sets sampled for the order of shingles, and the most shingles that it moves to the end.
SAMPLED, FREQUENT = 5_000, 50_000


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Distinct XXH64 of the word shingles, rising; shorter texts are one shingle, wordless ones none."""
    parts = (text or "").encode().lower().split()
    if not parts:
        return np.zeros(0, np.uint64)
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else [b" ".join(parts)]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(s, 42) for s in shingles], np.uint64))


def set_key(shingles: np.ndarray) -> int:
    """A signed number that equal sets share; 0 for no shingle."""
    return int(np.array([xxhash.xxh64_intdigest(shingles.tobytes(), 7)], np.uint64).view(np.int64)[0]) if len(shingles) else 0


def _mixed(h: np.ndarray, step: int) -> np.ndarray:
    """64 further bits of each hash, others for every step."""
    h = h + np.uint64(step * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def set_print(shingles: np.ndarray) -> tuple[int, ...]:
    """SimHash of a set in signed parts of 64 bits: a bit is 1 if it is in over half the shingles' hashes."""
    total = np.zeros(64 * len(PRINT), np.int64)
    for start in range(0, len(shingles), 1 << 15):
        some = shingles[start : start + (1 << 15)]
        parts = np.stack([some, *(_mixed(some, step) for step in range(1, len(PRINT)))], axis=1).astype("<u8").view(np.uint8).reshape(-1, 8 * len(PRINT))
        total += np.unpackbits(parts, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return tuple(np.packbits(2 * total > len(shingles), bitorder="little").view("<i8").tolist())


def set_marks(shingles: np.ndarray, words: int = len(MARKS)) -> tuple[int, ...]:
    """Whether an odd number of shingles falls into each of ``64 * words`` cells, in signed parts of 64 bits."""
    cells = (_mixed(shingles, len(PRINT)) % np.uint64(64 * words)).astype(np.int64)
    odd = (np.bincount(cells, minlength=64 * words) & 1).astype(np.uint8)
    return tuple(np.packbits(odd, bitorder="little").view("<i8").tolist())


def most_apart(sizes, similarity: float):
    """Most shingles that only one of two sets has if they are as similar as asked; ``sizes`` is the sum of theirs."""
    return sizes * ((1 - similarity) / (1 + similarity)) + 1e-6


def _frequent(nodes: DataFrame, words: int) -> np.ndarray:
    """Shingles of three or more sampled sets, the rarest first; a bounded number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column(0):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(text.as_py(), words).view(np.int64))], ["s"])

    share = min(1.0, SAMPLED / max(1, nodes.count()))
    some = nodes.filter(F.pmod(F.xxhash64("node"), F.lit(1_000_000)) < share * 1_000_000).select("text")
    counts = some.mapInArrow(run, "s long").groupBy("s").count().filter("count > 2")
    found = counts.orderBy(F.desc("count"), "s").limit(FREQUENT).toPandas()
    return found["s"].to_numpy(np.int64).view(np.uint64)[::-1].copy()


def _listed(nodes: DataFrame, words: int, similarity: float, frequent: np.ndarray) -> DataFrame:
    """(s, node, n, at): the shingles in a set's prefix, the set's size, the place in its order."""
    order = np.argsort(frequent)
    values = frequent[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(text.as_py(), words)
                n = len(shingles)
                if not n:
                    continue
                if len(values):
                    at = np.minimum(np.searchsorted(values, shingles), len(values) - 1)
                    late = np.where(values[at] == shingles, order[at] + 1, 0)
                    shingles = shingles[np.argsort(late, kind="stable")]
                size = n - ceil(similarity * n - 1e-9) + 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shingles[:size].view(np.int64)), pa.array(np.full(size, node, np.int64)), pa.array(np.full(size, n, np.int32)), pa.array(np.arange(size, dtype=np.int32))],
                    ["s", "node", "n", "at"],
                )

    return nodes.select("node", "text").mapInArrow(run, "s long, node long, n int, at int")


def _by_shingle(batches: Iterator[pa.RecordBatch], work: Callable[[list[np.ndarray]], Iterator[list[np.ndarray]]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """``work`` on columns with whole runs of the first one, in which the batches are sorted."""
    held: list[list[np.ndarray]] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        first = int(np.searchsorted(columns[0], columns[0][-1]))  # where the last run begins
        if held and first == 0 and held[-1][0][-1] == columns[0][0]:
            held.append(columns)
            continue
        held.append([c[:first] for c in columns])
        for out in work([np.concatenate(c) for c in zip(*held)]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
        held = [[c[first:] for c in columns]]
    if held:
        for out in work([np.concatenate(c) for c in zip(*held)]):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)


def _runs(keys: np.ndarray) -> Iterator[tuple[int, int]]:
    """Bounds of the runs of two or more."""
    edges = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1], True]) if len(keys) else np.zeros(1, np.int64)
    long = np.flatnonzero(np.diff(edges) > 1)
    yield from zip(edges[long].tolist(), edges[long + 1].tolist())


def _with_leader(similarity: float):
    """Rows of shared shingles, each with a member of its list whose size allows the similarity."""

    def work(columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        s, n, node, at = columns
        rows, leaders = [], []
        for lo, hi in _runs(s):
            leader = lo
            for i in range(lo, hi):
                if n[leader] < similarity * n[i] - 1e-9:
                    leader = i
                rows.append(i)
                leaders.append(leader)
        if rows:
            yield [s[rows], n[rows], node[rows], at[rows], node[leaders]]

    return lambda batches: _by_shingle(batches, work, ["s", "n", "node", "at", "leader"])


def _allowed(columns: list[np.ndarray], i: int, rest: slice, similarity: float) -> np.ndarray:
    """Which of ``rest`` are in other components than row i and may be similar by sizes and places."""
    _, n, _, at, part = columns[:5]
    common = similarity / (1 + similarity) * (n[i] + n[rest])
    # prefixes are in one order, so what lies before a shared place in both can be common too
    most = np.minimum(at[i], at[rest]) + np.minimum(n[i] - at[i], n[rest] - at[rest])
    larger, smaller = np.maximum(n[i], n[rest]), np.minimum(n[i], n[rest])
    return (part[rest] != part[i]) & (smaller >= similarity * larger - 1e-9) & (most >= common - 1e-6)


def _apart(columns: list[np.ndarray], i: int, left: np.ndarray, prints: np.ndarray, marks: np.ndarray, similarity: float) -> tuple[np.ndarray, np.ndarray]:
    """Those of ``left`` that fingerprints and marks allow to be similar to row i, and the bits their fingerprints differ by."""
    n = columns[1].astype(np.int64)
    odd = np.bitwise_count(marks[left] ^ marks[i]).sum(1, dtype=np.int64)
    left = left[odd <= most_apart(n[i] + n[left], similarity)]
    apart = np.bitwise_count(prints[left] ^ prints[i]).sum(1, dtype=np.int32)
    return left[apart <= REACH], apart[apart <= REACH]


def _sketches(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints and marks of the rows of a list."""
    parts = [c.view(np.uint64) for c in columns[5:]]
    return np.stack(parts[: len(PRINT)], axis=1), np.stack(parts[len(PRINT) :], axis=1)


def _nearest(similarity: float):
    """(node, other, apart): the nearest allowed member of another component in each list, by fingerprint."""

    def work(columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        s, _, node, _, part = columns[:5]
        prints, marks = _sketches(columns)
        rows, others, far = [], [], []
        for lo, hi in _runs(s):
            if (part[lo:hi] == part[lo]).all():
                continue
            for i in range(lo, hi):
                left = np.flatnonzero(_allowed(columns, i, slice(lo, hi), similarity)) + lo
                if len(left):
                    left, apart = _apart(columns, i, left, prints, marks, similarity)
                if len(left):
                    best = int(apart.argmin())
                    rows.append(i)
                    others.append(left[best])
                    far.append(apart[best])
        if rows:
            yield [node[rows], node[others], np.array(far, np.int32)]

    return lambda batches: _by_shingle(batches, work, ["node", "other", "apart"])


def _across(similarity: float):
    """Pairs of a list that are in different components and that sizes, places, marks and fingerprints allow."""

    def work(columns: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
        s, _, node, _, part = columns[:5]
        prints, marks = _sketches(columns)
        low, high, held = [], [], 0
        for lo, hi in _runs(s):
            if (part[lo:hi] == part[lo]).all():
                continue
            for i in range(lo, hi - 1):
                left = np.flatnonzero(_allowed(columns, i, slice(i + 1, hi), similarity)) + i + 1
                if len(left):
                    left, _ = _apart(columns, i, left, prints, marks, similarity)
                if len(left):
                    others = node[left]
                    low.append(np.minimum(others, node[i]))
                    high.append(np.maximum(others, node[i]))
                    held += len(others)
                if held > 1 << 18:
                    yield [np.concatenate(low), np.concatenate(high)]
                    low, high, held = [], [], 0
        if held:
            yield [np.concatenate(low), np.concatenate(high)]

    return lambda batches: _by_shingle(batches, work, ["a", "b"])


def _close(pairs: DataFrame, prints: DataFrame) -> DataFrame:
    """The (a, b) of ``pairs`` whose fingerprints differ by REACH bits or less."""
    one, two = (prints.select(F.col("node").alias(n), *[F.col(x).alias(f"{n}{x}") for x in PRINT]) for n in "ab")
    apart = sum(F.bit_count(F.col(f"a{x}").bitwiseXOR(F.col(f"b{x}"))) for x in PRINT)
    return pairs.join(one, "a").join(two, "b").filter(apart <= REACH).select("a", "b")


def _verified(pairs: DataFrame, nodes: DataFrame, words: int, similarity: float) -> DataFrame:
    """The (a, b) of ``pairs`` (written) whose sets are as similar as asked."""

    marks = [f"m{i}" for i in range(PAIR_MARKS)]

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                shingles = shingle_set(text.as_py(), words)
                columns = [[node], [len(shingles)], *([x] for x in set_marks(shingles, PAIR_MARKS))]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array([shingles.tobytes()], pa.binary())], ["node", "n", *marks, "set"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, one = [], None, None
            a, b, sets, others = batch.columns
            for i in range(batch.num_rows):
                if a[i].as_py() != last:
                    last, one = a[i].as_py(), np.frombuffer(sets[i].as_py(), np.uint64)
                two = np.frombuffer(others[i].as_py(), np.uint64)
                common = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(common >= similarity * (len(one) + len(two) - common) - 1e-9)
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    sets = stored(nodes.select("node", "text").join(needed, "node", "left_semi").mapInArrow(make, f"node long, n long, {', '.join(f'{x} long' for x in marks)}, set binary"), "near-sets")
    one, two = (sets.select(F.col("node").alias(x), *[F.col(m).alias(f"{x}{m}") for m in ("n", *marks)]) for x in "ab")
    odd = sum(F.bit_count(F.col(f"a{m}").bitwiseXOR(F.col(f"b{m}"))) for m in marks)
    likely = pairs.join(one, "a").join(two, "b").filter(odd <= most_apart(F.col("an") + F.col("bn"), similarity)).select("a", "b")
    likely = stored(likely, "near-likely")
    left, right = (sets.select(F.col("node").alias(n), F.col("set").alias(f"s{n}")) for n in "ab")
    found = stored(likely.join(right, "b").join(left, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long"), "near-links-found")
    discard(sets, likely)
    return found


def links(nodes: DataFrame, prints: DataFrame, near: DataFrame, words: int = WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(a, b) with a < b whose components are those of all pairs of similar texts.

    ``nodes`` (node: long, unique; text) and ``prints`` (node, its ``set_print`` and ``set_marks``) are stable when read again.
    ``near`` (a, b) are pairs found by their fingerprints; lists find what is further apart.
    """
    listed = _listed(nodes, words, similarity, _frequent(nodes, words)).select("s", "n", "node", "at")
    in_order = listed.repartition("s").sortWithinPartitions("s", "n", "node")
    shared = stored(in_order.mapInArrow(_with_leader(similarity), "s long, n int, node long, at int, leader long"), "shared-shingles")
    # a text meets the leaders of a few of its lists, drawn by hash: most lists of a near copy are its group's
    drawn = F.array_distinct(F.array(*[F.min_by("leader", F.xxhash64("s", F.lit(draw))) for draw in range(LEADERS)]))
    met = shared.filter("node <> leader").groupBy("node").agg(drawn.alias("leaders")).select("node", F.explode("leaders").alias("leader"))
    met = met.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b"))
    met = met.unionByName(near).distinct()
    tried = stored(_close(met, prints), "near-led")
    found = _verified(tried, nodes, words, similarity)

    def parted(label: str) -> DataFrame:
        """Lists with the component that each member is in by now."""
        known = prints.join(components(found, label), "node", "left").select("node", F.coalesce("root", "node").alias("part"), *PRINT, *MARKS)
        rows = shared.drop("leader").join(known, "node").select("s", "n", "node", "at", "part", *PRINT, *MARKS)
        return rows.repartition("s").sortWithinPartitions("s", "n", "node")

    closest = parted("near-led-components").mapInArrow(_nearest(similarity), "node long, other long, apart int")
    closest = closest.groupBy("node").agg(F.slice(F.sort_array(F.collect_set(F.struct("apart", "other"))), 1, NEAREST).alias("x"))
    met = closest.select("node", F.explode("x.other").alias("other")).select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    # pairs are written before they are compared with those tried: each comes from every list that both are in
    fresh = stored(stored(met.distinct(), "near-met").join(tried, ["a", "b"], "left_anti"), "near-nearest")
    tried, found = tried.unionByName(fresh), found.unionByName(_verified(fresh, nodes, words, similarity))
    across = stored(parted("near-nearest-components").mapInArrow(_across(similarity), "a long, b long").distinct(), "near-across-met")
    across = stored(across.join(tried, ["a", "b"], "left_anti"), "near-across")
    more = _verified(across, nodes, words, similarity)
    discard(shared, tried, across)
    return found.unionByName(more)
