"""SimHash near-duplicates by the generalised pigeonhole principle.

A fingerprint's 64 bits are grouped into partitions, correlated bits together, so that the
other partitions stay selective. Two fingerprints within ``distance`` bits differ by at most
t_i bits in some partition i, for any thresholds t_i that add up to distance - partitions + 1
(-1: a partition that isn't probed). A dynamic program picks the thresholds with the fewest
expected rows, from counts of each partition's values. Every fingerprint is listed under its
value in each probed partition, and probes all values within the threshold; what meets is
verified. All of this runs on distinct fingerprints, so copies never meet each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm import near_sets
from tidewrack.llm.tables import components, stored, unused
from tidewrack.operators.dedupe import drop_rows

SHINGLE, DISTANCE, PARTITIONS = 3, 3, 3


def fingerprint(text: str | None, words: int = SHINGLE) -> int:
    """SimHash over XXH64 of word shingles; zero without words. Unsigned."""
    parts = (text or "").encode().lower().split()  # of bytes: lower-cases A-Z, splits at ASCII white space
    if not parts:
        return 0
    shingles = map(b" ".join, zip(*(parts[i:] for i in range(words)))) if len(parts) >= words else [b" ".join(parts)]
    digest = xxhash.xxh64_intdigest
    total, seen = np.zeros(64, np.int64), 0
    hashes = [digest(s, 42) for s in shingles]
    for start in range(0, len(hashes), 1 << 16):
        some = np.array(hashes[start : start + (1 << 16)], "<u8")
        total += np.unpackbits(some.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        seen += len(some)
    return int(np.packbits(2 * total > seen, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = SHINGLE) -> DataFrame:
    """(id, f: long, the 64 bits as a signed number) of every row; null text counts as empty."""
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t.as_py(), words) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["id", "f"])

    return docs.select(F.col(id_column).alias("id"), F.col(text).alias("text")).mapInArrow(run, f"id {kind}, f long")


def correlations(distinct: DataFrame) -> np.ndarray:
    """64 x 64 correlations of the bits over all fingerprints; tasks send sums of products."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((65, 65))
        for batch in batches:
            f = batch["f"].to_numpy(np.int64).view(np.uint64)
            bits = np.unpackbits(f.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            bits = np.hstack([bits, np.ones((len(bits), 1))])
            total += bits.T @ bits
        yield pd.DataFrame({"at": np.arange(65 * 65), "s": total.ravel()})

    sums = distinct.mapInPandas(run, "at int, s double").groupBy("at").agg(F.sum("s").alias("s")).toPandas()
    total = np.zeros(65 * 65)
    total[sums["at"].to_numpy(np.int64)] = sums["s"]
    total = total.reshape(65, 65)
    n = max(1.0, total[64, 64])
    mean = total[64, :64] / n
    cov = total[:64, :64] / n - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov), 1e-12))
    return cov / np.outer(sd, sd)


def group_bits(correlation: np.ndarray, partitions: int = PARTITIONS) -> list[list[int]]:
    """Split the bits into groups of near-equal number, correlated bits together.

    The most correlated bits seed a group, which takes the bits closest to what it holds
    until it is full; the next group starts among the bits left over.
    """
    strength = np.abs(correlation).copy()
    np.fill_diagonal(strength, 0)
    left, groups = set(range(len(strength))), []
    for number in range(partitions):
        room = -(-len(left) // (partitions - number))
        rest = sorted(left)
        group = [max(rest, key=lambda i: (strength[i, rest].max(), -i))]
        left.discard(group[0])
        while len(group) < room:
            best = max(sorted(left), key=lambda i: (strength[i, group].sum(), -i))
            group.append(best)
            left.discard(best)
        groups.append(sorted(group))
    return groups


def allocate(costs: list[list[float]], distance: int = DISTANCE) -> list[int]:
    """Thresholds t_i >= -1 with sum distance - len(costs) + 1 and least total cost.

    ``costs[i][t + 1]`` is the expected cost of threshold t in partition i. Dynamic
    programming over partitions and the sum still to be spent.
    """
    spend = distance - len(costs) + 1 + len(costs)  # thresholds counted from 0 as t + 1
    best: list[tuple[float, list[int]] | None] = [(0.0, [])] + [None] * spend
    for cost in costs:
        step: list[tuple[float, list[int]] | None] = [None] * (spend + 1)
        for used, state in enumerate(best):
            if state is None:
                continue
            for t1, c in enumerate(cost[: spend - used + 1]):
                now = (state[0] + c, [*state[1], t1 - 1])
                if step[used + t1] is None or now < step[used + t1]:
                    step[used + t1] = now
        best = step
    return best[spend][1]


def value_of(column, bits: list[int]):
    """The number that a fingerprint's ``bits`` spell, as a column of longs."""
    mask = sum(1 << b for b in bits)
    return column.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask))


def _masks(bits: list[int], radius: int) -> list[int]:
    masks = [sum(1 << b for b in some) for r in range(radius + 1) for some in combinations(bits, r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def expected_costs(distinct: DataFrame, groups: list[list[int]], distance: int) -> list[list[float]]:
    """Rows a threshold is expected to cost: probes, and candidates found by them.

    Candidates at threshold 0 are counted exactly (sum of squared value counts). A wider
    probe meets, per further value, as many as a value holds on average, weighted likewise.
    """
    listed = distinct.select(F.explode(F.array(*(F.struct(F.lit(i).alias("i"), value_of(F.col("f"), g).alias("v")) for i, g in enumerate(groups)))).alias("x"))
    sizes = listed.groupBy("x.i", "x.v").agg(F.count("*").cast("double").alias("n"))
    found = {r["i"]: r for r in sizes.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("pairs")).collect()}
    costs = []
    for i, bits in enumerate(groups):
        n, pairs = (found[i]["n"], found[i]["pairs"]) if i in found else (0.0, 0.0)
        near = pairs + n * n / 2.0 ** len(bits)
        cost = [0.0]
        for t in range(distance + 1):
            probes = sum(comb(len(bits), r) for r in range(t + 1))
            cost.append(n * (1 + probes) + pairs + (probes - 1) * near / 2)
        costs.append(cost)
    return costs


def links(distinct: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """(a, b) with a < b: pairs of different fingerprints (column f) within ``distance`` bits."""
    groups = group_bits(correlations(distinct), partitions)
    thresholds = allocate(expected_costs(distinct, groups, distance), distance)
    f, here, probes = F.col("f"), [], []
    for i, (bits, t) in enumerate(zip(groups, thresholds)):
        if t < 0:
            continue
        value = value_of(f, bits)
        here.append(F.struct(F.lit(i).alias("i"), value.alias("v")))
        probes += [F.struct(F.lit(i).alias("i"), value.bitwiseXOR(F.lit(m)).alias("v")) for m in _masks(bits, t)]
    listed = distinct.select(F.col("f").alias("b"), F.explode(F.array(*here)).alias("x")).select("b", "x.i", "x.v")
    asked = distinct.select(F.col("f").alias("a"), F.explode(F.array(*probes)).alias("x")).select("a", "x.i", "x.v")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance
    # a pair is close from either side, so probing by the smaller one finds it
    return asked.join(listed, ["i", "v"]).filter((F.col("a") < F.col("b")) & close).select("a", "b").distinct()


def component_of(rows: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """(f, root, component_id) of each distinct fingerprint in ``rows`` (id, f: a written table)."""
    distinct = stored(rows.groupBy("f").agg(F.min("id").alias("least")), "distinct-fingerprints")
    pairs = stored(links(distinct.select("f"), distance, partitions), "fingerprint-links")
    roots = components(pairs, "fingerprint-components")
    rooted = stored(distinct.join(roots, distinct["f"] == roots["node"], "left").select("f", "least", F.coalesce("root", "f").alias("root")), "fingerprint-roots")
    least = stored(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "component-ids")
    return stored(rooted.join(least, "root").select("f", "root", "component_id"), "component-of-fingerprint")


def near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", distance: int = DISTANCE, partitions: int = PARTITIONS, words: int = SHINGLE) -> DataFrame:
    """Per row: id, fingerprint (16 hex digits), component_id (smallest id reachable over links).

    Equal fingerprints are linked, empty texts' zero included. Null ids don't count as
    smallest; a component of null ids only has a null component_id. Repeated rows stay.
    """
    rows = stored(fingerprints(docs, text, id_column, words), "fingerprints")
    digits = F.lower(F.lpad(F.hex("f"), 16, "0"))
    found = rows.join(component_of(rows, distance, partitions), "f")
    return found.select(F.col("id").alias(id_column), digits.alias("fingerprint"), "component_id")


def close_sets(prints: DataFrame, distance: int = DISTANCE, partitions: int = PARTITIONS) -> DataFrame:
    """(a, b) with a < b: each node of ``prints`` (node, f: fingerprint) with the least node of its fingerprint, and that
    one with the least node of the lowest fingerprint within ``distance`` bits.
    """
    heads = stored(prints.groupBy("f").agg(F.min("node").alias("head")), "close-heads")
    lowest = links(heads.select("f"), distance, partitions).groupBy("b").agg(F.min("a").alias("a"))
    one, two = (heads.select(F.col("f").alias(n), F.col("head").alias(f"{n}head")) for n in "ab")
    over = lowest.join(one, "a").join(two, "b").select(F.col("ahead").alias("a"), F.col("bhead").alias("b"))
    same = prints.join(heads, "f").select(F.col("head").alias("a"), F.col("node").alias("b"))
    both = over.unionByName(same).filter("a <> b")
    return stored(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "close-sets")


def drop_near_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", words: int = near_sets.WORDS, similarity: float = near_sets.SIMILARITY) -> DataFrame:
    """One row of each component stays, with all its columns: that of the smallest id (nulls last).

    Linked are texts whose sets of ``words``-word shingles have a Jaccard similarity of
    ``similarity`` or more. SimHash fingerprints of the sets within ``DISTANCE`` bits are found by the generalised
    pigeonhole principle. Most similar sets differ by more bits than can be probed, so pairs also
    meet over lists of shingles; fingerprints of 256 bits then tell those
    that may be similar from those that only share a passage, and sets decide. Texts without words
    are one component. Of rows that repeat the smallest id, one stays: that of the longest text, then the least one.
    """

    parts = (*near_sets.PRINT, *near_sets.MARKS)

    @F.pandas_udf(f"f long, {', '.join(f'{x} long' for x in parts)}")
    def digest(texts: pd.Series) -> pd.DataFrame:
        sets = [near_sets.shingle_set(t, words) for t in texts]
        return pd.DataFrame([(near_sets.set_key(s), *near_sets.set_print(s), *near_sets.set_marks(s)) for s in sets], columns=["f", *parts], dtype="int64")

    row, bits = unused(docs, "row_number_"), unused(docs, "shingles_key_")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()).withColumn(bits, digest(F.col(text))), "fingerprinted")
    rows = whole.select(F.col(row).alias("uid"), F.col(id_column).alias("id"), F.col(bits).getField("f").alias("f"), F.length(text).alias("n"), F.xxhash64(text).alias("h"))
    first_of = F.min(F.struct("uid", *parts)).alias("x")
    prints = whole.select(F.col(row).alias("uid"), *[F.col(bits).getField(x).alias(x) for x in ("f", *parts)])
    node_of = stored(prints.groupBy("f").agg(first_of).select("f", F.col("x.uid").alias("node"), *[f"x.{x}" for x in parts]), "near-nodes")
    real = node_of.filter("f <> 0")
    # texts stay where they are: what leaves are the few rows that repeat a set or have none
    repeats = stored(rows.join(node_of, "f").filter("uid <> node or f = 0").select(F.col("uid").alias("node")), "near-repeats")
    nodes = whole.select(F.col(row).alias("node"), F.col(text).alias("text")).join(repeats, "node", "left_anti")
    near = close_sets(real.select("node", F.col(parts[0]).alias("f")))
    roots = components(near_sets.links(nodes, real.select("node", *parts), near, words, similarity), "near-components")
    rooted = stored(node_of.join(roots, "node", "left").select("f", F.coalesce("root", "node").alias("root")), "near-roots")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", F.negative(F.coalesce("n", F.lit(0))).alias("n"), "h", "uid"))
    of_root = stored(rows.join(rooted, "f").select("uid", "root", "id", "n", "h"), "near-rows")
    stay = of_root.groupBy("root").agg(first.alias("first")).select("root", F.col("first.uid").alias("stays"))
    gone = stored(of_root.join(stay, "root").filter("uid <> stays").select(F.col("uid").alias(row)), "near-gone")
    return drop_rows(whole, gone, (row,))[0].select(*docs.columns)  # few ids are sent to the texts, not the texts to the ids
