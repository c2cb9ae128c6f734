"""Shards of near-equal bytes for indivisible groups, by Karmarkar-Karp differencing.

Each group starts as a partial partition that holds it in one bin and nothing in the
others. The two partial partitions with the largest spread are combined again and again,
the fullest bin of one with the emptiest of the other. Spark runs this in chunks: groups
are differenced inside hash chunks, the chunks' partial partitions inside chunks of chunks,
and so on until one is left. Every task has a bounded number of partial partitions.

A group larger than a chunk's mean bin would leave a spread that the chunk can't fill. Such
groups, fewer than chunks times bins, are differenced first, together. Each chunk starts with
its part of the bins they make, so the small groups of all chunks fill the spread; the last
chunk starts with all that the others made.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tables import gapless_ranks, stored

CHUNK_GROUPS = 8192
FAN_IN = 128


def difference(partials: list[list[tuple[int, object]]]) -> list[tuple[int, object]]:
    """Combine partial partitions (bins as (sum, members)) into one; members nest as pairs."""
    heap = []
    for order, bins in enumerate(partials):
        bins = sorted(bins, key=lambda x: x[0])
        heap.append((bins[0][0] - bins[-1][0], order, bins))
    heapq.heapify(heap)
    order = len(partials)
    while len(heap) > 1:
        (_, _, one), (_, _, two) = heapq.heappop(heap), heapq.heappop(heap)
        bins = [(a[0] + b[0], a[1] if b[1] is None else b[1] if a[1] is None else (a[1], b[1])) for a, b in zip(one, reversed(two))]
        bins.sort(key=lambda x: x[0])
        heapq.heappush(heap, (bins[0][0] - bins[-1][0], order, bins))
        order += 1
    return heap[0][2]


def leaves(members: object):
    """The items below nested pairs; items are ints."""
    pending = [members]
    while pending:
        top = pending.pop()
        if isinstance(top, tuple):
            pending.extend(top)
        elif top is not None:
            yield top


def _split_groups(bins: int, start: list[int] | None = None, parts: int = 0):
    """Bins of a chunk's groups. ``start`` has what its bins hold at first; of ``parts`` parts
    of that, a node counts its own."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["bytes", "key"], ascending=[False, True], kind="stable").reset_index(drop=True)
        empty = [(0, None)] * (bins - 1)
        partials = [[(int(size), i), *empty] for i, size in enumerate(frame["bytes"])]
        if start is not None:
            held = start
            if parts:
                node = int(frame["node"].iloc[0])
                held = [(node + 1) * s // parts - node * s // parts for s in start]
            partials.append([(s, -1 - b) for b, s in enumerate(held)])  # below 0: the bin it is
        bin_of = [0] * len(frame)
        for number, (_, members) in enumerate(difference(partials)):
            items = list(leaves(members))
            number = next((-1 - i for i in items if i < 0), number)
            for i in items:
                if i >= 0:
                    bin_of[i] = number
        return frame.assign(bin=bin_of)[["key", "node", "bytes", "bin"]]

    return run


def _split_nodes(bins: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        nodes = sorted(frame["node"].unique())
        sums = {(n, b): s for n, b, s in zip(frame["node"], frame["bin"], frame["bytes"])}
        out = difference([[(int(sums.get((n, b), 0)), i * bins + b) for b in range(bins)] for i, n in enumerate(nodes)])
        found = [(nodes[leaf // bins], leaf % bins, number) for number, (_, members) in enumerate(out) for leaf in leaves(members)]
        result = pd.DataFrame(found, columns=["node", "bin", "up"])
        return result.assign(parent=frame["parent"].iloc[0])[["node", "bin", "parent", "up"]]

    return run


def balanced_bins(groups: DataFrame, bins: int, chunk_groups: int = CHUNK_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """(key, bin) for ``groups`` (key: binary, unique; bytes: long), sums near equal."""
    groups = stored(groups.select("key", F.col("bytes").cast("long").alias("bytes")), "shard-groups")
    chunks = max(1, -(-groups.count() // chunk_groups))
    dealt = groups.withColumn("node", F.pmod(F.xxhash64("key"), F.lit(chunks)))
    if chunks > 1:
        large = F.col("bytes") > groups.agg(F.sum("bytes")).first()[0] / (chunks * bins)
        if not groups.filter(large).isEmpty():
            return _around_large(dealt.filter(large), dealt.filter(~large), bins, chunks)
    placed = stored(dealt.groupBy("node").applyInPandas(_split_groups(bins), "key binary, node long, bytes long, bin int"), "shard-bins")
    sums = stored(placed.groupBy("node", "bin").agg(F.sum("bytes").alias("bytes")), "shard-sums")
    path = placed.select("key", "node", "bin")
    level = 0
    while chunks > 1:
        chunks = -(-chunks // fan_in)
        nodes = sums.withColumn("parent", F.expr(f"node div {fan_in}"))
        moves = stored(nodes.groupBy("parent").applyInPandas(_split_nodes(bins), "node long, bin int, parent long, up int"), f"shard-moves-{level}")
        path = path.join(moves, ["node", "bin"]).select("key", F.col("parent").alias("node"), F.col("up").alias("bin"))
        sums = stored(sums.join(moves, ["node", "bin"]).groupBy(F.col("parent").alias("node"), F.col("up").alias("bin")).agg(F.sum("bytes").alias("bytes")), f"shard-sums-{level}")
        level += 1
    return path.select("key", "bin")


def _around_large(large: DataFrame, small: DataFrame, bins: int, chunks: int) -> DataFrame:
    """(key, bin), with the small groups of every chunk filling the spread of the large ones."""
    shape = "key binary, node long, bytes long, bin int"
    alone = large.withColumn("node", F.lit(0).cast("long")).groupBy("node")
    placed = stored(alone.applyInPandas(_split_groups(bins), shape), "shard-large")
    start = _bin_sums(placed, bins)
    most = small.filter("node > 0").groupBy("node").applyInPandas(_split_groups(bins, start, chunks), shape)
    placed = placed.unionByName(stored(most, "shard-bins"))
    last = small.filter("node = 0").groupBy("node").applyInPandas(_split_groups(bins, _bin_sums(placed, bins)), shape)
    return placed.unionByName(stored(last, "shard-last")).select("key", "bin")


def _bin_sums(placed: DataFrame, bins: int) -> list[int]:
    sums = {r["bin"]: r["bytes"] for r in placed.groupBy("bin").agg(F.sum("bytes").alias("bytes")).collect()}  # a row per bin
    return [int(sums.get(b, 0)) for b in range(bins)]


def shard(docs: DataFrame, shards: int = 24, text: str = "text", id_column: str = "doc_id", overhead: int = 8, chunk_groups: int = CHUNK_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """Per input row: the id, size, text_crc32, shard, slot (gapless from 0 in its shard).

    Rows with equal texts form one indivisible group (null counts as empty; texts are told
    apart by SHA-256). A row's size is its UTF-8 bytes plus ``overhead``. Shards are made as
    equal in size as the groups allow: no shard can be smaller than its largest group.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    sized = docs.select(F.col(id_column).alias("id"), data.alias("data")).select(
        F.monotonically_increasing_id().alias("uid"), "id",
        (F.length("data") + overhead).cast("long").alias("size"),
        F.crc32("data").alias("text_crc32"), F.unhex(F.sha2("data", 256)).alias("key"),
    )
    rows = stored(sized, "shard-rows")
    bins = stored(balanced_bins(rows.groupBy("key").agg(F.sum("size").alias("bytes")), shards, chunk_groups, fan_in), "shard-of-key")
    placed = stored(rows.join(bins, "key").select("uid", "id", "size", "text_crc32", F.col("bin").alias("shard")), "shard-placed")
    return gapless_ranks(placed, ["shard"], [F.col("id").asc_nulls_last()], "slot", "shard-offsets").select(
        F.col("id").alias(id_column), "size", "text_crc32", "shard", F.col("slot").cast("long").alias("slot")
    )
