"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors with cosine c are sqrt(2 - 2c) apart, and a projection brings none further
apart. So vectors are projected on their leading principal dimensions and sorted by label and
by the cells, as wide as that distance, that they fall into there. The sorted sequence is cut into blocks.
Two intervals of the sequence whose bounding boxes are further apart hold no link.

The recursion over pairs of intervals runs twice. From the whole sequence down to blocks it is
a DataFrame of interval pairs, halved (by ``FAN`` at a time) and filtered level by level. Inside a pair
of blocks it goes on in the task, down to small intervals, whose vectors are compared exactly.

A pair of blocks gives each of its vectors' number of links, and of the links themselves only a
forest: as many as connect what the links connect. So output grows with blocks, never with
the square of a group. Equal vectors are joined as one that counts for all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import components, stored

#: Vectors of a block, intervals a step of the recursion cuts an interval into, leading dimensions.
BLOCK, FAN, LEADING = 1_024, 16, 8
#: Partner blocks that a task holds at a time.
RUN = 8
#: Intervals of so many vectors are compared without cutting them further.
SMALL = 64


def _takes_part(id_column: str, vector: str, label: str) -> Column:
    """Whether a row can have links. Never null."""
    odd = F.exists(F.col(vector), lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    here = F.col(id_column).isNotNull() & F.col(label).isNotNull()
    return here & ~F.coalesce(odd, F.lit(True)) & F.coalesce(F.exists(F.col(vector), lambda x: x != 0), F.lit(False))


def unit_rows(frame: DataFrame, id_column: str, vector: str, label: str) -> DataFrame:
    """(id, label, dim, key, v) of the rows that can have links: the unit vector and its digest."""
    rows = frame.filter(_takes_part(id_column, vector, label))
    rows = rows.select(F.col(id_column).cast("long").alias("id"), F.col(label).alias("label"), F.size(vector).alias("dim"), F.col(vector).cast("array<double>").alias("v"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                part = batch.filter(pa.array(dims == dim))
                v = _matrix(part.column("v"), dim)
                # by the largest component first, so that squares neither vanish nor overflow
                v = v / np.abs(v).max(1)[:, None]
                v /= np.sqrt(np.einsum("ij,ij->i", v, v))[:, None]
                keys = [hashlib.sha256(row.tobytes()).hexdigest() for row in v]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, v.size + 1, dim, dtype=np.int32)), pa.array(v.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:3], pa.array(keys), lists], ["id", "label", "dim", "key", "v"])

    return rows.mapInArrow(run, f"id long, label {rows.schema['label'].dataType.simpleString()}, dim int, key string, v array<double>")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def principal_axes(rows: DataFrame, leading: int) -> dict[int, np.ndarray]:
    """Per vector length its leading principal directions (length x leading), over all rows.

    Tasks send sums of products, which are added up in Spark; the driver gets one matrix per length.
    """

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column(0).to_numpy()
            for dim in np.unique(dims).tolist():
                v = _matrix(batch.column(1).filter(pa.array(dims == dim)), dim)
                v = np.hstack([v, np.ones((len(v), 1))])
                totals[dim] = totals.get(dim, 0.0) + v.T @ v
        for dim, total in totals.items():
            n = (dim + 1) ** 2
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, dim, np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(total.ravel())], ["dim", "at", "s"])

    sums = rows.select("dim", "v").mapInArrow(products, "dim int, at int, s double").groupBy("dim", "at").agg(F.sum("s").alias("s"))
    axes = {}
    for dim, part in sums.toPandas().groupby("dim"):
        total = np.zeros((dim + 1) ** 2)
        total[part["at"].to_numpy()] = part["s"]
        total = total.reshape(dim + 1, dim + 1)
        mean = total[dim, :dim] / total[dim, dim]
        _, directions = np.linalg.eigh(total[:dim, :dim] / total[dim, dim] - np.outer(mean, mean))
        axes[int(dim)] = directions[:, ::-1][:, :leading]
    return axes


def _projected(rows: DataFrame, axes: dict[int, np.ndarray], width: float, leading: int) -> DataFrame:
    """Adds place, the projection on the leading axes (zeros where there are fewer), and its cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            place = np.zeros((batch.num_rows, leading))
            for dim in np.unique(dims).tolist():
                of = dims == dim
                at = axes[dim]
                place[of, : at.shape[1]] = _matrix(batch.column("v").filter(pa.array(of)), dim) @ at
            cell = np.floor(place / width).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(np.arange(0, m.size + 1, leading, dtype=np.int32)), pa.array(m.ravel())) for m in (place, cell)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *lists], [*batch.schema.names, "place", "cell"])

    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{shape}, place array<double>, cell array<int>")


def _packed(block: int, kind: str):
    """Sorted rows to blocks of one label and length, numbered inside their partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number, held, kept = TaskContext.get().partitionId(), 0, [], 0

        def cut(table: pa.Table, last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal number, held, kept
            table = table.combine_chunks()
            labels, dims = table["label"].to_numpy(zero_copy_only=False), table["dim"].to_numpy()
            ends = [*(np.flatnonzero((labels[1:] != labels[:-1]) | (dims[1:] != dims[:-1])) + 1).tolist(), len(table)]
            start = 0
            for end in ends:
                while end - start >= block or (start < end and (last or end < len(table))):
                    some = table.slice(start, min(block, end - start))
                    place = np.array(some["place"].combine_chunks().flatten()).reshape(len(some), -1)
                    v = some["v"].combine_chunks().flatten().to_numpy()
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part], pa.int32()), pa.array([number], pa.int32()), some["label"].slice(0, 1).combine_chunks(), some["dim"].slice(0, 1).combine_chunks(),
                            pa.array([place.min(0).tolist()], pa.list_(pa.float64())), pa.array([place.max(0).tolist()], pa.list_(pa.float64())),
                            pa.array([some["id"].to_numpy().astype("<i8").tobytes()]), pa.array([some["copies"].to_numpy().astype("<i8").tobytes()]),
                            pa.array([place.astype("<f4").tobytes()]), pa.array([v.astype("<f8").tobytes()]),
                        ],
                        ["part", "number", "label", "dim", "low", "high", "ids", "copies", "places", "vectors"],
                    )
                    number += 1
                    start += len(some)
            held = [table.slice(start)] if start < len(table) else []
            kept = len(table) - start

        for batch in batches:
            held.append(pa.Table.from_batches([batch]))
            kept += batch.num_rows
            if kept >= block:
                yield from cut(pa.concat_tables(held), False)
        if kept:
            yield from cut(pa.concat_tables(held), True)

    return run, f"part int, number int, label {kind}, dim int, low array<double>, high array<double>, ids binary, copies binary, places binary, vectors binary"


def sequence_blocks(rows: DataFrame, block: int) -> DataFrame:
    """The rows in epsilon grid order, as packed blocks numbered ``at`` = 0, 1, 2 ... along the sequence."""
    cells = [F.col("cell")[i].alias(f"c{i}") for i in range(LEADING)]
    names = [f"c{i}" for i in range(LEADING)]
    # the id ends the order, so that a crowded cell is split as well
    order = ["label", "dim", *names, "id"]
    in_order = rows.select("id", "copies", "label", "dim", "v", "place", *cells).repartitionByRange(*order).sortWithinPartitions(*order)
    run, shape = _packed(block, rows.schema["label"].dataType.simpleString())
    packed = stored(in_order.select("id", "copies", "label", "dim", "v", "place").mapInArrow(run, shape), "grid-packed")
    # one row per partition of the sort meets in the window
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = packed.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_first"))
    return packed.join(starts, "part").withColumn("at", F.col("_first") + F.col("number")).drop("part", "number", "_first")


def _near(epsilon: float) -> Column:
    """Whether boxes a and b may hold a link: labels and lengths overlap, and the gap isn't wider than epsilon."""
    gap = F.expr(
        "aggregate(zip_with(zip_with(a.low, b.high, (x, y) -> x - y), zip_with(b.low, a.high, (x, y) -> x - y), (x, y) -> greatest(x, y, 0D)), 0D, (t, g) -> t + g * g)"
    )
    overlap = F.expr("a.first <= b.last AND b.first <= a.last")
    return overlap & (gap <= epsilon * epsilon * (1 + 1e-9) + 1e-12)


def block_pairs(blocks: DataFrame, epsilon: float, fan: int = FAN) -> DataFrame:
    """(a, b) with a <= b: blocks that may hold links with each other, by recursion over intervals."""
    key = F.struct("label", "dim")
    levels = [blocks.select("at", "low", "high", key.alias("first"), key.alias("last"))]
    size = blocks.count()
    leading = [F.min(F.col("low")[i]).alias(f"l{i}") for i in range(LEADING)] + [F.max(F.col("high")[i]).alias(f"h{i}") for i in range(LEADING)]
    while size > 1:
        up = levels[-1].groupBy(F.expr(f"at div {fan}").alias("at")).agg(*leading, F.min("first").alias("first"), F.max("last").alias("last"))
        up = up.select("at", F.array(*[f"l{i}" for i in range(LEADING)]).alias("low"), F.array(*[f"h{i}" for i in range(LEADING)]).alias("high"), "first", "last")
        levels.append(stored(up, f"grid-level-{len(levels)}"))
        size = -(-size // fan)
    top = levels.pop()
    pairs = top.select(F.col("at").alias("a"), F.col("at").alias("b"))
    for level in reversed(levels):
        boxes = level.withColumn("up", F.expr(f"at div {fan}"))
        left = pairs.join(boxes.select(F.col("up").alias("a"), F.struct("at", "low", "high", "first", "last").alias("left")), "a").select("left", "b")
        both = left.join(boxes.select(F.col("up").alias("b"), F.struct("at", "low", "high", "first", "last").alias("right")), "b")
        both = both.select(F.col("left").alias("a"), F.col("right").alias("b")).filter("a.at <= b.at").filter(_near(epsilon))
        pairs = both.select(F.col("a.at").alias("a"), F.col("b.at").alias("b"))
    return stored(pairs, "grid-pairs")


def linked(a: np.ndarray, b: np.ndarray, near_a: np.ndarray, near_b: np.ndarray, least: float, epsilon: float, same: bool) -> tuple[np.ndarray, np.ndarray, int]:
    """(i, j, compared): rows of ``a`` and ``b`` with cosine of ``least`` or more; i < j if ``same``.

    Halves the longer interval until both are small, and skips intervals whose boxes are too far apart.
    """
    reach, out, compared = epsilon * epsilon * (1 + 1e-6) + 1e-6, [], 0
    todo = [(0, len(a), 0, len(b))]
    while todo:
        p, q, r, s = todo.pop()
        if same and p >= s:  # wholly below the diagonal: the pairs are seen from the other side
            continue
        gap = np.maximum(0, np.maximum(near_a[p:q].min(0) - near_b[r:s].max(0), near_b[r:s].min(0) - near_a[p:q].max(0)))
        if float((gap * gap).sum()) > reach:
            continue
        if max(q - p, s - r) <= SMALL:
            compared += (q - p) * (s - r)
            i, j = np.nonzero(a[p:q] @ b[r:s].T >= least)
            i, j = i + p, j + r
            if same:
                i, j = i[i < j], j[i < j]
            if len(i):
                out.append((i, j))
        elif q - p >= s - r:
            todo += [(p, (p + q) // 2, r, s), ((p + q) // 2, q, r, s)]
        else:
            todo += [(p, q, r, (r + s) // 2), (p, q, (r + s) // 2, s)]
    if not out:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), compared
    return np.concatenate([o[0] for o in out]), np.concatenate([o[1] for o in out]), compared


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Root of each of ``n`` nodes: the least node reachable over the links (i, j)."""
    root = np.arange(n)
    while len(i):
        least = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], least)
        np.minimum.at(root, root[j], least)
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up
        open_ = root[i] != root[j]
        i, j = i[open_], j[open_]
    return root


def _side(table: pa.Table, row: int) -> tuple[np.ndarray, ...]:
    """(ids, copies, unit vectors, places) of a packed block."""
    get = {name: table[name][row].as_py() for name in ("ids", "copies", "vectors", "places")}
    ids, copies = np.frombuffer(get["ids"], "<i8"), np.frombuffer(get["copies"], "<i8")
    return ids, copies, np.frombuffer(get["vectors"], "<f8").reshape(len(ids), -1), np.frombuffer(get["places"], "<f4").astype(np.float64).reshape(len(ids), -1)


def _joined(least: float, epsilon: float):
    """Task of a block and a run of blocks: (id, links, other), the links of each vector and an edge of a forest."""

    def run(key: tuple, own: pa.Table, others: pa.Table) -> pa.Table:
        ids, links, edges = [], [], []
        for number in range(others.num_rows if own.num_rows else 0):
            ids_a, copies_a, a, near_a = _side(own, 0)
            ids_b, copies_b, b, near_b = _side(others, number)
            same = key[0].as_py() == others["b"][number].as_py()
            i, j, _ = linked(a, b, near_a, near_b, least, epsilon, same)
            every = ids_a if same else np.r_[ids_a, ids_b]
            j_at = j if same else j + len(ids_a)
            count = np.bincount(i, copies_b[j], len(every)) + np.bincount(j_at, copies_a[i], len(every))
            use = np.flatnonzero(count)
            ids.append(every[use]), links.append(count[use].astype(np.int64)), edges.append(every[forest(i, j_at, len(every))[use]])
        columns = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in (ids, links, edges)]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["id", "links", "other"])

    return run


def block_links(blocks: DataFrame, pairs: DataFrame, similarity: float, epsilon: float) -> DataFrame:
    """(id, links, other) of all block pairs. A task holds a block and at most ``RUN`` of its partners."""
    packed = ("ids", "copies", "places", "vectors")
    pairs = pairs.withColumn("run", F.expr(f"b div {RUN}"))
    own = pairs.select("a", "run").distinct().join(blocks.select(F.col("at").alias("a"), *packed), "a")
    others = pairs.join(blocks.select(F.col("at").alias("b"), *packed), "b")
    others = others.select(*[F.col(c).alias(c) for c in others.columns])  # columns apart from those of ``own``
    met = own.groupBy("a", "run").cogroup(others.groupBy("a", "run"))
    return met.applyInArrow(_joined(similarity, epsilon), "id long, links long, other long")


def near_vectors(
    frame: DataFrame, similarity: float = 0.98, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK,
) -> DataFrame:
    """Per row: id, n_links, component_id, kept.

    Rows of equal label are linked if their cosine, in double precision, is ``similarity`` (above 0) or more.
    ``n_links`` counts the other rows linked directly, ``component_id`` is the smallest id
    reachable over links, itself included, and ``kept`` says that this is the row's own.

    Rows with a null id, a null label, a null, zero or empty vector, or a null or non-finite component
    link with nothing; nor do vectors of different lengths. Rows that share an id are rows of their own.
    A row with a null id has a null component and is kept.
    """
    epsilon = float(np.sqrt(2 - 2 * similarity))
    rows = stored(unit_rows(frame, id_column, vector, label), "grid-rows")
    # equal vectors stand as one, under a number of their own
    equal = rows.groupBy("label", "key").agg(F.min("id").alias("least"), F.count("*").alias("copies"), F.first("dim").alias("dim"), F.first("v").alias("v"))
    nodes = stored(equal.withColumn("id", F.monotonically_increasing_id()), "grid-nodes")
    places = _projected(nodes.select("id", "copies", "label", "dim", "v"), principal_axes(nodes, LEADING), epsilon, LEADING)
    blocks = sequence_blocks(places, block)
    found = stored(block_links(blocks, block_pairs(blocks, epsilon), similarity, epsilon), "grid-links")
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")), "grid-components")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    known = nodes.select("label", "key", "least", "copies", "id").join(links, "id", "left").join(roots, F.col("id") == F.col("node"), "left")
    known = known.select("label", "key", "least", F.coalesce("root", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    known = stored(known, "grid-known")
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select("label", "key", "n_links", "component_id")
    linked_rows = rows.select("id", "label", "key").join(known, ["label", "key"]).select("id", "n_links", "component_id")
    own = F.col(id_column).cast("long")
    alone = frame.filter(~_takes_part(id_column, vector, label)).select(own.alias("id"), F.lit(0).cast("long").alias("n_links"), own.alias("component_id"))
    every = linked_rows.unionByName(alone)
    return every.select(F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
