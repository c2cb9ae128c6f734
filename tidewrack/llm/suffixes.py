"""Removal of long repeats: bytes covered by a 50-byte string that starts in an earlier document too.

Anchors: in every window of 50 bytes the 16-byte string with the smallest hash is picked, so
equal windows pick the same anchor, and a document picks about one in eighteen. Windows
are compared only where their anchors are shared:

1. Each batch of documents sends, per bucket of anchor hashes, where an anchor occurs.
   Anchors that two texts of a batch share are known to be shared at once; of these one marker goes on, the
   positions go straight through. So an anchor has few records per batch, however frequent.
2. Positions of shared anchors meet their text again, and give contexts: the 84 bytes
   that hold every window around the anchor. Equal contexts are combined before they are
   shuffled, keeping the smallest and the largest document.
3. Contexts of the same anchor meet. The suffixes from the anchor on are sorted, and the
   reversed prefixes before it; equal windows are neighbours in both orders and form a
   class, whose smallest document answers for each of its windows. Only contexts with
   something to remove go on.
4. Answers return to the occurrences, and each document unites the windows that start in
   a smaller document as well.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tables import stored

WINDOW, GRAM = 50, 16
REACH = WINDOW - GRAM  # windows that hold an anchor start up to so many bytes before it
WIDTH = REACH + WINDOW
ROW = 2 + WIDTH
#: Work of one group task: anchors of a bucket, contexts of a bucket.
BUCKET_ANCHORS, BUCKET_CONTEXTS = 1_000_000, 60_000
_TABLE = np.random.default_rng(50).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from each position on."""
    h, span = _TABLE[data], 1
    while span < GRAM:  # GRAM is a power of two
        h = h[:-span] * np.uint64(0x9E3779B97F4A7C15 + 2 * span) + h[span:]
        span *= 2
    h ^= h >> np.uint64(31)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    return h


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions, hashes) of the anchors of a byte array, by position."""
    if len(data) < WINDOW:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = _gram_hashes(data)
    wide, span = h, 1
    count = REACH + 1
    while 2 * span <= count:
        wide = np.minimum(wide[:-span], wide[span:])
        span *= 2
    if span < count:
        wide = np.minimum(wide[: len(wide) - (count - span)], wide[count - span :])
    # every position whose hash is the least of a window that holds it
    padded = np.r_[np.zeros(count - 1, np.uint64), wide, np.zeros(count - 1, np.uint64)]
    span, best = 1, padded
    while 2 * span <= count:
        best = np.maximum(best[:-span], best[span:])
        span *= 2
    if span < count:
        best = np.maximum(best[: len(best) - (count - span)], best[count - span :])
    least = h <= best[: len(h)]
    at = np.flatnonzero(least)
    return at, h[at]


def _scan(buckets: int):
    """Records of a batch: per bucket its anchors' hashes, rows and positions, and per row the positions known to be shared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            keys = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            rows, places, hashes = [], [], []
            for row, text in enumerate(batch.column(1)):
                at, h = anchors(np.frombuffer(text.as_py() or b"", np.uint8))
                rows.append(np.full(len(at), row, np.int32)), places.append(at.astype(np.int32)), hashes.append(h)
            if not rows or not sum(map(len, rows)):
                continue
            row, place, h = np.concatenate(rows), np.concatenate(places), np.concatenate(hashes)
            order = np.argsort(h, kind="stable")
            sorted_h, sorted_key = h[order], keys[row[order]]
            start = np.flatnonzero(np.r_[True, sorted_h[1:] != sorted_h[:-1]])
            differ = np.maximum.reduceat(sorted_key, start) != np.minimum.reduceat(sorted_key, start)
            shared = np.zeros(len(h), bool)
            shared[order] = np.repeat(differ, np.diff(np.r_[start, len(h)]))
            marker = np.zeros(len(h), bool)
            marker[order[start]] = differ
            out: list[tuple[int, int | None, bytes]] = []
            of = np.flatnonzero(shared)
            cuts = np.flatnonzero(np.r_[True, np.diff(row[of]) != 0]) if len(of) else np.zeros(0, np.int64)
            for part in np.split(of, cuts[1:]) if len(of) else []:
                out.append((int(keys[row[part[0]]]) % buckets, int(keys[row[part[0]]]), place[part].tobytes()))
            sent = np.flatnonzero(~shared | marker)
            bucket = (h[sent] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            cuts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
            for part in np.split(sent[order], cuts[1:]):
                used, index = np.unique(row[part], return_inverse=True)
                body = struct.pack("<qq", len(used), len(part)) + keys[used].tobytes() + index.astype("<u4").tobytes()
                body += place[part].astype("<i4").tobytes() + (h[part] // np.uint64(buckets)).astype("<u4").tobytes() + np.packbits(marker[part]).tobytes()
                out.append((int(h[part[0]] % np.uint64(buckets)), None, pack(body)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.int64()), pa.array([o[2] for o in out], pa.binary())], ["bucket", "key", "body"]
            )

    return run


def _packed_places(key: np.ndarray, place: np.ndarray) -> bytes:
    """Places by key: the keys, how many places each has, the places."""
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    start = _starts(key)
    body = struct.pack("<qq", len(start), len(key)) + key[start].astype("<i8").tobytes() + np.diff(np.r_[start, len(key)]).astype("<i4").tobytes()
    return zstandard.ZstdCompressor(level=1).compress(body + place.astype("<i4").tobytes())


def _unpacked_places(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    body = zstandard.ZstdDecompressor().decompress(packed)
    keys, n = struct.unpack("<qq", body[:16])
    key = np.frombuffer(body, "<i8", keys, 16)
    return np.repeat(key, np.frombuffer(body, "<i4", keys, 16 + 8 * keys)), np.frombuffer(body, "<i4", n, 16 + 12 * keys)


def _meet(groups: int):
    """Positions of a bucket's anchors that occur in more than one text, with those known before.

    One record per group of texts, so that records don't grow with texts times buckets.
    """

    def run(table: pa.Table) -> pa.Table:
        unpack = zstandard.ZstdDecompressor().decompress
        keys, places, hashes, marks, done_key, done = [], [], [], [], [], []
        for key, body in zip(table.column("key").to_pylist(), table.column("body")):
            data = body.as_py()
            if key is not None:
                done.append(np.frombuffer(data, "<i4"))
                done_key.append(np.full(len(done[-1]), key, np.int64))
                continue
            data = unpack(data)
            rows, n = struct.unpack("<qq", data[:16])
            own = np.frombuffer(data, "<i8", rows, 16)
            at = 16 + 8 * rows
            keys.append(own[np.frombuffer(data, "<u4", n, at)])
            places.append(np.frombuffer(data, "<i4", n, at + 4 * n))
            hashes.append(np.frombuffer(data, "<u4", n, at + 8 * n))
            marks.append(np.unpackbits(np.frombuffer(data, np.uint8, offset=at + 12 * n), count=n).astype(bool))
        if keys:
            key, place, h, mark = map(np.concatenate, (keys, places, hashes, marks))
            order = np.argsort(h, kind="stable")
            start = np.flatnonzero(np.r_[True, np.diff(h[order]) != 0])
            sorted_key = key[order]
            shared = (np.maximum.reduceat(sorted_key, start) != np.minimum.reduceat(sorted_key, start)) | np.logical_or.reduceat(mark[order], start)
            hit = order[np.repeat(shared, np.diff(np.r_[start, len(h)]))]
            done_key.append(key[hit])
            done.append(place[hit])
        key, place = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (done_key, done))
        group = key % groups
        order = np.argsort(group, kind="stable")
        cuts = _starts(group[order])
        out = [(int(group[part[0]]), _packed_places(key[part], place[part])) for part in (np.split(order, cuts[1:]) if len(order) else [])]
        return pa.table({"part": pa.array([o[0] for o in out], pa.int64()), "body": pa.array([o[1] for o in out], pa.binary())})

    return run


def _gathered(table: pa.Table) -> pa.Table:
    """(key, places) of a group's texts from its records of all buckets."""
    pairs = [_unpacked_places(body.as_py()) for body in table.column("body")]
    key, place = (np.concatenate(c) for c in zip(*pairs))
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    start = _starts(key)
    ends = np.r_[start[1:], len(key)]
    return pa.table({"key": pa.array(key[start]), "places": pa.array([place[a:b].astype("<i4").tobytes() for a, b in zip(start, ends)], pa.binary())})


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Occurrences (id, key, place, ctx, c1, c2, g) of shared anchors, from texts and their positions.

    A context is ROW bytes: how many bytes count before and from the anchor on, then these.
    """
    around = np.arange(-REACH, WINDOW)
    parts: list[tuple] = []

    def rows() -> pa.RecordBatch:
        own, key, place, ctx, gram = map(np.concatenate, zip(*parts))
        parts.clear()
        halves = _digests(ctx)
        fixed = pa.Array.from_buffers(pa.binary(ROW), len(place), [None, pa.py_buffer(ctx.tobytes())]).cast(pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(own), pa.array(key), pa.array(place), fixed, pa.array(halves[:, 0]), pa.array(halves[:, 1]), pa.array(gram)],
            ["id", "key", "place", "ctx", "c1", "c2", "g"],
        )

    for batch in batches:
        for own, key, text, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3)):
            data = np.frombuffer(text.as_py() or b"", np.uint8)
            if len(data) < WINDOW:
                continue
            every = np.unique(np.frombuffer(found.as_py(), "<i4"))
            every = every[every + GRAM <= len(data)]
            hashes = _gram_hashes(data)
            for start in range(0, len(every), 20_000):
                place = every[start : start + 20_000]
                at = place[:, None] + around
                ctx = np.zeros((len(place), ROW), np.uint8)
                ctx[:, 0], ctx[:, 1] = np.minimum(REACH, place), np.minimum(WINDOW, len(data) - place)
                ctx[:, 2:] = np.where((at >= 0) & (at < len(data)), data[np.clip(at, 0, len(data) - 1)], 0)
                gram = (hashes[place] >> np.uint64(1)).astype(np.int64)
                parts.append((np.full(len(place), own, np.int64), np.full(len(place), key, np.int64), place.astype(np.int32), ctx, gram))
                if sum(len(p[2]) for p in parts) >= 20_000:
                    yield rows()
    if parts:
        yield rows()


def _digests(ctx: np.ndarray) -> np.ndarray:
    """128-bit hashes of contexts, as two columns."""
    body = ctx.tobytes()
    return np.frombuffer(b"".join(xxhash.xxh128_digest(body[i : i + ROW]) for i in range(0, len(body), ROW)), "<i8").reshape(-1, 2)


def _matrix(column: pa.Array) -> np.ndarray:
    """A binary column of ROW bytes each, as a matrix."""
    first = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset)
    return np.frombuffer(column.buffers()[2], np.uint8)[first[0] : first[-1]].reshape(-1, ROW)


def _combined(groups: int):
    """Equal contexts that stand near each other are combined; per bucket one packed record of them.

    It holds the contexts by anchor, and each one's smallest and largest document.
    """

    def packed(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held).combine_chunks()
        c1, c2, own, gram = (table.column(name).to_numpy() for name in ("c1", "c2", "id", "g"))
        order = np.lexsort((c2, c1))
        start = _starts(c1[order], c2[order])
        least, most, at = np.minimum.reduceat(own[order], start), np.maximum.reduceat(own[order], start), order[start]
        bucket = gram[at] % groups
        order = np.lexsort((gram[at], bucket))
        ctx, pack, out = _matrix(table.column("ctx").chunk(0)), zstandard.ZstdCompressor(level=3).compress, []
        for part in np.split(order, _starts(bucket[order])[1:]):
            body = struct.pack("<q", len(part)) + ctx[at[part]].tobytes() + least[part].tobytes() + most[part].tobytes()
            out.append((int(bucket[part[0]]), pack(body)))
        return pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.binary())], ["bucket", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
            if sum(b.num_rows for b in held) >= 300_000:
                yield packed(held)
                held = []
        if held:
            yield packed(held)

    return run


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where rows of sorted columns differ from the row before."""
    new = np.ones(len(columns[0]), bool)
    if len(new):
        new[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return np.flatnonzero(new)


def sorted_prefixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' sorted order, and how many first bytes each sorted row shares with the one before."""
    words = np.pad(rows, ((0, 0), (0, -rows.shape[1] % 8))).view(">u8").astype(np.uint64)
    order = np.lexsort(words.T[::-1])
    shared = np.zeros(len(rows), np.int16)
    for start in range(1, len(rows), 50_000):
        stop = min(len(rows), start + 50_000)
        differ = rows[order[start:stop]] != rows[order[start - 1 : stop - 1]]
        shared[start:stop] = np.where(differ.any(1), differ.argmax(1), rows.shape[1])
    return order, shared


def _classes(table: pa.Table) -> pa.Table:
    """For each context of a bucket the smallest document of each of its windows, as runs.

    What follows the anchor is sorted, and so is what precedes it, read backwards. A window
    of l bytes before the anchor and r from it on is equal to another if both are neighbours,
    or linked by neighbours, with l and r equal bytes in these orders. Contexts
    none of whose windows start in a smaller document than its largest are left out.
    """
    unpack = zstandard.ZstdDecompressor().decompress
    parts = []
    for packed in table.column("body"):
        body = unpack(packed.as_py())
        n = struct.unpack("<q", body[:8])[0]
        at = 8 + n * ROW
        parts.append((np.frombuffer(body, np.uint8, n * ROW, 8).reshape(-1, ROW), np.frombuffer(body, "<i8", n, at), np.frombuffer(body, "<i8", n, at + 8 * n)))
    ctx, least, most = map(np.concatenate, zip(*parts))
    halves = _digests(ctx)
    c1, c2 = halves[:, 0], halves[:, 1]
    order = np.lexsort((c2, c1))
    start = _starts(c1[order], c2[order])
    least, most = np.minimum.reduceat(least[order], start), np.maximum.reduceat(most[order], start)
    ctx, c1, c2, n = ctx[order[start]], c1[order[start]], c2[order[start]], len(start)
    left, right = ctx[:, 0].astype(np.int64), ctx[:, 1].astype(np.int64)
    after, after_shared = sorted_prefixes(np.ascontiguousarray(ctx[:, 2 + REACH :]))
    before, before_shared = sorted_prefixes(np.ascontiguousarray(ctx[:, 2 : 2 + REACH][:, ::-1]))
    answer = np.full((n, REACH + 1), np.iinfo(np.int64).max)
    for j in range(REACH + 1):  # a window's first byte in the context
        ahead = REACH - j
        takes = np.flatnonzero((left >= ahead) & (right >= WINDOW - ahead))
        if not len(takes):
            continue
        class_after, class_before = np.empty(n, np.int64), np.empty(n, np.int64)
        class_after[after] = np.cumsum(after_shared < WINDOW - ahead)
        class_before[before] = np.cumsum(before_shared < ahead)
        both = class_after[takes] * (n + 1) + class_before[takes]
        by = np.argsort(both, kind="stable")
        first = _starts(both[by])
        smallest = np.minimum.reduceat(least[takes][by], first)
        answer[takes[by], j] = np.repeat(smallest, np.diff(np.r_[first, len(by)]))
    use = np.flatnonzero(answer.min(1) < most)
    answer = answer[use]
    change = np.ones(answer.shape, bool)
    change[:, 1:] = answer[:, 1:] != answer[:, :-1]
    row, at = np.nonzero(change)
    body = np.c_[at, answer[row, at]].astype("<i8").tobytes()
    ends = np.r_[0, np.cumsum(16 * change.sum(1))].astype(np.int32)
    runs = pa.Array.from_buffers(pa.binary(), len(use), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(body)])
    return pa.table({"c1": pa.array(c1[use]), "c2": pa.array(c2[use]), "runs": runs})


def _spans(own: tuple[np.ndarray, np.ndarray], places: np.ndarray, runs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Merged (document number, start, end) of windows that start in a smaller document.

    Every hit has its document's number and id (``own``), a place and its context's runs.
    """
    number, ids = own
    pairs = np.frombuffer(b"".join(runs), "<i8").reshape(-1, 2)
    hit = np.repeat(np.arange(len(runs)), [len(r) // 16 for r in runs])
    last = np.full(len(pairs), REACH + 1)
    same = hit[1:] == hit[:-1]
    last[:-1][same] = pairs[1:, 0][same]
    use = pairs[:, 1] < ids[hit]
    hit, first, last = hit[use], pairs[use, 0], last[use]
    doc, low, high = number[hit], places[hit] - REACH + first, places[hit] - REACH + last - 1 + WINDOW
    order = np.lexsort((low, doc))
    doc, low, high = doc[order], low[order], high[order]
    if not len(doc):
        return doc, low, high
    far = np.int64(1) << 32  # documents lie apart, so reach never crosses them
    reach = np.maximum.accumulate(doc * far + high)
    new = np.r_[True, (doc * far + low)[1:] > reach[:-1]]
    start = np.flatnonzero(new)
    stop = np.r_[start[1:], len(doc)] - 1
    return doc[start], low[start], reach[stop] - doc[start] * far


def repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """(id, data, spans) of every row: its text's bytes and the removed runs (start, end).

    Null texts count as empty. Rows with a null id neither lose bytes nor make others lose
    any; rows that share an id don't make each other lose bytes. Ids are whole numbers.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_column).cast("long").alias("id"), data.alias("data")).withColumn("key", F.xxhash64("id", "data"))
    taking_part = rows.filter(F.col("id").isNotNull() & (F.length("data") >= WINDOW))
    size = docs.agg(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    buckets = max(1, -(-size // (18 * BUCKET_ANCHORS)))
    records = taking_part.select("key", "data").mapInArrow(_scan(buckets), "bucket long, key long, body binary")
    places = records.groupBy("bucket").applyInArrow(_meet(buckets), "part long, body binary")
    gathered = places.groupBy("part").applyInArrow(_gathered, "key long, places binary")
    # of equal texts only the smallest id looks for repeats: the others lose everything
    texts = stored(taking_part.select("id", "key", F.sha2("data", 256).alias("sha"), F.length("data").alias("n")), "repeat-texts")
    firsts = stored(texts.groupBy("sha").agg(F.min("id").alias("first"), F.max("id").alias("last")).filter("first < last").select("sha", "first"), "repeat-firsts")
    copies = stored(texts.join(firsts, "sha").filter("id > first").select("id", "key", "n").distinct(), "repeat-copies")
    gathered = gathered.join(copies.groupBy("key").agg(F.collect_set("id").alias("copies")), "key", "left")
    asking = ~F.coalesce(F.array_contains("copies", F.col("id")), F.lit(False))
    found = taking_part.join(gathered, "key").filter(asking).select("id", "key", "data", "places")
    occurrences = stored(found.mapInArrow(_contexts, "id long, key long, place int, ctx binary, c1 long, c2 long, g long"), "repeat-occurrences")
    groups = max(1, -(-occurrences.count() // BUCKET_CONTEXTS))
    contexts = occurrences.select("g", "ctx", "c1", "c2", "id").mapInArrow(_combined(groups), "bucket long, body binary")
    classes = stored(contexts.groupBy("bucket").applyInArrow(_classes, "c1 long, c2 long, runs binary"), "repeat-classes")
    known = occurrences.select("id", "key", "place", "c1", "c2").join(classes, ["c1", "c2"])
    by_row = known.groupBy("id", "key").agg(F.collect_list(F.struct("place", "runs")).alias("hits"))

    def cover(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            hits = lists.flatten()
            number = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            ids = batch.column(0).to_numpy()[number]
            doc, low, high = _spans((number, ids), hits.field("place").to_numpy().astype(np.int64), hits.field("runs").to_pylist())
            sizes = np.r_[0, np.cumsum(16 * np.bincount(doc, minlength=batch.num_rows))].astype(np.int32)
            out = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(sizes.tobytes()), pa.py_buffer(np.c_[low, high].astype("<i8").tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), out], ["id", "key", "spans"])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            runs = [struct.pack("<qq", 0, n) for n in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(runs, pa.binary())], ["id", "key", "spans"])

    shape = "id long, key long, spans binary"
    covered = by_row.mapInArrow(cover, shape).filter(F.length("spans") > 0)
    spans = stored(covered.unionByName(copies.mapInArrow(whole, shape)), "repeat-spans")
    return rows.join(spans, ["id", "key"], "left").select(F.col("id").alias(id_column), "data", "spans")


def without_repeats(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: id, n_bytes, n_removed, n_spans, kept (binary: the bytes that stay), kept_sha256."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, gone, runs, kept, digest = [], [], [], [], []
            for data, spans in zip(batch.column(1), batch.column(2)):
                body = data.as_py()
                pairs = np.frombuffer(spans.as_py() or b"", "<i8").reshape(-1, 2)
                edges = [0, *pairs.ravel().tolist(), len(body)]
                left = b"".join(body[a:b] for a, b in zip(edges[::2], edges[1::2]))
                size.append(len(body)), gone.append(len(body) - len(left)), runs.append(len(pairs)), kept.append(left)
                digest.append(hashlib.sha256(left).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(runs, pa.int64()), pa.array(kept, pa.binary()), pa.array(digest, pa.string())],
                ["id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
            )

    return repeats(docs, text, id_column).mapInArrow(cut, "id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string").withColumnRenamed("id", id_column)
