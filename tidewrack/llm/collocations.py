"""Phrase collocations by top-order marginalisation.

Every word occurrence leads one window of the ``longest`` words from it on, padded where its
piece ends. Only these windows are counted. An occurrence of a shorter phrase is the
beginning of exactly one window, so Spark's ROLLUP over the window's columns sums the counts
of all shorter phrases, and of all words, from those of the windows.

Most windows are rare. Two scans before add up, in tables of fixed size, counts by hash: first of words and
word pairs, then of longer stretches all of whose pairs may be frequent. What shares a bucket can
only make a count larger, so where a bucket is below the least frequency, no phrase reaches across:
windows are padded from there on as well, and become equal. That loses nothing, whatever
the size of the tables; counts come from the windows alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import stored

LONGEST, LEAST, TOP = 5, 100, 2_000
#: Buckets of the table of counts, as a power of two. A task holds one number for each.
TABLE_BITS = 24
#: Buckets of the table that are packed into one record, as a power of two.
PAGE_BITS = 16
#: Text bytes that a task counts at a time.
AT_ONCE = 8 << 20
#: Different windows of a language that a task gathers before it hands them on.
HELD = 2_000_000
#: ASCII characters that end a piece; blank and tab part words.
ENDS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + ENDS + b"\t", bytes(range(97, 123)) + b"." * len(ENDS) + b" ")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(texts: list[bytes]) -> list[bytes]:
    """The texts' words, lower-cased, with ``.`` where a piece ends."""
    return b" . ".join(texts).translate(_PLAIN).replace(b".", b" . ").split()


def _numbered(words: list[bytes]) -> tuple[list[bytes], np.ndarray]:
    """Different words, ``.`` first, and each word's number among them."""
    different = list(dict.fromkeys([b".", *words]))
    number = dict(zip(different, range(len(different))))
    return different, np.fromiter(map(number.__getitem__, words), np.int32, len(words))


def _hashes(lang: str, different: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh32_intdigest(lang.encode(), 13)
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in different), np.uint64, len(different))


def _longer(stretch: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a stretch and the word after it."""
    h = (stretch * _MIX) ^ (word + (stretch >> np.uint64(29)))
    return (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)


def _buckets(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def _stretches(body: bytes) -> Iterator[bytes]:
    """A text in parts of whole pieces, of about AT_ONCE bytes where pieces are not longer."""
    start = 0
    while len(body) - start > AT_ONCE:
        stop = max(body.rfind(bytes([end]), start, start + AT_ONCE) for end in ENDS)
        if stop < 0:
            stop = min((at for end in ENDS if (at := body.find(bytes([end]), start)) >= 0), default=len(body))
        yield body[start : stop + 1]
        start = stop + 1
    yield body[start:]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """Texts of one language at a time, about AT_ONCE bytes of them."""
    held: dict[str, list[bytes]] = {}
    sizes: dict[str, int] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            for body in _stretches(text.as_py()):
                held.setdefault(lang, []).append(body)
                sizes[lang] = sizes.get(lang, 0) + len(body) + 20
                if sizes[lang] >= AT_ONCE:
                    yield lang, held.pop(lang)
                    del sizes[lang]
    yield from held.items()


def _pages(table: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(page, counts): the table's pages with anything in them, a byte for each bucket.

    A byte holds 255 at most, which is over any sum of interest.
    """
    pack, size = zstandard.ZstdCompressor(level=1).compress, min(len(table), 1 << PAGE_BITS)
    for page in range(len(table) // size):
        part = table[page * size : (page + 1) * size]
        if part.any():
            yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([pack(np.minimum(part, 255).astype(np.uint8).tobytes())], pa.binary())], ["page", "counts"])


def _counted(bits: int):
    """Counts of words and word pairs by bucket, as a task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, np.int32)
        for lang, texts in _by_lang(batches):
            different, at = _numbered(words_of(texts))
            h = _hashes(lang, different)
            counts = np.bincount(at, minlength=len(different))
            counts[0] = 0
            np.add.at(table, _buckets(h, bits), counts.astype(np.int32))
            pairs = np.flatnonzero((at[:-1] != 0) & (at[1:] != 0))
            np.add.at(table, _buckets(_longer(h[at[pairs]], h[at[pairs + 1]]), bits), np.int32(1))
        yield from _pages(table)

    return run


def _stretched(lang: str, different: list[bytes], at: np.ndarray, longest: int, bits: int, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, Callable[[np.ndarray], None]]]:
    """Lengths 1, 2 ... ``longest`` with the positions that lead a stretch of this many words which ``words`` (the
    table of words and pairs) doesn't rule out, and the stretches' hashes. The last item says which of them go on.
    """
    h = _hashes(lang, different)
    known = words[_buckets(h, bits)]
    known[0] = False
    pairs = np.flatnonzero(known[at[:-1]] & known[at[1:]]) if len(at) else np.zeros(0, np.int64)
    joined = np.zeros(len(at) + 1, bool)
    joined[pairs] = words[_buckets(_longer(h[at[pairs]], h[at[pairs + 1]]), bits)]
    lead = np.flatnonzero(known[at])
    stretch = h[at[lead]]
    for length in range(1, longest + 1):
        if length > 1:
            on = joined[lead + length - 2]
            lead, stretch = lead[on], stretch[on]
            stretch = _longer(stretch, h[at[lead + length - 1]])
        going = np.ones(len(lead), bool)
        yield length, lead, stretch, lambda keep, going=going: np.copyto(going, keep)
        lead, stretch = lead[going], stretch[going]


def _counted_further(longest: int, bits: int, packed: np.ndarray):
    """Counts of stretches of three words and more by bucket, as a task sees them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, table = np.unpackbits(packed).astype(bool), np.zeros(1 << bits, np.int32)
        for lang, texts in _by_lang(batches):
            for length, _, stretch, _ in _stretched(lang, *_numbered(words_of(texts)), longest, bits, words):
                if length > 2:
                    np.add.at(table, _buckets(stretch, bits), np.int32(1))
        yield from _pages(table)

    return run


def _summed(least: int):
    """(page, bits): whether the buckets of the pages in a task sum up to ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, sums = zstandard.ZstdDecompressor().decompress, {}
        for batch in batches:
            for page, counts in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(unpack(counts.as_py()), np.uint8)
                # as large as need be: sums stop growing where they can't be told from larger ones
                sums[page] = np.minimum(sums[page] + part, least) if page in sums else np.minimum(part.astype(np.int32), least)
        for page, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([page], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["page", "bits"])

    return run


def frequent_buckets(counts: DataFrame, least: int, bits: int) -> np.ndarray:
    """Whether each bucket's count reaches ``least``: 2^bits truth values as bits, gathered in pages."""
    if least > 255:  # a task's byte can't show it
        return np.full(max(1, 1 << (bits - 3)), 255, np.uint8)
    pages = counts.repartition("page").mapInArrow(_summed(least), "page int, bits binary").collect()  # 2^bits bits
    size = min(1 << bits, 1 << PAGE_BITS)
    table = np.zeros(((1 << bits) // size, size >> 3), np.uint8)
    for row in pages:
        table[row["page"]] = np.frombuffer(row["bits"], np.uint8)
    return table.ravel()


def _united(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows as one, with the sum of their counts."""
    order = np.lexsort(rows.T[::-1])
    rows, counts = rows[order], counts[order]
    start = np.flatnonzero(np.r_[True, (rows[1:] != rows[:-1]).any(1)]) if len(rows) else np.zeros(0, np.int64)
    return rows[start], np.add.reduceat(counts, start) if len(start) else counts


class _Windows:
    """Padded windows of one language and their counts, as a task gathers them."""

    def __init__(self, longest: int) -> None:
        self.number = {b"": 0}
        self.rows, self.counts = np.zeros((0, longest), np.int32), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, different: list[bytes], lead: np.ndarray, counts: np.ndarray) -> None:
        used = np.unique(lead)
        renumbered = np.zeros(len(different), np.int32)
        renumbered[used] = [self.number.setdefault(different[i], len(self.number)) for i in used.tolist()]
        self.waiting.append((renumbered[lead], counts))
        self.held += len(lead)
        if self.held > max(200_000, len(self.rows)):  # so that each row is sorted a few times only
            self.unite()

    def unite(self) -> None:
        rows, counts = zip(*self.waiting) if self.waiting else ((), ())
        self.rows, self.counts = _united(np.concatenate([self.rows, *rows]), np.concatenate([self.counts, *counts]))
        self.waiting, self.held = [], 0

    def batches(self, lang: str, names: list[str]) -> Iterator[pa.RecordBatch]:
        self.unite()
        vocabulary = pa.array([w.decode(errors="replace") for w in self.number])
        for first in range(0, len(self.rows), 50_000):
            part = self.rows[first : first + 50_000]
            columns = [vocabulary.take(pa.array(part[:, i])) for i in range(part.shape[1])]
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(part), pa.string()), *columns, pa.array(self.counts[first : first + 50_000])], names)

    def records(self, lang: str, parts: int) -> Iterator[pa.RecordBatch]:
        """One record for each part that the windows are dealt to by their words' hash."""
        self.unite()
        words = list(self.number)
        h, mixed = _hashes(lang, words), np.zeros(len(self.rows), np.uint64)
        for i in range(self.rows.shape[1]):
            mixed = _longer(mixed, h[self.rows[:, i]])
        part = ((mixed >> np.uint64(17)) % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        for some in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            used, rows = np.unique(self.rows[some], return_inverse=True)
            own = b" ".join(words[i] for i in used.tolist())  # no word has a blank; padding, if there, is first and empty
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(part[some[0]])], pa.int32()), pa.array([lang]), pa.array([own], pa.binary()), pa.array([rows.astype("<i4").tobytes()], pa.binary()), pa.array([self.counts[some].astype("<i8").tobytes()], pa.binary())],
                ["part", "lang", "words", "rows", "counts"],
            )


def _gathered(longest: int):
    """(lang, w1 ... , c): the different windows of the parts that a task gets, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["lang", *[f"w{i + 1}" for i in range(longest)], "c"]
        gathered: dict[str, _Windows] = {}
        for batch in batches:
            for _, lang, words, rows, counts in zip(*(column.to_pylist() for column in batch.columns)):
                own = gathered.setdefault(lang, _Windows(longest))
                own.add(words.split(b" "), np.frombuffer(rows, "<i4").reshape(-1, longest), np.frombuffer(counts, "<i8"))
        for lang, own in gathered.items():
            yield from own.batches(lang, names)

    return run


def _windows(longest: int, bits: int, words_packed: np.ndarray, further_packed: np.ndarray, parts: int):
    """(part, lang, words, rows, counts): different padded windows of a task and their counts, packed by part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, further = (np.unpackbits(packed).astype(bool) for packed in (words_packed, further_packed))
        gathered: dict[str, _Windows] = {}
        for lang, texts in _by_lang(batches):
            different, at = _numbered(words_of(texts))
            windows = np.zeros((len(at), longest), np.int32)  # 0 pads
            for length, lead, stretch, go_on in _stretched(lang, different, at, longest, bits, words):
                if length > 2:
                    known = further[_buckets(stretch, bits)]
                    go_on(known)
                    lead = lead[known]
                windows[lead, length - 1] = at[lead + length - 1]
            rows, counts = _united(windows[at != 0], np.ones(int((at != 0).sum()), np.int64))
            if len(rows):
                own = gathered.setdefault(lang, _Windows(longest))
                own.add([b"", *different[1:]], rows, counts)
                if len(own.rows) > HELD:
                    yield from gathered.pop(lang).records(lang, parts)
        for lang, own in gathered.items():
            yield from own.records(lang, parts)

    return run


def phrase_counts(docs: DataFrame, text: str, lang: str, longest: int, least: int, bits: int) -> DataFrame:
    """(lang, k, phrase, f): phrases of k words that occur ``least`` times or more; k = 0 holds the number of all words."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).cast("binary").alias("body")).filter(F.length("body") > 0)
    columns = [f"w{i + 1}" for i in range(longest)]
    shape = ", ".join(["lang string", *[f"{c} string" for c in columns], "c long"])
    words = frequent_buckets(rows.mapInArrow(_counted(bits), "page int, counts binary"), least, bits)
    further = frequent_buckets(rows.mapInArrow(_counted_further(longest, bits, words), "page int, counts binary"), least, bits)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    packed = rows.mapInArrow(_windows(longest, bits, words, further, parts), "part int, lang string, words binary, rows binary, counts binary")
    windows = packed.repartition("part").mapInArrow(_gathered(longest), shape)
    sums = windows.rollup("lang", *columns).agg(F.grouping_id().alias("g"), F.sum("c").alias("f")).filter("lang IS NOT NULL")
    # grouping_id has a bit for each column that is summed over, so k words are left where it is 2^(longest - k) - 1
    k = F.lit(0)
    for words in range(1, longest + 1):
        k = F.when(F.col("g") == (1 << (longest - words)) - 1, words).otherwise(k)
    counted = sums.withColumn("k", k).filter((F.col("k") == 0) | (F.col("f") >= least))
    counted = counted.withColumn("ws", F.slice(F.array(*columns), 1, F.col("k")))
    # a phrase that a window's padding shortens has been counted on its own level
    return counted.filter(~F.array_contains("ws", "")).select("lang", "k", F.array_join("ws", " ").alias("phrase"), "f")


def exact_score(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    """floor(1000 a n / (l r)) of columns of longs below 10^17: products have up to 37 digits, all kept."""
    return F.expr(f"(cast({a} AS decimal(17)) * cast({n} AS decimal(17)) * 1000BD) div (cast({l} AS decimal(17)) * cast({r} AS decimal(17)))")


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, cover: int = 100, top: int = TOP, bits: int = TABLE_BITS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``longest`` words.

    Texts are lower-cased (A-Z), split at ``.,;:!?`` and line ends into pieces, and at blanks and
    tabs into words. A candidate occurs ``a`` >= ``least`` times inside pieces. Cut in two, its parts
    occur ``l`` and ``r`` times; the cut with the lowest floor(1000 a n / (l r)) counts, the first of
    equals, with n the language's words. Candidates inside a longer one that occurs at least
    ``cover`` percent as often are dropped. Ranked by score, then a, then the phrase's bytes.

    A null language is ``und``; null and empty texts have no words; repeated rows count
    each time. Other columns are ignored.
    """
    counts = stored(phrase_counts(docs, text, lang, longest, least, bits), "phrase-counts")
    totals = counts.filter("k = 0").select("lang", F.col("f").alias("n"))
    found = counts.filter("k > 1").withColumn("ws", F.split("phrase", " ")).withColumn("cut", F.explode(F.expr("sequence(1, k - 1)")))
    cuts = stored(
        found.select(
            "lang", "phrase", "k", F.col("f").alias("a"), "cut",
            F.expr("array_join(slice(ws, 1, cut), ' ')").alias("first"), F.expr("array_join(slice(ws, cut + 1, k - cut), ' ')").alias("rest"),
        ),
        "phrase-cuts",
    )
    # what lies in a longer candidate also lies in one that is a word longer, which is at least as frequent
    inside = cuts.filter("k > 2 AND cut = k - 1").select("lang", F.col("first").alias("phrase"), "a")
    inside = inside.unionByName(cuts.filter("k > 2 AND cut = 1").select("lang", F.col("rest").alias("phrase"), "a"))
    longer = inside.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    parts = counts.filter("k > 0")
    firsts = parts.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l"))
    rests = parts.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r"))
    scored = cuts.join(firsts, ["lang", "first"]).join(rests, ["lang", "rest"]).join(totals, "lang")
    lowest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(exact_score("a", "n", "l", "r").alias("score"), "cut", "l", "r")).alias("x"))
    kept = lowest.join(longer, ["lang", "phrase"], "left").filter(F.coalesce(100 * F.col("longer") < cover * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("x.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "x.l", "x.r", "n", "x.score")
