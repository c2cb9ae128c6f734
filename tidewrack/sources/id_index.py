"""Index of stored ids: which ids of a batch are stored already, without reading the layer.

Ids are dealt over hash buckets, one folder each. In front of them stand pages of a Bloom
filter, 4 KB each, that an id's hash chooses between; a page holds ``PROBES`` bits for each of its ids.
An id that lacks a bit is new, which needs the pages only. Other ids may be stored: only
the buckets that such ids fall into are opened. So a batch reads as many
pages whatever the history, and the buckets of likely repeats.

Everything is published with the layer: ids name the attempt they belong to and count while that attempt
is live, so an index written by a batch that was never published says nothing. The pages only ever gain
bits, and are replaced together with the batch that brings its ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewrack.operators.dedupe import drop_rows
from tidewrack.session import shared_folder
from tidewrack.sources.commits import CommitLog, Entry, new_attempt
from tidewrack.sources.lake import Lake, folders, visible

#: Entry of a layer's log that names its pages.
PAGES = "_pages"
#: Bits of a page (that of Spark's bitmap functions), bits set by an id, ids that a page is made for: 0.7 % of new ids look stored.
PAGE_BITS, PROBES, IDS_PER_PAGE = 32_768, 4, 2_800
BUCKETS = 64
#: Id folders of single batches that are merged into one.
FOLD = 12


def _page(key: str, pages: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(pages)).cast("int")


def _bucket(key: str) -> Column:
    # other bits of the hash than those that choose the page
    return F.pmod(F.shiftright(F.xxhash64(key), 40), F.lit(BUCKETS)).cast("string")


def _bits(key: str) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(PAGE_BITS)) for probe in range(PROBES)]


def new_pages(ids: DataFrame, key: str, pages: int) -> DataFrame:
    """(page, bits) of some ids. Bits are combined on the map side, so a page has few rows per task."""
    bits = ids.select(_page(key, pages).alias("page"), F.explode(F.array(*_bits(key))).alias("bit"))
    return bits.groupBy("page").agg(F.bitmap_construct_agg("bit").alias("bits"))


def maybe_stored(ids: DataFrame, pages_frame: DataFrame, key: str, pages: int) -> DataFrame:
    """(key, bucket) of the ids all of whose bits are set."""
    byte = [F.conv(F.hex(F.substring("bits", F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int") for bit in _bits(key)]
    is_set = [F.getbit(b, F.pmod(bit, F.lit(8)).cast("int")) == 1 for b, bit in zip(byte, _bits(key))]
    found = ids.select(key, _page(key, pages).alias("page")).join(pages_frame, "page")
    condition = is_set[0]
    for one in is_set[1:]:
        condition = condition & one
    return found.filter(condition).select(key, _bucket(key).alias("bucket"))


class IdIndex:
    """The ids of one layer's live batches."""

    def __init__(self, spark: SparkSession, lake: Lake, layer: str, dataset: str, key: str = "event_id") -> None:
        self.spark, self.key = spark, key
        self.root = f"{lake.root.rstrip('/')}/ids/{layer}/{dataset}"
        self.ids = CommitLog(spark, f"{lake.root.rstrip('/')}/_log/ids/{layer}-{dataset}")

    def _pages(self, entry: Entry) -> tuple[DataFrame, int]:
        pages = int(entry.path.rsplit("=", 1)[1])
        return self.spark.read.schema("page int, bits binary").parquet(f"{self.root}/{entry.path}"), pages

    def opened(self, maybes: DataFrame, owners: list[str]) -> DataFrame | None:
        """Stored ids of the buckets that ``maybes`` fall into; None if there is no such bucket."""
        buckets = [row["bucket"] for row in maybes.select("bucket").distinct().collect()]  # BUCKETS at most
        live = self.ids.live()
        paths = [f"{self.root}/{entry.path}" for entry in live.values()]
        if not buckets or not paths:
            return None
        stored = self.spark.read.option("basePath", self.root).schema(f"{self.key} string, owner string, attempt string, bucket string").parquet(*paths)
        return stored.filter(F.col("bucket").isin(buckets) & F.col("owner").isin(owners))

    def maybes(self, rows: DataFrame, live: dict[str, Entry]) -> DataFrame:
        """(key, bucket) of the rows that may be stored, written once."""
        ids = rows.select(self.key)
        if PAGES in live:
            bits, pages = self._pages(live[PAGES])
            found = maybe_stored(ids, bits, self.key, pages)
        else:
            found = ids.select(self.key, _bucket(self.key).alias("bucket"))
        path = shared_folder(self.spark, "maybe-stored")
        found.write.parquet(path)
        return self.spark.read.schema(f"{self.key} string, bucket string").parquet(path)

    def unseen(self, rows: DataFrame, live: dict[str, Entry], batch_id: str) -> tuple[DataFrame, bool]:
        """The rows (one per id) whose id no other live batch has stored, and whether they stay in their tasks."""
        owners = sorted({e.attempt for e in live.values() if visible(e) and e.batch not in (batch_id, PAGES)})
        if not owners:
            return rows, True
        maybes = self.maybes(rows, live)
        stored = self.opened(maybes, owners)
        if stored is None:
            return rows, True
        path = shared_folder(self.spark, "stored-already")
        stored.join(maybes.select(self.key), self.key, "left_semi").select(self.key).write.parquet(path)
        return drop_rows(rows, self.spark.read.schema(f"{self.key} string").parquet(path), (self.key,))

    def add(self, rows: DataFrame, attempt: str, live: dict[str, Entry], total: int) -> Entry:
        """Store the ids of ``rows`` for an attempt and give the entry of pages that hold them too.

        ``total`` is the number of ids the layer will hold; pages are made anew, for twice as many, when it
        outgrows them. The entry is to be published together with the attempt.
        """
        ids = rows.select(self.key)
        dealt = ids.select(self.key, F.lit(attempt).alias("owner"), _bucket(self.key).alias("bucket"))
        dealt.hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key).write.partitionBy("bucket").parquet(f"{self.root}/attempt={attempt}")
        if folders(self.spark, f"{self.root}/attempt={attempt}/bucket=*"):
            self.ids.commit([Entry(attempt, f"attempt={attempt}")])
        bits, pages = None, 0
        if PAGES in live:
            bits, pages = self._pages(live[PAGES])
        if total > pages * IDS_PER_PAGE:
            pages = 1 << max(3, (2 * total // IDS_PER_PAGE).bit_length())
            every = self.spark.read.option("basePath", self.root).schema(f"{self.key} string, owner string, attempt string, bucket string")
            paths = [f"{self.root}/{entry.path}" for entry in self.ids.live().values()]
            merged = new_pages(every.parquet(*paths) if paths else ids, self.key, pages)
        else:
            merged = bits.unionByName(new_pages(ids, self.key, pages)).groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))
        name = f"attempt=pages-{new_attempt()}/pages={pages}"
        merged.write.parquet(f"{self.root}/{name}")
        return Entry(PAGES, name)

    def fold(self) -> None:
        """Merge the id folders of single batches when there are many, so that a bucket lies in few files."""
        live = self.ids.live()
        if len(live) < FOLD:
            return
        name = new_attempt()
        paths = [f"{self.root}/{entry.path}" for entry in live.values()]
        every = self.spark.read.option("basePath", self.root).schema(f"{self.key} string, owner string, attempt string, bucket string").parquet(*paths)
        every = every.select(self.key, "owner", "bucket").hint("rebalance", "bucket").sortWithinPartitions("bucket", self.key)
        every.write.partitionBy("bucket").parquet(f"{self.root}/attempt={name}")
        # entries that were added meanwhile stay: only those merged are dropped
        self.ids.commit([Entry(name, f"attempt={name}")], live)
