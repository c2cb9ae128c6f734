"""Helpers that several operators share: written intermediates, gapless ranks, components."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidewrack.session import shared_folder

#: White space of the text contracts: blank, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(frame: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back: a lineage cut that survives lost executors."""
    path = shared_folder(frame.sparkSession, label)
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the files of ``stored`` frames that nothing reads any more."""
    for frame in frames:
        for folder in {name.rsplit("/", 1)[0] for name in frame.inputFiles()}:
            path = frame.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(frame.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def unused(frame: DataFrame, base: str) -> str:
    """A column name that ``frame`` doesn't have."""
    while base.lower() in {c.lower() for c in frame.columns}:
        base += "_"
    return base


def gapless_ranks(frame: DataFrame, groups: list[str], order: list, rank: str, label: str, bucket_rows: int = 20_000, null_safe: bool = False) -> DataFrame:
    """Add ``rank``, 0, 1, 2 ... inside each group, without one task per group.

    ``frame`` must be stable when read again (a written table) and have the unique column
    ``uid``. Groups are dealt over hash buckets of about ``bucket_rows`` rows; a bucket's
    rows follow those of the buckets before it, so only bucket sizes meet in one window.
    ``null_safe`` keeps rows whose group has nulls.
    """
    buckets = max(1, -(-frame.count() // bucket_rows))
    dealt = frame.withColumn("_bucket", F.pmod(F.xxhash64("uid"), F.lit(buckets)))
    before = Window.partitionBy(*groups).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy(*groups, "_bucket").count()
    offsets = stored(
        sizes.select(*groups, "_bucket", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset")), label
    )
    inside = Window.partitionBy(*groups, "_bucket").orderBy(*order, "uid")
    numbered = dealt.withColumn("_inside", F.row_number().over(inside) - 1)
    if null_safe:
        match = [F.col(f"n.{name}").eqNullSafe(F.col(f"o.{name}")) for name in [*groups, "_bucket"]]
        found = numbered.alias("n").join(offsets.alias("o"), match).select("n.*", "o._offset")
    else:
        found = numbered.join(offsets, [*groups, "_bucket"])
    return found.withColumn(rank, F.col("_offset") + F.col("_inside")).drop("_bucket", "_inside", "_offset")


def components(edges: DataFrame, label: str, rounds: int = 100) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b: long); root is the smallest node reachable.

    Alternating star contraction: every node hangs its larger, then its smaller neighbours
    on the least of them, until no edge changes. Each half round is a group-by with map-side
    combine and a join whose two sides are written or shuffled plainly, so skewed nodes split.
    """

    def star(pairs: DataFrame, step: str) -> DataFrame:
        least = stored(pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), f"{label}-least-{step}")
        return pairs.join(least, "a")

    edges = stored(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-edges")
    seen = None
    for turn in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = star(both, f"l{turn}").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(large.filter("a > b").distinct(), f"{label}-large-{turn}")
        starred = star(large, f"s{turn}")
        small = starred.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(starred.select("a", F.col("m").alias("b")))
        edges = stored(small.filter("a > b").distinct(), f"{label}-small-{turn}")
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == seen:
            break
        seen = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
