"""Exact duplicates by deterministic block naming, in DataFrame operations only.

A text without white space is cut into blocks of fixed size. Equal blocks get equal
integers: blocks are grouped, sorted and numbered. Then adjacent integers are named in
pairs, level by level, until one integer is left for each document. Names are given by
equality at each level, so equal identities mean equal texts; no fingerprint decides.

Blocks travel once as text: they are grouped under a 64-bit hash, and the set of distinct
blocks below each hash gives a block its place there. (hash, place) is then exact, and all
later levels move only integers. Hashes with more than one block are listed with their
blocks and joined back by content.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tables import SPACES, stored, unused

BLOCK_BYTES = 4096


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, "")


def _blocks(frame: DataFrame, block_bytes: int, hash_bits: int) -> DataFrame:
    """One row per block of ``_bytes``; an empty text has one empty block."""
    count = F.greatest(F.ceil(F.length("_bytes") / F.lit(block_bytes)), F.lit(1)).cast("int")
    cut = frame.withColumn("k", count).withColumn("idx", F.explode(F.sequence(F.lit(0), count - 1)))
    block = F.substring(F.col("_bytes"), F.col("idx") * block_bytes + 1, F.lit(block_bytes))
    mask = F.lit(-1 if hash_bits == 64 else (1 << hash_bits) - 1).cast("long")
    return cut.withColumn("block", block).withColumn("h", F.xxhash64("block").bitwiseAND(mask)).drop("_bytes")


def _named(keys: DataFrame, level: int) -> DataFrame:
    """Replace each pair (a, b) by one integer; equal pairs and only those share it."""
    pairs = keys.select("a", "b").distinct().sortWithinPartitions("a", "b")
    names = stored(pairs.withColumn("name", F.monotonically_increasing_id()), f"block-names-{level}")
    return stored(keys.join(names, ["a", "b"]).select("uid", "idx", "k", "name"), f"named-{level}")


def identities(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """One row per input row: ``uid``, the ``keep`` columns, n_points, text_sha256, level, name.

    Two rows have equal (level, name) exactly if their texts are equal without white space.
    Null texts count as empty. ``uid`` tells repeated rows apart. ``hash_bits`` is for tests,
    which shorten the hash so that different blocks share one.
    """
    source = docs.select(*keep, F.col(text).alias("_text"))
    shaped = source.withColumn("_bytes", normalised(F.col("_text")).cast("binary"))
    distinct = _blocks(shaped.select("_bytes"), block_bytes, hash_bits).groupBy("h").agg(F.collect_set("block").alias("blocks"))
    shared = stored(
        distinct.filter(F.size("blocks") > 1)
        .select("h", F.posexplode(F.array_sort("blocks")).alias("place", "block")),
        "shared-hashes",
    )
    rows = (
        source.withColumn("uid", F.monotonically_increasing_id())
        .withColumn("n_points", F.char_length(F.coalesce("_text", F.lit(""))).cast("long"))
        .withColumn("_bytes", normalised(F.col("_text")).cast("binary"))
        .withColumn("text_sha256", F.sha2("_bytes", 256))
        .drop("_text")
    )
    first = F.col("idx") == 0
    blocks = stored(
        _blocks(rows, block_bytes, hash_bits)
        .join(shared, ["h", "block"], "left")
        .select(
            "uid", "idx", "k", F.col("h").alias("a"), F.coalesce("place", F.lit(0)).cast("long").alias("b"),
            F.when(first, F.struct(*keep, "n_points", "text_sha256")).alias("doc"),
        ),
        "blocks",
    )
    level, finished, keys = 0, None, blocks.drop("doc")
    while True:
        named = _named(keys, level)
        done = named.filter("k = 1").select("uid", F.lit(level).alias("level"), "name")
        finished = done if finished is None else finished.unionByName(done)
        open_ = named.filter("k > 1")
        if open_.isEmpty():
            break
        keys = (
            open_.groupBy("uid", F.expr("idx div 2").cast("int").alias("half"), F.expr("(k + 1) div 2").cast("int").alias("left_over"))
            .agg(F.max(F.expr("if(idx % 2 = 0, name, null)")).alias("a"), F.coalesce(F.max(F.expr("if(idx % 2 = 1, name, null)")), F.lit(-1)).alias("b"))
            .select("uid", F.col("half").alias("idx"), F.col("left_over").alias("k"), "a", "b")
        )
        level += 1
    documents = blocks.filter("idx = 0").select("uid", "doc.*")
    return documents.join(finished, "uid")


def exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id", block_bytes: int = BLOCK_BYTES, hash_bits: int = 64) -> DataFrame:
    """Per input row: ``uid``, the id, keep_id, group_size, kept, text_sha256.

    The row with the most code points in its original text stays, then the smallest id
    (nulls last); of rows that repeat in both, one. An empty table gives no rows. Other
    columns of ``docs`` play no part, whatever their names.
    """
    rows = stored(identities(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text")), block_bytes=block_bytes, hash_bits=hash_bits), "identities")
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("none"), "doc_id", "uid"))
    groups = stored(rows.groupBy("level", "name").agg(best.alias("best"), F.count("*").alias("group_size")), "identity-groups")
    return rows.join(groups, ["level", "name"]).select(
        "uid", F.col("doc_id").alias(id_column), F.col("best.doc_id").alias("keep_id"), "group_size",
        (F.col("uid") == F.col("best.uid")).alias("kept"), "text_sha256",
    )


def drop_exact_duplicates(docs: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row of each group of equal texts stays, with all its columns; see ``exact_duplicates``.

    The row is found again by its id, its length and its text's SHA-256, so rows that repeat
    in these count as one.
    """
    identity = {
        unused(docs, "id_"): F.coalesce(F.col(id_column).cast("string"), F.lit("null")),
        unused(docs, "points_"): F.char_length(F.coalesce(F.col(text), F.lit(""))).cast("long"),
        unused(docs, "sha_"): F.sha2(normalised(F.col(text)).cast("binary"), 256),
    }
    names = list(identity)
    rows = stored(identities(docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"))), "identities")
    best = F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("none"), "doc_id", "text_sha256"))
    kept = rows.groupBy("level", "name").agg(best.alias("best")).select(
        F.coalesce(F.col("best.doc_id").cast("string"), F.lit("null")).alias(names[0]), (-F.col("best.p")).alias(names[1]), F.col("best.text_sha256").alias(names[2])
    )
    return docs.withColumns(identity).join(stored(kept, "kept-identities"), names, "left_semi").dropDuplicates(names).select(*docs.columns)
