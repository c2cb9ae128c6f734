"""Mixing sources to target weights by hierarchical budgeting.

A token budget goes down a tree of domains, languages and sources by weight. Where a
branch has less than its share, its siblings take the shortage in proportion to their
weights; only what they can't take rises to the branches above. Each leaf then reads its
documents in seeded epochs: whole passes, and of the last pass a prefix of the epoch's
own random order. The prefix is cut by tokens, so a leaf takes exactly its budget: of the
document at the cut, the first tokens are taken.
"""

from __future__ import annotations

import re
from itertools import islice

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewrack.llm.tables import gapless_ranks, stored, unused

LEVELS = ("domain", "lang", "source")
#: Rows of a leaf that one window task adds up, on average.
BUCKET_ROWS = 20_000


def weight_of(column: str, weights: dict[str, float] | None, other: float = 1.0) -> Column:
    """A node's weight by its name; nodes that aren't listed get ``other``."""
    out = F.lit(float(other))
    for name, weight in sorted((weights or {}).items()):
        out = F.when(F.col(column) == name, F.lit(float(weight))).otherwise(out)
    return out


def share_out(children: DataFrame, parent: list[str]) -> DataFrame:
    """Budget of each child from its ``parent_budget``: by weight, never above its capacity.

    Children in rising order of capacity per weight: while a child has less than its share
    of what is left, it takes all it has; from the first one that has more, the rest is
    split by weight. That is where passing shortages on among siblings ends.
    """
    by = Window.partitionBy(*parent).orderBy((F.col("capacity") / F.col("weight")), "node")
    taken = F.coalesce(F.sum("capacity").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight_left = F.sum("weight").over(by.rowsBetween(0, Window.unboundedFollowing))
    level = (F.col("parent_budget") - taken) / weight_left
    marked = children.withColumn("level", level).withColumn("short", F.col("capacity") / F.col("weight") <= F.col("level"))
    whole = Window.partitionBy(*parent)
    split = F.min(F.when(~F.col("short"), F.struct((F.col("capacity") / F.col("weight")).alias("x"), "node", "level"))).over(whole)["level"]
    filled = F.when(F.col("short"), F.col("capacity")).otherwise(F.least(F.col("capacity"), F.floor(F.col("weight") * split + 1e-6)))
    return marked.withColumn("budget", F.greatest(filled.cast("long"), F.lit(0))).drop("level", "short", "parent_budget")


def leaf_budgets(leaves: DataFrame, total: Column, epochs: int, weights: dict[str, dict[str, float]]) -> DataFrame:
    """(domain, lang, source, tokens, budget) for ``leaves`` (the three names and tokens)."""
    names = list(LEVELS)
    leaves = leaves.withColumn("capacity", (F.col("tokens") * epochs).cast("long"))
    budgets = leaves.agg(total.cast("long").alias("parent_budget"))
    for depth, name in enumerate(names):
        above = names[:depth]
        nodes = leaves.groupBy(*names[: depth + 1]).agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", weight_of(name, weights.get(name))).withColumn("node", F.col(name))
        if above:
            nodes = nodes.join(budgets.withColumnRenamed("budget", "parent_budget"), above)
        else:
            nodes = nodes.withColumn("parent_budget", F.lit(budgets.first()["parent_budget"] or 0).cast("long"))
        budgets = stored(share_out(nodes, above or ["root"]) if above else share_out(nodes.withColumn("root", F.lit(0)), ["root"]), f"budgets-{name}")
        budgets = budgets.select(*names[: depth + 1], "tokens", "budget") if depth == 2 else budgets.select(*names[: depth + 1], "budget")
    return budgets


def words_of(text: Column) -> Column:
    """Words by white space: the token count that budgets are in."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def first_words(text: Column, words: Column) -> Column:
    """``text`` up to the end of its word number ``words``."""

    @F.pandas_udf("string")
    def cut(texts: pd.Series, counts: pd.Series) -> pd.Series:
        word, out = re.compile(r"[^\x20\x09-\x0D]+"), []
        for text, count in zip(texts, counts):
            end = 0
            for found in islice(word.finditer(text), int(count)):
                end = found.end()
            out.append(text[:end])
        return pd.Series(out, dtype=object)

    return cut(text, words)


def mix(docs: DataFrame, domain: Column, share: float = 0.8, epochs: int = 1, weights: dict[str, dict[str, float]] | None = None, seed: int = 17, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """One row per selected document and epoch: id, domain, lang, source, tokens, epoch, budget.

    ``share`` of all tokens is the budget. ``tokens`` are those taken: fewer than the document
    has where the cut falls inside it, so that a leaf's tokens add up to its budget. Null
    domains, languages and sources are nodes of their own, named ''. A document without tokens
    belongs to the prefix if it stands before the cut. Weights must be positive. Repeated rows
    are told apart and may both be taken. The draw depends on ids and texts only, not on files.
    """
    row = unused(docs, "uid")
    rows = stored(_measured(docs.withColumn(row, F.monotonically_increasing_id()), row, domain, text, id_column), "mix-rows")
    chosen = _chosen(rows, _copy_numbers(rows), share, epochs, weights, seed)
    return chosen.drop("uid", "whole_tokens", "draw", "text_hash", "copy").withColumnRenamed("id", id_column)


def _leaf_columns(row: str, domain: Column, text: str, id_column: str) -> list[Column]:
    """What places a document: uid, id, its leaf and a hash of its text."""
    return [
        F.col(row).alias("uid"), F.col(id_column).alias("id"), F.coalesce(domain.cast("string"), F.lit("")).alias("domain"),
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("lang"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("source"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("text_hash"),
    ]


def _measured(docs: DataFrame, row: str, domain: Column, text: str, id_column: str) -> DataFrame:
    return docs.select(*_leaf_columns(row, domain, text, id_column), words_of(F.col(text)).alias("tokens"))


def _copy_numbers(rows: DataFrame) -> DataFrame:
    """(uid, copy) of the rows that repeat another's id and text in a leaf; ``copy`` tells them apart."""
    same = [*LEVELS, "id", "text_hash"]
    repeated = stored(rows.groupBy(*same).count().filter("count > 1").drop("count"), "mix-repeated")
    match = [F.col(f"r.{name}").eqNullSafe(F.col(f"s.{name}")) for name in same]
    copies = stored(rows.alias("r").join(repeated.alias("s"), match, "left_semi"), "mix-copies")
    return stored(gapless_ranks(copies, same, [], "copy", "mix-copy-offsets", null_safe=True).select("uid", F.col("copy").cast("long")), "mix-copy-numbers")


def _numbered(rows: DataFrame, numbers: DataFrame) -> DataFrame:
    return rows.join(numbers, "uid", "left").withColumn("copy", F.coalesce("copy", F.lit(0).cast("long")))


def _draw(seed: int, epoch: Column) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.col("id"), "text_hash", "copy")


def _chosen(rows: DataFrame, numbers: DataFrame, share: float, epochs: int, weights: dict[str, dict[str, float]] | None, seed: int) -> DataFrame:
    """``rows`` is a written table of ``_measured`` documents."""
    names = list(LEVELS)
    leaves = stored(rows.groupBy(*names).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("rows")), "mix-leaves")
    budgets = leaf_budgets(leaves.drop("rows"), F.floor(F.sum("tokens") * share), epochs, weights or {})
    leaf = leaves.select(*names, "rows").join(budgets, names)
    passes = stored(
        leaf.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
        .withColumn("room", F.col("budget") - F.col("epoch") * F.col("tokens"))
        .filter("room > 0 or (tokens = 0 and epoch = 0)")
        .withColumn("buckets", F.ceil(F.col("rows") / BUCKET_ROWS).cast("long"))
        .select(*names, "epoch", "room", "budget", "buckets", F.col("tokens").alias("leaf_tokens")),
        "mix-passes",
    )
    drawn = _numbered(rows, numbers).join(passes, names).withColumn("draw", _draw(seed, F.col("epoch")))
    drawn = drawn.withColumn("bucket", F.expr("cast(floor((draw / 18446744073709551616D + 0.5D) * buckets) as long)"))
    drawn = drawn.withColumn("bucket", F.greatest(F.lit(0), F.least(F.col("bucket"), F.col("buckets") - 1)))
    keys = [*names, "epoch"]
    # hash values rise from bucket to bucket, so a row's place is its bucket's start and its place inside
    sums = drawn.groupBy(*keys, "bucket").agg(F.sum("tokens").alias("bucket_tokens"))
    before = Window.partitionBy(*keys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = stored(sums.select(*keys, "bucket", F.coalesce(F.sum("bucket_tokens").over(before), F.lit(0)).alias("start")), "mix-starts")
    inside = Window.partitionBy(*keys, "bucket").orderBy("draw", "id", "text_hash", "copy").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = drawn.join(starts, [*keys, "bucket"]).withColumn("begin", F.col("start") + F.sum("tokens").over(inside) - F.col("tokens"))
    taken = placed.filter("begin < room or (tokens = 0 and begin = room)").withColumnRenamed("tokens", "whole_tokens")
    taken = taken.withColumn("tokens", F.least(F.col("whole_tokens"), F.col("room") - F.col("begin")))
    return taken.select("uid", "id", *names, "tokens", "epoch", "budget", "whole_tokens", "draw", "text_hash", "copy")


def keep_mixed(docs: DataFrame, domain: Column, share: float, weights: dict[str, dict[str, float]] | None = None, seed: int = 17, text: str = "text", id_column: str = "doc_id", chars: str = "n_chars") -> DataFrame:
    """The documents that one epoch of the mixture takes, with all their columns.

    The document at a leaf's cut has the text that was taken, and ``chars``, where there is
    such a column, counts its characters.
    """
    row = unused(docs, "row_number_")
    whole = stored(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    rows = stored(_measured(whole, row, domain, text, id_column), "mix-rows")
    numbers = _copy_numbers(rows)
    # a leaf's documents are a prefix of its draw, so its last one tells for each document whether it is taken:
    # texts stay where they are, only the leaves' ends and the numbers of repeated rows move
    place = F.struct("draw", "id", "text_hash", "copy")
    chosen = _chosen(rows, numbers, share, 1, weights, seed).select(*LEVELS, place.alias("place"), "tokens", "whole_tokens")
    ends = stored(chosen.groupBy(*LEVELS).agg(F.max(F.struct("place", "tokens", "whole_tokens")).alias("end")), "mix-ends")
    known = whole.select(F.struct(*docs.columns).alias("doc"), *_leaf_columns(row, domain, text, id_column))
    placed = _numbered(known, numbers).withColumn("draw", _draw(seed, F.lit(0))).select("doc", *LEVELS, place.alias("place"))
    kept = placed.join(ends, list(LEVELS)).filter(F.col("place") <= F.col("end.place"))
    # at most one document of a leaf is cut
    is_cut = (F.col("place") == F.col("end.place")) & (F.col("end.tokens") < F.col("end.whole_tokens"))
    uncut = kept.filter(~is_cut).select("doc.*")
    short = kept.filter(is_cut).select("doc.*", F.col("end.tokens").alias(row))
    short = short.withColumn(text, first_words(F.col(text), F.col(row)))
    if chars in docs.columns:
        short = short.withColumn(chars, F.length(text).cast(docs.schema[chars].dataType))
    return uncut.unionByName(short.select(*docs.columns))
