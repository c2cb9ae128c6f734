"""Verdicts on URLs: listed rules first, gradient-boosted trees for the rest.

Trees see how a URL is written: lengths, depth, digit ratio, entropy, parameter counts, and
how often the rules block its host suffixes. They are trained on URLs that rules decide.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.tables import stored

#: Bound of the fit: about so many labelled URLs are sampled by a hash of the URL.
MAX_LABELLED = 50_000


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules that the production query is given.
RULES = (
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
)
FEATURES = (
    "url_length", "host_length", "path_length", "depth", "labels", "digits", "capitals", "hyphens", "parameters", "entropy",
    "escaped", "fragment", "secure", "dotted_end", "last_blocked", "last_seen", "site_blocked", "site_seen",
)


def host_of(url: Column) -> Column:
    after = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(after, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(host: Column, path: Column, rules: tuple[Rule, ...], value) -> Column:
    """``value`` of the longest rule that fits; null if none does."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(value(rule))).otherwise(out)
    return out


def _share(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)) / F.greatest(F.length(text), F.lit(1))


def _entropy(text: Column) -> Column:
    """Bits per character: log2 n less the mean of log2 of each character's count, from runs of the sorted characters."""
    signs = F.split(text, "")

    def bits(run: Column) -> Column:
        return F.when(run > 0, run * F.log2(run.cast("double"))).otherwise(0.0)

    def step(state: Column, sign: Column) -> Column:
        again = F.struct(state["sign"].alias("sign"), (state["run"] + 1).alias("run"), state["total"].alias("total"))
        new = F.struct(sign.alias("sign"), F.lit(1).alias("run"), (state["total"] + bits(state["run"])).alias("total"))
        return F.when(state["sign"] == sign, again).otherwise(new)

    start = F.struct(F.lit("").alias("sign"), F.lit(0).alias("run"), F.lit(0.0).alias("total"))
    total = F.aggregate(F.array_sort(signs), start, step, lambda state: state["total"] + bits(state["run"]))
    size = F.greatest(F.size(signs), F.lit(1)).cast("double")
    return F.log2(size) - total / size


def lexical(pages: DataFrame) -> DataFrame:
    """Lexical feature columns for ``url``, ``host`` and ``path``."""
    url = F.coalesce("url", F.lit(""))
    labels = F.split("host", r"\.")
    return pages.select(
        "*",
        F.length(url).cast("double").alias("url_length"), F.length("host").cast("double").alias("host_length"),
        F.length("path").cast("double").alias("path_length"), F.regexp_count("path", F.lit("/")).cast("double").alias("depth"),
        F.size(labels).cast("double").alias("labels"), _share(url, "[0-9]").alias("digits"), _share(url, "[A-Z]").alias("capitals"),
        _share(url, "[-_]").alias("hyphens"), F.regexp_count(url, F.lit("[?&][^=&#]+=")).cast("double").alias("parameters"),
        _entropy(url).alias("entropy"), F.regexp_count(url, F.lit("%[0-9A-Fa-f]{2}")).cast("double").alias("escaped"),
        F.contains(url, F.lit("#")).cast("double").alias("fragment"), F.startswith(url, F.lit("https://")).cast("double").alias("secure"),
        F.rlike("path", F.lit(r"\.[A-Za-z0-9]{1,5}$")).cast("double").alias("dotted_end"),
        F.element_at(labels, -1).alias("last_label"), F.concat_ws(".", F.slice(labels, -F.least(F.size(labels), F.lit(2)), 2)).alias("site"),
    )


def _suffix_table(known: DataFrame, column: str, name: str) -> DataFrame:
    """Blocked and seen counts of each host suffix among labelled URLs."""
    found = known.groupBy(column).agg(F.sum("label").alias(f"{name}_b"), F.count("*").cast("double").alias(f"{name}_n"))
    return stored(found, f"suffix-{name}")


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, id_column: str = "page_id", url: str = "url", trees: int = 10, depth: int = 4, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Per input row: id, host, path, rule, verdict, score (of blocking; null where a rule decides).

    Null URLs and those without ``://`` have empty host and path, so no rule fits them and
    the trees decide. If the rules decide no URL, or give all the same verdict, there is
    nothing to learn: the rest gets that verdict (allow without any).
    """
    parsed = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url")).withColumn("host", host_of(F.col("url"))).withColumn("path", path_of(F.col("url")))
    ruled = parsed.withColumn("rule", matched(F.col("host"), F.col("path"), rules, lambda r: r.name)).withColumn("by_rule", matched(F.col("host"), F.col("path"), rules, lambda r: r.verdict))
    rows = lexical(ruled)
    known = rows.filter("by_rule is not null").withColumn("label", (F.col("by_rule") == "block").cast("double"))
    counts = {row["label"]: row["count"] for row in known.groupBy("label").count().collect()}  # two rows at most
    if len(counts) < 2:
        verdict = "block" if counts.get(1.0) else "allow"
        return ruled.select(F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("by_rule", F.lit(verdict)).alias("verdict"), F.lit(None).cast("double").alias("score"))
    last, site = _suffix_table(known, "last_label", "last"), _suffix_table(known, "site", "site")

    def described(frame: DataFrame) -> DataFrame:
        """Features; a labelled row's own label has no part in its suffix statistics."""
        joined = frame.join(last, "last_label", "left").join(site, "site", "left")
        own = F.col("label").isNotNull().cast("double")
        for name in ("last", "site"):
            seen = F.coalesce(f"{name}_n", F.lit(0.0)) - own
            blocked = F.coalesce(f"{name}_b", F.lit(0.0)) - F.coalesce("label", F.lit(0.0))
            joined = joined.withColumns({f"{name}_blocked": (blocked + 0.5) / (seen + 1), f"{name}_seen": F.log1p(seen)})
        return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(joined)

    share = min(1.0, max_labelled / sum(counts.values()))
    sample = known.filter(F.pmod(F.xxhash64("url"), F.lit(1_000_000)) < share * 1_000_000)
    learnt = described(sample).select("label", "features")
    # a bounded number of rows, in an order that does not depend on how they were read
    learnt = learnt.repartitionByRange(4, F.hash(vector_to_array("features")), "label").sortWithinPartitions(F.hash(vector_to_array("features")), "label")
    model: GBTClassificationModel = GBTClassifier(maxIter=trees, maxDepth=depth, maxBins=32, stepSize=0.3, seed=7, labelCol="label").fit(learnt)
    rest = model.transform(described(rows.filter("by_rule is null").withColumn("label", F.lit(None).cast("double")))).select(
        "id", "host", "path", "rule", F.col("by_rule").alias("verdict"), F.element_at(vector_to_array("probability"), 2).alias("score")
    )
    decided = ruled.filter("by_rule is not null").select("id", "host", "path", "rule", F.col("by_rule").alias("verdict"), F.lit(None).cast("double").alias("score"))
    judged = rest.withColumn("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return decided.unionByName(judged).withColumnRenamed("id", id_column)
