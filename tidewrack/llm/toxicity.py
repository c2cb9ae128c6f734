"""Toxicity scores by weak supervision.

A lexicon is mined from a bounded sample of labelled rows: words and word beginnings that
stand almost only in toxic documents. Its entries are dealt to lexicon voters; pattern
voters look at shouting, exclamation, clutter and how densely entries occur. A generative
label model says how a document's class makes the voters vote: expectation maximisation
finds each voter's hit rates in both classes, without the labels, and correlated voters are
joined in a forest so that echoes don't count twice. A linear classifier over entries
and patterns is then trained on the model's posterior labels and scores every document.
The sample holds more toxic rows than the labels' share of them; every row counts by how many it
stands for, so that the prior and the threshold of one half don't move with the number of labels.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.labelled import label_sample, labelled_texts, remainder, scored
from tidewrack.llm.tables import stored

WORD = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6)
#: Bounds of the fit: labelled rows sampled, lexicon entries kept.
MAX_LABELLED = 12_000
MAX_ENTRIES = 300
LEXICON_VOTERS = 12


def terms(text: str) -> set[str]:
    """Lower-cased words, and beginnings of longer words marked with a star."""
    words = set(WORD.findall(text.lower()))
    return words.union(w[:n] + "*" for w in words for n in STEMS if len(w) > n)


def patterns(text: str) -> list[float]:
    """Rates of capitals, exclamation marks, clutter signs, digits and repeated letters."""
    n = max(1, len(text))
    capitals = len(re.findall(r"[A-ZÀ-Þ]", text))
    return [capitals / n, text.count("!") / n * 10, len(re.findall(r"[#$%&*@]", text)) / n * 10, len(re.findall(r"\d", text)) / n, len(re.findall(r"(\w)\1\1", text)) / n * 100]


@dataclass
class Model:
    """What is learnt; sizes are bounded by MAX_ENTRIES."""

    entries: dict[str, int]
    weights: np.ndarray
    bias: float
    prior: float

    def features(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), len(self.entries) + 7), np.float32)
        stems = {n: {e for e in self.entries if e.endswith("*") and len(e) == n + 1} for n in STEMS}
        plain = set(self.entries)
        stems = {n: s for n, s in stems.items() if s}
        for row, text in enumerate(texts):
            words = set(WORD.findall(text.lower()))
            hits = words & plain
            for n, known in stems.items():
                hits |= {w[:n] + "*" for w in words if len(w) > n} & known
            for entry in hits:
                out[row, self.entries[entry]] = 1
            out[row, -7:-2] = patterns(text)
            out[row, -2] = min(len(hits), 4) / 4
            out[row, -1] = min(1.0, 20 * len(hits) / max(1, len(words)))
        return out

    def scores(self, texts: list[str]) -> np.ndarray:
        if not self.entries:
            return np.full(len(texts), self.prior)
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights + self.bias, -30, 30)))


def votes(x: np.ndarray, voters: int = LEXICON_VOTERS) -> np.ndarray:
    """Voters' votes from feature rows: entries dealt by rank, then the pattern voters."""
    entries = x[:, :-7]
    lexicon = [entries[:, v::voters].any(1) for v in range(min(voters, entries.shape[1]))]
    limits = (0.3, 0.05, 0.05, 0.2, 0.2, 0.5, 0.05)
    return np.column_stack([*lexicon, *(x[:, -7 + i] > limit for i, limit in enumerate(limits))]).astype(np.float64)


def label_model(v: np.ndarray, prior: float, weight: np.ndarray | None = None, rounds: int = 40, link: float = 0.15) -> np.ndarray:
    """Posterior of class 1 for each row of votes; ``weight`` says how many rows each stands for.

    First with voters independent given the class; then each pair's correlation within
    the classes is measured, the strongest links over ``link`` make a forest, and a voter
    with a parent there votes given its parent's vote.
    """
    rows, voters = v.shape
    weight = np.ones(rows) if weight is None else weight / weight.mean()
    parent = [-1] * voters
    post = np.clip((v[:, :-7].sum(1) > 0) * 0.9 + 0.02, 0, 1)
    prior = min(max(prior, 0.005), 0.995)
    for stage in (0, 1):
        for _ in range(rounds):
            total = np.log(np.array([1 - prior, prior]))[None, :].repeat(rows, 0)
            for j in range(voters):
                given = v[:, parent[j]] if parent[j] >= 0 else np.zeros(rows)
                for y, share in ((0, weight * (1 - post)), (1, weight * post)):
                    for g in (0, 1):
                        mask = given == g
                        if not mask.any():
                            continue
                        w = share[mask]
                        rate = (w @ v[mask, j] + (0.05 if y == 0 else 0.5)) / (w.sum() + 1)
                        total[mask, y] += np.where(v[mask, j] > 0, np.log(rate), np.log1p(-rate))
            post = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -50, 50)))
            prior = min(max(float(weight @ post) / rows, 0.005), 0.995)
        if stage == 0:
            parent = forest(v, post, weight, link)
            post = (post + prior) / 2  # echoes counted as many voters have made it too sure to learn better
    return post


def forest(v: np.ndarray, post: np.ndarray, weight: np.ndarray, link: float) -> list[int]:
    """Parents of a maximum spanning forest over correlations within the classes."""
    strength = np.zeros((v.shape[1], v.shape[1]))
    for share in (weight * (1 - post), weight * post):
        if share.sum() < 5:
            continue
        centred = v - (share @ v) / share.sum()
        cov = (centred * share[:, None]).T @ centred / share.sum()
        sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
        strength = np.maximum(strength, np.abs(cov / sd[:, None] / sd[None, :]))
    parent, tree = [-1] * v.shape[1], {0}
    while len(tree) < v.shape[1]:
        out = [j for j in range(v.shape[1]) if j not in tree]
        best, a, b = max((strength[i, j], -i, -j) for i in tree for j in out)
        if best > link:
            parent[-b] = -a
        tree.add(-b)
    return parent


def train_linear(x: np.ndarray, soft: np.ndarray, weight: np.ndarray, steps: int = 400, rate: float = 0.5, decay: float = 1e-4) -> tuple[np.ndarray, float]:
    """Logistic regression on posterior labels, full-batch gradient with momentum."""
    weight = weight / weight.sum()
    mean = float(weight @ soft)
    w, b, mw, mb = np.zeros(x.shape[1]), float(np.log((mean + 1e-3) / (1 - mean + 1e-3))), 0.0, 0.0
    w[:-7] = 2.0
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) - soft)
        mw = 0.9 * mw + (x.T @ error + decay * w)
        mb = 0.9 * mb + error.sum()
        w, b = w - rate * mw, b - rate * mb
    return w, float(b)


def mine(texts: DataFrame, max_entries: int) -> tuple[list[str], int, int]:
    """Entries by rank, and the numbers of toxic and other rows; counted by Spark."""

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for text, y in zip(batch["text"], batch["y"]):
                found = sorted(terms(text))
                yield pd.DataFrame({"term": [*found, ""], "y": y})

    counts = stored(texts.mapInPandas(emit, "term string, y int").groupBy("term").agg(F.sum("y").alias("pos"), F.count("*").alias("all")), "toxic-terms")
    sizes = counts.filter("term = ''").first()
    if sizes is None:
        return [], 0, 0
    toxic, clean = sizes["pos"], sizes["all"] - sizes["pos"]
    if not toxic or not clean:
        return [], toxic, clean
    # a term must stand in toxic rows more often than chance would have any of so many terms do
    rate = (F.col("all") - F.col("pos")) / clean
    prior, share = toxic / (toxic + clean), F.col("pos") / F.col("all")
    surprise = F.col("pos") * F.log(share / prior) + F.when(share < 1, (F.col("all") - F.col("pos")) * F.log((1 - share) / (1 - prior))).otherwise(0.0)
    enough = math.log(counts.count()) + 2.3
    known = counts.filter(f"term <> '' and pos >= {max(2, round(0.004 * toxic))}").filter((F.col("pos") / toxic > 20 * rate) & (surprise > enough))
    top = known.orderBy(F.desc(F.col("pos") / toxic - 20 * rate), "term").limit(max_entries).collect()
    return [row["term"] for row in top], toxic, clean


def fit(docs: DataFrame, labels: DataFrame, learn, text: str = "text", id_column: str = "doc_id", max_labelled: int = MAX_LABELLED, max_entries: int = MAX_ENTRIES) -> Model:
    """Learn from the labelled rows for which ``learn`` holds; with one class only, a constant score."""
    sample = label_sample(labels, "toxic", learn, max_labelled, id_column)
    texts = labelled_texts(docs, sample, text, id_column).persist()
    try:
        entries, toxic, clean = mine(texts, max_entries)
        shares = {row["y"]: row["rows"] for row in texts.groupBy("y").agg(F.sum("weight").alias("rows")).collect()}  # two rows
        prior = shares.get(1, 0.0) / (sum(shares.values()) or 1.0)
        model = Model({e: i for i, e in enumerate(entries)}, np.zeros(0), 0.0, prior)
        if not entries:
            return model

        def shape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                x = model.features(batch["text"].to_list())
                yield pd.DataFrame({"x": [row.tobytes() for row in x], "weight": batch["weight"]})

        rows = texts.mapInPandas(shape, "x binary, weight double").toPandas()
    finally:
        texts.unpersist()
    rows = rows.assign(x=rows["x"].map(bytes)).sort_values(["x", "weight"])
    x, weight = np.frombuffer(b"".join(rows["x"]), np.float32).reshape(-1, len(entries) + 7).astype(np.float64), rows["weight"].to_numpy()
    model.weights, model.bias = train_linear(x, label_model(votes(x), prior, weight), weight)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: id, held_out, score, predicted. Learns from rows that aren't held out.

    Rows with a null id are scored and never learnt from (held_out false). Without labels,
    or with one class, every score is the labelled share of toxic rows (0 without labels).
    """
    held = F.coalesce(remainder(id_column, 5) == 0, F.lit(False))
    model = fit(docs, labels, ~held, text, id_column)
    return scored(docs, model.scores, text, id_column).select(
        id_column, held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` scored below one half, with all their columns."""
    held = F.coalesce(remainder(id_column, 5) == 0, F.lit(False))
    model = fit(docs, labels, ~held, text, id_column)

    @F.pandas_udf("double")
    def rated(texts: pd.Series) -> pd.Series:
        return pd.Series(model.scores([t or "" for t in texts]).astype(float))

    return docs.filter(rated(F.coalesce(F.col(text), F.lit(""))) < 0.5)
