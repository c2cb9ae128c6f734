"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. A line's features are its own and its neighbours' letter, sign
and repetition statistics; links between neighbouring labels make them agree. Which lines of
a labelled document are good is not known: its label is taken as a noisy sight of every
line's label, and the field maximises the likelihood of these sights, so a good document may hold bad lines.
A document's score is the mean of its lines' forward-backward marginals, weighted by length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewrack.llm.labelled import label_sample, labelled_texts, remainder, scored

#: Bounds of the fit: about how many documents and lines are sampled. Lines are drawn in stretches
#: of neighbours, so that a long document counts by an even sample of its lines.
MAX_LABELLED = 6_000
MAX_LEARNT_LINES = 300_000
STRETCH = 200
#: Probability that a line differs from its document's label.
NOISE = 0.1
#: Byte classes: line break, blank, lower, capital, digit, ! ?, clutter, quiet signs, other, above 127.
CLASSES = np.full(256, 8, np.uint8)
CLASSES[10] = 0
CLASSES[[9, 11, 12, 13, 32]] = 1
CLASSES[97:123], CLASSES[65:91], CLASSES[48:58] = 2, 3, 4
CLASSES[[33, 63]] = 5
CLASSES[[ord(c) for c in "#$%&*@^~=<>{}[]\\|_+"]] = 6
CLASSES[[ord(c) for c in ".,;:'\"-()"]] = 7
CLASSES[128:] = 9
WIDTH = 14


def line_table(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of all lines, their lengths, and the number of lines of each text."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    lines = np.array([r.count(b"\n") + 1 for r in raw], np.int64)
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
    kinds = CLASSES[data]
    ends = np.flatnonzero(kinds == 0)
    starts = np.r_[0, ends[:-1] + 1]
    counts = np.stack([np.diff(np.r_[0, np.cumsum(kinds == c)[ends]]) for c in range(1, 10)], 1).astype(np.float64)
    length = (ends - starts).astype(np.float64)
    n = np.maximum(1, length)
    words = counts[:, 0] + 1
    letters = np.maximum(1, counts[:, 1] + counts[:, 2])
    repeats = np.concatenate([_repeats(r) for r in raw]) if raw else np.zeros((0, 3))
    own = np.stack(
        [
            np.ones_like(n), np.log1p(length) / 5, counts[:, 2] / letters, counts[:, 3] / n * 5, np.minimum(4, counts[:, 4] / words * 4),
            np.minimum(4, counts[:, 5] / words * 4), counts[:, 6] / n * 10, counts[:, 8] / n, np.minimum(4, n / words / 8), repeats[:, 0],
            repeats[:, 1], repeats[:, 2], counts[:, 7] / n * 10, (length == 0).astype(float),
        ],
        1,
    )
    return own, np.maximum(length, 1.0), lines


def _repeats(raw: bytes) -> np.ndarray:
    """For each line: the share of the text's other lines that equal it, and of its words those
    that equal the word before and those that stand in the line already."""
    lines = raw.split(b"\n")
    seen: dict[bytes, int] = {}
    for line in lines:
        seen[line] = seen.get(line, 0) + 1
    out = np.zeros((len(lines), 3))
    for i, line in enumerate(lines):
        if line:
            words = line.split()
            n = max(1, len(words))
            out[i] = (seen[line] - 1) / len(lines), sum(map(eq, words, words[1:])) / n * 4, 1 - len(set(words)) / n
    return out


def with_neighbours(own: np.ndarray, lines: np.ndarray) -> np.ndarray:
    """Own features beside those of the line before and after (zeros at the ends)."""
    last = np.cumsum(lines) - 1
    before = np.vstack([np.zeros((1, own.shape[1])), own[:-1]])
    before[np.r_[0, last[:-1] + 1]] = 0
    after = np.vstack([own[1:], np.zeros((1, own.shape[1]))])
    after[last] = 0
    return np.hstack([own, before, after])


@dataclass
class Field:
    weights: np.ndarray  # per feature, for "good" against "bad"
    links: np.ndarray  # score of a neighbouring pair, by [label, next label]
    prior: float | None = None  # set if there was nothing to learn from

    def marginals(self, x: np.ndarray, lines: np.ndarray) -> np.ndarray:
        """Probability that each line is good."""
        return chain(line_scores(x @ self.weights), lines, self.links).good

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.prior is not None or not texts:
            return np.full(len(texts), self.prior or 0.0)
        own, length, lines = line_table(texts)
        good = self.marginals(with_neighbours(own, lines), lines)
        first = np.r_[0, np.cumsum(lines)[:-1]]
        return np.add.reduceat(good * length, first) / np.add.reduceat(length, first)


def line_scores(emit: np.ndarray) -> np.ndarray:
    """Scores of (bad, good) for each line."""
    return np.stack([np.zeros_like(emit), np.clip(emit, -40, 40)], 1)


@dataclass
class Beliefs:
    good: np.ndarray  # probability that each line is good
    pairs: np.ndarray  # probabilities of each neighbouring pair's labels, [pair, label, next label]
    inner: np.ndarray  # the line that each pair begins with
    total: np.ndarray  # log of the summed weight of each chain's labellings


def chain(score: np.ndarray, lines: np.ndarray, links: np.ndarray) -> Beliefs:
    """Forward-backward over all chains at once.

    Chains are taken longest first, so that step t touches a prefix of them.
    """
    order = np.argsort(-lines, kind="stable")
    starts = np.r_[0, np.cumsum(lines)[:-1]]
    first, size = starts[order], lines[order]
    ahead, back = np.zeros_like(score), np.zeros_like(score)
    for t in range(size[0]):
        at = first[: np.searchsorted(-size, -t)] + t
        ahead[at] = score[at]
        if t:
            m = ahead[at - 1][:, :, None] + links[None]
            ahead[at] += np.logaddexp(m[:, 0], m[:, 1])
    for t in range(size[0] - 2, -1, -1):
        at = first[: np.searchsorted(-size, -(t + 1))] + t
        m = links[None] + (score[at + 1] + back[at + 1])[:, None, :]
        back[at] = np.logaddexp(m[:, :, 0], m[:, :, 1])
    total = ahead + back
    good = 1 / (1 + np.exp(np.clip(total[:, 0] - total[:, 1], -50, 50)))
    inner = np.ones(len(score), bool)
    inner[np.cumsum(lines) - 1] = False
    at = np.flatnonzero(inner)
    whole = np.logaddexp(total[:, 0], total[:, 1])
    pair = ahead[at][:, :, None] + links[None] + (score[at + 1] + back[at + 1])[:, None, :]
    return Beliefs(good, np.exp(pair - whole[at][:, None, None]), at, whole[starts])


def objective(flat: np.ndarray, x: np.ndarray, lines: np.ndarray, y: np.ndarray, weight: np.ndarray, noise: float = NOISE, decay: float = 1e-3) -> tuple[float, np.ndarray]:
    """The loss and its gradient by the weights, then the four links.

    The loss is minus the weighted log likelihood of seeing ``y`` of its chain at every line, where
    a line's hidden label shows with probability 1 - ``noise``, and half the decay times the squared length.
    """
    links = flat[-4:].reshape(2, 2)
    free = line_scores(x @ flat[:-4])
    sight = np.log(np.where(np.arange(2) == np.repeat(y, lines)[:, None], 1 - noise, noise))
    seen, unseen = chain(free + sight, lines, links), chain(free, lines, links)
    per_line = np.repeat(weight, lines)
    slope = x.T @ ((unseen.good - seen.good) * per_line)
    pairs = ((unseen.pairs - seen.pairs) * per_line[unseen.inner][:, None, None]).sum(0)
    loss = weight @ (unseen.total - seen.total) + decay / 2 * flat @ flat
    return float(loss), np.r_[slope, pairs.ravel()] + decay * flat


def train(x: np.ndarray, lines: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 120, rate: float = 0.08) -> Field:
    """The field of least loss, by Adam. ``y`` and ``weight`` are per chain."""
    flat = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, steps + 1):
        _, slope = objective(flat, x, lines, y, weight)
        m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
        flat = flat - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return Field(flat[:-4], flat[-4:].reshape(2, 2))


def fit(
    docs: DataFrame, labels: DataFrame, learn, text: str = "text", id_column: str = "doc_id", max_labelled: int = MAX_LABELLED, max_lines: int = MAX_LEARNT_LINES,
) -> Field:
    """Learn from a sample of labelled documents. Every document weighs the same, however many lines it has.

    Where the sampled documents have more than ``max_lines`` lines, stretches of them are drawn with equal chance.
    """
    sample = label_sample(labels, "quality", learn, max_labelled, id_column, balanced=False)
    texts = labelled_texts(docs, sample, text, id_column).persist()
    try:
        held = texts.agg(F.sum(F.length("text") - F.length(F.translate("text", "\n", "")) + 1)).first()[0] or 0
        share = min(1.0, max_lines / max(1, held))

        def shape(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for one, y in zip(batch["text"], batch["y"]):
                    own, _, lines = line_table([one])
                    x = with_neighbours(own, lines).astype(np.float32)
                    draw = np.random.default_rng(zlib.crc32(one.encode("utf-8", "replace")))
                    starts = np.arange(0, len(x), STRETCH)
                    kept = [x[i : i + STRETCH].tobytes() for i in starts[draw.random(len(starts)) < share]]
                    yield pd.DataFrame({"x": kept, "y": y, "lines": len(x)})

        rows = texts.mapInPandas(shape, "x binary, y int, lines long").toPandas()
    finally:
        texts.unpersist()
    if rows["y"].nunique() < 2:
        return Field(np.zeros(0), np.zeros((2, 2)), float(rows["y"].mean()) if len(rows) else 0.0)
    rows = rows.assign(x=rows["x"].map(bytes)).sort_values(["y", "x", "lines"])
    parts = [np.frombuffer(b, np.float32).reshape(-1, 3 * WIDTH) for b in rows["x"]]
    chains = np.array([len(p) for p in parts], np.int64)
    weight = 1 / rows["lines"].to_numpy()
    return train(np.vstack(parts).astype(np.float64), chains, rows["y"].to_numpy(), weight / (weight @ chains))


def quality(docs: DataFrame, labels: DataFrame, text: str = "text", id_column: str = "doc_id") -> DataFrame:
    """Per row: id, held_out, score, predicted (1 from 0.7). Null text counts as empty.

    Rows with a null id are scored, not held out and never learnt from. Without labels of
    both classes every score is the labelled share of good rows (0 without labels).
    """
    held = F.coalesce(remainder(id_column, 4) == 2, F.lit(False))
    field = fit(docs, labels, ~held, text, id_column)

    return scored(docs, field.scores, text, id_column).select(id_column, held.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
