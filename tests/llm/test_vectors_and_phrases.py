"""Hard negatives, grid order join and collocations: brute force, odd rows, and the methods' own parts."""

import collections
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewrack.llm import collocations, grid_order, hard_negatives

VECTORS = "vec_id long, embedding array<double>, label int, id long, v string, dim int, chunk int, copies int"
NAN = float("nan")


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, l, 0, "x", 1, 1, 1) for i, v, l in rows], VECTORS)


def clustered(n=600, dim=12, seed=3):
    """Vectors around a few centres with exact and near copies, integer valued times 1/256."""
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, dim))
    v = centres[draw.integers(0, 9, n)] + draw.normal(size=(n, dim)) * draw.choice([0.02, 0.2, 1.0], n)[:, None]
    v[n // 2 : n // 2 + 40] = v[0]
    return [(int(i), [float(x) for x in row], int(draw.integers(0, 4))) for i, row in enumerate(v)]


ODD = [
    (1000, None, 1), (1001, [1.0, None] + [0.0] * 10, 1), (1002, [NAN] + [0.0] * 11, 1), (1003, [float("inf")] + [0.0] * 11, 1),
    (1004, [0.5] * 12, None), (None, [0.5] * 12, 1), (1005, [0.0] * 12, 1), (1006, [], 1), (1007, [], 2), (1100, [1.0, 2.0], 1),
    (1101, [1.0, 2.0], 2), (1102, [2.0, 1.0], 1), (1200, [0.5] * 12, 2), (1200, [0.5] * 12, 2), (1201, [0.25] * 12, 2),
]


def plain_negatives(rows, positives=5, negatives=10):
    ok = {(i, l, tuple(np.floor(256 * np.array(v)).astype(int).tolist())) for i, v, l in rows if None not in (i, l, v) and all(x is not None and np.isfinite(x) for x in v)}
    out = []
    for a, label, v in sorted(ok):
        if a % 100 or any(r[0] == a and r < (a, label, v) for r in ok):
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, m) for i, m, w in ok if i != a and len(w) == len(v))
        same = [(s, i) for s, i, m in scores if m == label][:positives]
        for s, p in same:
            found = [(t, i) for t, i, m in scores if m != label and 30 * -s <= 100 * -t <= 90 * -s][:negatives]
            out += [(a, p, rank + 1, i, -s, -t) for rank, (t, i) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize(("chunk_rows", "block_anchors"), [(8192, 4096), (90, 3)])
def test_hard_negatives_equal_brute_force(spark, chunk_rows, block_anchors):
    rows = clustered() + ODD
    found = hard_negatives.hard_negatives(vectors_frame(spark, rows), F.col("id") % 100 == 0, F.col("label"), chunk_rows=chunk_rows, block_anchors=block_anchors)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == plain_negatives(rows)


def test_hard_negatives_of_empty_tables_and_huge_numbers(spark):
    empty = vectors_frame(spark, clustered(4)).limit(0)
    assert hard_negatives.hard_negatives(empty, F.col("id") % 100 == 0, F.col("label")).count() == 0
    huge = vectors_frame(spark, [(0, [1e30, 1.0], 1), (1, [1.0, 1.0], 1)])
    with pytest.raises(ValueError, match="exact"):
        hard_negatives.hard_negatives(huge, F.col("id") % 100 == 0, F.col("label"))


def test_index_gives_up_pairs_early(spark):
    """High thresholds accumulate a part of the dimensions and lose no pair."""
    draw = np.random.default_rng(1)
    rows = np.floor(256 * draw.normal(size=(500, 64)) * np.geomspace(1, 0.05, 64))
    asking = rows[:20].copy()
    index = hard_negatives.ChunkIndex(rows)
    some = asking[:, index.order]
    exact = asking @ rows.T
    least = np.sort(exact, axis=1)[:, -10]
    a, r, s = index.pairs(some, hard_negatives._rests(some), least, np.ones((20, 500), bool))
    assert {(i, j): v for i, j, v in zip(a, r, s)} == {(i, j): exact[i, j] for i in range(20) for j in range(500) if exact[i, j] >= least[i]}
    assert index.sums < 0.5 * 20 * 500 * 8


def plain_near(rows, least=0.98):
    usable = {}
    for n, (i, v, l) in enumerate(rows):
        if None not in (i, l, v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            usable[n] = (l, np.array(v) / np.sqrt(np.dot(v, v)))
    root = {n: n for n in usable}
    links = collections.Counter()
    for a in usable:
        for b in usable:
            if a < b and usable[a][0] == usable[b][0] and len(usable[a][1]) == len(usable[b][1]) and usable[a][1] @ usable[b][1] >= least:
                links[a] += 1
                links[b] += 1
                x, y = root[a], root[b]
                for n in root:
                    root[n] = x if root[n] == y else root[n]
    out = []
    for n, (i, _, _) in enumerate(rows):
        component = min(rows[m][0] for m in root if root[m] == root[n]) if n in root else i
        out.append((i, links[n], component, i == component))
    return sorted(out, key=str)


@pytest.mark.parametrize("block", [1024, 16])
def test_near_vectors_equal_brute_force(spark, block):
    rows = clustered() + ODD
    found = grid_order.near_vectors(vectors_frame(spark, rows), block=block)
    assert found.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(map(tuple, found.collect()), key=str) == plain_near(rows)


def test_near_vectors_of_empty_tables_and_extreme_numbers(spark):
    empty = vectors_frame(spark, clustered(4)).limit(0)
    assert grid_order.near_vectors(empty).count() == 0
    rows = [(1, [1e300, 1e300], 1), (2, [1e-300, 1e-300], 1), (3, [-1.0, 1.0], 1)]
    assert sorted(map(tuple, grid_order.near_vectors(vectors_frame(spark, rows)).collect())) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_intervals_are_skipped(spark):
    """Sorted vectors of far clusters: few intervals are compared, all links are found."""
    draw = np.random.default_rng(2)
    centres = draw.normal(size=(40, 16))
    v = np.repeat(centres, 50, axis=0) + draw.normal(size=(2000, 16)) * 0.01
    v /= np.linalg.norm(v, axis=1)[:, None]
    order = np.lexsort(np.floor(v[:, :8] / 0.2).T[::-1])
    v = v[order]
    epsilon = np.sqrt(2 - 2 * 0.98)
    i, j, compared = grid_order.linked(v, v, v[:, :8], v[:, :8], 0.98, epsilon, True)
    want = np.triu(v @ v.T >= 0.98, 1)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(list, map(np.ndarray.tolist, np.nonzero(want)))))
    assert compared < 0.4 * 2000 * 2000


def test_forest_has_the_links_components():
    draw = np.random.default_rng(4)
    for n in (1, 10, 200):
        i, j = draw.integers(0, n, n // 2), draw.integers(0, n, n // 2)
        root = list(range(n))
        for a, b in zip(i, j):
            x, y = root[a], root[b]
            root = [min(x, y) if r in (x, y) else r for r in root]
        assert grid_order.forest(i, j, n).tolist() == root


DOCS = "doc_id long, text string, lang string, rank long, n long, phrase string, w1 string, c long"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, l, 0, 0, "p", "w", 1) for i, (t, l) in enumerate(rows)], DOCS)


def plain_collocations(rows, longest=5, least=100, cover=100, top=2000):
    counts, totals = collections.Counter(), collections.Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, longest + 1):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    out = []
    for p, a in candidates.items():
        lang, words = p[0], p[1:]
        inside = any(
            q[0] == lang and len(q) > len(p) and 100 * b >= cover * a and any(q[i : i + len(words)] == words for i in range(1, len(q)))
            for q, b in candidates.items()
        )
        cuts = [(1000 * a * totals[lang] // (counts[(lang, *words[:k])] * counts[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        if not inside:
            out.append((lang, -score, -a, " ".join(words).encode(), counts[(lang, *words[:k])], counts[(lang, *words[k:])]))
    ranked, seen = [], collections.Counter()
    for lang, score, a, phrase, l, r in sorted(out):
        seen[lang] += 1
        if seen[lang] <= top:
            ranked.append((lang, seen[lang], phrase.decode(), -a, l, r, totals[lang], -score))
    return ranked


def phrase_rows():
    draw = np.random.default_rng(5)
    words = np.array([f"w{i}" for i in range(60)] + ["Été", "日本", "|", "NEW", "york"])
    weights = 1 / np.arange(1, len(words) + 1)
    texts = []
    for n in range(120):
        body = list(draw.choice(words, 60, p=weights / weights.sum()))
        body[5:5] = ["New", "York", "City", "Hall"] if n % 3 else ["new", "york,", "city"]
        texts.append((" ".join(body).replace("w7 ", "w7.\t").replace("w9 ", "w9\r\n"), ["en", "de", None, "und", ""][n % 5]))
    return texts + [(None, "en"), ("", "en"), (" \t\n", "en"), ("...", None), ("one", None)] + [("a b " * 3000, "en")] + [("x y z", "zz")] * 3


@pytest.mark.parametrize("bits", [24, 10])
def test_collocations_equal_brute_force(spark, bits):
    rows = phrase_rows()
    for least, cover in ((5, 100), (3, 60)):
        found = collocations.collocations(docs_frame(spark, rows), least=least, cover=cover, bits=bits)
        assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
        assert sorted(map(tuple, found.collect())) == sorted(plain_collocations(rows, least=least, cover=cover))


def test_collocations_of_empty_tables(spark):
    assert collocations.collocations(docs_frame(spark, phrase_rows()).limit(0)).count() == 0
    assert collocations.collocations(docs_frame(spark, [(None, None), ("", "en")])).count() == 0


def test_long_texts_are_cut_at_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "AT_ONCE", 50)
    draw = np.random.default_rng(6)
    body = b"".join(draw.choice([b"a", b"bb", b" ", b".", b"c\n", b"x" * 70], 400))
    parts = list(collocations._stretches(body))
    assert b"".join(parts) == body and len(parts) > 3
    assert collocations.words_of([body]) == [w for i, p in enumerate(parts) for w in collocations.words_of([p])] or all(p[-1:] in [bytes([e]) for e in collocations.ENDS] for p in parts[:-1])


def test_scores_are_exact(spark):
    rows = [(10**16, 9 * 10**16, 10**16 + 1, 10**16 + 3), (123456789012345, 98765432109876543, 123456789012346, 223456789012345), (100, 100, 100, 100)]
    found = spark.createDataFrame(rows, "a long, n long, l long, r long").withColumn("s", collocations.exact_score("a", "n", "l", "r"))
    assert [r["s"] for r in found.collect()] == [1000 * a * n // (l * r) for a, n, l, r in rows]
