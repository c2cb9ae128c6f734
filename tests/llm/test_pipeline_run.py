"""The whole pipeline on a fixture with planted copies, stage by stage against plain Python."""

import zlib

import numpy as np
import pytest

import corpus_pipeline
from tidewrack.llm import near_sets

NORMALISE = str.maketrans("", "", " \t\n\x0b\x0c\r")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """300 documents: families of near copies, exact copies but for white space, shared passages, toxic ones, odd ones."""
    draw = np.random.default_rng(21)
    words = np.array([f"word{i}" for i in range(2000)])
    passage = " ".join(draw.choice(words, 60))
    bad = ["you vile scum", "kill all of them", "worthless filth"]
    texts, toxic = [], []
    for i in range(100):
        base = list(draw.choice(words, int(draw.integers(40, 300))))
        if i % 5 == 0:
            base += passage.split()
        is_toxic = i % 10 == 3
        if is_toxic:
            base[10:10] = " ".join(draw.choice(bad, 6)).split()
        for copy in range(1 + (4 if i % 7 == 0 else i % 2)):
            text = list(base)
            for place in draw.choice(len(text), min(copy, 2), replace=False):
                text[place] = "changed"
            texts.append(" ".join(text))
            toxic.append(int(is_toxic))
        if i % 6 == 0:
            texts.append("  ".join(base) + "\n")
            toxic.append(int(is_toxic))
    texts += ["", None, " ", "one two", "one  two", "one two three four five six"]
    toxic += [0] * 6
    path = tmp_path_factory.mktemp("pipeline")
    langs, sources = ["en", "de", "fr", None], [f"src{i}" for i in range(5)] + [None]
    docs = [(i, t, langs[i % 4], sources[i % 6], len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(i, 1, t) for i, t in enumerate(toxic) if i % 2 == 0]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path)


def shingles(text):
    parts = (text or "").lower().split()
    return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))} if parts else set()


def exact_kept(rows):
    best = {}
    for r in rows:
        key = (r["text"] or "").translate(NORMALISE)
        rank = (-len(r["text"] or ""), r["doc_id"])
        best[key] = min(best.get(key, rank), rank)
    return sorted(rank[1] for rank in best.values())


def near_kept(rows):
    sets = [shingles(r["text"]) for r in rows]
    root = list(range(len(rows)))
    near = [[b for b in root if sets[a] == sets[b] or (sets[a] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]))] for a in root]
    while (lower := [min(root[b] for b in n) for n in near]) != root:
        root = lower
    first = {}
    for r, group in zip(rows, root):
        first[group] = min(first.get(group, r["doc_id"]), r["doc_id"])
    return sorted(first.values())


def test_run_equals_its_stages_in_plain_python(spark, folder):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    seen = [sorted(docs.collect(), key=lambda r: r["doc_id"])]
    frame = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        path = f"{folder}/after-{name}"
        frame.write.parquet(path)
        frame = spark.read.parquet(path)
        assert frame.columns == docs.columns
        seen.append(sorted(frame.collect(), key=lambda r: r["doc_id"]))
    clean, exact, near, mixed = ([r["doc_id"] for r in rows] for rows in seen[1:])
    assert len(clean) < len(seen[0]) and set(clean) <= {r["doc_id"] for r in seen[0]}
    assert exact == exact_kept(seen[1]) and len(exact) < len(clean)
    assert near == near_kept(seen[2]) and len(near) < len(exact)
    assert set(mixed) <= set(near)
    placed = corpus_pipeline.run(spark, folder).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r["doc_id"]: r["text"] or "" for r in seen[4]}
    assert {r["doc_id"] for r in placed} == set(texts)
    for doc, text in texts.items():
        ids = np.array([*tokens.encode(text, add_special_tokens=False).ids, 1], "<u4")
        pieces = sorted((r["start"], r["length"], r["ids_crc32"]) for r in placed if r["doc_id"] == doc)
        assert [zlib.crc32(ids[s : s + n].tobytes()) for s, n, _ in pieces] == [c for _, _, c in pieces]
        assert sum(n for _, n, _ in pieces) == len(ids)
    assert set(stages) == {"toxicity", "exact_dedup", "simhash_near_dedup", "mixing", "packing"}


def test_fingerprints_keep_similar_pairs():
    """Of pairs at the threshold none is further apart than the reach, of pairs that share a passage most are."""
    draw = np.random.default_rng(8)

    def apart(a, b):
        one, two = (np.array(near_sets.set_print(s), np.int64).view(np.uint64) for s in (a, b))
        return sum(int(x).bit_count() for x in one ^ two)

    def pair(common, own):
        shared = draw.integers(0, 1 << 63, common, dtype=np.uint64)
        return [np.unique(np.r_[shared, draw.integers(0, 1 << 63, own, dtype=np.uint64)]) for _ in range(2)]

    for n in (8, 16, 80, 800):  # common / (common + 2 own) = 0.8
        assert all(apart(*pair(n, n // 8)) <= near_sets.REACH for _ in range(400))
    assert sum(apart(*pair(40, 500)) <= near_sets.REACH for _ in range(400)) < 40


def test_fingerprint_pairs_come_first(spark):
    """The stage's fingerprints are linked as op3 links them: each set meets the lowest one within the radius."""
    from tidewrack.llm import simhash

    draw = np.random.default_rng(9)
    values = []
    for base in draw.integers(0, 2**64, 40, np.uint64):
        values += [int(base), int(base), int(base) ^ 1 << 5, int(base) ^ 7 << 40, int(base) ^ 31 << 20]
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    rows = spark.createDataFrame(list(enumerate(signed)), "node long, f long")
    found = {(r["a"], r["b"]) for r in simhash.close_sets(rows).collect()}
    head = {}
    for node, f in enumerate(signed):
        head.setdefault(f, node)
    wanted = {(head[f], node) for node, f in enumerate(signed) if head[f] != node}
    for f in head:
        lower = [g for g in head if g < f and ((f ^ g) & (2**64 - 1)).bit_count() <= simhash.DISTANCE]
        if lower:
            wanted.add(tuple(sorted((head[min(lower)], head[f]))))
    assert found == wanted


def test_sets_that_share_a_passage_are_far_apart():
    """Of pairs that share a fiftieth of their shingles none is verified; similar sets of few shingles are."""
    draw = np.random.default_rng(10)

    def close(a, b):
        one, two = (np.array(near_sets.set_print(np.sort(s)), np.int64).view(np.uint64) for s in (a, b))
        return int(np.bitwise_count(one ^ two).sum()) <= near_sets.REACH

    passage = draw.integers(0, 2**64, 4, np.uint64)
    prints = [near_sets.set_print(np.sort(np.r_[passage, draw.integers(0, 2**64, 200, np.uint64)])) for _ in range(300)]
    prints = np.array(prints, np.int64).view(np.uint64)
    for i in range(len(prints)):
        assert (np.bitwise_count(prints[i + 1 :] ^ prints[i]).sum(1) > near_sets.REACH).all()
    for _ in range(300):
        few = draw.integers(0, 2**64, 5, np.uint64)
        assert close(few[:4], few)


def test_marks_never_part_similar_sets():
    """Sets as similar as asked never differ in more cells than allowed; sets that share half of their shingles mostly do."""
    draw = np.random.default_rng(11)

    def allowed(common, own, words):
        shared = draw.integers(0, 2**64, common, np.uint64)
        sets = [np.unique(np.r_[shared, draw.integers(0, 2**64, own, np.uint64)]) for _ in range(2)]
        one, two = (np.array(near_sets.set_marks(s, words), np.int64).view(np.uint64) for s in sets)
        return int(np.bitwise_count(one ^ two).sum()) <= near_sets.most_apart(sum(map(len, sets)), near_sets.SIMILARITY)

    for words in (len(near_sets.MARKS), near_sets.PAIR_MARKS):
        assert all(allowed(n, n // 8, words) for n in (8, 16, 80, 800, 8000) for _ in range(50))
        assert sum(allowed(100, 50, words) for _ in range(100)) < 5


def test_large_group_of_half_similar_texts_stays_linear(spark, monkeypatch):
    """Texts of one template, all pairs about 0.6 alike: their pairs aren't verified, and none is lost."""
    draw = np.random.default_rng(12)
    base = [f"w{i}" for i in range(160)]
    texts = []
    for number in range(120):
        words = list(base)
        for at in draw.choice(160, 8 if number % 10 else 1, replace=False):
            words[at] = f"x{number}y{at}"
        texts.append(" ".join(words))
    sets = [near_sets.shingle_set(t) for t in texts]
    wanted = set(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i + 1, len(texts)):
            common = len(np.intersect1d(sets[i], sets[j]))
            if common >= near_sets.SIMILARITY * (len(sets[i]) + len(sets[j]) - common):
                wanted.discard(j)
    met, whole = [], near_sets._verified

    def counted(pairs, *rest):
        met.append(pairs.count())
        return whole(pairs, *rest)

    monkeypatch.setattr(near_sets, "_verified", counted)
    from tidewrack.llm import simhash

    kept = simhash.drop_near_duplicates(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert {r["doc_id"] for r in kept.collect()} == wanted
    assert sum(met) < 8 * len(texts)
