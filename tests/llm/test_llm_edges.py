"""Nulls, empty and repeated rows, clashing columns, empty tables, and the methods' own parts."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tidewrack.llm import block_names, line_quality, mixing, packing, sharding, simhash, suffixes, toxicity, urls, vector_files
from tidewrack.llm.queries import WEIGHTS, domain_of

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, f long, h string, key string"
LONG = "word another thing " * 4000
ROWS = [
    (1, "Some text that is here.", "en", "src0", 5, 1, 2, "x", "k"), (1, "Some text that is here.", "en", "src0", 5, 1, 2, "x", "k"),
    (2, "Some  text that is\there.", "en", None, 5, 1, 2, "x", "k"), (3, None, None, "src0", None, None, None, None, None),
    (4, "", "en", "src1", 0, 1, 1, "", ""), (None, "no id", "en", "src1", 0, 1, 1, "", ""), (5, LONG, "de", "src0", 1, 1, 1, "a", "b"),
    (6, " \t\n", "de", "src0", 1, 1, 1, "a", "b"), (7, "naïve ☃ 日本語 text 🙂", "fr", "src2", 1, 1, 1, "a", "b"),
]
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, None, 1), (None, 0, 0), (3, 0, None), (5, 0, 1), (5, 0, 1)], LABELS)


def operators(labels):
    return {
        "packing": lambda d: packing.pack(d).placed, "toxicity": lambda d: toxicity.toxicity(d, labels), "simhash": simhash.near_duplicates,
        "sharding": sharding.shard, "suffixes": suffixes.without_repeats, "quality": lambda d: line_quality.quality(d, labels),
        "mixing": lambda d: mixing.mix(d, domain_of(), 0.8, 2, WEIGHTS), "exact": block_names.exact_duplicates,
    }


@pytest.mark.parametrize("name", ["packing", "toxicity", "simhash", "sharding", "suffixes", "quality", "mixing", "exact"])
def test_odd_rows_and_empty_tables(spark, docs, labels, name):
    run = operators(labels)[name]
    rows = run(docs).count()
    if name in ("toxicity", "simhash", "sharding", "suffixes", "quality", "exact"):
        assert rows == len(ROWS)
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("stage", range(5))
def test_stages_on_odd_rows(spark, docs, tmp_path, labels, stage):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    name, run = corpus_pipeline.STAGES[stage]
    out = run(spark, docs, str(tmp_path))
    assert stage == 4 or out.columns == docs.columns
    assert out.count() <= len(ROWS) or stage == 4
    assert run(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_exact_duplicates_of_odd_rows(docs):
    rows = {(r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in block_names.exact_duplicates(docs).collect()}
    assert (2, 2, 3, True) in rows and (1, 2, 3, False) in rows  # the longer original stays
    assert (3, 6, 3, False) in rows and (6, 6, 3, True) in rows and (None, None, 1, True) in rows


def test_blocks_that_share_a_hash(spark):
    texts = ["ab" * 40, "ab" * 39 + "ac", "ab" * 40, "cd" * 33, "cd" * 33 + "e", "", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for bits in (1, 4, 64):
        rows = {r["doc_id"]: r["keep_id"] for r in block_names.exact_duplicates(docs, block_bytes=8, hash_bits=bits).collect()}
        assert rows == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4, 5: 5, 6: 5}


def test_near_duplicates_keep_one(docs):
    kept = simhash.drop_near_duplicates(docs).collect()
    assert sorted(r["doc_id"] for r in kept if r["doc_id"]) == [1, 3, 5, 7]


def test_near_copies_equal_brute_force(spark):
    draw = np.random.default_rng(11)
    words = np.array([f"w{i}" for i in range(3000)])
    common = " ".join(draw.choice(words, 40))  # a passage that many unrelated texts share
    texts = []
    for i in range(60):
        base = draw.choice(words, 120)
        texts.append(" ".join(base) + " " + common * (i % 2))
        for _ in range(i % 4 if i else 40):
            copy = base.copy()
            copy[draw.choice(120, draw.integers(1, 5), replace=False)] = draw.choice(words, 5)[0]
            texts.append(" ".join(copy) + " " + common * (i % 2))
    texts += ["a b", "A  b", "a c", "", None, " ", "x y z"]
    order = draw.permutation(len(texts))
    docs = [(int(i), texts[k]) for i, k in enumerate(order)]

    def shingles(text):
        parts = (text or "").lower().split()
        return {tuple(parts[i : i + 5]) for i in range(max(1, len(parts) - 4))}

    sets = [shingles(t) for _, t in docs]
    near = [[b for b in range(len(docs)) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])] for a in range(len(docs))]
    root = list(range(len(docs)))
    while (lower := [min(root[b] for b in n) for n in near]) != root:
        root = lower
    assert 60 < len(set(root)) < len(docs)
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.drop_near_duplicates(spark, frame, "").collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(root))


def test_thresholds():
    assert sum(simhash.allocate([[0, 5, 9, 20, 50], [0, 1, 2, 3, 4], [0, 50, 60, 70, 80]])) == 1
    groups = simhash.group_bits(np.eye(64), 3)
    assert sorted(b for g in groups for b in g) == list(range(64))


def test_differencing():
    sizes = [8, 7, 6, 5, 4]
    bins = sharding.difference([[(s, i), (0, None)] for i, s in enumerate(sizes)])
    assert sorted(s for s, _ in bins) == [14, 16]
    for total, members in bins:
        assert total == sum(sizes[i] for i in sharding.leaves(members))


def test_chunked_shards_stay_whole(spark):
    groups = spark.range(500).select(F.unhex(F.sha2(F.col("id").cast("string").cast("binary"), 256)).alias("key"), (F.col("id") % 97 + 1).alias("bytes"))
    out = sharding.balanced_bins(groups, 5, chunk_groups=20, fan_in=3).join(groups, "key").groupBy("bin").agg(F.sum("bytes").alias("b")).collect()
    # what differencing in chunks promises: shards within the largest group of each other
    assert len(out) == 5 and max(r["b"] for r in out) - min(r["b"] for r in out) <= 97


@pytest.mark.parametrize("large", [[0.02], [0.03, 0.02, 0.02, 0.005], [0.09]])
def test_chunks_fill_the_spread_of_large_groups(spark, large):
    draw = np.random.default_rng(9)
    sizes = [int(x) for x in draw.integers(1, 5000, 2400)]
    total = sum(sizes)
    sizes += [int(x * total) for x in large]
    groups = spark.createDataFrame([(i.to_bytes(4, "big"), s) for i, s in enumerate(sizes)], "key binary, bytes long")
    rows = sharding.balanced_bins(groups, 24, chunk_groups=200).collect()
    assert sorted(int.from_bytes(r["key"], "big") for r in rows) == list(range(len(sizes)))
    made = np.zeros(24, np.int64)
    for r in rows:
        made[r["bin"]] += sizes[int.from_bytes(r["key"], "big")]
    if max(sizes) > sum(sizes) / 24:  # then a group is a shard of its own, and the others are level
        assert made.max() == max(sizes)
        made = np.delete(made, made.argmax())
    assert made.max() - made.min() <= 0.02 * made.mean()


def test_packing_program():
    rng = np.random.default_rng(3)
    sizes = np.unique(rng.integers(1, 100, 30))
    demand = rng.integers(1, 500, len(sizes)).astype(float)
    patterns, use = packing.column_generation(sizes, demand, 128)
    assert np.allclose((patterns * use[:, None]).sum(0), demand) and ((patterns * sizes).sum(1) <= 128).all()
    assert use.sum() >= (sizes * demand).sum() / 128 - 1e-6


def test_added_tokens_keep_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["x <|endoftext|> y", "<|endoftext|><|endoftext|>", "日本 <|endoftext|> y", "x <|endoftext| > y", "plain"]
    encoder = packing.Encoder()
    for text in texts:
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == tokens.encode(text, add_special_tokens=False).ids
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).placed.collect()
    want = {i: len(tokens.encode(t, add_special_tokens=False).ids) + 1 for i, t in enumerate(texts)}
    assert {r["doc_id"]: r["doc_tokens"] for r in rows} == want


def test_search_reads_few_exact_vectors():
    rng = np.random.default_rng(5)
    exact = rng.integers(-130, 130, (4000, 64))
    ids, queries = np.arange(4000), exact[:5].astype(float)
    found, read = vector_files.search_block(ids, exact, ids[:5], queries, 5)
    for q in range(5):
        scores = sorted(((-int(exact[i] @ exact[q]), i) for i in ids if i != q))[:5]
        assert [(i, s) for a, i, s in found if a == q] == [(i, -s) for s, i in scores]
    assert read < 5 * 4000 / 10


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (50, [0.5, 0.5]), (50, [0.5, 0.5]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (None, [1.0, 1.0]), (4, [1.0, 0.0]), (5, [1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = [tuple(r) for r in vector_files.top_k(vectors, F.col("id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 4, 65536), (0, 2, 50, 32768), (50, 1, 0, 32768), (50, 2, 4, 32768)]
    assert vector_files.top_k(vectors.limit(0), F.col("id") % 50 == 0).count() == 0


def test_odd_urls(spark):
    rows = [(1, None), (2, "nothing"), (3, "HTTP://A.Example.ORG/en/12?x=1#y"), (4, "a://b.com/de/"), (None, "x://com"), (4, "a://b.com/de/")]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    got = {(r["page_id"], r["host"], r["path"], r["rule"]) for r in urls.judge(pages).collect()}
    assert got == {(1, "", "", None), (2, "", "", None), (3, "a.example.org", "/en/12", "example.org/en/1"), (4, "b.com", "/de/", "com/de/"), (None, "com", "", None)}
    assert urls.judge(pages.limit(0)).count() == 0


def test_budgets_pass_shortages_on(spark):
    leaves = spark.createDataFrame([("a", "en", "x", 10), ("a", "en", "y", 100), ("a", "de", "z", 100), ("b", "en", "w", 30)], "domain string, lang string, source string, tokens long")
    got = {r["source"]: r["budget"] for r in mixing.leaf_budgets(leaves, F.lit(200), 1, {}).collect()}
    # b has 30 of its 100, so a gets 170: 85 for each language; x has 10 of 42, y takes the rest
    assert got == {"w": 30, "z": 85, "x": 10, "y": 75}


def test_mixture_takes_whole_budgets(spark):
    rows = [(i, "long " * 5000 if i == 3 else "some words here " * (i % 7 + 1), "en", f"src{i % 3}", i) for i in range(60)]
    rows += [rows[7], rows[7], (None, "no id", "en", "src1", 0), (None, "no id", "en", "src1", 0), (100, "one very long " * 9000, "de", "src0", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.createDataFrame(rows, schema)
    taken = mixing.mix(docs, domain_of(), 0.5, 2, WEIGHTS).toPandas()
    leaves = taken.groupby(["domain", "lang", "source"]).agg({"tokens": "sum", "budget": "first"})
    assert (leaves["tokens"] == leaves["budget"]).all()
    total = sum(len(r[1].split()) for r in rows)
    assert total // 2 - 10 <= leaves["budget"].sum() <= total // 2  # budgets are rounded down
    full = [len(r[1].split()) for r in rows]
    assert sum(t not in full for t in taken["tokens"]) <= 2 * len(leaves)

    def drawn(frame):
        return sorted(map(tuple, mixing.mix(frame, domain_of(), 0.5, 2, WEIGHTS).fillna(-1, ["doc_id"]).collect()))

    again = spark.createDataFrame(rows[::-1], schema).repartition(5)
    assert drawn(docs.coalesce(1)) == drawn(again)

    kept = mixing.keep_mixed(docs, domain_of(), 0.5, WEIGHTS).collect()
    once = mixing.mix(docs, domain_of(), 0.5, 1, WEIGHTS).toPandas()
    assert sorted(len(r["text"].split()) for r in kept) == sorted(once["tokens"])
    whole = {r[0]: r[1] for r in rows}
    for r in kept:
        assert whole[r["doc_id"]].startswith(r["text"])
        assert r["text"] == whole[r["doc_id"]] or r["n_chars"] == len(r["text"])


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    emit, lines, links = rng.normal(size=7), np.array([3, 1, 3]), rng.normal(size=(2, 2))
    good = line_quality.chain(line_quality.line_scores(emit), lines, links).good
    at = 0
    for n in lines:
        weight, total = np.zeros(n), 0.0
        for code in range(2**n):
            labels = [(code >> i) & 1 for i in range(n)]
            p = np.exp(sum(emit[at + i] * y for i, y in enumerate(labels)) + sum(links[a, b] for a, b in zip(labels, labels[1:])))
            total += p
            weight += p * np.array(labels)
        assert np.allclose(good[at : at + n], weight / total)
        at += n


def test_repeats_of_periodic_and_touching_texts(spark):
    draw = np.random.default_rng(5)
    pool = ["".join(draw.choice(list("ab \n"), draw.integers(1, 90))) for _ in range(12)]
    docs = [(i, "".join(pool[draw.integers(12)] + "é" * draw.integers(0, 3) for _ in range(draw.integers(0, 9)))) for i in range(80)]
    docs += [(80, "ab" * 400), (81, "x" + "ab" * 100), (82, "ba" * 60), (83, "a" * 500), (84, "b" + "a" * 49), (85, "c" + "a" * 50), (86, None), (86, docs[3][1]), (87, docs[3][1])]
    first: dict[bytes, int] = {}
    for own, text in docs:
        data = (text or "").encode()
        for p in range(len(data) - 49):
            first[data[p : p + 50]] = min(own, first.get(data[p : p + 50], own))
    want = []
    for own, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 49):
            if first[data[p : p + 50]] < own:
                gone[p : p + 50] = b"\1" * 50
        want.append((own, sum(gone), len([x for x in bytes(gone).split(b"\0") if x]), bytes(x for x, g in zip(data, gone) if not g)))
    found = suffixes.without_repeats(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r["doc_id"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found) == sorted(want)


def test_line_field_gradient_is_the_slope_of_its_loss():
    draw = np.random.default_rng(3)
    lines, y = np.array([4, 1, 6, 2]), np.array([1, 0, 0, 1])
    x, weight, flat = draw.normal(size=(13, 5)), draw.random(4), draw.normal(size=9)
    _, slope = line_quality.objective(flat, x, lines, y, weight)
    for i in range(9):
        step = np.eye(9)[i] * 1e-5
        rise = line_quality.objective(flat + step, x, lines, y, weight)[0] - line_quality.objective(flat - step, x, lines, y, weight)[0]
        assert abs(rise / 2e-5 - slope[i]) < 1e-6


def test_line_likelihood_equals_enumeration():
    draw = np.random.default_rng(4)
    x, flat, lines = draw.normal(size=(4, 2)), draw.normal(size=6), np.array([4])
    loss, _ = line_quality.objective(flat, x, lines, np.array([1]), np.array([1.0]), noise=0.2, decay=0.0)
    seen = total = 0.0
    for code in range(16):
        z = np.array([(code >> i) & 1 for i in range(4)])
        p = np.exp((x @ flat[:2]) @ z + sum(flat[2:].reshape(2, 2)[a, b] for a, b in zip(z, z[1:])))
        total += p
        seen += p * np.prod(np.where(z == 1, 0.8, 0.2))
    assert np.isclose(loss, -np.log(seen / total))


GOOD, BAD = "The committee met in spring and wrote a long, careful report.", "BUY $$$ NOW!!! buy buy buy ### 50% @@@"


def test_lines_of_a_mixed_document_differ_and_long_documents_are_learnt_from(spark):
    rows = [(i, "\n".join([f"{GOOD} {i}" if i % 2 else f"{BAD} {i}"] * (3 + i % 5))) for i in range(120)]
    rows += [(1001, "\n".join(f"{GOOD} {i}" for i in range(20_000))), (1002, "\n".join(f"{BAD} {i}" for i in range(20_000)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i, _ in rows], LABELS)
    for sampled in (docs, docs.filter("doc_id > 1000")):  # long documents alone teach as well
        field = line_quality.fit(sampled, labels, F.lit(True), max_lines=5_000)
        assert field.prior is None
        own, _, lines = line_quality.line_table(["\n".join([GOOD] * 6 + [BAD] * 6)])
        good = field.marginals(line_quality.with_neighbours(own, lines), lines)
        assert good[:5].min() > 0.7 > 0.3 > good[7:].max()


def _votes(draw, toxic, rates):
    return (draw.random((len(toxic), rates.shape[1])) < rates[toxic]).astype(float)


def test_label_model_recovers_voters_and_prior():
    """Posteriors without labels, of voters of known accuracy, two of them echoes of a third."""
    draw = np.random.default_rng(6)
    toxic = (draw.random(20_000) < 0.1).astype(int)
    rates = np.vstack([np.full(12, 0.02), np.full(12, 0.6)])
    v = _votes(draw, toxic, rates)
    v[:, 1] = v[:, 2] = v[:, 0]
    post = toxicity.label_model(v, 0.3)
    assert ((post > 0.5) == toxic).mean() > 0.98 and abs(post.mean() - toxic.mean()) < 0.015
    for j in range(3, 5):
        assert abs(post @ v[:, j] / post.sum() - 0.6) < 0.05 and abs((1 - post) @ v[:, j] / (1 - post).sum() - 0.02) < 0.01
    parents = toxicity.forest(v, post, np.ones(len(v)), 0.15)
    assert sum(parents[j] >= 0 for j in (0, 1, 2)) == 2  # one tree of the three echoes
    assert all(parents[j] < 0 for j in range(3, 12))
    # a sample with as many toxic rows as others, weighted, gives what all rows give
    few = np.r_[np.flatnonzero(toxic), np.flatnonzero(toxic == 0)[: toxic.sum()]]
    weight = np.where(toxic[few] == 1, 1.0, (toxic == 0).sum() / toxic.sum())
    part = toxicity.label_model(v[few], 0.3, weight)
    assert abs(weight @ part / weight.sum() - toxic.mean()) < 0.02 and np.abs(part - post[few]).mean() < 0.02


def test_sample_weights_stand_for_all_labels(spark):
    labels = spark.range(20_000).selectExpr("id as doc_id", "int(id % 10 = 0) as toxic")
    found = {r["y"]: (r["n"], r["w"]) for r in toxicity.label_sample(labels, "toxic", F.lit(True), 1_000).groupBy("y").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert all(400 < n < 600 for n, _ in found.values())
    assert abs(found[1][1] / 2_000 - 1) < 0.2 and abs(found[0][1] / 18_000 - 1) < 0.2
    assert {r["weight"] for r in toxicity.label_sample(labels, "toxic", F.lit(True), 100_000).select("weight").distinct().collect()} == {1.0}


def test_values_of_odd_rows(spark, docs, labels):
    """Null and empty texts score alike, repeated rows too; sizes, shards and spans of odd rows hold."""
    for run, modulus, held_at in ((toxicity.toxicity, 5, 0), (line_quality.quality, 4, 2)):
        rows = run(docs, labels).collect()
        by_id = {r["doc_id"]: r for r in rows}
        assert by_id[3]["score"] == by_id[4]["score"] and by_id[None]["held_out"] is False
        assert len({r["score"] for r in rows if r["doc_id"] == 1}) == 1
        assert all(0 <= r["score"] <= 1 for r in rows)
        assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == held_at) for r in rows if r["doc_id"] is not None)
    placed = [r for r in sharding.shard(docs).collect()]
    assert {r["size"] for r in placed if r["doc_id"] in (3, 4)} == {8}
    assert len({r["shard"] for r in placed if r["doc_id"] in (3, 4)}) == 1  # null and empty texts are one group
    assert len({(r["shard"], r["slot"]) for r in placed}) == len(ROWS)
