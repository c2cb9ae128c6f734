"""Registered queries next to their SQL or to plain Python, on the smallest tables."""

import collections
import hashlib
import re
import zlib

import duckdb
import numpy as np
import pytest
import xxhash

import __spark_entry__ as entry
from compare import compare, duckdb_connection
from tidewrack.llm.queries import ORACLE, QUERIES


@pytest.fixture(scope="module")
def texts(sf):
    return dict(duckdb.sql(f"select doc_id, coalesce(text, '') from '{sf}/documents.parquet'").fetchall())


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())
    assert {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")} == set(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf, name):
    rows, problem = compare(spark, duckdb_connection(sf), QUERIES[name], ORACLE[name], sf)
    assert not problem and rows > 0


def test_packing_places_every_token_once(spark, sf, texts):
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = QUERIES["op1_packing"](spark, sf).collect()
    tokens = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    by_doc, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = np.array([*tokens.encode(texts[doc], add_special_tokens=False).ids, 1], "<u4")
        at = 0
        for p in sorted(pieces, key=lambda p: p["start"]):
            assert p["start"] == at and p["doc_tokens"] == len(ids)
            assert p["ids_crc32"] == zlib.crc32(ids[at : at + p["length"]].tobytes())
            at += p["length"]
        assert at == len(ids)
    padding = total = 0
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
        total += at
        padding += 2048 - at if at & (at - 1) else 0
    assert padding < 0.01 * total


def held_out_accuracy(rows, labels):
    pairs = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return sum(p == y for p, y in pairs) / len(pairs)


@pytest.mark.parametrize(("name", "label", "least"), [("op2_toxicity", "toxic", 0.9), ("op8_line_quality", "quality", 0.9)])
def test_held_out_accuracy(spark, name, label, least):
    sf = "/root/testdata/sf0.01"
    rows = QUERIES[name](spark, sf).collect()
    labels = dict(duckdb.sql(f"select doc_id, {label} from '{sf}/labels.parquet'").fetchall())
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert held_out_accuracy(rows, labels) >= least


def test_simhash_equals_brute_force(spark, sf, texts):
    def plain(text):
        words = text.encode().lower().split()
        shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)] * bool(words)
        hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))

    found = {r["doc_id"]: r for r in QUERIES["op3_simhash"](spark, sf).collect()}
    prints = {d: plain(t) for d, t in texts.items()}
    assert {d: int(r["fingerprint"], 16) for d, r in found.items()} == prints
    root = {d: d for d in prints}
    for _ in prints:
        old = dict(root)
        for a in prints:
            root[a] = min(root[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 3)
        if root == old:
            break
    assert {d: r["component_id"] for d, r in found.items()} == root


def test_shards(spark, sf, texts):
    rows = QUERIES["op4_sharding"](spark, sf).collect()
    size, slots, of_text = collections.Counter(), collections.defaultdict(list), {}
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert r["size"] == len(data) + 8 and r["text_crc32"] == zlib.crc32(data)
        assert of_text.setdefault(data, r["shard"]) == r["shard"]
        size[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len(t) for t in of_text)
    assert max(size.values()) - min(size[s] for s in range(24)) <= largest + 8


def test_urls(spark, sf):
    urls = dict(duckdb.sql(f"select page_id, url from '{sf}/pages.parquet'").fetchall())
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]
    rows = QUERIES["op5_urls"](spark, sf).collect()
    assert len(rows) == len(urls)
    for r in rows:
        host, path = "", ""
        if "://" in (urls[r["page_id"]] or ""):
            rest = urls[r["page_id"]].split("://", 1)[1]
            host = re.split("[/?#]", rest)[0]
            path = re.split("[?#]", rest[len(host) :])[0]
        assert (r["host"], r["path"]) == (host.lower(), path)
        fits = [x for x in rules if ("." + r["host"]).endswith("." + x[0]) and path.startswith(x[1])]
        if fits:
            best = max(fits, key=lambda x: len(x[0] + x[1]))
            assert (r["rule"], r["verdict"]) == (best[0] + best[1], best[2])
        else:
            assert r["rule"] is None and r["verdict"] in ("allow", "block") and 0 <= r["score"] <= 1


def test_repeats_equal_brute_force(spark, sf, texts):
    found = {r["doc_id"]: r for r in QUERIES["op6_suffix_repeats"](spark, sf).collect()}
    seen = set()
    for doc in sorted(texts):
        data, covered, own = texts[doc].encode(), set(), set()
        for s in range(len(data) - 49):
            window = data[s : s + 50]
            if window in seen:
                covered.update(range(s, s + 50))
            own.add(window)
        seen |= own
        kept = bytes(c for i, c in enumerate(data) if i not in covered)
        spans = sum(i - 1 not in covered for i in covered)
        r = found[doc]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (len(data), len(covered), spans)
        assert r["kept_sha256"] == hashlib.sha256(kept).hexdigest()


def test_mixture_fills_budgets(spark, sf):
    taken = QUERIES["op7_mixing"](spark, sf).toPandas()
    assert not taken.duplicated(["doc_id", "epoch"]).any()
    for _, leaf in taken.groupby(["domain", "lang", "source"]):
        assert leaf["tokens"].sum() <= leaf["budget"].iloc[0]
    assert (taken["epoch"] < 2).all()


def test_pipeline(spark, sf, texts):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, sf).cache()
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name
        before = docs.count()
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert packed.select("doc_id").distinct().count() == before
