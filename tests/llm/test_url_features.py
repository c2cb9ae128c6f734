"""URL features against plain Python, long URLs, suffix statistics without a row's own label."""

import collections
import math

from pyspark.sql import functions as F

from tidewrack.llm import urls


def entropy(text):
    counts = collections.Counter(text)
    return -sum(c / len(text) * math.log2(c / len(text)) for c in counts.values()) if text else 0.0


def test_entropy_reads_the_whole_url(spark):
    texts = ["", "a", "aab", "http://x.org/é☃a", "x" * 300 + "abcdefgh" * 600, "https://e.com/" + "".join(chr(97 + i % 26) for i in range(20_000))]
    rows = spark.createDataFrame([(t,) for t in texts], "url string").select(urls._entropy(F.col("url")).alias("e")).collect()
    for row, text in zip(rows, texts):
        assert abs(row["e"] - entropy(text)) < 1e-9


def test_features_equal_plain_python(spark):
    url = "HTTPS://Sub.Example.org/a/b-c_1/x.html?q=1&r=%20#top"
    frame = spark.createDataFrame([(1, url)], "page_id long, url string").withColumn("host", urls.host_of(F.col("url"))).withColumn("path", urls.path_of(F.col("url")))
    row = urls.lexical(frame).first()
    assert (row["url_length"], row["host_length"], row["depth"], row["labels"], row["parameters"], row["escaped"]) == (len(url), 15.0, 3.0, 3, 2.0, 1.0)
    assert row["digits"] == sum(c.isdigit() for c in url) / len(url) and row["dotted_end"] == 1.0
    assert (row["last_label"], row["site"]) == ("org", "example.org")


def test_urls_with_clashing_columns_and_long_paths(spark):
    """Extra columns named like the operator's own; a site of blocked URLs judges its unruled neighbour."""
    rows = [(i, f"http://a{i % 7}.org/p{i}", "h", "p", 1.0) for i in range(60)]
    rows += [(100 + i, f"http://b{i % 5}.com/de/{'x' * (i % 9)}", "h", "p", 1.0) for i in range(60)]
    rows += [(200, "http://b1.com/other/" + "y" * 5000, "h", "p", 1.0), (201, None, None, None, None), (202, "no scheme", "h", "p", 1.0), (200, "http://b1.com/other/" + "y" * 5000, "h", "p", 1.0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, host string, site string, label double")
    found = urls.judge(frame).collect()
    assert len(found) == len(rows)
    by_id = collections.defaultdict(list)
    for r in found:
        by_id[r["page_id"]].append(r)
    assert all(r["rule"] == "org/" and r["verdict"] == "allow" for i in range(60) for r in by_id[i])
    assert all(r["rule"] == "com/de/" and r["verdict"] == "block" for i in range(60) for r in by_id[100 + i])
    assert [r["rule"] for r in by_id[200]] == [None, None] and len({r["verdict"] for r in by_id[200]}) == 1
    assert by_id[201][0]["host"] == "" and by_id[202][0]["verdict"] in ("allow", "block")
