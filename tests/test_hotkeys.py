from collections import defaultdict

from pyspark.sql import functions as F

from fjordmill.operators.hotkeys import canonical_domain, key_profile, number_within_key


def brute(rows):
    groups = defaultdict(list)
    for d, c, w, t in rows:
        d = (d or "").strip().lower().removeprefix("www.") or None
        groups[d].append((c, w, t))
    out = {}
    for d, g in groups.items():
        words, times = [w for _, w, _ in g if w is not None], [t for _, _, t in g if t is not None]
        out[d] = (len(g), len({c for c, _, _ in g if c is not None}), sum(words) / len(words) if words else None, max(times, default=None))
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "domain string, content string, words int, us long").withColumn("key", F.lit("clash"))
    return {r["key"]: (r["n_rows"], r["n_contents"], r["mean_words"], r["latest_us"]) for r in key_profile(df, canonical_domain("domain"), "content", "words", "us", **kw).collect()}


def test_profile(spark):
    rows = [("hot.dk", f"c{i % 97}", i % 5, i) for i in range(1000)] + [("WWW.hot.dk ", None, None, None)] * 3 + [(None, "x", 1, 5), ("  ", "x", None, None), ("a.dk", "", 2, 2)]
    for kw in ({}, {"chunk_size": 3}, {"chunk_size": 10, "partitions": 3}):
        assert run(spark, rows, **kw) == brute(rows)


def test_empty(spark):
    assert run(spark, []) == {}


def test_chunks_are_bounded(spark):
    rows = [("hot.dk", f"c{i}", 1, i) for i in range(500)]
    df = spark.createDataFrame(rows, "domain string, content string, words int, us long")
    n = number_within_key(df, "domain", ["domain", "content"], 4)
    assert sorted(r["n"] for r in n.collect()) == list(range(500))
    assert key_profile(df, F.col("domain"), "content", "words", "us", chunk_size=100).first()["n_chunks"] == 5
