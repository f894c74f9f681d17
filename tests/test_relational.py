from pyspark.sql import functions as F

from fjordmill.operators import relational as R
from fjordmill.operators.classify import classify, first_match


def test_keep_first_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 3), (2, "a", 5), (3, None, 1), (4, None, 2)], "id int, h string, w int")
    assert {r["id"] for r in R.keep_first(df, ["h"], [F.desc("w"), F.asc("id")]).collect()} == {2, 4}
    assert {r["id"] for r in R.drop_duplicate_content(df, "h", [F.asc("id")]).collect()} == {1, 3, 4}
    assert {r["id"] for r in R.drop_duplicate_content(df, "h", [F.asc("id")], "collapse").collect()} == {1, 3}


def test_batches_are_exact(spark):
    df = spark.range(1000).withColumn("k", F.xxhash64("id"))
    out = R.number_batches(df, ["k"], 128, partitions=5).orderBy("k").collect()
    assert [r["batch"] for r in out] == [i // 128 for i in range(1000)]


def test_redirects(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("l", "m"), ("m", "l"), ("s", "s")], "src string, dst string")
    starts = spark.createDataFrame([("a",), ("c",), ("l",), ("s",), ("a",)], "url string")
    got = {tuple(r) for r in R.resolve_redirects(starts, edges, 5).collect()}
    assert got == {("a", "c", 2, "resolved"), ("c", "c", 0, "direct"), ("l", "m", 5, "loop"), ("s", "s", 0, "direct")}
    twice = edges.union(edges).union(spark.createDataFrame([("a", "z"), (None, "q"), ("z", None)], "src string, dst string"))
    assert {tuple(r) for r in R.resolve_redirects(starts.union(spark.createDataFrame([(None,)], "url string")), twice, 5, every=1).collect()} == got
    assert {tuple(r) for r in R.resolve_redirects(starts.filter("url = 'a'"), edges, 1).collect()} == {("a", "b", 1, "budget")}


def test_seen_and_sets(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,), ("x",)], "k string")
    b = spark.createDataFrame([("y",), ("z",), (None,)], "k string")
    assert sorted((r["k"] or "") for r in R.not_seen(a, b, "k").collect()) == ["", "x", "x"]
    assert {tuple(r) for r in R.compare_sets(a, b, "k").collect()} == {("x", "only_a"), ("y", "both"), ("z", "only_b")}


def test_upsert_and_merge(spark):
    old = spark.createDataFrame([("a", 1, "p"), ("b", 1, "q")], "k string, t int, v string")
    new = spark.createDataFrame([("a", 2)], "k string, t int")
    assert {tuple(r) for r in R.upsert(old, new, ["k"], [F.desc("t")]).collect()} == {("a", 2, None), ("b", 1, "q")}


def test_sample_is_stable(spark):
    df = spark.createDataFrame([("a", i) for i in range(100)] + [("b", 1), (None, 2)], "k string, id int")
    x = {tuple(r) for r in R.sample_per_key(df, "k", "id", 10, 8).collect()}
    assert x == {tuple(r) for r in R.sample_per_key(df.repartition(7), "k", "id", 10, 8).collect()}
    assert sum(k == "a" for k, _ in x) == 8 and len(x) == 10


def test_classify(spark):
    classes = spark.createDataFrame([("a.dk", "mainstream"), ("a.dk", "alternative"), ("b.dk", "mainstream")], "domain string, classification string")
    df = spark.createDataFrame([("a.dk",), ("sub.b.dk",), (None,), ("b.dk",)], "domain string")
    got = {tuple(r) for r in classify(df, classes).collect()}
    assert got == {("a.dk", "alternative"), ("sub.b.dk", "other"), (None, "invalid_url"), ("b.dk", "mainstream")}


def test_first_match(spark):
    names = spark.createDataFrame([("dr nyheder",), ("intet",), (None,)], "name string")
    patterns = spark.createDataFrame([("nyheder", 2), ("^dr", 1)], "pattern string, rank int")
    assert {tuple(r) for r in first_match(names, patterns, F.col("name"), ["name"]).collect()} == {("dr nyheder", "^dr")}


def test_first_match_against_brute_force(spark):
    import random
    import re

    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab.c") for _ in range(n))
    patterns = sorted({(rng.randrange(4), word(rng.randrange(0, 3))) for _ in range(12)})
    texts = sorted({word(rng.randrange(6)) for _ in range(60)})
    p = spark.createDataFrame(patterns + [(0, None)], "rank int, pattern string")
    t = spark.createDataFrame([(x,) for x in texts] + [(None,)], "name string")
    for contains in (True, False):
        hit = (lambda x, y: y in x) if contains else (lambda x, y: re.search(y, x))
        want = {(x, min(q for q in patterns if hit(x, q[1]))[1]) for x in texts if any(hit(x, q[1]) for q in patterns)}
        assert {tuple(r) for r in first_match(t, p, F.col("name"), ["name"], contains=contains).collect()} == want


def test_hot_keys_are_cut_into_ranges(spark):
    """Sessions, runs and ranks of a hot key over many ranges against one pass."""
    import random

    rng = random.Random(6)
    rows = [(None if rng.random() < 0.1 else "hot" if rng.random() < 0.8 else rng.choice("ab"), i, rng.randrange(600), rng.random() < 0.7) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, id int, minute int, good boolean").withColumn("t", F.timestamp_seconds(F.col("minute") * 60))
    sessions, runs, ranks = {}, {}, {}
    for k in {r[0] for r in rows}:
        last, no, run = None, 0, 0
        for pos, (_, i, minute, good) in enumerate(sorted((r for r in rows if r[0] == k), key=lambda r: (r[2], r[1])), 1):
            no += last is None or minute > last + 3
            last, run = minute, run + 1 if good else 0
            sessions[i], runs[i], ranks[i] = no, run, pos
    for parts in (1, 7):
        assert {r["id"]: r["session_no"] for r in R.sessions(df, ["k"], "t", "id", 3, parts).collect()} == sessions
        assert {r["id"]: r["run_length"] for r in R.islands(df, ["k"], "t", "id", F.col("good"), partitions=parts).collect()} == runs
        assert {r["id"]: r["rank"] for r in R.rank_within_key(df, ["k"], ["t", "id"], partitions=parts).collect()} == ranks
    assert R.sessions(df.limit(0), ["k"], "t", "id").columns[-1] == "session_no"
