import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from fjordmill.llm.spans import SharedSpans, compact_windows, joined_windows, min_hashes, signatures, sliding_min, window_hashes


def brute(rows, k):
    seen, pairs, shared = defaultdict(set), set(), {}
    for i, t in rows:
        for p in range(len(t or "") - k + 1):
            seen[t[p : p + k]].add(i)
    for s in seen.values():
        pairs |= {(a, b) for a in s for b in s if a < b}
    for i, t in rows:
        hit = [False] * len(t or "")
        for p in range(len(t or "") - k + 1):
            if len(seen[t[p : p + k]]) > 1:
                hit[p : p + k] = [True] * k
        shared[i] = sum(hit)
    return pairs, shared


def check(spark, rows, span, gram, few):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("uid", F.lit("clash")).withColumn("sig", F.lit(1))
    s = SharedSpans(df, span=span, gram=gram, few=few)
    got = [tuple(r) for r in s.pairs().collect()]
    pairs, shared = brute(rows, span)
    assert len(got) == len(set(got)) and set(got) == pairs
    assert {r["doc_id"]: r["n_shared"] for r in s.shared_chars().collect()} == shared


def test_helpers():
    x = np.random.default_rng(1).integers(0, 50, 300).astype(np.uint64)
    for w in (1, 2, 3, 7, 64, 100):
        assert (sliding_min(x, w) == [x[i : i + w].min() for i in range(len(x) - w + 1)]).all()
    c = np.frombuffer(("abc" * 40).encode("utf-32-le"), dtype=np.uint32)
    h = window_hashes(c, 10)
    assert len(set(h.tolist())) == 3 and (h[:-3] == h[3:]).all()


def test_against_brute_force(spark):
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("abcdefgæ😀") for _ in range(rng.randrange(2, 7)))
    passages = [" ".join(word() for _ in range(8)) for _ in range(4)]
    rows = []
    for i in range(60):
        t = " ".join(word() for _ in range(rng.randrange(20)))
        for _ in range(rng.randrange(3)):
            p = rng.choice(passages)
            a = rng.randrange(len(p))
            at = rng.randrange(len(t) + 1)
            t = t[:at] + p[a : a + rng.randrange(15, 60)] + t[at:]
        rows.append((i, t))
    rows += [(100, None), (101, ""), (102, rows[0][1]), (103, rows[0][1]), (104, "aaaa" * 60), (105, "a" * 150), (106, "b" + "aaaa" * 20 + "c")]
    for few in (1, 3, 1000):
        check(spark, rows, 24, 10, few)


def test_edges(spark):
    check(spark, [(1, "x" * 23), (2, "x" * 23)], 24, 10, 32)
    check(spark, [(1, "x" * 24), (2, "x" * 24), (3, None)], 24, 10, 32)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert SharedSpans(df).pairs().count() == 0 and SharedSpans(df).shared_chars().count() == 0


def test_windows_are_nodes_of_the_tree():
    """The compact windows against the Cartesian tree: a node spanning at least w tokens is the least token of a run of starts."""
    rng = np.random.default_rng(3)
    for _ in range(60):
        n, w = int(rng.integers(5, 60)), int(rng.integers(2, 9))
        tokens = rng.permutation(n).astype(np.uint64)
        want, todo = [], [(0, n - 1)]
        while todo:
            lo, hi = todo.pop()
            if hi - lo + 1 < w:
                continue
            c = lo + int(tokens[lo : hi + 1].argmin())
            want.append((max(lo, c - w + 1), int(tokens[c])))
            todo += [(lo, c - 1), (c + 1, hi)]
        first, sig = compact_windows(tokens, w)
        assert list(zip(first.tolist(), sig.tolist())) == sorted(want)


def test_interval_join():
    """Joined windows against the signatures of every start."""
    rng = np.random.default_rng(5)
    for _ in range(40):
        tokens = rng.integers(0, 30, int(rng.integers(8, 80))).astype(np.uint64)
        parts = min_hashes(tokens, 3)
        starts, joint, own = joined_windows([compact_windows(t, 5) for t in parts])
        each = list(zip(*(sliding_min(t, 5).tolist() for t in parts)))
        edges = [0] + [k for k in range(1, len(each)) if each[k] != each[k - 1]]
        assert starts.tolist() == edges and own.tolist() == [each[k][0] for k in edges]
        assert len(set(joint.tolist())) == len({each[k] for k in edges})
    # texts in one batch have the signatures that they have alone
    texts = ["abcdefgh" * 9, "x" * 30, "hgfedcba" * 8 + "abcdefgh" * 9]
    together = {(int(k), int(v)) for k, v in zip(*signatures(texts, 24, 10))}
    assert together == {(n, int(v)) for n, t in enumerate(texts) for v in signatures([t], 24, 10)[1]}


def test_classes(spark):
    rows = [(5, "ab" * 40), (3, "ab" * 40), (9, "ab" * 40), (4, "cd" * 50), (7, None), (8, "short")]
    got = {tuple(r) for r in SharedSpans(spark.createDataFrame(rows, "doc_id long, text string"), span=24, gram=10).classes().collect()}
    assert got == {(3, 3), (5, 3), (9, 3), (4, 4)}
