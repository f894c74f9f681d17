import random
from collections import defaultdict

import numpy as np

from fjordmill.llm.packing import fill_containers, pack


def brute_pack(sizes, capacity):
    """The rule in plain words: try every level, count squares anew, the fullest wins ties."""
    boxes, out = [], []
    for s in sizes:
        def squares(change):
            n = defaultdict(int)
            for k, b in enumerate(boxes):
                n[b + (s if k == change else 0)] += 1
            if change is None:
                n[s] += 1
            return sum(v * v for level, v in n.items() if level < capacity)

        options = [(squares(k), -b, k) for k, b in enumerate(boxes) if b + s <= capacity] + [(squares(None), 0, None)]
        best = min(options, key=lambda o: (o[0], o[1]))
        if best[2] is None:
            boxes.append(s)
            out.append(s)
        else:
            boxes[best[2]] += s
            out.append(boxes[best[2]])
    return out, boxes


def test_rule():
    rng = random.Random(1)
    for _ in range(60):
        cap = rng.choice([7, 12, 30])
        sizes = [rng.randrange(1, cap + 1) for _ in range(25)]
        got = pack(np.array(sizes), cap)
        fill, levels = defaultdict(int), []
        for s, b in zip(sizes, got.tolist()):
            fill[b] += s
            levels.append(fill[b])
        want, boxes = brute_pack(sizes, cap)
        assert levels == want and sorted(fill.values()) == sorted(boxes) and max(fill.values()) <= cap


def test_containers(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([0, 1, 3, 50, 99, 100, 101, 250, 300])) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, n_tokens long")
    for shard_items in (50, 1000):
        out = fill_containers(df, len(rows), 100, shard_items).collect()
        total, pieces = defaultdict(int), defaultdict(list)
        for r in out:
            pieces[r["doc_id"]].append((r["piece"], r["n_tokens"], r["container"]))
            if r["container"] is not None:
                total[r["container"]] += r["n_tokens"]
        assert max(total.values()) <= 100 and set(pieces) == {i for i, _ in rows}
        for i, n in rows:
            p = sorted(pieces[i])
            assert sum(x[1] for x in p) == n and [x[0] for x in p] == list(range(len(p)))
            assert len(p) == max(1, -(-n // 100)) and (p[0][2] is None) == (n == 0)
        assert sum(n for _, n in rows) / (100 * len(total)) > 0.9
    assert fill_containers(df.limit(0), 0).count() == 0
