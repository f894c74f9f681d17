"""Filling containers of fixed capacity by the sum-of-squares rule.

Each item goes to the fill level (0 is a new container) after which the sum, over all fill levels, of the squared counts of
partly filled containers is least; a level array holds the counts and the containers open at each level. Ties go to the
fullest container. The rule is made for items in random order, so a shard's items come in the order of a hash, but its
smallest ``late`` share last, in falling size, to fill what is left; ``late=0`` is the plain online order.

Scale: items are hashed into shards of about ``shard_items`` by id; a shard is packed alone, in O(capacity) memory per
level array, and at most a few containers per fill level stay open in each, which is a vanishing share of a shard. Texts
over the capacity give full containers directly; only their rest is an item, so there are never more items than rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.session import ship_package

CAPACITY, LATE = 2048, 0.3
SHARD_ITEMS = 25_000


def pack(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The container (0, 1, ...) of each size, 0 < size <= capacity, placed in the order given."""
    counts = np.zeros(capacity + 1, dtype=np.int64)
    open_at: list[list[int]] = [[] for _ in range(capacity + 1)]
    out = np.empty(len(sizes), dtype=np.int64)
    made, big = 0, np.iinfo(np.int64).max
    for k, size in enumerate(sizes.tolist()):
        best, level = (2 * int(counts[size]) + 1 if size < capacity else 0), 0
        if size < capacity:
            # change of the sum of squares by moving one container from level h to h + size; a full one leaves the sum
            here = counts[1 : capacity - size + 1]
            change = 2 * (counts[1 + size : capacity + 1] - here) + 2
            change[-1] = 1 - 2 * here[-1]
            change[here == 0] = big
            h = len(change) - 1 - int(change[::-1].argmin())
            if change[h] <= best:
                level = h + 1
        if level:
            box = open_at[level].pop()
            counts[level] -= 1
        else:
            box, made = made, made + 1
        now = level + size
        if now < capacity:
            counts[now] += 1
            open_at[now].append(box)
        out[k] = box
    return out


def fill_containers(sizes: DataFrame, n_rows: int, capacity: int = CAPACITY, shard_items: int = SHARD_ITEMS, late: float = LATE) -> DataFrame:
    """doc_id, piece, n_tokens, container: the pieces of each text in order and where they lie.

    sizes has doc_id and n_tokens; n_rows is its number of rows or an upper bound (a parquet footer count). A text over the
    capacity is split into full pieces and a rest. Rows with no tokens give one row with piece 0, no tokens and a null
    container. Containers are named ``<shard>-<number>``, full pieces' own ``full-<doc_id>-<piece>``.
    """
    ship_package(sizes.sparkSession)
    shards = max(1, -(-n_rows // shard_items))
    n, full = F.col("n_tokens"), F.floor(F.col("n_tokens") / capacity).cast("int")
    whole = F.transform(F.when(full > 0, F.sequence(F.lit(0), full - 1)).otherwise(F.array().cast("array<int>")), lambda k: F.struct(k.alias("piece"), F.lit(capacity).cast("long").alias("n")))
    rest = F.when((n % capacity > 0) | (n == 0), F.array(F.struct(full.alias("piece"), (n % capacity).cast("long").alias("n")))).otherwise(F.array().cast("array<struct<piece:int,n:bigint>>"))
    pieces = sizes.select("doc_id", F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), F.explode(F.concat(whole, rest)).alias("p"))

    def place(t: pa.Table) -> pa.Table:
        t = t.sort_by([("order", "ascending"), ("doc_id", "ascending"), ("piece", "ascending")])
        ids, places, tokens = (t.column(c).to_numpy() for c in ("doc_id", "piece", "n_tokens"))
        shard = t.column("shard")[0].as_py()
        names = np.array([None] * len(t), dtype=object)
        for k in np.flatnonzero(tokens == capacity).tolist():
            names[k] = f"full-{ids[k]}-{places[k]}"
        items = (tokens > 0) & (tokens < capacity)
        at = np.flatnonzero(items)
        if len(at):
            last = tokens[at] < np.quantile(tokens[at], late)
            at = np.concatenate([at[~last], at[last][np.argsort(-tokens[at[last]], kind="stable")]])
            names[at] = [f"{shard}-{b}" for b in pack(tokens[at], capacity).tolist()]
        return t.select(["doc_id", "piece", "n_tokens"]).append_column("container", pa.array(names, pa.string()))

    rows = pieces.select("doc_id", "shard", F.col("p.piece").alias("piece"), F.col("p.n").alias("n_tokens"), F.xxhash64("doc_id", "p.piece").alias("order"))
    return rows.groupBy("shard").applyInArrow(place, "doc_id long, piece int, n_tokens long, container string")
