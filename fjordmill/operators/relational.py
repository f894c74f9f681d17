"""Dedup, merge, set comparison and incremental building blocks over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fjordmill.session import staged

def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``, which should end in a unique column. Null keys form one group.

    The rank filter becomes a limit per group before the shuffle, so hot keys don't grow it.
    """
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def drop_duplicate_content(df: DataFrame, hash_col: str, order: list[Column], null_hash: str = "keep") -> DataFrame:
    """One row per content hash; rows without one are all kept, or collapsed to one with ``null_hash='collapse'``."""
    if null_hash == "collapse":
        return keep_first(df, [hash_col], order)
    return keep_first(df.filter(F.col(hash_col).isNotNull()), [hash_col], order).unionByName(df.filter(F.col(hash_col).isNull()))


def top_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first k rows of each group with their rank."""
    return df.withColumn(rank, F.row_number().over(W.partitionBy(*keys).orderBy(*order))).filter(F.col(rank) <= k)


def not_seen(df: DataFrame, seen: DataFrame, key: str, seen_key: str | None = None) -> DataFrame:
    """The rows whose key isn't among those seen; rows with a null key are new."""
    return df.join(seen.select(F.col(seen_key or key).alias("_seen")).distinct(), F.col(key) == F.col("_seen"), "left_anti")


def not_seen_any(df: DataFrame, seen: DataFrame, id_cols: list[str], candidates: list[Column], seen_key: str) -> DataFrame:
    """The rows none of whose candidate keys was seen. The keys are exploded, so the join stays an equi-join."""
    probe = df.select(*id_cols, F.explode(F.array_distinct(F.array(*candidates))).alias("_key"))
    hit = probe.join(seen.select(F.col(seen_key).alias("_key")).distinct(), "_key", "left_semi").select(*id_cols).distinct()
    return df.join(hit, id_cols, "left_anti")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """base with changes: per key the first row by ``order`` over both; columns missing on one side are null."""
    return keep_first(base.unionByName(changes, allowMissingColumns=True), keys, order)


def merge_sources(frames: dict[str, DataFrame], keys: list[str], order: list[Column]) -> DataFrame:
    """The union of the frames with their name as ``source``, one row per key."""
    parts = [f.withColumn("source", F.lit(name)) for name, f in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return keep_first(out, keys, order)


def compare_sets(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """key, side: each distinct non-null key with where it occurs: both, only_a or only_b."""
    left, right = (x.select(key).filter(F.col(key).isNotNull()).distinct() for x in (a, b))
    joined = left.withColumn("_a", F.lit(1)).join(right.withColumn("_b", F.lit(1)), key, "full")
    return joined.select(key, F.when(F.col("_a").isNull(), "only_b").when(F.col("_b").isNull(), "only_a").otherwise("both").alias("side"))


def number_batches(df: DataFrame, order: list[str], size: int, partitions: int | None = None, out: str = "batch") -> DataFrame:
    """df with ``out``: the batch, from 0, of each row in the global order, ``size`` rows a batch.

    Rows are range-partitioned, counted per partition and numbered by offset; no task sees all rows. order should be unique.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # written once: range bounds are sampled, so a second run of the same plan could place rows otherwise
    placed = staged(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # at most n rows, one per partition
    offsets = F.broadcast(counts.select("_part", (F.sum("_rows").over(W.orderBy("_part")) - F.col("_rows")).alias("_offset")))
    local = placed.withColumn("_pos", F.row_number().over(W.partitionBy("_part").orderBy(*order)) - 1)
    return local.join(offsets, "_part").withColumn(out, F.floor((F.col("_pos") + F.col("_offset")) / size)).drop("_part", "_pos", "_offset")


def _ranges(df: DataFrame, key: list[str], order: list[str], partitions: int | None = None) -> DataFrame:
    """df with ``_part``, ranges of (key, order): a key with a third of all rows lies in many parts. Written once, as range bounds are sampled."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return staged(df.repartitionByRange(n, *key, *order).withColumn("_part", F.spark_partition_id()))


def _carried(rows: DataFrame, key: list[str], state: Column, fold, out: str) -> DataFrame:
    """rows with ``out``: the fold of the states of a key's earlier parts; null for its first part. There are at most parts x keys states."""
    before = W.partitionBy(*key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    states = rows.groupBy(*key, "_part").agg(state.alias("_state"))
    carry = states.select(*(F.col(k).alias(f"_key{i}") for i, k in enumerate(key)), F.col("_part").alias("_at"), fold(F.col("_state")).over(before).alias(out))
    on = rows["_part"] == carry["_at"]
    for i, k in enumerate(key):
        on = on & rows[k].eqNullSafe(carry[f"_key{i}"])
    return rows.join(carry, on).drop("_at", *(f"_key{i}" for i in range(len(key))))


def rank_within_key(df: DataFrame, key: list[str], order: list[str], out: str = "rank", partitions: int | None = None) -> DataFrame:
    """df with ``out``: 1, 2, ... within each key by ``order``, exactly, with no task that has a whole key."""
    rows = _carried(_ranges(df, key, order, partitions), key, F.count("*"), F.sum, "_before")
    local = W.partitionBy(*key, "_part").orderBy(*order)
    return rows.withColumn(out, F.row_number().over(local) + F.coalesce("_before", F.lit(0))).drop("_part", "_before")


def sessions(df: DataFrame, key: list[str], time: str, tie: str, gap_minutes: int = 30, partitions: int | None = None) -> DataFrame:
    """df with session_no, from 1 within each key: a new one starts after a gap of more than ``gap_minutes``.

    A key's rows are cut into ranges of time; each range takes over the last time and the number of sessions of those before it.
    """
    rows = _carried(_ranges(df, key, [time, tie], partitions), key, F.max(time), F.max, "_last")
    local = W.partitionBy(*key, "_part").orderBy(time, tie)
    previous = F.coalesce(F.lag(time).over(local), F.col("_last"))
    gap = F.col(time) > previous + F.expr(f"INTERVAL {gap_minutes} MINUTES")
    opened = rows.withColumn("_new", F.when(previous.isNull() | gap, 1).otherwise(0))
    counted = _carried(opened, key, F.sum("_new"), F.sum, "_opened")
    return counted.withColumn("session_no", F.sum("_new").over(local) + F.coalesce("_opened", F.lit(0))).drop("_new", "_opened", "_last", "_part")


def islands(df: DataFrame, key: list[str], time: str, tie: str, flag: Column, out: str = "run_length", partitions: int | None = None) -> DataFrame:
    """df with ``out``: how many rows in a row, up to this one, have the flag; a null flag ends a run.

    A row's run is its position less that of the last row without the flag, in its range of time or in those before it.
    """
    rows = _carried(_ranges(df.withColumn("_flag", F.coalesce(flag, F.lit(False))), key, [time, tie], partitions), key, F.count("*"), F.sum, "_before")
    local = W.partitionBy(*key, "_part").orderBy(time, tie)
    placed = rows.withColumn("_pos", F.row_number().over(local) + F.coalesce("_before", F.lit(0))).withColumn("_break", F.when(~F.col("_flag"), F.col("_pos")))
    carried = _carried(placed, key, F.max("_break"), F.max, "_broke")
    last = F.coalesce(F.max("_break").over(local.rowsBetween(W.unboundedPreceding, 0)), F.col("_broke"), F.lit(0))
    return carried.withColumn(out, F.when(F.col("_flag"), F.col("_pos") - last).otherwise(0)).drop("_flag", "_pos", "_break", "_before", "_broke", "_part")


def resolve_redirects(starts: DataFrame, edges: DataFrame, max_redirects: int = 5, every: int = 4, checkpoint=staged) -> DataFrame:
    """url, resolved_url, redirect_count, ended: each start followed along edges (src, dst) for at most ``max_redirects`` steps.

    Of several dst of one src the least counts; null ones are none. A start without an edge resolves to itself; when the budget ends, what was reached
    counts. ended says how: ``direct`` (no edge), ``resolved``, ``loop`` (an address came twice) or ``budget``. Each step is one equi-join;
    ``checkpoint`` (a function of a DataFrame) cuts the lineage every few steps. A path has at most ``max_redirects`` + 1 addresses.
    """
    first = F.array("url")
    cur = starts.select("url").filter("url IS NOT NULL").distinct().select("url", F.col("url").alias("resolved_url"), F.lit(0).alias("redirect_count"), first.alias("_path"), F.lit(False).alias("_loop"), F.lit(False).alias("_open"))
    e = edges.filter("src <> dst").groupBy(F.col("src").alias("_src")).agg(F.min("dst").alias("_dst"))
    for step in range(1, max_redirects + 1):
        j = cur.join(e, cur["resolved_url"] == e["_src"], "left")
        moved = F.col("_dst").isNotNull()
        cur = j.select(
            "url", F.coalesce("_dst", "resolved_url").alias("resolved_url"), (F.col("redirect_count") + F.when(moved, 1).otherwise(0)).alias("redirect_count"),
            F.when(moved, F.array_append("_path", F.col("_dst"))).otherwise(F.col("_path")).alias("_path"), (F.col("_loop") | F.coalesce(F.array_contains("_path", F.col("_dst")), F.lit(False))).alias("_loop"), moved.alias("_open"),
        )
        if checkpoint and step % every == 0:
            cur = checkpoint(cur)
    more = cur.join(e.select(F.col("_src")), cur["resolved_url"] == F.col("_src"), "left")  # whether the last address would go on
    ended = F.when(F.col("redirect_count") == 0, "direct").when(F.col("_loop"), "loop").when(F.col("_open") & F.col("_src").isNotNull(), "budget").otherwise("resolved")
    return more.select("url", "resolved_url", "redirect_count", ended.alias("ended"))


def sample_per_key(df: DataFrame, key: str, row_id: str, percent: float, cap: int | None = None, seed: int = 42) -> DataFrame:
    """max(1, percent of the rows) per key, at most ``cap``: those with the least seeded hashes. The same rows each time."""
    counts = df.groupBy(F.col(key).alias("_k")).agg(F.count("*").alias("_size"))
    want = F.greatest(F.lit(1), F.floor(F.col("_size") * F.lit(percent) / 100))
    if cap is not None:
        want = F.least(want, F.lit(cap))
    ranked = rank_within_key(df.withColumn("_hash", F.xxhash64(F.lit(seed), row_id)), [key], ["_hash", row_id], "_rank")
    return ranked.join(counts, F.col(key).eqNullSafe(F.col("_k"))).filter(F.col("_rank") <= want).drop("_k", "_hash", "_rank", "_size")
