"""Per-key results when a few keys hold most rows: exact offset chunking.

1. Rows are pre-aggregated per (key, content): repeats collapse before and after one shuffle on both columns, so a hot key
   is spread over all partitions by its contents.
2. Keys are counted per partition; a prefix sum over the partitions gives each its offset; every row is numbered
   offset + position, where it is, and number // chunk_size is its chunk. The counts have at most partitions x keys rows.
3. Chunks of at most chunk_size rows are aggregated to states, which are merged per key in chunk order.

No task gets a key whole: the largest unit of work is a chunk, or a key's part of one partition.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fjordmill.session import ship_package

CHUNK = 1 << 12


def canonical_domain(c: Column | str) -> Column:
    """Trimmed, lower-case, without one leading ``www.``; null for null and blank values."""
    c = F.col(c) if isinstance(c, str) else c
    d = F.regexp_replace(F.lower(F.regexp_replace(c, r"^[\s ]+|[\s ]+$", "")), r"^www\.", "")
    return F.when(d != "", d)


def number_within_key(df: DataFrame, key: str, by: list[str], partitions: int) -> DataFrame:
    """df with ``n``: 0, 1, ... within each key, by exact offsets. df is hash-partitioned on ``by``; the numbers' order is arbitrary.

    Positions are counted where the rows are, with one counter per key of a partition: no sort and no further shuffle of the rows.
    """
    ship_package(df.sparkSession)
    placed = df.repartition(partitions, *by).withColumn("_part", F.spark_partition_id())
    counts = placed.groupBy(key, "_part").agg(F.count("*").alias("_rows"))
    before = W.partitionBy(key).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(F.col(key).alias("_key"), F.col("_part").alias("_at"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict = {}
        for b in batches:
            at = []
            for k in b.column(b.schema.get_field_index(key)).to_pylist():
                n = seen.get(k, 0)
                at.append(n)
                seen[k] = n + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int64())], [*b.schema.names, "_pos"])

    local = placed.mapInArrow(number, StructType([*placed.schema.fields, StructField("_pos", LongType())]))
    joined = local.join(offsets, local[key].eqNullSafe(offsets["_key"]) & (local["_part"] == offsets["_at"]))
    return joined.withColumn("n", F.col("_pos") + F.col("_offset")).drop("_key", "_at", "_offset", "_pos", "_part")


def key_profile(df: DataFrame, key: Column, content: str, words: str, moment: str, chunk_size: int = CHUNK, partitions: int | None = None) -> DataFrame:
    """key, n_rows, n_contents, mean_words, latest_us, n_chunks: one row per key; null keys form one group.

    n_contents counts distinct non-null contents by their MD5; mean_words ignores null counts and is null if all are;
    latest_us is the latest moment, null if there is none. Empty tables give no row.
    """
    spark = df.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    slim = df.select(key.alias("_k"), F.md5(F.col(content)).alias("_c"), F.col(words).cast("long").alias("_w"), F.col(moment).alias("_t"))
    pre = slim.groupBy("_k", "_c").agg(F.count("*").alias("_n"), F.sum("_w").alias("_ws"), F.count("_w").alias("_wn"), F.max("_t").alias("_t"))
    numbered = number_within_key(pre, "_k", ["_k", "_c"], partitions)
    states = numbered.groupBy("_k", F.floor(F.col("n") / chunk_size).alias("_chunk")).agg(
        F.sum("_n").alias("_n"), F.count("_c").alias("_d"), F.sum("_ws").alias("_ws"), F.sum("_wn").alias("_wn"), F.max("_t").alias("_t")
    )
    return states.groupBy(F.col("_k").alias("key")).agg(
        F.sum("_n").alias("n_rows"), F.sum("_d").alias("n_contents"), (F.sum("_ws") / F.sum("_wn")).alias("mean_words"), F.max("_t").alias("latest_us"), F.count("*").alias("n_chunks")
    )
