"""Session helpers: table access, the shared checkpoint folder and a local session for tests."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run; once per application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="fjordmill-")) / "fjordmill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))
    _shipped.add(app)


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The parquet table ``name`` below ``root``."""
    ship_package(spark)
    return spark.read.parquet(f"{root}/{name}.parquet")


SPREAD_PARTITIONS = 8


def spread(df: DataFrame) -> DataFrame:
    """df over all cores if it is a scan of a few partitions for many cores (a small file with one row group is one task
    otherwise), so at most ``SPREAD_PARTITIONS`` input splits ever move; larger scans stay as they are. The rows are the same."""
    have, want = df.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(want) if have <= SPREAD_PARTITIONS and 2 * have <= want else df


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the cluster's ``spark.checkpoint.dir``; a folder of our own only in local mode where that is unset."""
    have = spark.sparkContext.getCheckpointDir()
    if have:
        return have
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir is unset; a cluster needs a shared folder there")
        path = os.path.join(tempfile.gettempdir(), "fjordmill-checkpoints")
    spark.sparkContext.setCheckpointDir(path)
    return spark.sparkContext.getCheckpointDir() or path


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, on whatever file system it is, when the application ends."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(p)


def staged(df: DataFrame) -> DataFrame:
    """df, written once as a table into the shared checkpoint folder and read back: its lineage is cut, it survives lost
    executors, and it is removed when the application ends."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    delete_on_exit(spark, path)
    return spark.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, limit: int, measure: Column | None = None) -> DataFrame:
    """df, staged, with a broadcast hint if its rows (or the sum of ``measure``) are at most ``limit``; else as it is."""
    kept = staged(df)
    size = kept.agg(F.sum(measure) if measure is not None else F.count("*")).first()[0] or 0
    return F.broadcast(kept) if size <= limit else kept


def local_session(cores: str = "8", app: str = "fjordmill") -> SparkSession:
    """A local session for tests and the bench."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("FJORDMILL_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
