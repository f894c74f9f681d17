"""CSV batches, lenient CSV and Excel files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

URL_COLUMNS = ["url", "resolved_url", "original_url"]


def csv_batches(spark: SparkSession, glob: str, schema: str | None = None) -> DataFrame:
    """All batch files with multi-line quoted fields, with the batch number of their name; unreadable files are skipped."""
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("ignoreCorruptFiles", True)
    df = (r.schema(schema) if schema else r).csv(glob)
    return df.withColumn("batch", F.regexp_extract(F.col("_metadata.file_name"), r"(\d+)\.csv$", 1).try_cast("int"))


def url_list(spark: SparkSession, path: str) -> DataFrame:
    """url: the URLs of a CSV file, from its url column, else another known one, else its first; malformed lines are dropped."""
    df = spark.read.option("header", True).option("mode", "DROPMALFORMED").csv(path)
    name = next((c for c in URL_COLUMNS if c in df.columns), df.columns[0])
    return df.select(F.trim(F.col(name)).alias("url")).filter("url IS NOT NULL AND url <> ''")


def excel(spark: SparkSession, path: str, sheet: int | str = 0) -> DataFrame:
    """One sheet of a workbook, read on the driver; workbooks hold at most about a million rows."""
    try:
        import pandas as pd

        return spark.createDataFrame(pd.read_excel(path, sheet_name=sheet))
    except ImportError as e:
        raise RuntimeError("reading Excel files needs pandas with an Excel engine") from e
