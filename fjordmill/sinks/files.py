"""File sinks: flat CSV, size-limited parts, numbered batches, reports and manifests."""

from __future__ import annotations

import json
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.operators.relational import not_seen, number_batches

# values as they are: the writer would trim them
CSV = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def flat(df: DataFrame) -> DataFrame:
    """df for CSV: times as ISO text, arrays joined by '; ', structs and maps as JSON."""
    cols = []
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind.startswith("timestamp"):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif kind.startswith("array<struct") or kind.startswith(("struct", "map", "variant")):
            c = F.to_json(c)
        elif kind.startswith("array"):
            c = F.array_join(c.cast("array<string>"), "; ")
        cols.append(c.alias(name))
    return df.select(*cols)


def write_csv(df: DataFrame, path: str, max_rows: int = 1_000_000, mode: str = "overwrite") -> None:
    """CSV parts of at most max_rows rows, each with a header."""
    flat(df).write.options(**CSV).option("maxRecordsPerFile", max_rows).mode(mode).csv(path)


def write_both(df: DataFrame, path: str, max_rows: int = 1_000_000) -> None:
    """Parquet and CSV of the same rows."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    write_csv(df.sparkSession.read.parquet(f"{path}/parquet"), f"{path}/csv", max_rows)


def write_batches(df: DataFrame, path: str, order: list[str], size: int, first: int = 0) -> None:
    """Numbered batches of ``size`` rows in the given order, one folder each; batches written again are replaced, others stay."""
    numbered = number_batches(df, order, size).withColumn("batch", F.col("batch") + first)
    flat(numbered).repartition("batch").write.options(**CSV).option("partitionOverwriteMode", "dynamic").partitionBy("batch").mode("overwrite").csv(path)


def write_by_domain(df: DataFrame, path: str, domain: str = "domain", max_rows: int = 100_000) -> None:
    """JSON lines, one folder per domain."""
    df.write.option("maxRecordsPerFile", max_rows).partitionBy(domain).mode("overwrite").json(path)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """A report of several tables, one folder per sheet."""
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name}")


def _few(df: DataFrame, limit: int) -> list:
    """The rows of a small aggregate; more than ``limit`` are an error, not a shorter report."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"a report has at most {limit} rows; write larger tables with write_csv")
    return rows


def write_report(df: DataFrame, path: str, title: str, limit: int = 1000) -> str:
    """A short text report of a small aggregate; returns the text. More than ``limit`` rows are an error."""
    rows = _few(df, limit)
    text = "\n".join([title, "=" * len(title), *("  ".join(f"{k}: {v}" for k, v in r.asDict().items()) for r in rows)]) + "\n"
    Path(path).write_text(text, encoding="utf8")
    return text


def write_json_report(df: DataFrame, path: str, limit: int = 1000) -> None:
    """The rows of a small aggregate as a JSON list. More than ``limit`` rows are an error."""
    rows = [json.loads(r[0]) for r in _few(df.select(F.to_json(F.struct("*"))), limit)]
    Path(path).write_text(json.dumps(rows, ensure_ascii=False, indent=1), encoding="utf8")


def append_new(df: DataFrame, path: str, key: str, known: DataFrame | None, batch: str = "0") -> None:
    """Adds the rows whose key isn't known yet as one batch, in a folder of its own; a batch written again is replaced."""
    fresh = df if known is None else not_seen(df, known, key)
    fresh.dropDuplicates([key]).write.mode("overwrite").parquet(f"{path}/batch={batch}")
