"""Classification by dictionary joins."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fjordmill.session import ship_package

PRECEDENCE = ["alternative", "mainstream"]
DICTIONARY_LIMIT = 200_000


def dictionary(classes: DataFrame) -> DataFrame:
    """domain, classification with one row per domain; a domain in several classes keeps the first of PRECEDENCE."""
    rank = F.coalesce(*(F.when(F.col("classification") == c, F.lit(k)) for k, c in enumerate(PRECEDENCE)), F.lit(len(PRECEDENCE)))
    return classes.groupBy("domain").agg(F.min_by("classification", F.struct(rank, "classification")).alias("classification"))


def classify(df: DataFrame, classes: DataFrame, domain: str = "domain", out: str = "news_classification") -> DataFrame:
    """df with ``out``: the dictionary's class, ``other`` for other domains, ``invalid_url`` for null ones. Exact matches only.

    The dictionary is the user's and small; adaptive execution broadcasts it by its measured size.
    """
    d = dictionary(classes).select(F.col("domain").alias("_domain"), F.col("classification").alias("_class"))
    joined = df.join(d, F.col(domain) == F.col("_domain"), "left")
    return joined.withColumn(out, F.when(F.col(domain).isNull(), "invalid_url").otherwise(F.coalesce("_class", F.lit("other")))).drop("_domain", "_class")


class Patterns:
    """A dictionary of patterns: literal ones are found together in one pass over a text, regular expressions one by one, by rank."""

    SPECIAL = set("\\.^$*+?{}[]|()")

    def __init__(self, ranked: list[tuple[object, str]], contains: bool):
        ordered = sorted(ranked)
        self.literals = {p: k for k, (_, p) in reversed(list(enumerate(ordered))) if contains or not self.SPECIAL.intersection(p)}
        self.regexes = [(k, re.compile(p)) for k, (_, p) in enumerate(ordered) if p not in self.literals]
        self.texts = [p for _, p in ordered]
        self.always = self.literals.pop("", None)  # an empty pattern is in every text
        self.automaton = None
        try:
            from ahocorasick import Automaton
        except ImportError:
            return
        if self.literals:
            self.automaton = Automaton()
            for p, k in self.literals.items():
                self.automaton.add_word(p, k)
            self.automaton.make_automaton()

    def first(self, text: str | None) -> str | None:
        if text is None:
            return None
        found = (k for _, k in self.automaton.iter(text)) if self.automaton is not None else (k for p, k in self.literals.items() if p in text)
        best = min(found, default=len(self.texts))
        if self.always is not None:
            best = min(best, self.always)
        best = next((k for k, r in self.regexes if k < best and r.search(text)), best)
        return self.texts[best] if best < len(self.texts) else None


def first_match(df: DataFrame, patterns: DataFrame, text: Column, key: list[str], pattern: str = "pattern", rank: str = "rank", contains: bool = False) -> DataFrame:
    """key columns and the first pattern, by rank, that matches ``text`` (as a regular expression, or by containment); no row without a match.

    patterns is a dictionary of at most DICTIONARY_LIMIT rows, which is checked, and goes to each worker once. Ties of rank go to
    the least pattern; null patterns and texts match nothing.
    """
    spark = df.sparkSession
    rows = patterns.filter(F.col(pattern).isNotNull()).select(F.col(rank), F.col(pattern)).limit(DICTIONARY_LIMIT + 1).collect()
    if len(rows) > DICTIONARY_LIMIT:
        raise ValueError(f"a pattern dictionary has at most {DICTIONARY_LIMIT} rows")
    ship_package(spark)
    ranked = spark.sparkContext.broadcast([(r[0], r[1]) for r in rows])
    probe = df.select(*key, text.cast("string").alias("_text")).distinct()
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in probe.schema.fields[:-1]]

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Patterns(ranked.value, contains)
        for b in batches:
            found = pa.array([known.first(t) for t in b.column(b.num_columns - 1).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], found], [*b.schema.names[:-1], "pattern"]).filter(found.is_valid())

    return probe.mapInArrow(match, ", ".join([*fields, "pattern string"]))
