"""Texts cut off by field limits or in transfer.

1. Length histograms per source and column, in characters and in bytes over distinct texts, show spikes at limits: a
   length is a spike if it has at least ``SPIKE_LEAST`` texts, ``SPIKE_TIMES`` the mean of the lengths around it and six
   standard deviations of a Poisson count more than it. A text of a spike length that ends without punctuation is cut,
   unless its last line is, letter for letter, a line that another line follows elsewhere, or a line of some length that
   other texts end in too (a footer). Other texts that don't end as
   sentences do are judged by 2 and 3.
2. A text is cut if it ends inside markup, an entity or a broken character, or with a mark (dots, an ellipsis in brackets)
   after something other than a finished sentence.
3. What is left ends without punctuation: a heading, list, name, link or furniture, or an unmarked cut. The last fragment
   is held against the complete units of the corpus (finished sentences, and lines that another line follows): it is
   whole if its skeleton (names and numbers by kind, and in all but short units words of four letters or more too) is that
   of complete units, and its last word ends units, both in a share of at least ``END_SHARE``: ends against ends and
   places inside longer units, counted over distinct texts, so that the verdict doesn't hang on the size of the corpus; one
   text alone is no evidence. A fragment that is letter for letter a complete unit is whole. A fragment after a finished sentence in its line must be
   like the unfinished ends of such lines.

Notices and filler don't count. Scale: units are counted in each task before the shuffle, in a table that is flushed when
it is full; only their hashes travel. Texts without an end (a minor part) are joined to the counts by hash. Nulls, blanks
are whole, and so are links and texts without letters at their end, unless at a spike.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fjordmill.llm.pagetext import FILLER, LATIN, NEUTRAL, NOTICES, PLACEHOLDERS, joined
from fjordmill.llm.residue import LONG_NOTICE, NOTICE_CHARS, SPLIT, host
from fjordmill.session import broadcast_if_small, ship_package

SPIKE_LEAST, SPIKE_TIMES, SPIKE_REACH = 8, 4.0, 20
END_SHARE, END_LEAST = 0.05, 2
ENDING_CHARS = 20
SHORT_BLANKS = 4
FLUSH = 300_000
BROADCAST_COPIES = 1_000_000
UNFINISHED, MARKED, BROKEN = "unfinished", "marked", "broken"

MARK = re.compile(r"\s*(?:…|\.\.\.|\[(?:…|\.\.\.)\]|\((?:…|\.\.\.)\))$")
IN_MARKUP = re.compile(r"<[a-zA-Z/!?][^<>]*$|<$|&[#a-zA-Z][#a-zA-Z0-9]{0,7}$|&$|�$")
LINK = re.compile(r"(?:https?://|www\.)\S+$")
SENTENCE_BREAK = re.compile(r"(?<=[^0-9\n][.!?…])[»”“\"’)\]]*\s+")
LEAD = re.compile(r"\s*(?:[-–•*]\s+|\d+[.)]\s+|\d+[:.]\d\d\s+|[^\W\d_]+(?: [^\W\d_]+){0,2} ?:\s+)")
LETTER = re.compile(r"[^\W\d_]")
NOTICE_RE, LONG_NOTICE_RE, NEUTRAL_RE, SPLIT_RE = re.compile(joined(NOTICES)), re.compile(LONG_NOTICE), re.compile(joined(NEUTRAL)), re.compile(SPLIT)
RESIDUE_LINE = re.compile(rf"(?i)^\W*{joined(FILLER)}\W*$|{joined(PLACEHOLDERS)}")
LATIN_SET = set(LATIN)
PUNCTUATION = " \t.,;:!?…»«”“„\"'’()[]{}–—-*•/|·"


def is_finished(text: str) -> bool:
    """Whether a text, trimmed at its end, ends as a sentence does; quotes, brackets and emoji may follow the full stop."""
    for ch in reversed(text):
        if ch in ".!?":
            return True
        if ch.isalnum() or ch in "<&":
            return False
    return False


def is_notice_text(text: str, site: str | None) -> bool:
    """The rule of residue.is_notice for one text."""
    name = (site or "").split(".")[0]
    some = False
    for x in SPLIT_RE.split(text.strip().lower()):
        x = x.strip().rstrip(". \t\r\n")
        if NOTICE_RE.search(x) if len(x) <= NOTICE_CHARS else LONG_NOTICE_RE.search(x):
            some = True
        elif x and x != name and not NEUTRAL_RE.search(x):
            return False
    return some


def is_filler_line(line: str) -> bool:
    words = [w.strip(PUNCTUATION).lower() for w in line.split()]
    run = 0
    for w in words:
        run = run + 1 if w in LATIN_SET else 0
        if run >= 5:
            return True
    return bool(RESIDUE_LINE.search(line))


class Units:
    """Skeletons and last words of fragments; words seen before are remembered."""

    def __init__(self, remember: int = 300_000):
        self.short: dict[str, str] = {}
        self.long: dict[str, str] = {}
        self.seen: dict[str, tuple[str, str, str | None]] = {}
        self.prefixes: dict[str, tuple[str, list[str]]] = {}
        self.remember = remember

    def _kind(self, token: str, long: bool) -> str:
        core = token.strip(PUNCTUATION)
        if not core:
            return token
        if not core.isalpha() and any(ch.isdigit() for ch in core):
            kind = "X" if core[0].isalpha() else "0"
        elif core[0].isupper():
            kind = "X"
        else:
            kind = "w" if long and len(core) >= 4 else core
        return token.replace(core, kind, 1)

    def _known(self, token: str, long: bool) -> str:
        known = self.long if long else self.short
        k = known.get(token)
        if k is None:
            if len(known) >= self.remember:
                known.clear()
            k = known[token] = self._kind(token, long)
        return k

    def skeleton(self, fragment: str, after: bool) -> str:
        fragment = fragment.strip()
        lead = LEAD.match(fragment)
        tokens = (fragment[lead.end() :] if lead else fragment).split()
        long = len(tokens) > SHORT_BLANKS
        return ("+" if after else "") + " ".join([self._known(t, long) for t in tokens]).rstrip(PUNCTUATION)

    @staticmethod
    def last_word(fragment: str) -> str:
        word = fragment.rstrip(PUNCTUATION).rsplit(None, 1)[-1:]
        core = word[0].strip(PUNCTUATION).lower() if word else ""
        return "0" if not core.isalpha() and any(ch.isdigit() for ch in core) else core

    def _learn(self, token: str) -> tuple[str, str, str | None]:
        """A token's kind in short units, in longer ones, and its key as a word."""
        if len(self.seen) >= self.remember:
            self.seen.clear()
        word = self.last_word(token)
        out = self.seen[token] = (self._kind(token, False), self._kind(token, True), "w" + word if word else None)
        return out

    def scan(self, fragment: str, after: bool, in_line: bool) -> tuple[str, str, list[str], list[str]]:
        """The keys of a unit's skeleton and last word, of its beginnings and of its other words, in one pass over its tokens."""
        fragment = fragment.strip()
        lead = LEAD.match(fragment)
        get = self.seen.get
        tokens = [get(t) or self._learn(t) for t in fragment.split()]
        words = [t[2] for t in tokens[:-1] if t[2]]
        last = next((t[2] for t in reversed(tokens) if t[2]), "w")
        if lead:
            tokens = [get(t) or self._learn(t) for t in fragment[lead.end() :].split()]
        n, sign = len(tokens), "s+" if in_line else "s"
        begun = [sign + " ".join([t[0] for t in tokens[:k]]).rstrip(PUNCTUATION) for k in range(1, min(n, SHORT_BLANKS + 1))]
        if n <= SHORT_BLANKS:
            whole = " ".join([t[0] for t in tokens]).rstrip(PUNCTUATION)
        else:
            kinds = sign + " ".join([t[1] for t in tokens])
            known = self.prefixes.get(kinds)
            if known is None:
                if len(self.prefixes) >= self.remember // 20:
                    self.prefixes.clear()
                at = [k for k, c in enumerate(kinds) if c == " "][SHORT_BLANKS:]
                known = self.prefixes[kinds] = (kinds[len(sign) :].rstrip(PUNCTUATION), [kinds[:k].rstrip(PUNCTUATION) for k in at])
            whole = known[0]
            begun += known[1]
        return ("s+" if after else "s") + whole, last, begun, words

    def fragments(self, line: str) -> list[tuple[str, bool]]:
        """The fragments of a line, and whether each is unfinished after a finished one."""
        parts = [p for p in SENTENCE_BREAK.split(line) if p.strip()]
        return [(p, k > 0 and not is_finished(p)) for k, p in enumerate(parts)]

    def complete(self, text: str) -> Iterator[tuple[str, bool, bool]]:
        """(unit, after, in_line) of the complete units of a text, trimmed at its end; in_line: whether another one stands before it in its line."""
        lines = [x for x in text.split("\n") if x.strip()]
        for n, line in enumerate(lines, 1):
            parts = self.fragments(line)
            if n == len(lines) and not is_finished(line):
                parts = parts[:-1]
            for k, (part, after) in enumerate(parts):
                yield part, after, k > 0

    @staticmethod
    def followed_lines(text: str) -> list[str]:
        """The lines of a text, trimmed at its end, that another line follows."""
        return [x for line in text.split("\n")[:-1] if (x := line.strip())]


def text_fields(df: DataFrame, fields: tuple[str, ...] = ("content", "paywall_snippet")) -> DataFrame:
    """row_id, source, site, field, text: the fields that aren't empty, one row each."""
    ship_package(df.sparkSession)
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields))
    rows = df.select("row_id", F.coalesce("source", F.lit("")).alias("source"), host("resolved_url", "original_url").alias("site"), F.explode(pairs).alias("p"))
    return rows.select("row_id", "source", "site", F.col("p.field").alias("field"), F.col("p.text").alias("text")).filter(F.length("text") > 0)


def distinct_texts(texts: DataFrame) -> DataFrame:
    """text: each text of ``texts`` once; only the keys of later copies travel, not the texts."""
    keyed = texts.select("row_id", "field", F.xxhash64("text").alias("_h"))
    first = keyed.groupBy("_h").agg(F.min(F.struct("row_id", "field")).alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    copies = keyed.join(first, "_h").filter(F.struct("row_id", "field") != F.col("_first")).select("row_id", "field")
    return texts.join(broadcast_if_small(copies, BROADCAST_COPIES), ["row_id", "field"], "left_anti").select("text")


def corpus_units(texts: DataFrame, share: float = END_SHARE) -> DataFrame:
    """unit, ends: the hashes of the skeletons and last words that end at least ``share`` of the units they occur in, of
    unfinished units, of the lines that another line follows and of the long last lines, with their number of distinct texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, ends, inside = Units(), Counter(), Counter()

        def flush() -> pa.RecordBatch:
            keys = ends.keys() | inside.keys()
            hashes = pa.array([xxhash.xxh64_intdigest(k.encode("utf8", "surrogatepass")) - (1 << 63) for k in keys], pa.int64())
            out = pa.RecordBatch.from_arrays([hashes, pa.array([ends[k] for k in keys], pa.int64()), pa.array([inside[k] for k in keys], pa.int64())], ["unit", "ends", "inside"])
            ends.clear()
            inside.clear()
            return out

        for b in batches:
            for text in b.column(0).to_pylist():
                text = text.rstrip()
                if not text:
                    continue
                ending, inner = set(), set()
                for part, after, in_line in units.complete(text):
                    whole, word, begun, others = units.scan(part, after, in_line)
                    ending.add(whole)
                    ending.add(word)
                    if not is_finished(part):
                        ending.add("u" + part.strip())
                    inner.update(begun)
                    inner.update(others)
                ending.update(["l" + x for x in units.followed_lines(text)])
                last = text.rsplit("\n", 1)[-1].strip()
                if len(last) >= ENDING_CHARS and not is_finished(last) and not LINK.search(last):  # links cut short are alike
                    ending.add("e" + last)
                ends.update(ending)
                inside.update(inner)
                if len(ends) + len(inside) > FLUSH:
                    yield flush()
        yield flush()

    counted = distinct_texts(texts).mapInArrow(count, "unit long, ends long, inside long").groupBy("unit").agg(F.sum("ends").alias("ends"), F.sum("inside").alias("inside"))
    return counted.filter((F.col("ends") > 0) & (F.col("ends") >= share * (F.col("ends") + F.col("inside")))).select("unit", "ends")


def open_ends(texts: DataFrame) -> DataFrame:
    """row_id, source, field, chars, bytes, state, plain, skeleton, word, same, line, ending: the fields that don't end as sentences do.

    plain: whether the end is a link or has no letters. Notices and filler are left out.
    """

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units()
        key = lambda k: xxhash.xxh64_intdigest(k.encode("utf8", "surrogatepass")) - (1 << 63)
        for b in batches:
            rows = []
            for row_id, source, site, field, raw in zip(*(c.to_pylist() for c in b.columns)):
                text = raw.rstrip()
                if not text:
                    continue
                marked = False
                bare = text
                if text[-1] in ".…])":
                    while m := MARK.search(bare):
                        bare, marked = bare[: m.start()].rstrip(), True
                if is_finished(bare) or not bare:
                    continue
                last = text.rsplit("\n", 1)[-1]
                if is_filler_line(last) or is_notice_text(text, site):
                    continue
                parts = units.fragments(bare.rsplit("\n", 1)[-1])
                part, after = parts[-1] if parts else ("", False)
                broken = bool(IN_MARKUP.search(text))
                state = BROKEN if broken else MARKED if marked else UNFINISHED
                plain = not LETTER.search(part) or bool(LINK.search(last))
                rows.append((row_id, source, field, len(raw), len(raw.encode("utf8", "surrogatepass")), state, plain, key("s" + units.skeleton(part, after)), key("w" + units.last_word(part)), key("u" + part.strip()), key("l" + last.strip()), key("e" + last.strip())))
            columns = list(zip(*rows)) or [()] * 12
            types = [pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            names = ["row_id", "source", "field", "chars", "bytes", "state", "plain", "skeleton", "word", "same", "line", "ending"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)

    slim = texts.select(F.col("row_id").cast("long"), "source", "site", "field", "text")
    return slim.mapInArrow(look, "row_id long, source string, field string, chars int, bytes int, state string, plain boolean, skeleton long, word long, same long, line long, ending long")


def length_spikes(texts: DataFrame) -> DataFrame:
    """source, field, unit (chars, bytes), length, n_texts: the lengths that stand out from those around them."""
    units = F.array(F.struct(F.lit("chars").alias("unit"), F.length("text").alias("length")), F.struct(F.lit("bytes").alias("unit"), F.octet_length("text").alias("length")))
    distinct = texts.select("source", "field", units.alias("units"), F.xxhash64("text").alias("_h")).groupBy("source", "field", "_h").agg(F.first("units").alias("units"))
    counts = distinct.select("source", "field", F.explode("units").alias("u")).groupBy("source", "field", "u.unit", "u.length").agg(F.count("*").alias("n_texts"))
    near = W.partitionBy("source", "field", "unit").orderBy("length").rangeBetween(-SPIKE_REACH, SPIKE_REACH)
    around = (F.sum("n_texts").over(near) - F.col("n_texts")) / (2 * SPIKE_REACH)
    stands_out = (F.col("n_texts") >= SPIKE_LEAST) & (F.col("n_texts") >= SPIKE_TIMES * F.col("_around")) & (F.col("n_texts") >= F.col("_around") + 6 * F.sqrt(F.col("_around") + 1))
    return counts.withColumn("_around", around).filter(stands_out).drop("_around")


def cut_fields(df: DataFrame) -> DataFrame:
    """row_id, source, field, state, chars, bytes, at_limit: the cut contents and snippets of df, one row each, how the cut
    shows and whether the length is a spike of its source and column.

    df has row_id, source, original_url, resolved_url, content and paywall_snippet; other columns are ignored.
    """
    texts = text_fields(df)
    units = corpus_units(texts)
    spikes = length_spikes(texts).select("source", "field", "unit", F.col("length").alias("_length"))
    by_unit = lambda u: spikes.filter(F.col("unit") == u).select("source", "field", F.col("_length").alias(u), F.lit(True).alias(f"in_{u}"))
    ends = open_ends(texts).join(by_unit("chars"), ["source", "field", "chars"], "left").join(by_unit("bytes"), ["source", "field", "bytes"], "left")
    ends = ends.withColumn("at_limit", F.col("in_chars").isNotNull() | F.col("in_bytes").isNotNull())
    least = {"skeleton": END_LEAST, "word": END_LEAST, "same": 1, "line": 1, "ending": END_LEAST}
    pairs = F.array(*(F.struct(F.lit(c).alias("role"), F.col(c).alias("unit")) for c in least))
    own = ["row_id", "source", "field", "state", "chars", "bytes", "plain", "at_limit"]
    # all five in one join: the corpus is counted once
    sought = ends.select(*own, F.explode(pairs).alias("p")).select(*own, "p.role", "p.unit").join(units, "unit", "left")
    judged = sought.groupBy(*own).agg(*(F.coalesce(F.max(F.when(F.col("role") == c, F.col("ends") >= n)), F.lit(False)).alias(c) for c, n in least.items()))
    whole = F.when(F.col("at_limit"), F.col("line") | F.col("ending")).otherwise(F.col("plain") | F.col("same") | (F.col("skeleton") & F.col("word")))
    return judged.filter((F.col("state") != UNFINISHED) | ~whole).select("row_id", "source", "field", "state", "chars", "bytes", "at_limit")


def cut_at_limits(df: DataFrame) -> DataFrame:
    """row_id, source, field, state, at_limit of cut_fields."""
    return cut_fields(df).drop("chars", "bytes")


def truncation_rates(df: DataFrame) -> DataFrame:
    """source, field, n_texts, n_cut, rate: how often each source cuts each column; empty fields don't count as texts."""
    texts = text_fields(df).groupBy("source", "field").agg(F.count("*").alias("n_texts"))
    cut = cut_fields(df).groupBy("source", "field").agg(F.count("*").alias("n_cut"))
    n_cut = F.coalesce("n_cut", F.lit(0))
    return texts.join(cut, ["source", "field"], "left").select("source", "field", "n_texts", n_cut.alias("n_cut"), F.round(n_cut / F.col("n_texts"), 6).alias("rate"))
