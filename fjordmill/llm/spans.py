"""Long exact spans shared between texts.

Tokens are the hashes of all stretches of ``gram`` characters; a stretch of ``span`` characters is a subsequence of w = span - gram + 1
tokens. Under one min-hash function, a subsequence's signature is its least token: the lowest common node of the subsequence in the
Cartesian tree over the text's token hashes. So all subsequences of w tokens fall into *compact windows*, one per node whose subtree
spans at least w tokens: the run of starts whose subsequences have that node as their least token. As w is fixed, the nodes and their
runs are those of the sliding minima (``compact_windows``; the tests compare them with the tree itself).

``HASHES`` min-hash functions give as many partitions of a text's starts into windows. An interval join of them (``joined_windows``)
gives the runs of starts that share all signatures. A verbatim stretch has the same signatures under every function in all texts, so
here enough hashes are all hashes, and the join between texts is an equality of joint signatures; what two grams share by
chance under one function seldom agrees under all.

Copies are collapsed to their least id first, by 128-bit hashes of the texts. Joint signatures of one text only are dropped. One of at
most ``few`` windows is verified pair by pair, on characters: each occurrence of the first function's least token
carries the characters that a stretch of ``span`` characters around it can reach, and the common reach to both sides must
add up to ``span``. A signature of more windows is never paired: each stretch in them becomes a 128-bit BLAKE2 digest of its characters; equal digests
are shared stretches, and only left-maximal ones (different characters before them, or the start of a text) make pairs, so
a stretch in the middle of a passage that a third of all texts hold makes none, and every pair made is in the result.

Scale: three scans: one for the hashes of whole texts, one for the signatures, one for the candidates' occurrences; a shuffle of
(signature, id); the shared signatures are broadcast only after a check of their number, else joined. Groups are joined, never collected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.session import broadcast_if_small, ship_package, staged

SPAN, GRAM, FEW, HASHES = 160, 40, 32, 2
BROADCAST_SIGNATURES, BROADCAST_COPIES = 1_000_000, 1_000_000
BATCH_CHARS = 1 << 21
BASE = 0x9E3779B97F4A7C15


@lru_cache(8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64, i < n."""
    inverse = pow(base, -1, 1 << 64)
    with np.errstate(over="ignore"):
        make = lambda b: np.concatenate([[np.uint64(1)], np.cumprod(np.full(n - 1, b, dtype=np.uint64), dtype=np.uint64)])
        return make(base), make(inverse)


def _mix(x: np.ndarray, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185 + 2 * salt)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
        return x ^ (x >> np.uint64(33))


def window_hashes(codes: np.ndarray, width: int, base: int = BASE) -> np.ndarray:
    """A hash of codes[i:i+width] for each i; equal for equal stretches at any place."""
    n = len(codes)
    if n < width:
        return np.empty(0, dtype=np.uint64)
    size = 1 << max(16, int(n).bit_length())
    up, down = _powers(base, size)
    with np.errstate(over="ignore"):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64) + np.uint64(1), 7) * up[:n], dtype=np.uint64)])
        return _mix((sums[width:] - sums[:-width]) * down[: n - width + 1], 1)


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """The least of x[i:i+width] for each i, by doubling."""
    done, out = 1, x
    while done * 2 <= width:
        out = np.minimum(out[:-done], out[done:])
        done *= 2
    rest = width - done
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


def _batched(texts: list[str]) -> Iterator[tuple[int, int]]:
    start, size = 0, 0
    for k, t in enumerate(texts):
        size += len(t)
        if size >= BATCH_CHARS:
            yield start, k + 1
            start, size = k + 1, 0
    if start < len(texts):
        yield start, len(texts)


def min_hashes(tokens: np.ndarray, hashes: int = HASHES) -> list[np.ndarray]:
    """The tokens under each min-hash function."""
    return [tokens] + [_mix(tokens, 11 + k) for k in range(1, hashes)]


def compact_windows(tokens: np.ndarray, w: int) -> tuple[np.ndarray, np.ndarray]:
    """(first start, signature) of the compact windows of all subsequences of w tokens; a window ends where the next begins."""
    if len(tokens) < w:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    least = sliding_min(tokens, w)
    first = np.flatnonzero(np.concatenate([[True], least[1:] != least[:-1]]))
    return first, least[first]


def joined_windows(windows: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first start, joint signature, first signature) of the interval join of several partitions into windows."""
    starts = np.unique(np.concatenate([first for first, _ in windows]))
    joint = np.zeros(len(starts), dtype=np.uint64)
    own = None
    for first, sig in windows:
        here = sig[np.searchsorted(first, starts, side="right") - 1] if len(first) else np.empty(0, dtype=np.uint64)
        own = here if own is None else own
        joint = _mix(joint ^ here, 3)
    return starts, joint, own


def signatures(texts: list[str], span: int, gram: int, hashes: int = HASHES) -> tuple[np.ndarray, np.ndarray]:
    """(index of the text, joint signature) of all joined windows of texts."""
    which, found = [], []
    w = span - gram + 1
    for a, b in _batched(texts):
        # texts of a batch in one array; a window never counts beyond its text's last start
        codes = _codes("".join(texts[a:b]))
        tokens = window_hashes(codes, gram)
        if len(tokens) < w:
            continue
        starts, joint, _ = joined_windows([compact_windows(t, w) for t in min_hashes(tokens, hashes)])
        ends = np.cumsum([len(t) for t in texts[a:b]])
        begins = np.concatenate([[0], ends[:-1]])
        begins = begins[begins < len(tokens) - w + 1]
        # windows that run on into the next text begin anew there
        all_starts = np.union1d(starts, begins)
        sig = joint[np.searchsorted(starts, all_starts, side="right") - 1]
        owner = np.searchsorted(ends, all_starts, side="right")
        inside = all_starts + span <= ends[owner]
        which.append(owner[inside] + a)
        found.append(sig[inside])
    if not which:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    return np.concatenate(which), np.concatenate(found)


def _lcp(a: str, b: str) -> int:
    """The length of the longest common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    lo, hi = 0, n  # a[:lo] is common, a[:hi] isn't
    while hi - lo > 1:
        mid = (lo + hi) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid)
    return lo


def _shared_windows(text: str, shared: np.ndarray, span: int, gram: int, hashes: int) -> tuple[np.ndarray, Iterator[tuple[int, int, int, int]]]:
    """The text's tokens and (first start, last start, joint signature, least token) of its joined windows in ``shared``."""
    w = span - gram + 1
    tokens = window_hashes(_codes(text), gram)
    starts, joint, own = joined_windows([compact_windows(t, w) for t in min_hashes(tokens, hashes)])
    ends = np.append(starts[1:], len(tokens) - w + 1) - 1
    at = np.flatnonzero(np.isin(joint, shared))
    return tokens, zip(starts[at].tolist(), ends[at].tolist(), joint[at].view(np.int64).tolist(), own[at].tolist())


def occurrences(text: str, shared: np.ndarray, span: int, gram: int, hashes: int = HASHES) -> dict[tuple[int, str, str], list[int]]:
    """(signature, up to span - gram characters before it in reverse, up to span from it) -> places of the least tokens of the windows in ``shared``."""
    out: dict[tuple[int, str, str], list[int]] = {}
    reach, w = span - gram, span - gram + 1
    tokens, windows = _shared_windows(text, shared, span, gram, hashes)
    for a, b, sig, least in windows:
        for p in (np.flatnonzero(tokens[a : b + w] == np.uint64(least)) + a).tolist():
            places = out.setdefault((sig, text[max(0, p - reach) : p][::-1], text[p : p + span]), [])
            if p not in places[-1:]:
                places.append(p)
    return out


def stretches(text: str, shared: np.ndarray, span: int, gram: int, hashes: int = HASHES) -> dict[tuple[int, int, int], list[int]]:
    """(digest, digest, code before or -1) -> starts of the stretches of ``span`` characters in the windows in ``shared``."""
    codes = _codes(text)
    out: dict[tuple[int, int, int], list[int]] = {}
    for a, b, _, _ in _shared_windows(text, shared, span, gram, hashes)[1]:
        for p in range(a, b + 1):
            d = hashlib.blake2b(codes[p : p + span].tobytes(), digest_size=16).digest()
            key = (int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True), int(codes[p - 1]) if p else -1)
            out.setdefault(key, []).append(p)
    return out


class SharedSpans:
    """The stretches of at least ``span`` characters that texts of df share.

    Null texts and texts under ``span`` characters share nothing. Rows with equal texts are copies of one text, which the least
    of their ids stands for; a row id should be unique. Other columns are ignored.
    """

    def __init__(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "text", span: int = SPAN, gram: int = GRAM, few: int = FEW, hashes: int = HASHES):
        ship_package(df.sparkSession)
        self.span, self.gram, self.few, self.hashes = span, gram, few, hashes
        docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
        self.keyed = staged(docs.select("doc_id", F.length("text").alias("n"), F.when(F.length("text") >= span, F.unhex(F.md5("text"))).alias("h")))
        long_texts = self.keyed.filter("h IS NOT NULL")
        several = long_texts.groupBy("h").agg(F.min("doc_id").alias("uid"), F.count("*").alias("copies")).filter("copies > 1").select("h", "uid")
        self.copies = staged(long_texts.join(several, "h").select("doc_id", "uid"))
        self.docs = docs.filter(F.length("text") >= span).join(broadcast_if_small(self.copies.filter("doc_id <> uid").select("doc_id"), BROADCAST_COPIES), "doc_id", "left_anti")
        self.found = staged(self._found())

    def classes(self) -> DataFrame:
        """doc_id, uid: the text class of each document of at least ``span`` characters; copies have one class."""
        single = self.keyed.filter("h IS NOT NULL").join(self.copies.select("doc_id"), "doc_id", "left_anti").select("doc_id", F.col("doc_id").alias("uid"))
        return single.unionByName(self.copies)

    def _found(self) -> DataFrame:
        """uid, sig, left, right, h2, before, ats: occurrences of signatures, with left and right, and stretches, with h2 and before."""
        span, gram, few, hashes = self.span, self.gram, self.few, self.hashes

        def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                which, found = signatures(b.column(1).to_pylist(), span, gram, hashes)
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(which)), pa.array(found.view(np.int64))], ["uid", "sig"])

        def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                rows = []
                for uid, text, shared, hot in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                    sigs, hot = shared.values.to_numpy().view(np.uint64), hot.values.to_numpy(zero_copy_only=False).astype(bool)
                    if not hot.all():
                        rows += [(uid, sig, left, right, None, None, ats) for (sig, left, right), ats in occurrences(text, sigs[~hot], span, gram, hashes).items()]
                    if hot.any():
                        rows += [(uid, h1, None, None, h2, before, ats) for (h1, h2, before), ats in stretches(text, sigs[hot], span, gram, hashes).items()]
                columns = list(zip(*rows)) or [()] * 7
                types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int32(), pa.list_(pa.int32())]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["uid", "sig", "left", "right", "h2", "before", "ats"])

        signed = staged(self.docs.select(F.col("doc_id").alias("uid"), "text").mapInArrow(sign, "uid long, sig long"))
        common = signed.groupBy("sig").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"), F.count("*").alias("n")).filter("lo <> hi").select("sig", (F.col("n") > few).alias("hot"))
        common = broadcast_if_small(common, BROADCAST_SIGNATURES)
        per_text = signed.join(common, "sig").groupBy("uid").agg(F.collect_set(F.struct("sig", "hot")).alias("shared"))
        chosen = broadcast_if_small(per_text.select("uid", F.col("shared.sig").alias("sigs"), F.col("shared.hot").alias("hot")), BROADCAST_SIGNATURES, F.size("sigs"))
        work = self.docs.select(F.col("doc_id").alias("uid"), "text").join(chosen, "uid").select("uid", "text", "sigs", "hot")
        return work.mapInArrow(locate, "uid long, sig long, left string, right string, h2 long, before int, ats array<int>")

    def _verified(self) -> DataFrame:
        """a, b, at_a, at_b, back, length: pairs of occurrences whose common reach is at least ``span``."""
        span = self.span
        few = self.found.filter("left IS NOT NULL").select("uid", "sig", "left", "right", "ats")
        a, b = (few.select("sig", *(F.col(c).alias(f"{c}_{x}") for c in ("uid", "left", "right", "ats"))) for x in "ab")
        met = a.join(b, "sig").filter("uid_a < uid_b").select("uid_a", "uid_b", "left_a", "left_b", "right_a", "right_b", "ats_a", "ats_b")

        def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for t in batches:
                rows = []
                for ua, ub, la, lb, ra, rb, xa, xb in zip(*(c.to_pylist() for c in t.columns)):
                    back = _lcp(la, lb)
                    if back + (on := _lcp(ra, rb)) >= span:
                        rows.append((ua, ub, xa, xb, back, back + on))
                columns = list(zip(*rows)) or [()] * 6
                types = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["a", "b", "at_a", "at_b", "back", "length"])

        return met.mapInArrow(verify, "a long, b long, at_a array<int>, at_b array<int>, back int, length int")

    def text_pairs(self) -> DataFrame:
        """uid_a < uid_b of different texts that share a stretch."""
        many = self.found.filter("h2 IS NOT NULL").select("uid", F.col("sig").alias("h1"), "h2", "before")
        keys = many.groupBy("h1", "h2").agg(F.min("uid").alias("lo"), F.max("uid").alias("hi"), F.min("before").alias("b0"), F.max("before").alias("b1"))
        keys = keys.filter("lo <> hi AND (b0 <> b1 OR b0 = -1)").select("h1", "h2")
        maximal = many.join(keys, ["h1", "h2"], "left_semi")
        a, b = maximal.alias("a"), maximal.alias("b")
        same = (F.col("a.h1") == F.col("b.h1")) & (F.col("a.h2") == F.col("b.h2")) & (F.col("a.uid") < F.col("b.uid"))
        open_left = (F.col("a.before") != F.col("b.before")) | (F.col("a.before") == -1)
        hot = a.join(b, same & open_left).select(F.col("a.uid").alias("uid_a"), F.col("b.uid").alias("uid_b"))
        return self._verified().select(F.col("a").alias("uid_a"), F.col("b").alias("uid_b")).unionByName(hot).distinct()

    def pairs(self) -> DataFrame:
        """doc_id_a < doc_id_b of all different documents that share a stretch, copies included."""
        copies = self.copies
        side = lambda x, y: copies.select(F.col("uid").alias(f"uid_{x}"), F.col("doc_id").alias(y))
        met = self.text_pairs().join(side("a", "x"), "uid_a", "left").join(side("b", "y"), "uid_b", "left")
        across = met.select(F.coalesce("x", "uid_a").alias("x"), F.coalesce("y", "uid_b").alias("y"))
        within = copies.select(F.col("doc_id").alias("x"), "uid").join(copies.select(F.col("doc_id").alias("y"), "uid"), "uid").filter("x < y")
        return across.unionByName(within.select("x", "y")).select(F.least("x", "y").alias("doc_id_a"), F.greatest("x", "y").alias("doc_id_b"))

    def shared_chars(self) -> DataFrame:
        """doc_id, n_shared: how many characters of each document lie in a stretch that another document holds too. Classes are never paired with their copies."""
        span = self.span
        few = self._verified()
        sides = (few.select(F.col(x).alias("uid"), F.explode(f"at_{x}").alias("at"), "back", "length").select("uid", (F.col("at") - F.col("back")).alias("lo"), "length") for x in "ab")
        one, two = (s.select("uid", "lo", (F.col("lo") + F.col("length")).alias("hi")) for s in sides)
        many = self.found.filter("h2 IS NOT NULL").select("uid", F.col("sig").alias("h1"), "h2", "ats")
        keys = many.groupBy("h1", "h2").agg(F.min("uid").alias("u0"), F.max("uid").alias("u1")).filter("u0 <> u1").select("h1", "h2")
        three = many.join(keys, ["h1", "h2"], "left_semi").select("uid", F.explode("ats").alias("lo")).select("uid", "lo", (F.col("lo") + span).alias("hi"))
        spans = one.unionByName(two).unionByName(three).groupBy("uid", "lo").agg(F.max("hi").alias("hi")).groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans"))
        empty = F.struct(F.lit(0).alias("end"), F.lit(0).alias("sum"))
        add = lambda s, x: F.struct(F.greatest(s["end"], x["hi"]).alias("end"), (s["sum"] + F.greatest(F.lit(0), x["hi"] - F.greatest(s["end"], x["lo"]))).alias("sum"))
        covered = spans.select(F.col("uid").alias("doc_id"), F.aggregate("spans", empty, add)["sum"].alias("covered"))
        copied = self.copies.select("doc_id", F.lit(True).alias("copied"))
        joined = self.keyed.select("doc_id", "n").join(copied, "doc_id", "left").join(covered, "doc_id", "left")
        shared = F.when(F.col("copied"), F.col("n")).otherwise(F.coalesce("covered", F.lit(0)))
        return joined.select("doc_id", shared.cast("long").alias("n_shared"))
