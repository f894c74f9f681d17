"""The language of each document and of each of its segments, by multilingual mixture inference.

A sentence has a log-likelihood in every language, from character 4-gram counts. Expectation-maximisation over a document's
sentences gives the document's language proportions and the likelihood of their mixture; a language stays in the document's set only
if the mixture without it, fitted anew, is less likely by ``SET_PENALTY``. Segments are the best path through the sentences over the
languages of the set, where every segment has at least two sentences, its language is drawn from the document's proportions
and a change of language costs ``PENALTY``. Confidence is the posterior of the segment's language over its sentences, with the
proportions as the prior.

The n-gram model is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, the rows with the least hashes of their
ids, of at most ``SAMPLE_CHARS`` characters each): sentences are first counted under the row's label, then as the model places them within their documents, in turn.
Labels in the sample may be wrong as long as most are right; function words of all languages are always counted.

Scale: the fit is bounded; the model is a fixed table of a few MB, broadcast; the inference is a narrow Arrow stage over
whole texts, vectorised over all sentences of a batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.llm.mainbody import FURNITURE_RE, INNER_END
from fjordmill.llm.residue import with_residue_flag
from fjordmill.session import ship_package

LANGUAGES = ["da", "en", "de", "sv", "no", "fr"]
SAMPLE_ROWS, SAMPLE_CHARS = 6000, 10_000
BUCKETS = 1 << 18
PENALTY, MOST = 8.5, 10.0  # what a change of language costs; the most that one sentence can say for or against a language
SET_PENALTY = 4.0  # what a language costs a document
EM_ROUNDS = 6
LABEL_WORTH = 2.0
WORDS_WEIGHT = 20.0  # occurrences that each function word counts for; matters in small samples only
TEMPER = 0.25  # neighbouring 4-grams share three characters

# Codes and names of the languages, lower-case.
LABELS = {
    "da": "da dan danish dansk dänisch danska danois", "en": "en eng english engelsk engelska englisch anglais", "de": "de deu ger german deutsch tysk tyska allemand",
    "sv": "sv swe swedish svenska svensk schwedisch suédois", "no": "no nor nb nob nn nno norwegian norsk bokmål bokmal nynorsk norska norwegisch norvégien", "fr": "fr fra fre french français francais fransk franska französisch",
}
LABEL_OF = {name: lang for lang, names in LABELS.items() for name in names.split()}

# Frequent function words.
FUNCTION_WORDS = {
    "da": "og jeg det at en til er som på de med af for ikke der var har om blev hun fra ud op hvor hvad her vil når efter også uden ifølge derfor mens hverken mere siger",
    "no": "og jeg det at en til er som på de med av for ikke der var har om ble hun fra ut opp hvor hva her vil når etter også uten ifølge derfor mens verken mer sier",
    "sv": "och jag det att en till är som på de med av för inte där var har om blev hon från ut upp hur vad här vill när efter också utan enligt därför medan varken mer säger",
    "en": "and the that to a is as on they with of for not there was has about from out up where what here will when after also without according therefore while neither more says",
    "de": "und ich das dass ein zu ist wie auf die mit von für nicht da war hat um wurde sie aus auf wo was hier will wenn nach auch ohne laut deshalb während weder mehr sagt",
    "fr": "et je le que un à est comme sur ils avec de pour ne pas il était a elle du dans où quoi ici va quand après aussi sans selon donc pendant ni plus dit les des une",
}
SENTENCE_END = re.compile(r"[.!?…]+[»”“\"’)\]]*\s+")
ENDED = re.compile(r"[.!?…][»”“\"’)\]\W]*$")
WORDS = re.compile(r"[^\W\d_]+")


def label_language(label: str | None) -> str | None:
    """The language that a label names, by any spelling or region of its code or name; None if it names none."""
    return LABEL_OF.get(re.split(r"[-_\s(]", (label or "").strip().lower())[0])


def sentences(text: str) -> list[str]:
    """The sentences of a text's paragraphs; of all its lines with words if no line ends as a sentence does."""
    lines = [x for x in (y.strip() for y in text.split("\n")) if x]
    paragraphs = [x for x in lines if x.count(" ") >= 2 and (ENDED.search(x) or (INNER_END.search(x) and not FURNITURE_RE.match(x)))]
    out = [s for x in paragraphs for s in SENTENCE_END.split(x) if s.count(" ") >= 3]
    return out or [x for x in lines if x.count(" ") >= 3] or [x for x in lines if WORDS.search(x)]


def gram_ids(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of each 4-gram of the lower-case texts, start of each text); 4-grams over an edge are bucket 0."""
    padded = [f"\n {t.lower()} \n" for t in texts]
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    starts = np.concatenate([[0], np.cumsum([len(p) for p in padded])[:-1]])
    codes = np.concatenate([codes, np.full(3, 10, dtype=np.uint32)])
    with np.errstate(over="ignore"):
        h = codes[:-3] * np.uint32(0x9E3779B1)
        h = (h ^ (h >> np.uint32(15))) + codes[1:-2] * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) + codes[2:-1] * np.uint32(0xC2B2AE35)
        h = (h ^ (h >> np.uint32(16))) + codes[3:] * np.uint32(0x27D4EB2F)
        h ^= h >> np.uint32(14)
    ids = (h % np.uint32(BUCKETS - 1) + np.uint32(1)).astype(np.int32)
    edge = codes == 10
    ids[edge[:-3] | edge[1:-2] | edge[2:-1] | edge[3:]] = 0
    return ids, starts


def sentence_scores(model: np.ndarray, texts: list[str]) -> np.ndarray:
    """Tempered log-likelihood of each text in each language."""
    if not texts:
        return np.zeros((0, len(LANGUAGES)), dtype=np.float32)
    ids, starts = gram_ids(texts)
    out = np.empty((len(texts), len(LANGUAGES)), dtype=np.float32)
    for k in range(len(LANGUAGES)):
        out[:, k] = np.add.reduceat(model[k][ids], starts)
    return out * np.float32(TEMPER)


def count_model(texts: list[str], weights: np.ndarray) -> np.ndarray:
    """Log-probabilities of the 4-grams in each language from weighted texts; function words are always counted."""
    words = [" ".join(FUNCTION_WORDS[x].split()) for x in LANGUAGES]
    ids, starts = gram_ids(texts + words)
    sizes = np.diff(np.append(starts, len(ids)))
    rows = []
    for k in range(len(LANGUAGES)):
        w = np.concatenate([weights[:, k], WORDS_WEIGHT * np.eye(len(LANGUAGES))[k]])
        counts = np.bincount(ids, weights=np.repeat(w, sizes), minlength=BUCKETS)
        counts[0] = 0
        row = np.log((counts + 0.05) / (counts.sum() + 0.05 * BUCKETS))
        row[0] = 0
        rows.append(row.astype(np.float32))
    return np.stack(rows)


def fit(rows: list[tuple[str | None, str]], rounds: int = 3) -> np.ndarray:
    """The model from (label, content) rows: first all sentences as labelled, then as the model places them within their documents."""
    texts, owner, given = [], [], []
    for k, (label, content) in enumerate(rows):
        lang = label_language(label)
        for s in sentences(content):
            texts.append(s)
            owner.append(k)
            given.append(LANGUAGES.index(lang) if lang else -1)
    if not texts:
        return count_model([], np.zeros((0, len(LANGUAGES))))
    owners, labels = np.array(owner), np.array(given)
    weights = np.eye(len(LANGUAGES))[labels] * (labels >= 0)[:, None]
    for _ in range(rounds):
        scores = sentence_scores(count_model(texts, weights), texts)
        weights = np.exp(scores - scores.max(axis=1, keepdims=True)) * proportions(scores, owners, len(rows))[owners]
        weights /= weights.sum(axis=1, keepdims=True)
    return count_model(texts, weights)


def proportions(scores: np.ndarray, owner: np.ndarray, n_docs: int, rounds: int = 4) -> np.ndarray:
    """Language proportions of each document by expectation-maximisation."""
    k = scores.shape[1]
    mix = np.full((n_docs, k), 1 / k)
    base = np.exp(scores - scores.max(axis=1, keepdims=True)).astype(np.float64)
    sizes = np.maximum(np.bincount(owner, minlength=n_docs), 1)[:, None]
    for _ in range(rounds):
        resp = base * mix[owner]
        resp /= resp.sum(axis=1, keepdims=True)
        mix = np.stack([np.bincount(owner, weights=resp[:, j], minlength=n_docs) for j in range(k)], axis=1) / sizes
        mix = np.maximum(mix, 1e-6)
    return mix


def mixture(scores: np.ndarray, chosen: list[int], rounds: int = EM_ROUNDS) -> tuple[np.ndarray, float]:
    """(proportions, log-likelihood) of one document as a mixture of the chosen languages, by expectation-maximisation."""
    own = scores[:, chosen].astype(np.float64)
    top = own.max(axis=1, keepdims=True)
    base = np.exp(own - top)
    mix = np.full(len(chosen), 1 / len(chosen))
    for _ in range(rounds if len(chosen) > 1 else 0):
        each = base * mix
        mix = np.maximum((each / each.sum(axis=1, keepdims=True)).mean(axis=0), 1e-9)
    return mix, float(np.log(base @ mix).sum() + top.sum())


def language_set(scores: np.ndarray, mix: np.ndarray, penalty: float = SET_PENALTY) -> tuple[list[int], np.ndarray]:
    """The languages of one document and their proportions: the least needed ones leave while the mixture without them is
    less likely by under ``penalty``. mix has the proportions over all languages; those that make up half a sentence enter."""
    chosen = [int(j) for j in np.argsort(-mix) if mix[j] > 0.5 / (len(scores) + 1)] or [int(mix.argmax())]
    shares, likely = mixture(scores, chosen)
    while len(chosen) > 1:
        without = [(mixture(scores, [x for x in chosen if x != j]), j) for j in chosen]
        (fewer, less), gone = max(without, key=lambda x: x[0][1])
        if likely - less >= penalty:
            break
        chosen.remove(gone)
        shares, likely = fewer, less
    return chosen, shares


def segments(scores: np.ndarray, chosen: list[int], penalty: float = PENALTY, least: int = 2, shares: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(first sentence, end, language) of the best path; all segments have ``least`` sentences unless there are fewer in all.

    shares are the proportions of the chosen languages: a segment's language is drawn from them.
    """
    n = len(scores)
    prior = dict(zip(chosen, np.log(shares) if shares is not None else np.zeros(len(chosen))))
    if len(chosen) == 1 or n < 2 * least:
        part = scores.sum(axis=0)
        return [(0, n, max(chosen, key=lambda j: part[j] + prior[j]))]
    total = np.concatenate([np.zeros((1, scores.shape[1])), np.cumsum(scores, axis=0, dtype=np.float64)])
    # best[e]: the best path that ends a segment before sentence e; open[j]: the best start of a segment in language j so far
    best = [0.0] + [-np.inf] * n
    back: list[tuple[int, int, int]] = [(0, -1, -1)] * (n + 1)
    last_lang = [-1] * (n + 1)
    open_at = {j: (-np.inf, 0) for j in chosen}
    for e in range(1, n + 1):
        s = e - least
        if s >= 0 and best[s] > -np.inf:
            for j in chosen:
                if last_lang[s] != j:
                    value = best[s] - total[s, j] - (penalty if s else 0) + prior[j]
                    if value > open_at[j][0]:
                        open_at[j] = (value, s)
        for j in chosen:
            value = open_at[j][0] + total[e, j]
            if value > best[e]:
                best[e], last_lang[e], back[e] = value, j, (open_at[j][1], e, j)
    out = []
    e = n
    while e > 0:
        out.append(back[e])
        e = back[e][0]
    merged: list[tuple[int, int, int]] = []
    for s, e, j in reversed(out):
        if merged and merged[-1][2] == j:
            merged[-1] = (merged[-1][0], e, j)
        else:
            merged.append((s, e, j))
    return merged


def infer(model: np.ndarray, texts: list[str], labels: list[str | None] | None = None) -> list[list[tuple[str, float, int]]]:
    """For each text its segments: language, confidence and number of sentences. Texts without words have none.

    A text in one language that two languages explain almost alike goes to the one that its label names.
    """
    parts = [sentences(t) if WORDS.search(t) else [] for t in texts]
    owner = np.repeat(np.arange(len(texts)), [len(p) for p in parts])
    flat = [s for p in parts for s in p]
    scores = sentence_scores(model, flat)
    ends = np.cumsum([len(p) for p in parts]).tolist()
    tops = scores.argmax(axis=1) if len(flat) else np.zeros(0, dtype=int)
    mix = proportions(scores, owner, len(texts)) if len(flat) else np.zeros((len(texts), len(LANGUAGES)))
    out: list[list[tuple[str, float, int]]] = []
    for k, p in enumerate(parts):
        if not p:
            out.append([])
            continue
        at = ends[k] - len(p)
        own, top = scores[at : ends[k]], tops[at : ends[k]]
        if (top == top[0]).all():  # the likeliest mixture is that language alone
            found = [(0, len(p), int(top[0]))]
        else:
            # one foreign sentence must not outweigh its neighbours, so that it can't make a segment with one of them
            bounded = np.maximum(own - own.max(axis=1, keepdims=True), -MOST)
            chosen, shares = language_set(bounded, mix[k])
            found = segments(bounded, chosen, shares=shares)
        if len(found) == 1 and labels and (named := label_language(labels[k])):
            part = own.sum(axis=0, dtype=np.float64)
            if part.max() - part[LANGUAGES.index(named)] < LABEL_WORTH:
                found = [(0, len(p), LANGUAGES.index(named))]
        rows = []
        for s, e, j in found:
            part = own[s:e].sum(axis=0, dtype=np.float64) + np.log(mix[k])
            rows.append((LANGUAGES[j], float(1 / np.exp(np.minimum(part - part[j], 50)).sum()), e - s))
        out.append(rows)
    return out


def fit_on(df: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS) -> np.ndarray:
    """The model from at most ``rows`` labelled rows of df of at most ``chars`` characters: those with the least hashes of row_id."""
    fits = "language IS NOT NULL AND content IS NOT NULL AND length(language) > 1 AND length(content) > 40"
    place = F.shiftrightunsigned(F.xxhash64("row_id"), 1)  # 63 bits
    labelled = df.filter(fits).filter(F.length("content") <= chars).select("language", "content", place.alias("h"))
    share = min(1.0, 1.5 * rows / max(1, labelled.select("h").count()))
    sample = labelled.filter(F.col("h") <= min(2**63 - 1, int(share * 2**63))).orderBy("h").limit(rows)
    return fit([(r["language"], r["content"]) for r in sample.collect()])


def language_segments(df: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """row_id, seg_no, lang, confidence, n_sentences, n_segments, label: the segments of every content with words.

    df has row_id, language and content, and what with_residue_flag needs; contents of residue are left out, as are null and
    empty ones. label is the language that the row's label names, or null. Repeated rows are inferred each.
    """
    ship_package(df.sparkSession)
    model = df.sparkSession.sparkContext.broadcast(fit_on(df, sample_rows))
    rows = with_residue_flag(df.select("row_id", "language", "content", "title", "original_url", "resolved_url").filter("content IS NOT NULL")).filter("NOT bad_content").select("row_id", "language", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for lo in range(0, b.num_rows, 1000):
                part = b.slice(lo, 1000)
                ids, labels, texts = (c.to_pylist() for c in part.columns)
                for row_id, label, found in zip(ids, labels, infer(model.value, texts, labels)):
                    out += [(row_id, n, lang, sure, size, len(found), label_language(label)) for n, (lang, sure, size) in enumerate(found, 1)]
            columns = list(zip(*out)) or [()] * 7
            types = [pa.int64(), pa.int32(), pa.string(), pa.float64(), pa.int32(), pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["row_id", "seg_no", "lang", "confidence", "n_sentences", "n_segments", "label"])

    return rows.mapInArrow(run, "row_id long, seg_no int, lang string, confidence double, n_sentences int, n_segments int, label string")


def document_languages(df: DataFrame) -> DataFrame:
    """row_id, lang, confidence, languages, n_segments: the language of most sentences of each content, the first on ties, and all its languages."""
    s = language_segments(df)
    weight = F.sum(F.col("confidence") * F.col("n_sentences")) / F.sum("n_sentences")
    by_lang = s.groupBy("row_id", "lang").agg(F.sum("n_sentences").alias("n"), weight.alias("confidence"), F.min("seg_no").alias("first"), F.count("*").alias("segments"))
    best = F.struct(F.col("n"), -F.col("first"))
    return by_lang.groupBy("row_id").agg(
        F.max_by("lang", best).alias("lang"), F.max_by("confidence", best).alias("confidence"), F.sort_array(F.collect_set("lang")).alias("languages"), F.sum("segments").alias("n_segments")
    )


def mislabelled_segments(df: DataFrame) -> DataFrame:
    """row_id, seg_no, lang of the contents in several languages and of those whose label is missing, empty of meaning or wrong."""
    s = language_segments(df)
    return s.filter((F.col("n_segments") > 1) | F.col("label").isNull() | (F.col("label") != F.col("lang"))).select("row_id", "seg_no", "lang")
