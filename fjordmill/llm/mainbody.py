"""The main body of each page, by wrapper induction over same-host pages.

A page is a tree: its lines are the root's children, and a line's children are its items (the entries of a menu line) or its
label (what stands before a colon). Numbers and the site's name are masked in node labels. Three steps:

1. Constants. A node that recurs on several pages of a host is a constant of the host's template; a node that recurs on
   several hosts is one of the shared template, which stands in where a host has too few pages. Copies of an address
   count once. A constant's role comes from where its host's pages have it: what nearly
   always introduces a sentence, seldom stands before the first one and hardly ever after the last is a heading of the main slot; what introduces two
   open lines in a row opens a slot of teasers; the rest is furniture.
2. Alignment. The template tree is head, main slot, tail, in this order; each constant has a place in them as often as the
   host's pages have it there. A page is matched to it by order-preserving tree matching: the bounds of the main slot are
   those under which the weights of all nodes add up to most (``align``); a constant out of the template's order matches
   nothing and is content.
3. Decision. Matched constants are furniture or headings; slots are content, but for slots of teasers.

Hosts of at least ``TEMPLATE_PAGES`` pages are decided by their templates and the shapes of lines alone. Only on hosts with fewer do the
wordings of ``pagetext`` name what the shared template doesn't know. Sentences are constants only on at least ``SENTENCE_PAGES`` pages and
``SENTENCE_SHARE`` of a host's.

Scale: nodes are counted by hash with partial sums; a host's template has at most nodes-per-page / CONSTANT_SHARE own constants. It
is joined to the pages on the host: broadcast after a check of the number of nodes, else by a shuffle join that adaptive execution splits
on hot hosts. The walk over a page's lines is an Arrow stage of single rows.

Null and empty contents have no lines. Pages without a host have no template; the wordings hold for them. Equal rows get equal results.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fjordmill.llm.pagetext import FUNCTION_WORDS, FURNITURE, MENU, NOTICES, SEPARATED_MENU, SUBHEADS, joined
from fjordmill.llm.residue import host, with_residue_flag
from fjordmill.session import broadcast_if_small, ship_package, staged

TEMPLATE_PAGES = 20
CONSTANT_PAGES, CONSTANT_SHARE, SHARED_HOSTS = 3, 0.01, 3
HEADING_SHARE, HEADING_HEAD, HEADING_TAIL, OPENER_SHARE = 0.87, 0.6, 0.06, 0.5
SENTENCE_PAGES, SENTENCE_SHARE = 5, 0.05
BROADCAST_NODES, BROADCAST_COPIES = 1_000_000, 1_000_000

PARAGRAPH, FURNISHED, TEASERS, SUBHEAD, MARK, BULLET, SENTENCE, SHORT = range(8)
ENDS = re.compile(r"[.!?…:;][»”“\"')\]]*\W*$|[»”“]\W*$")
INNER_END = re.compile(r"[^\d\s][.!?][»”“\"')]* +[»”“\"'(–]?[A-ZÆØÅÄÖÜÉÀ0-9]")
WORD = re.compile(r"[^\W\d_]+")
LETTERS = re.compile(r"[^\W\d_]")
MARKS = re.compile(
    r"(?:(?i:(?:af|av|by|von|par|de|text|tekst|texte|foto|photo|bild|billede|bilde)\b|/|–|—)\s*:?\s*(?:[A-ZÆØÅÄÖÜÉ][\w.’'-]*\s*){1,4}(?:, .{0,40}|/ .{0,40})?"  # bylines, credits and signatures
    r"|[A-ZÆØÅÄÖÜÉ][\w-]+,? (?:den )?\d{1,2}\. ?(?:\d{1,2}\.|[a-zæøåéû]+) ?\d{4}"  # place and day
    r"|https?://\S+|www\.\S+"
    r"|[\d\s|;,.%:/–-]+)"
)
LABELLED = re.compile(r"[^\W\d_]+(?: [^\W\d_]+){0,2} ?: +\S")
LABEL = re.compile(r"([^\W\d_]+(?:[ -][^\W\d_]+){0,4}) ?: +\S")
DIGITS = re.compile("[0-9]+")
BULLETS = re.compile(r"(?:[•*·‣▪]|\d{1,2}[.)]|[a-z]\))\s+\S")
DASHED = re.compile(r"[-–—]\s+\S")
CLOCKED = re.compile(r"(?:kl\. ?)?\d{1,2}[:.]\d{2}\s+\S")
FURNITURE_RE = re.compile(rf"\W*(?:{joined(FURNITURE)})", re.I)
LONG_FURNITURE = re.compile(r"\W*(?:©|få |get |recevez )", re.I)  # furniture even as a sentence
MENU_RE = re.compile(rf"\W*{SEPARATED_MENU}\W*", re.I)
ITEM_BREAK = re.compile(r"\s+[»›>]\s+|\s*[/|·•]\s*|\s{2,}")
PAGE_NUMBERS = re.compile(r"[«‹<]?(?:[ |·]*\d+)*[ |·]*(?:[»›>]|\.\.\.)|[«‹].*|\d+ ?/ ?\d+|[★☆▲▼►◄■●]+")
MANY_ITEMS = re.compile(r"[^/|·»›]{1,25}(?:\s*[/|·»›]\s*[^/|·»›]{1,25}){2,}")
NOTICE_RE = re.compile(joined(NOTICES), re.I)
TEASER_RE = re.compile(
    r"(?:seneste nyt|siste nytt|senaste nytt|latest|neueste meldungen|dernières nouvelles|derniers articles|redaktionen anbefaler|redaksjonen anbefaler|redaktionen (?:tipsar|rekommenderar)|picked by our editors|empfehlungen der redaktion|(?:le|les) choix de la rédaction"
    r"|(?:andre|andra|others?|andere|d.autres)\b.{0,14}\b(?:læser|leser|läser|read|lesen|lisent)\b|à lire (?:aussi|également)|(?:mest|most|gerade viel|les plus)\b.{0,6}\b(?:læste|lest|lästa?|läst|read|gelesen|lus)\b|relater|related|læs mere$|mer om|more on|mehr zum)",
    re.I,
)
SUBHEAD_SET = set(SUBHEADS)


def _stems(patterns: list[str]) -> set[str]:
    """The first four letters of the words in patterns; a line without any of them, other than function words, can't match."""
    common = {w for words in FUNCTION_WORDS for w in words.split()}
    return {w[:4] for p in patterns for w in WORD.findall(re.sub(r"\\[a-zA-Z]", " ", p).lower()) if w not in common}


HINTS = _stems([*FURNITURE, *NOTICES, TEASER_RE.pattern, *MENU])
TERMINAL = ".!?»”"
SPECIAL = "©«‹★☆▲▼►◄■●<>{(["


def kind_of(line: str) -> int:
    """The kind of a stripped, non-blank line by itself."""
    blanks = line.count(" ")
    if line[-1] in TERMINAL and blanks >= 14 and not LONG_FURNITURE.match(line):
        return PARAGRAPH
    low = line.lower()
    if low.rstrip(" :.") in SUBHEAD_SET:
        return SUBHEAD
    stems = {w[:4] for w in low.replace("·", " ").replace("|", " ").replace("/", " ").replace(",", " ").replace(":", " ").replace(".", " ").replace("’", " ").split()}
    if line[0].isalpha() and HINTS.isdisjoint(stems) and blanks >= 4 and ":" not in line and "»" not in line and "·" not in line and "|" not in line and "/" not in line and "  " not in line:
        if not line[-1].isalnum() and ENDS.search(line) or INNER_END.search(line):
            return PARAGRAPH
        if MARKS.fullmatch(line):
            return MARK
        return SENTENCE
    low = low.rstrip(" :.")
    words = WORD.findall(line)
    ended = bool(ENDS.search(line))
    if TEASER_RE.match(line) and len(words) <= 8 and not ended:
        return FURNISHED if ":" in line[:-1] else TEASERS
    if FURNITURE_RE.match(line) and not (ended and len(words) >= 8 and not LONG_FURNITURE.match(line)):
        return FURNISHED
    if not LETTERS.search(line):
        return MARK if MARKS.fullmatch(line) else (FURNISHED if len(line) < 12 else MARK)
    if NOTICE_RE.search(line) and len(words) <= 14:
        return FURNISHED
    if MENU_RE.fullmatch(line):
        return FURNISHED
    if MARKS.fullmatch(line) and not ended:
        return MARK
    if CLOCKED.match(line) or (LABELLED.match(line) and len(words) >= 5 and not ended):
        return FURNISHED
    if (ended and len(words) >= 3) or INNER_END.search(line):
        return PARAGRAPH
    if MANY_ITEMS.fullmatch(line) and len(words) <= 24:
        return FURNISHED
    if BULLETS.match(line) or DASHED.match(line):
        return BULLET
    return SENTENCE if len(words) >= 4 else SHORT


def shape_of(line: str) -> int:
    """The kind of a stripped, non-blank line by its shape, whatever its words."""
    if line[-1] in TERMINAL and line.count(" ") >= 14:
        return PARAGRAPH
    if not LETTERS.search(line):
        return FURNISHED if PAGE_NUMBERS.fullmatch(line) else MARK if MARKS.fullmatch(line) or len(line) >= 12 else FURNISHED
    ended = not line[-1].isalnum() and bool(ENDS.search(line))
    words = len(WORD.findall(line))
    if not ended and MARKS.fullmatch(line):
        return MARK
    if CLOCKED.match(line):
        return FURNISHED
    if not ended and MANY_ITEMS.fullmatch(line) and words <= 24:
        return FURNISHED
    if (ended and words >= 3) or INNER_END.search(line):
        return PARAGRAPH
    if BULLETS.match(line) or DASHED.match(line):
        return BULLET
    return SENTENCE if words >= 4 else SHORT


def is_sentence(line: str) -> bool:
    """Whether a stripped line ends as sentences do; the anchor of the main slot while nothing is known of the template."""
    last = line[-1]
    if last in ":;" or last.isalnum() or line.count(" ") < 2:
        return False
    return last in ".!?…»”“" or bool(ENDS.search(line))


class Nodes:
    """The node labels of lines, as 64-bit hashes."""

    def __init__(self, site: str | None = None):
        name = (site or "").split(".")[0]
        self.name = name if len(name) >= 3 else None

    def folded(self, line: str) -> str:
        t = DIGITS.sub("0", line.lower())
        return (t.replace(self.name, "@") if self.name else t).strip(" :\u00a0\r\t")

    @staticmethod
    def hashed(label: str) -> int:
        h = xxhash.xxh64_intdigest(label.encode("utf8", "surrogatepass"))
        return h - (1 << 64) if h >> 63 else h

    def line(self, line: str) -> int:
        return self.hashed(self.folded(line))

    def label(self, line: str) -> int | None:
        """The node of what stands before a colon, for lines that don't end as sentences do."""
        m = LABEL.match(line)
        return self.hashed(self.folded(m[1]) + ":") if m and not ENDS.search(line) else None

    def items(self, line: str) -> list[int]:
        """The nodes of a menu line's entries; none for other lines."""
        if len(line) > 240 or is_sentence(line):
            return []
        parts = [x for x in ITEM_BREAK.split(line) if x and len(x) <= 25]
        return [self.line(x) for x in parts] if len(parts) >= 2 else []


NODE_SCHEMA = "site string, node long, ended boolean, n int, before int, head int, tail int, open int"


def page_nodes(df: DataFrame) -> DataFrame:
    """site, node, ended and, for each node of a page, how often it occurs, introduces a sentence, stands before the
    first sentence, after the last one, and introduces two open lines. page is the hash of the first long sentence, of the whole text if there is none."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for site, content in zip(*(c.to_pylist() for c in b.columns)):
                lines = [x for x in (y.strip() for y in content.split("\n")) if x]
                if not lines:
                    continue
                nodes = Nodes(site)
                sentence = [is_sentence(x) for x in lines]
                body = [k for k, x in enumerate(sentence) if x]
                first, last = (body[0], body[-1]) if body else (len(lines), len(lines))
                found: dict[tuple[int, bool], list[int]] = {}
                opens = [not x and y.count(" ") >= 3 and not MARKS.fullmatch(y) for x, y in zip(sentence, lines)] + [False, False]
                for k, x in enumerate(lines):
                    before = k + 1 < len(lines) and sentence[k + 1]
                    opener = opens[k + 1] and opens[k + 2]
                    if sentence[k]:
                        found.setdefault((nodes.line(x), True), [0, 0, 0, 0, 0])[0] += 1
                        continue
                    label = nodes.label(x) if ":" in x else None
                    keys = [(nodes.line(x), before, opener), *([(label, before, False)] if label is not None else []), *((y, False, False) for y in nodes.items(x))]
                    for key, *context in keys:
                        at = found.setdefault((key, False), [0, 0, 0, 0, 0])
                        at[0] += 1
                        at[1] += context[0]
                        at[2] += k < first
                        at[3] += k > last
                        at[4] += context[1]
                rows += [(site, key, ended, *v) for (key, ended), v in found.items()]
            columns = list(zip(*rows)) or [()] * 8
            types = [pa.string(), pa.int64(), pa.bool_(), *[pa.int32()] * 5]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["site", "node", "ended", "n", "before", "head", "tail", "open"])

    return df.select("site", "content").mapInArrow(walk, NODE_SCHEMA)


def templates(df: DataFrame) -> DataFrame:
    """site, pages, nodes, codes: for each host its number of pages and its nodes, with what ``Template`` reads from their codes."""
    sums = [F.sum(c).alias(c) for c in ("n", "before", "head", "tail", "open")]
    rows = df.filter("site IS NOT NULL AND content IS NOT NULL")
    first = rows.groupBy("site", "page").agg(F.min("row_id").alias("_first"), F.count("*").alias("_n"))
    copies = rows.select("site", "page", "row_id").join(first.filter("_n > 1"), ["site", "page"]).filter("row_id <> _first").select("row_id")
    single = rows.join(broadcast_if_small(copies, BROADCAST_COPIES), "row_id", "left_anti")
    counted = staged(page_nodes(single).groupBy("site", "node", "ended").agg(F.count("*").alias("pages"), *sums))
    totals = first.groupBy("site").agg(F.count("*").alias("site_pages"))
    shared = counted.filter("NOT ended").groupBy("node").agg(F.count("*").alias("hosts"), *sums).filter(F.col("hosts") >= SHARED_HOSTS)
    shared = broadcast_if_small(shared.select(F.col("node").alias("_node"), *(F.col(c).alias(f"s_{c}") for c in ("n", "before", "head", "tail", "open"))), BROADCAST_NODES)
    own = counted.join(totals, "site").join(shared, ~F.col("ended") & (F.col("node") == F.col("_node")), "left")
    often = (F.col("pages") >= SENTENCE_PAGES) & (F.col("pages") >= F.col("site_pages") * SENTENCE_SHARE)
    constant = (F.col("pages") >= CONSTANT_PAGES) & (F.col("pages") >= F.col("site_pages") * CONSTANT_SHARE)
    kept = own.filter(F.when(F.col("ended"), often).otherwise(constant | F.col("_node").isNotNull()))
    stat = lambda c: F.coalesce(F.col(f"s_{c}"), F.col(c)).cast("double")
    n = stat("n")
    heading = ~F.col("ended") & ((stat("before") + 1) / (n + 1.5) >= HEADING_SHARE) & (stat("head") <= HEADING_HEAD * n) & (stat("tail") <= HEADING_TAIL * n + 1)
    opener = ~F.col("ended") & (stat("open") >= OPENER_SHARE * n)
    role = F.when(heading, SUBHEAD).when(opener, TEASERS).otherwise(FURNISHED)
    percent = lambda c: F.round(100 * stat(c) / n).cast("int")
    # one long and one int a node, as every row of a host carries them: role, whether it is a sentence, percent in the head and in the tail
    code = ((role * 2 + F.col("ended").cast("int")) * 128 + percent("head")) * 128 + percent("tail")
    packed = kept.groupBy("site").agg(F.first("site_pages").alias("pages"), F.collect_list(F.struct("node", code.alias("code"))).alias("t"))
    return packed.select("site", "pages", F.col("t.node").alias("nodes"), F.col("t.code").alias("codes"))


class Template:
    """A host's template: the role of each node and its weights in the head, the main slot and the tail."""

    def __init__(self, pages: int = 0, nodes: list[int] = (), codes: list[int] = ()):
        self.enough = pages >= TEMPLATE_PAGES
        self.roles: dict[int, int] = {}
        self.weights: dict[int, tuple[float, float, float]] = {}
        self.sentences = False
        for node, code in zip(nodes, codes):
            head, tail = (code >> 7 & 127) / 100, (code & 127) / 100
            self.sentences = self.sentences or bool(code >> 14 & 1)
            self.roles[node] = code >> 15
            self.weights[node] = tuple(math.log(0.05 + 0.95 * max(p, 0.0)) for p in (head, 1 - head - tail, tail))


def align(weights: list[tuple[float, float, float]]) -> tuple[int, int]:
    """(start, end) of the main slot: nodes before it match the head of the template, those from its end on the tail, in
    order, so that the weights add up to most. Ties make the main slot as long as can be."""
    head = main = 0.0
    best, start = 0.0, 0  # the best head so far, less the main slot's sum up to there
    whole, bounds = float("-inf"), (0, len(weights))
    tails = sum(w[2] for w in weights)
    for k in range(len(weights) + 1):
        value = best + main + tails
        if value >= whole - 1e-9:
            whole, bounds = max(value, whole), (start, k)
        if k < len(weights):
            head += weights[k][0]
            main += weights[k][1]
            tails -= weights[k][2]
            if head - main > best + 1e-9:
                best, start = head - main, k + 1
    return bounds


SLOT = {PARAGRAPH: (-4.0, 0.0, -4.0), SUBHEAD: (-1.0, 0.0, -2.0)}
NEUTRAL_NODE = (0.0, 0.0, 0.0)


class Pages:
    """Classifies pages line by line; lines seen before are remembered."""

    def __init__(self, remember: int = 200_000):
        self.worded: dict[str, int] = {}
        self.shaped: dict[str, int] = {}
        self.remember = remember

    def _kind(self, line: str, by_shape: bool) -> int:
        if line[-1] in TERMINAL and line.count(" ") >= 14 and (by_shape or not LONG_FURNITURE.match(line)):
            return PARAGRAPH
        known = self.shaped if by_shape else self.worded
        k = known.get(line)
        if k is None:
            if len(known) >= self.remember:
                known.clear()
            k = known[line] = shape_of(line) if by_shape else kind_of(line)
        return k

    def main(self, lines: list[str], template: Template | None = None, site: str | None = None, title: str | None = None) -> list[bool | None]:
        """For each line whether it is main body; None for blank lines."""
        template = template or Template()
        nodes, roles, weights = Nodes(site), template.roles, template.weights
        title = (title or "").lower()
        bare = [x.strip() for x in lines]
        at = [k for k, x in enumerate(bare) if x]
        kinds: list[int] = []
        constant: set[int] = set()  # the bullets that are; a list's entries recur as the names in them do, so only those before the text count
        places: list[tuple[float, float, float]] = []
        for k in at:
            line = bare[k]
            kind = self._kind(line, template.enough)
            place = SLOT.get(kind, NEUTRAL_NODE)
            if roles and kind != MARK and not (len(line) > 15 and line.lower() in title):
                # most paragraphs can be told from template sentences without a hash
                node = nodes.line(line) if kind != PARAGRAPH or template.sentences or not is_sentence(line) else None
                role = roles.get(node)
                if role is None and kind != PARAGRAPH:
                    label = nodes.label(line) if ":" in line else None
                    role, node = (roles.get(label), label) if label is not None else (None, node)
                    if role is None:
                        items = nodes.items(line)
                        if items and 2 * sum(x in roles and roles[x] != SUBHEAD for x in items) >= len(items):
                            node = next(x for x in items if x in roles and roles[x] != SUBHEAD)
                            role = FURNISHED
                if role is not None and (template.enough or kind in (SENTENCE, SHORT, BULLET, PARAGRAPH)):
                    place = weights[node]
                    if kind == BULLET:
                        constant.add(len(kinds))
                    else:
                        kind = role
            kinds.append(kind)
            places.append(place)
        start, end = align(places)
        body = [k for k in range(start, end) if kinds[k] == PARAGRAPH]
        if body:
            first, last = body[0], body[-1]
        else:
            first = last = next((k for k, x in enumerate(kinds) if x in (SENTENCE, BULLET) and k not in constant), len(at))
        out: list[bool | None] = [None] * len(lines)
        in_teasers = after_furniture = False
        for k, x in enumerate(kinds):
            text = bare[at[k]]
            if x == PARAGRAPH:
                in_teasers = False
                main = True
                if k <= last:
                    after_furniture = False
            elif x in (FURNISHED, TEASERS):
                main = False
                in_teasers = in_teasers or x == TEASERS
                after_furniture = True
            elif x in (SUBHEAD, MARK):
                main = True
                in_teasers = in_teasers and x == MARK
            elif k < first:
                main = x == SENTENCE or (x == BULLET and not in_teasers and k not in constant) or (len(text) > 3 and text.lower() in title)
                in_teasers = in_teasers and not main
            elif k > last:
                main = not in_teasers and not after_furniture
            else:
                main = not in_teasers
            out[at[k]] = main
        return out


def page_rows(df: DataFrame) -> DataFrame:
    """row_id, content, title, site and its pages and template; pages of residue are left out.

    The templates are broadcast only after a check of their number of nodes; above ``BROADCAST_NODES`` they are joined.
    """
    ship_package(df.sparkSession)
    page = F.xxhash64(F.coalesce("url_hash", "original_url"))
    found = templates(df.select("row_id", host("resolved_url", "original_url").alias("site"), page.alias("page"), "content"))
    found = broadcast_if_small(found, BROADCAST_NODES, F.size("nodes"))
    rows = with_residue_flag(df.select("row_id", "title", "content", "original_url", "resolved_url").filter("content IS NOT NULL"))
    return rows.filter("NOT bad_content").join(found, "site", "left").select("row_id", "content", "title", "site", "pages", "nodes", "codes")


class Templates:
    """The templates of the sites met so far."""

    def __init__(self, remember: int = 1000):
        self.known: dict[str | None, Template] = {None: Template()}
        self.remember = remember

    def of(self, site: str | None, pages: int | None, nodes: pa.ListScalar, codes: pa.ListScalar) -> Template:
        if site not in self.known:
            if len(self.known) > self.remember:
                self.known = {None: Template()}
            self.known[site] = Template(pages or 0, nodes.as_py() or [], codes.as_py() or [])
        return self.known[site]


def _walked(b: pa.RecordBatch, pages: Pages, known: Templates) -> Iterator[tuple[list[str], list[bool | None]]]:
    for content, title, site, n, nodes, codes in zip(*(b.column(k).to_pylist() for k in range(1, 5)), b.column(5), b.column(6)):
        lines = content.split("\n")
        yield lines, pages.main(lines, known.of(site, n, nodes, codes), site, title)


def furniture_lines(df: DataFrame) -> DataFrame:
    """row_id, line_no (from 1): the non-blank lines of each content that aren't main body. Residue pages are left out."""

    def classify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages, known = Pages(), Templates()
        for b in batches:
            ids, numbers = [], []
            for row_id, (_, kept) in zip(b.column(0).to_pylist(), _walked(b, pages, known)):
                found = [k for k, main in enumerate(kept, 1) if main is False]
                ids += [row_id] * len(found)
                numbers += found
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(numbers, pa.int32())], ["row_id", "line_no"])

    return page_rows(df).mapInArrow(classify, "row_id long, line_no int")


def main_bodies(df: DataFrame) -> DataFrame:
    """row_id, body: each content's main body. Null contents and residue pages are left out."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages, known = Pages(), Templates()
        for b in batches:
            bodies = ["\n".join(x for x, main in zip(lines, kept) if main is not False) for lines, kept in _walked(b, pages, known)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(bodies, pa.string())], ["row_id", "body"])

    return page_rows(df).mapInArrow(extract, "row_id long, body string")
