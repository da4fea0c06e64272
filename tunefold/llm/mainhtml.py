"""Main text of web pages by a maximum-scoring subsequence (operator 4).

A page is a sequence of words and tags. Words score by the kinds of the elements
around them, tags negative, and a linear scan finds the contiguous run of the
greatest sum: the content region.

The scores come from labelled pages: a bounded sample (``SAMPLE`` pages of
smallest hash) of pages on which the scan, with the prior scores, settles on the
one ``article`` or ``main`` element. For every kind of element (its name and its
classes, id and role, each as a whole) the words that it holds inside and outside the
article are counted there, on top of fixed prior counts for elements that HTML
defines as no content; elements around the article hold both and say nothing. Of the
kinds counted, the ``KINDS`` with most words are used, from ``EVIDENCE`` words on. A
compound name (``user-comment``, ``share-buttons``) also is of the kind that its
last part names, or the one before parts such as ``list`` or ``box``; so
``share-price`` is no sharing, and ``comment-on-budget`` no comment. Headings are
not judged by their id, nor paragraphs and the like by a compound one: such ids
are words of the text. A
word under a kind of mostly-outside words costs; under a kind of even share it
scores ``WORD``, as under kinds that nothing is known of, and up to ``MOST`` under
a kind of mostly-inside words. The lowest of the kinds around a word counts.

A page's only ``article`` or ``main`` is a mark if it is of no outside kind itself.
If ``MARK`` times the sum of its best run reaches the best sum that the page has
without its words, the region is that run; or else its words score nothing and the
scan decides among the rest. So a teaser or a comment that is the only ``article``
loses against the text of the page.

Elements of outside kind within the region are left out. ``html`` and ``body`` are
never of outside kind; nor is another element that holds most words of the page
and a heading, ``main`` or ``nav``, or without which nothing would be left. Text is
that of the region's blocks: references decoded, white space to one space, blocks
joined by one.

Every page is handled on its own in one pass (no shuffle); the model is a small
dictionary. Rows: null, blank or text-free html gives the empty text; repeated
page_ids are kept row by row; extra columns are ignored; an empty table gives no
rows (and no weights but the prior ones).
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import batches

#: Learned kinds at most, and the words of sampled pages that a kind needs to be one.
KINDS, EVIDENCE = 5000, 50
#: Labelled pages at most; scores of a word and a tag; share of inside words under which an element is outside.
SAMPLE, WORD, TAG, INSIDE = 2000, 1.0, -0.25, 0.2
#: Share of inside words at which a word scores WORD; greatest score of a word; times that a marked word counts.
EVEN, MOST, MARK = 0.5, 2.0, 3.0

# Element names and class words of HTML pages.
OUTSIDE = frozenset(
    "nav aside footer header form menu button select textarea option fieldset dialog".split()
)
OUTSIDE_WORDS = frozenset(
    """ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie cookies
    consent disqus footer header login masthead menu menubar modal nav navbar navigation newsletter notice notification
    pagination popup promo promoted related recommended share sharing sidebar signup skip social sponsor sponsored
    subscribe toolbar widget complementary contentinfo""".split()
)
#: Last parts of compound names that leave the meaning to the part before them.
HOLDERS = frozenset(
    """area bar block body bottom box btn button buttons card col column container content desktop entry feed frame group
    holder icon icons inner item items label left link links list main message mobile module outer overlay pane panel
    placeholder post posts region right root row section slot strip text title top unit wrap wrapper zone""".split()
)
#: Parts by which a compound name is a phrase ("history-of-the-menu") or a state ("page-with-sidebar").
PHRASE = frozenset("a an and as at by for from has how in is no not of on or the to vs what when why with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements of running text, and the words that name no outside kind on a heading.
TEXTUAL = HEADINGS | frozenset("p li dt dd td th blockquote pre figcaption caption".split())
HEADS = frozenset("banner header masthead".split())
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong
    sub sup time tt u var wbr nobr math mfrac mi mn mo mover mroot mrow ms msqrt mstyle msub msubsup msup mtext munder
    munderover semantics""".split()
)
NEUTRAL = INLINE | frozenset(
    """html head body div section article main p table thead tbody tr td th ul ol li dl dt dd blockquote pre figure
    figcaption caption center h1 h2 h3 h4 h5 h6""".split()
)
RAW = "script|style|noscript|template|iframe|svg|object|canvas|audio|video|title|annotation-xml|annotation"
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that a block ends, and those that the next of their kind ends, as end tags may be left out.
ENDED_BY_BLOCK = "p"
OWN_END = frozenset("li dt dd tr td th option".split())
#: Elements that can be around a whole page in spite of their kind, and what a page has once, so that its wrapper holds it.
WRAPPERS = NEUTRAL - INLINE | {"form"}
ONCE = frozenset("h1 main nav".split())

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{RAW})\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)|<[!?][^>]*>"
    r"|<(?P<end>/?)(?P<name>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<name2>[a-zA-Z][a-zA-Z0-9:-]*)[^>]*>",
    re.S | re.I,
)
_ATTR = re.compile(r"(?<![\w-])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")


def named(value: str, name: str) -> str | None:
    """The outside word that a compound class, id or role is named after, if any."""
    parts = [w for w in _PART.findall(value) if not w.isdigit()]
    if len(parts) < 2 and value in parts or PHRASE.intersection(parts):
        return None
    while len(parts) > 1 and parts[-1] in HOLDERS:
        parts.pop()
    word = parts[-1] if parts else ""
    return word if word in OUTSIDE_WORDS and not (name in HEADINGS and word in HEADS) else None


def kinds(name: str, attrs: str) -> tuple[str, ...]:
    """What is known of an element: its name, its classes, id and role, and the outside words that these are named after."""
    found = [name]
    if attrs and "=" in attrs:
        for m in _ATTR.findall(attrs):
            of = m[0].lower()
            if of == "id" and name in HEADINGS:
                continue
            for value in (m[1] or m[2] or m[3]).lower().split():
                if not (name in HEADINGS and value in HEADS):
                    found.append(f".{value}")
                if not (of == "id" and name in TEXTUAL):
                    word = named(value, name)
                    found += [f".{word}"] if word else []
    return tuple(dict.fromkeys(found))


def parsed(page: str) -> list[tuple]:
    """The page as ("text", string), ("open", name, kinds) and ("close", name), raw elements and comments left out."""
    out, at = [], 0
    for m in _TOKEN.finditer(page):
        if m.start() > at:
            out.append(("text", page[at : m.start()]))
        at = m.end()
        name = (m["name"] or m["name2"] or "").lower()
        if name:
            if m["end"] or m["end2"]:
                out.append(("close", name))
            else:
                out.append(("open", name, kinds(name, m["attrs"] or "")))
        else:
            out.append(("open", "br", ("br",)))  # white space stands for what is left out
    if at < len(page):
        out.append(("text", page[at:]))
    return out


def walked(tokens: list[tuple]) -> Iterator[tuple]:
    """Each token with the open elements around it (name and kinds, innermost last), end tags that are left out supplied."""
    stack: list[tuple] = []
    for t in tokens:
        if t[0] == "open" and t[1] not in VOID:
            name = t[1]
            if name not in INLINE and stack:
                for j in range(len(stack) - 1, -1, -1):  # a block ends an open paragraph, an item the item before it
                    if stack[j][0] == ENDED_BY_BLOCK or name in OWN_END and stack[j][0] == name:
                        del stack[j:]
                        break
                    if stack[j][0] not in INLINE:
                        break
            stack.append((name, t[2]))
        elif t[0] == "close":
            for j in range(len(stack) - 1, -1, -1):
                if stack[j][0] == t[1]:
                    del stack[j:]
                    break
                if stack[j][0] in ("article", "main", "body") and t[1] in INLINE | {"p"}:
                    break
        yield t, stack


_ARTICLE = ("article", "main")


class Page:
    """A page's tokens and the tree of its elements, numbered as they open; number 0 stands for the page."""

    def __init__(self, page: str):
        self.tokens = parsed(page)
        self.names, self.kinds, self.up = [""], [()], [0]
        self.at: list[int] = []  # innermost element of each token
        self.words = [len(t[1].split()) if t[0] == "text" else 0 for t in self.tokens]
        path: list[int] = []
        for t, stack in walked(self.tokens):
            del path[len(stack) :]
            if t[0] == "open" and t[1] not in VOID:  # may have ended elements as deep as itself
                del path[len(stack) - 1 :]
                self.up.append(path[-1] if path else 0)
                self.names.append(t[1])
                self.kinds.append(() if t[1] in ("html", "body") else t[2])
                path.append(len(self.up) - 1)
            self.at.append(path[-1] if path else 0)
        m = len(self.up)
        self.held, self.last, self.once = [0] * m, list(range(m)), [False] * m
        for e, n in zip(self.at, self.words):
            self.held[e] += n
        for e in range(m - 1, 0, -1):
            u = self.up[e]
            self.held[u] += self.held[e]
            self.last[u] = max(self.last[u], self.last[e])
            self.once[u] |= self.once[e] or self.names[e] in ONCE

    def scores(self, of: dict[str, float], left_out: frozenset[int] = frozenset()) -> tuple[list[float], frozenset[int]]:
        """Score of a word in each element, and the wrappers that are of outside kind and hold most of the page's words.

        Wrappers that hold what a page has once, and those in ``left_out``, are not judged.
        """
        out, large = [WORD], set()
        for e in range(1, len(self.up)):
            found = [of[k] for k in self.kinds[e] if k in of]
            if found and min(found) < 0 and self.names[e] in WRAPPERS and 2 * self.held[e] > self.held[0]:
                large.add(e)
                if self.once[e] or e in left_out:
                    found = []
            found.append(out[self.up[e]])
            low = min(found)
            out.append(low if low < WORD else max(found))
        return out, frozenset(large)

    def marks(self, scores: list[float]) -> list[int]:
        """The elements by which a page may mark its content."""
        found = [[e for e, x in enumerate(self.names) if x == name] for name in _ARTICLE]
        return [x[0] for x in found if len(x) == 1 and scores[x[0]] >= 0]

    def region(self, scores: list[float], mark: int | None, dropped: list[int]) -> tuple[int, int, float]:
        """First and last (exclusive) token of the best run, within the mark if there is one, and its sum.

        Words in ``dropped`` elements score nothing.
        """
        best, best_at, total, start = 0.0, (0, 0), 0.0, 0
        none = [(x, self.last[x]) for x in dropped]
        for i, (e, n) in enumerate(zip(self.at, self.words)):
            if mark is not None and not mark <= e <= self.last[mark]:
                total, start = 0.0, i + 1
                continue
            s = scores[e]
            if self.tokens[i][0] != "text":
                total += TAG / 100 if mark is not None else TAG * max(0.0, 2 * WORD - s)
            elif n and not any(x <= e <= y for x, y in none):
                # words that don't count: their element costs more the more of them it holds, but not within a mark
                total += s * n if s >= 0 else 0.0 if mark is not None else s * n - 4 * WORD
            if total > best:
                best, best_at = total, (start, i + 1)
            if total <= 0:
                total, start = 0.0, i + 1
        return *best_at, best

    def settled(self, scores: list[float]) -> tuple[int | None, int, int]:
        """The mark that stands against the best run without it, if any, and the region."""
        dropped: list[int] = []
        for mark in self.marks(scores):
            a, b, own = self.region(scores, mark, dropped)
            if own and MARK * own >= self.region(scores, None, [*dropped, mark])[2]:
                return mark, a, b
            dropped.append(mark)
        return None, *self.region(scores, None, dropped)[:2]


def counted(page: str) -> dict[str, tuple[int, int]]:
    """Words inside and outside the article under each kind of element; nothing if the page doesn't settle on a mark."""
    p = Page(page)
    mark = p.settled(p.scores(outside_kinds(prior()))[0])[0]
    if mark is None:
        return {}
    around, e = set(), mark
    while e:
        e = p.up[e]
        around.add(e)
    found: dict[str, list[int]] = {}
    until: dict[str, int] = {}  # last element within the outermost one of each kind
    for e in range(1, len(p.up)):
        for kind in p.kinds[e] if p.held[e] and e not in around else ():
            if e > until.get(kind, 0):  # words under several of a kind count once
                until[kind] = p.last[e]
                found.setdefault(kind, [0, 0])[not mark <= e <= p.last[mark]] += p.held[e]
    return {k: (a, b) for k, (a, b) in found.items()}


def prior() -> dict[str, tuple[float, float]]:
    """Counts of inside and outside words before any page is seen."""
    return {k: (0, 5000) for k in OUTSIDE} | {f".{k}": (0, 5000) for k in OUTSIDE_WORDS}


def outside_kinds(counts: dict[str, tuple[float, float]]) -> dict[str, float]:
    """Score of a word under each kind: below 0 if its words are mostly outside articles, WORD at an even share."""
    share = {k: a / (a + b + 1) for k, (a, b) in counts.items() if k not in NEUTRAL}
    return {k: min(MOST, WORD * (x - INSIDE) / (EVEN - INSIDE)) for k, x in share.items()}


def main_text(page: str | None, outside: dict[str, float]) -> str:
    """The text of the page's best region; ``outside`` has the scores of kinds."""
    if not page:
        return ""
    p = Page(page)
    scores, large = p.scores(outside)
    _, a, b = p.settled(scores)
    if a == b and large:  # nothing is left but what a wrapper holds
        scores = p.scores(outside, large)[0]
        _, a, b = p.settled(scores)
    out = []
    for t, e in zip(p.tokens[a:b], p.at[a:b]):
        if t[0] != "text":
            out.append("" if t[1] in INLINE else " ")  # the white space that tags stand for
        elif scores[e] >= 0 or not t[1].strip():
            out.append(t[1])
    return " ".join(html.unescape("".join(out)).split())


def learned(pages: DataFrame, sample: int = SAMPLE) -> dict[str, float]:
    """Scores of kinds, from labelled pages of the table."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for b in batches(parts):
            for page in b.column(0).to_pylist():
                for k, (x, y) in counted(page or "").items():
                    inside[k] += x
                    outside[k] += y
        names = sorted({*inside, *outside})
        columns = [pa.array(names), *(pa.array([c[k] for k in names], pa.int64()) for c in (inside, outside))]
        yield pa.RecordBatch.from_arrays(columns, names=["kind", "inside", "outside"])

    chosen = pages.select(F.xxhash64("page_id", "url").alias("h"), "page_id", "url").orderBy("h").limit(sample)
    ids = F.broadcast(chosen.select(F.col("page_id").alias("p"), F.col("url").alias("u")).distinct())  # at most `sample` rows
    rows = pages.join(ids, F.col("page_id").eqNullSafe(F.col("p")) & F.col("url").eqNullSafe(F.col("u")), "left_semi")
    counts = rows.select("html").mapInArrow(run, "kind string, inside long, outside long")
    counts = counts.groupBy("kind").agg(F.sum("inside").alias("a"), F.sum("outside").alias("b"))
    counts = counts.where(F.col("a") + F.col("b") >= EVIDENCE).orderBy(F.desc(F.col("a") + F.col("b")), "kind").limit(KINDS)
    total = prior()
    for r in counts.collect():
        a, b = total.get(r.kind, (0, 0))
        total[r.kind] = (a + r.a, b + r.b)
    return outside_kinds(total)


def extract(pages: DataFrame, outside: dict[str, float]) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            text = [main_text(p, outside) for p in b.column(2).to_pylist()]
            size = pa.array([len(t) for t in text], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(text, pa.string()), size], names=["page_id", "url", "text", "n_chars"]
            )

    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
