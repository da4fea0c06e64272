"""Removal of repeated passages by sliding sentence spans (operator 7).

A text's words fall into units: sentences (a word that ends in . ! ? … or another
script's stop, closing quotes and brackets aside, or before a line break ends one),
those of more than ``UNIT`` words in pieces of ``UNIT``. Every run of consecutive
units is hashed that has at least two units and ``WORDS`` words and no shorter one
like it: from every unit forwards, and to every unit backwards, so a passage that
repeats is covered from its first unit to its last. Words are compared in ASCII
lower case, white space between them doesn't matter.

Pieces of a long sentence hang on where it begins. So words are also cut where the
text itself says so: after every word whose hash is the least of the ``AROUND``
words on either side, and every ``UNIT`` words where that is rarer. Runs of these
units that have words of a sentence of more than ``UNIT`` words are hashed likewise;
an insertion, or a passage that begins in mid-sentence, changes the next cuts only.

The runs of all documents meet by hash: the first document that has a run (least
doc_id) keeps it; in all others, and at later places of the first one itself, the
units that it covers are removed.

At scale: a row per document and distinct run is shuffled once, 96 bits of hash and
the id. What a task has seen in a lesser document of its own is no first one, so of
a run only the least document of a task (of a batch, beyond ``MET`` remembered runs)
goes to the other tasks' by hash; the rest are spread by document. So a passage that stands in
a third of all documents is a few rows there. The hashes to remove of one document, at
most its own runs, meet in its row.

Repeats of under ``WORDS`` words stay, also if they are two short whole sentences:
phrases of that length repeat in clean text.

Rows: null, empty and one-unit texts stay as they are; so do rows without doc_id
(they are neither first nor repeats); rows that repeat a doc_id are one document,
each loses the same runs; a text over ``PART`` bytes is handled in parts that end
at white space, each with the ``OVERLAP`` words before and after it, so a run that
crosses an edge is one of the part that it begins in; extra columns are kept; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tunefold.llm.common import _SPACE, _hash_block, _powers, batches, fresh, mix, utf8

#: Words of a unit at most, words of a run at least, bytes of a part.
UNIT, WORDS, PART = 16, 20, 8_000_000
#: Words on either side among which a cut's hash is the least; words of the neighbours that a part sees (more than a run has).
AROUND, OVERLAP = 3, 80
#: Repeated runs that a task remembers (20 bytes each).
MET = 500_000

# Signs that end a sentence, and those that may follow them.
_STOPS = [c.encode() for c in "…。！？｡．।॥؟۔։።‼⁇⁈⁉"]
_CLOSERS = [c.encode() for c in "”’»›」』）】》"]
_END, _CLOSING = np.zeros(256, bool), np.zeros(256, bool)
_END[[ord(c) for c in ".!?"]] = True
_CLOSING[[ord(c) for c in "\"')]}"]] = True


def _ending(a: np.ndarray, starts: np.ndarray, ends: np.ndarray, sign: bytes) -> np.ndarray:
    """Whether the words between ``starts`` and ``ends`` end in the sign."""
    out = ends - starts >= len(sign)
    for k, c in enumerate(reversed(sign)):
        out &= a[ends - 1 - k] == c
    return out


def _stopped(a: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether the words end a sentence, closing signs aside."""
    out = np.zeros(len(starts), bool)
    at = np.flatnonzero(~_WORDLY[a[ends - 1]]) if len(starts) else np.zeros(0, int)
    start, end = starts[at], ends[at]
    for _ in range(3):
        sign = a[end - 1]
        closed = (_CLOSING[sign] & (end - start > 1)).astype(int)
        if (sign >= 128).any():
            for c in _CLOSERS:
                closed[_ending(a, start, end, c) & (end - start > len(c))] = len(c)
        if not closed.any():
            break
        end = end - closed
    sign = a[end - 1]
    out[at] = _END[sign]
    if (sign >= 128).any():
        for c in _STOPS:
            out[at] |= _ending(a, start, end, c)
    return out


#: ASCII letters and digits; most words end in one, and so end no sentence.
_WORDLY = np.array([c < 128 and chr(c).isalnum() for c in range(256)])


class Units:
    """Words, units and runs of some texts, with places in the joined bytes.

    ``a`` and ``b``: first and last unit (exclusive) of the runs of sentences; ``from_word`` and ``to_word`` (exclusive),
    ``run_one``, ``run_two`` and ``run_doc``: of those and of the runs of units that the text itself cuts.
    """

    def __init__(self, texts: list[bytes]):
        self.buffer = b"\n" + b"\n".join(texts) + b"\n"
        a = np.frombuffer(self.buffer, np.uint8)
        words, bounds, self.starts, ends = _hash_block(texts)
        n = len(words)
        self.text_at = np.cumsum([1, *(len(t) + 1 for t in texts)])
        lines = np.r_[0, np.cumsum(a == 10)]
        broken = np.zeros(n, bool)
        if n:
            broken[:-1] = lines[self.starts[1:]] > lines[ends[:-1]]
            broken[-1] = True
        last = broken | _stopped(a, self.starts, ends)
        first = np.r_[True, last[:-1]] if n else last
        self.unit, self.unit_end = self._pieces(first)
        self.doc_of_unit = np.searchsorted(bounds, self.unit, side="right") - 1
        self.units_at = np.searchsorted(self.unit, bounds)
        up, down = _powers(n + 1)
        sums = [np.r_[np.zeros(1, np.uint64), np.cumsum(w * up[:n])] for w in (words, mix(words))]
        self.a, self.b = self._runs(self.unit, self.unit_end, bounds)
        x, y = (self.unit[self.a], self.unit_end[self.b - 1]) if n else (self.a, self.b)
        self.one, self.two = self._hashes(sums, down, x, y)
        # the runs of units that the text itself cuts, where sentences are long
        begin = np.flatnonzero(first)
        size = np.diff(np.r_[begin, n])
        long = np.r_[0, np.cumsum(np.repeat(size > UNIT, size))] if n else np.zeros(1, int)
        if long[-1]:
            unit, unit_end = self._pieces(self._cut(words, bounds))
            c, d = self._runs(unit, unit_end, bounds)
            c, d = unit[c], unit_end[d - 1]
            fine = long[d] > long[c]
            key = np.setdiff1d(c[fine] * (n + 1) + d[fine], x * (n + 1) + y)
            c, d = key // (n + 1), key % (n + 1)
            more = self._hashes(sums, down, c, d)
        else:
            c, d, more = np.zeros(0, int), np.zeros(0, int), (self.one[:0], self.two[:0])
        self.from_word, self.to_word = np.r_[x, c], np.r_[y, d]
        self.run_one, self.run_two = np.r_[self.one, more[0]], np.r_[self.two, more[1]]
        self.run_doc = np.searchsorted(bounds, self.from_word, side="right") - 1

    def owned(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The runs that begin between two places of their texts."""
        at = self.starts[self.from_word] - self.text_at[self.run_doc] if len(self.from_word) else self.from_word
        return np.flatnonzero((at >= low[self.run_doc]) & (at < high[self.run_doc])) if len(at) else at

    @staticmethod
    def _pieces(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last word (exclusive) of each unit, where ``first`` tells the words that begin one."""
        n = len(first)
        begin = np.flatnonzero(first)
        within = np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n])) if n else np.zeros(0, int)
        unit = np.flatnonzero(within % UNIT == 0)
        return unit, np.r_[unit[1:], n] if n else unit

    @staticmethod
    def _cut(words: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The words that begin a unit as the text itself cuts: those after a least hash, and the first of each text."""
        n = len(words)
        least = np.ones(n, bool)
        for k in range(1, AROUND + 1):
            less = words[k:] < words[:-k]
            more = words[k:] > words[:-k]
            least[k:] &= less
            least[:-k] &= more
        first = np.r_[False, least[:-1]]
        first[bounds[:-1][bounds[:-1] < n]] = True
        return first

    @staticmethod
    def _runs(unit: np.ndarray, unit_end: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last unit (exclusive) of every run."""
        m = len(unit)
        of, units_at = np.searchsorted(bounds, unit, side="right") - 1, np.searchsorted(unit, bounds)
        low, high = units_at[of], units_at[of + 1]
        i = np.arange(m)
        # forwards: the least end with two units and enough words; backwards: the greatest start
        to = np.maximum(i + 2, np.searchsorted(unit_end, unit + WORDS) + 1)
        fine = to <= high
        start = np.minimum(i - 1, np.searchsorted(unit, unit_end - WORDS, side="right") - 1)
        back = start >= low
        a, b = np.r_[i[fine], start[back]], np.r_[to[fine], i[back] + 1]
        key = np.unique(a * (m + 1) + b)
        return key // (m + 1), key % (m + 1)

    @staticmethod
    def _hashes(sums: list[np.ndarray], down: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """96 bits of hash of the words from ``x`` to ``y`` (exclusive)."""
        one, two = ((s[y] - s[x]) * down[x] + (y - x).astype(np.uint64) for s in sums)
        return mix(one).view(np.int64), (mix(two) >> np.uint64(33)).astype(np.int32)


def parts(text: bytes) -> list[bytes]:
    """A text, or the parts of a very long one; they end at white space."""
    out, at = [], 0
    while len(text) - at > PART:
        end = at + PART
        while end < len(text) and not _SPACE[text[end]]:
            end += 1
        out.append(text[at:end])
        at = end
    return [*out, text[at:]]


def seen_parts(text: bytes) -> list[tuple[bytes, int, int, int]]:
    """The parts of a text with the words around them: bytes, where these begin, and where the part begins and ends in them."""
    found, at, out = parts(text), 0, []
    for p in found:
        before = after = 0
        if len(found) > 1:
            before, after = _words_back(text, at), _words_on(text, at + len(p))
        out.append((text[at - before : at + len(p) + after], at - before, before, before + len(p)))
        at += len(p)
    return out


def _words_back(text: bytes, at: int) -> int:
    """Bytes of the ``OVERLAP`` words before a place; of a part's length at most."""
    near = text[max(0, at - PART) : at]
    words = near.rsplit(None, OVERLAP)
    return len(near) if len(words) <= OVERLAP else len(near) - len(words[0])


def _words_on(text: bytes, at: int) -> int:
    """Bytes of the ``OVERLAP`` words after a place; of about a part's length at most."""
    near = text[at : at + PART]
    words = near.split(None, OVERLAP)
    size = len(near) if len(words) <= OVERLAP else len(near) - len(words[-1])
    while at + size < len(text) and not _SPACE[text[at + size]] and not _SPACE[text[at + size - 1]]:
        size += 1
    return size


class Met:
    """Runs that a task has met in several documents, and the least of these; a bounded number of runs."""

    def __init__(self, most: int = MET):
        self.most = most
        self.one, self.two, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int64)

    def known(self, one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Whether the task has met each run in an earlier row of a lesser document."""
        if not len(self.one) or not len(one):
            return np.zeros(len(one), bool)
        at = np.minimum(np.searchsorted(self.one, one), len(self.one) - 1)
        same = (self.one[at] == one) & (self.two[at] == two)
        np.minimum.at(self.doc, at[same], doc[same])
        return same & (self.doc[at] < doc)

    def add(self, one: np.ndarray, two: np.ndarray, doc: np.ndarray) -> None:
        """Notes runs, of each the row that goes into the shuffle."""
        if len(self.one) + len(one) > self.most:
            self.one, self.two, self.doc = self.one[:0], self.two[:0], self.doc[:0]
        one, two, doc = (np.r_[x, y] for x, y in ((self.one, one), (self.two, two), (self.doc, doc)))
        order = np.argsort(one, kind="stable")
        order = order[np.r_[True, one[order][1:] != one[order][:-1]]] if len(order) else order
        self.one, self.two, self.doc = one[order], two[order], doc[order]


def _run_rows(docs: DataFrame) -> DataFrame:
    """(one, two, doc_id, again): the distinct runs of every document.

    ``again`` is null where the document may be the first that has the run, and else the
    doc_id: a lesser document of the same task has it.
    """

    def run(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met = Met()
        for b in batches(batch):
            texts, ids = [], []
            for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                texts += (p := [(x, low, high) for x, _, low, high in seen_parts(t)])
                ids += [i] * len(p)
            u = Units([x for x, _, _ in texts])
            own = u.owned(np.array([x[1] for x in texts]), np.array([x[2] for x in texts]))
            doc = np.array(ids, np.int64)[u.run_doc[own]]
            one, two = u.run_one[own], u.run_two[own]
            order = np.lexsort((doc, two, one))
            one, two, doc = one[order], two[order], doc[order]
            begins = np.r_[True, (one[1:] != one[:-1]) | (two[1:] != two[:-1])][: len(doc)]
            new = begins | np.r_[True, doc[1:] != doc[:-1]][: len(doc)]
            one, two, doc, begins = one[new], two[new], doc[new], begins[new]
            again = ~begins
            again[begins] = met.known(one[begins], two[begins], doc[begins])
            several = np.r_[~begins[1:], False][: len(doc)] & begins & ~again
            met.add(one[several], two[several], doc[several])
            yield pa.RecordBatch.from_arrays(
                [pa.array(one), pa.array(two), pa.array(doc), pa.array(doc, mask=~again)], names=["one", "two", "doc_id", "again"]
            )

    return docs.mapInArrow(run, "one long, two int, doc_id long, again long")


def without(text: bytes, gone: set[tuple[int, int]]) -> tuple[bytes, int, int]:
    """The text without the words of runs in ``gone`` and of runs that repeat in it; removed words and bytes."""
    spans, seen = [], set()
    for part, base, low, high in seen_parts(text):
        u = Units([part])
        own = u.owned(np.array([low]), np.array([high]))
        edges = [*(u.starts - 1).tolist(), len(part)]  # places in the part
        runs = (u.from_word, u.to_word, u.run_one, u.run_two)
        for a, b, one, two in zip(*(x[own].tolist() for x in runs)):
            h = (one, two)
            if h in gone or h in seen:
                spans.append((base + edges[a], base + edges[b]))
            seen.add(h)
    kept, at, words, size = [], 0, 0, 0
    for a, b in sorted(spans):
        if b <= at:
            continue
        kept.append(text[at : max(a, at)])
        cut = text[max(a, at) : b]
        words, size, at = words + len(cut.split()), size + len(cut), b
    out = b"".join([*kept, text[at:]])
    return (out.rstrip() if words else out), words, size


def repeating(texts: list[bytes]) -> list[bool]:
    """Whether a text may hold a run twice; texts of several parts may."""
    u = Units([t if len(t) <= PART else b"" for t in texts])
    order = np.lexsort((u.run_two, u.run_one, u.run_doc))
    one, two, doc = u.run_one[order], u.run_two[order], u.run_doc[order]
    twice = np.flatnonzero((one[1:] == one[:-1]) & (two[1:] == two[:-1]) & (doc[1:] == doc[:-1]))
    out = np.array([len(t) > PART for t in texts], bool)
    out[doc[twice]] = True
    return out.tolist()


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs``, all columns, without repeated passages, and ``removed_words`` (in place of an input column of that name)."""
    names = [c for c in docs.columns if c != "removed_words"]
    key, gone = fresh("doc"), fresh("gone")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    # one exchange: rows that may be a run's first meet by run, those that are none already are dealt by document as well
    first = F.min("doc_id").over(Window.partitionBy("one", "two", "again"))
    found = _run_rows(rows).withColumn("first", first).where("again is not null or doc_id <> first")
    lists = found.groupBy(F.col("doc_id").alias(key)).agg(F.collect_set(F.struct("one", "two")).alias(gone))

    def run(batch: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(batch):
            at = b.schema.get_field_index("text")
            texts, counts = [], []
            own = repeating(utf8(b.column(at)))
            for t, doc, runs, again in zip(b.column(at).to_pylist(), b.column("doc_id").to_pylist(), b.column(gone).to_pylist(), own):
                if t is None or doc is None or not runs and not again:
                    texts.append(t)
                    counts.append(0)
                    continue
                x, words, _ = without(t.encode(), {(g["one"], g["two"]) for g in runs or ()})
                texts.append(x.decode())
                counts.append(words)
            columns = [pa.array(texts, b.schema.field(at).type) if k == at else b.column(k) for k in range(len(names))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64())], names=[*names, "removed_words"])

    fields = [docs.schema[n] for n in names]
    schema = StructType([*(StructField(f.name, StringType()) if f.name == "text" else f for f in fields), StructField("removed_words", LongType())])
    joined = docs.join(lists, F.col("doc_id").cast("long") == F.col(key), "left").select(*names, gone)
    return joined.mapInArrow(run, schema)
