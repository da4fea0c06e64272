"""Benchmark decontamination with a BM25 inverted index and block-max WAND (operator 1).

The benchmark's items (cut into entries of at most ``ENTRY`` words) form an
inverted index: per term its postings with their BM25 impacts, the greatest
impact, and the greatest impact in every block of ``BLOCK`` entries. Items are
indexed in shards of at most ``SHARD_BYTES`` of text, so what travels with the
tasks is bounded; more shards mean more passes over the documents, and each
shard is an index of its own.

Every document is a sequence of passages of ``2 * CELL`` words, one starting
every ``CELL`` words, and every passage is a query: wanted are all entries whose
score reaches ``SHARE`` of their score for their own text. WAND's pivot test is
made for all passages of a batch at once with arrays: for a passage and a block
of entries the bound is the sum of the block's greatest impacts of the
passage's rarer terms, plus the greatest impacts of its other terms. Where that
bound reaches the block's least threshold, the passage walks the postings of
that block document-at-a-time: pivot by greatest impacts, shallow test by block
maxima, then exact score. No passage is skipped whose score could reach a
threshold.

A retrieved item counts if it overlaps the words around the passage: ``OVERLAP`` of
its distinct runs of ``RUN`` words. Of an item that asks a question and goes on, the
question and the answer (its last sentence) must both overlap. Parts of at most
``FEW`` words have few runs, of which one changed word breaks many; they are judged
by shorter runs (of 2 words, an answer's of 3), which must lie close together, and
those of at most ``RUN`` words are looked for as they are; one of signs only asks for
nothing. So an answer of some words
to a question must be the same word for word but for its ends.

At scale: documents are read once per shard and not shuffled.

Rows: null, blank and short texts are passages too (a text of fewer words is one
short passage); an item without words matches nothing; repeated items each count
by their id; null and repeated doc_ids are judged row by row; extra columns are
ignored in results of ``matches`` and kept by ``clean``; an empty benchmark
leaves every document clean; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tunefold.llm.common import SIGNS, batches, fresh, mix, shingles, utf8, word_hashes, written

#: Words of half a passage, of an entry; entries of a block; bytes of items in a shard.
CELL, ENTRY, BLOCK, SHARD_BYTES = 32, 32, 4, 4_000_000
#: Share of an entry's own score, words of a run, share of runs that question and answer need.
SHARE, RUN, OVERLAP = 0.7, 5, 0.6
#: Terms in more than this share of entries only add to the bound; bounds (passages * blocks) that are held at once.
COMMON, HELD = 0.4, 4_000_000
#: Words of a part that is judged by shorter runs; words of its runs, and of those of an answer; runs by which it may be stretched.
FEW, SHORT, EXACT, SLACK = 16, 2, 3, 3
K1, B = 1.2, 0.75

_SENTENCE = re.compile(r"(?<=[.!?…])\s+")


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's two parts."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = len(words) - max(1, len(words) // 3)
    return " ".join(words[:cut] or words), " ".join(words[cut:])


_ASKS = re.compile(r"[?？؟]['\")\]”’»]*(?:\s|\Z)")


def parts_of(text: str) -> tuple[str, ...]:
    """What must be found of an item: question and answer, or all of an item that isn't a question with an answer."""
    question, answer = question_and_answer(text)
    return (question, answer) if _ASKS.search(question) else (text,)


class Part:
    """Distinct runs of a part's words."""

    def __init__(self, words: np.ndarray, answer: bool):
        self.words = len(words)
        self.run = self.words if self.words <= RUN else RUN if self.words > FEW else EXACT if answer else SHORT
        self.runs = np.unique(mix_of(words, self.run))

    def overlap(self, near: np.ndarray, have: dict[int, np.ndarray]) -> float:
        """Share of the runs among those of the words near; ``have`` holds these by their length."""
        if self.run not in have:
            have[self.run] = mix_of(near, self.run)
        found = have[self.run]
        if self.words <= RUN or self.words > FEW:
            return np.isin(self.runs, found).mean()
        at = np.flatnonzero(np.isin(found, self.runs))
        span = self.words - self.run + 1 + SLACK
        most = max((len(set(found[at[i : np.searchsorted(at, p + span)]].tolist())) for i, p in enumerate(at)), default=0)
        return most / len(self.runs)


class Index:
    """BM25 inverted index of benchmark items with block maxima."""

    def __init__(self, items: list[tuple[int, str]]):
        self.item, entries = [], []
        self.parts: dict[int, list[Part]] = {}
        self.ids = [i for i, _ in items]
        for n, (_, text) in enumerate(items):
            found, at = word_hashes([h.encode() for h in parts_of(text)], SIGNS)
            self.parts[n] = [Part(found[a:b], k > 0) for k, (a, b) in enumerate(zip(at, at[1:])) if a < b]
            words = word_hashes([text.encode()], SIGNS)[0]
            pieces = max(1, -(-len(words) // ENTRY))
            for piece in np.array_split(words, pieces) if len(words) else ():
                self.item.append(n)
                entries.append(piece)
        # entries of about the same size, and so of about the same threshold, share a block
        order = sorted(range(len(entries)), key=lambda i: len(entries[i]))
        self.item, entries = [self.item[i] for i in order], [entries[i] for i in order]
        n = len(entries)
        flat = np.concatenate(entries) if n else np.zeros(0, np.uint64)
        self.terms, term = np.unique(flat, return_inverse=True)
        size = np.array([len(e) for e in entries], float)
        entry = np.repeat(np.arange(n), size.astype(int))
        key, tf = np.unique(term.astype(np.int64) * max(1, n) + entry, return_counts=True)
        self.of_term, self.entry = key // max(1, n), key % max(1, n)
        df = np.bincount(self.of_term, minlength=len(self.terms))
        self.at = np.r_[0, np.cumsum(df)]
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        length = K1 * (1 - B + B * size[self.entry] / size.mean()) if n else 0
        self.impact = idf[self.of_term] * tf * (K1 + 1) / (tf + length)
        self.least = SHARE * np.bincount(self.entry, self.impact, minlength=n)
        self.blocks = max(1, math.ceil(n / BLOCK))
        self.block_least = np.full(self.blocks, np.inf)
        np.minimum.at(self.block_least, np.arange(n) // BLOCK, self.least)
        self.greatest = np.zeros(len(self.terms))
        np.maximum.at(self.greatest, self.of_term, self.impact)
        # (term, block) pairs with their greatest impact, by term
        pair, back = np.unique(self.of_term * self.blocks + self.entry // BLOCK, return_inverse=True)
        self.block_max = np.zeros(len(pair))
        np.maximum.at(self.block_max, back, self.impact)
        self.block_of = pair % self.blocks
        self.block_at = np.r_[0, np.cumsum(np.bincount(pair // self.blocks, minlength=len(self.terms)))]
        self.common = df > COMMON * n
        self.known = np.zeros(1 << 20, bool)
        self.known[(self.terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def lookup(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of known words and their terms."""
        at = np.flatnonzero(self.known[(words & np.uint64((1 << 20) - 1)).astype(np.int64)])
        term = np.searchsorted(self.terms, words[at])
        term[term == len(self.terms)] = 0
        fine = self.terms[term] == words[at] if len(self.terms) else np.zeros(len(at), bool)
        return at[fine], term[fine]

    def candidates(self, cell: np.ndarray, term: np.ndarray, next_cell: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cell, block) pairs whose bound reaches the block's least threshold.

        ``cell`` and ``term`` hold the distinct terms of the cells; a passage is a cell and the next of its document.
        """
        cells, after = len(next_cell), next_cell >= 0
        often = self.common[term]
        rest = np.bincount(cell[often], self.greatest[term[often]], minlength=cells)
        rest[after] += rest[next_cell[after]]
        cell, term = cell[~often], term[~often]
        found = []
        step = max(2, HELD // self.blocks)
        for low in range(0, cells, step - 1):  # a slice of cells and the one after it
            high = min(cells, low + step)
            x, y = np.searchsorted(cell, [low, high])
            n = self.block_at[term[x:y] + 1] - self.block_at[term[x:y]]
            where = np.repeat(self.block_at[term[x:y]] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum()) if y > x else np.zeros(0, int)
            key = np.repeat(cell[x:y] - low, n) * self.blocks + self.block_of[where]
            bound = np.bincount(key, self.block_max[where], minlength=(high - low) * self.blocks).reshape(-1, self.blocks)
            own = np.arange(low, high if high == cells else high - 1)
            total = bound[: len(own)] + rest[own, None]
            more = after[own]
            total[more] += bound[next_cell[own[more]] - low]
            c, b = np.nonzero(total >= self.block_least - 1e-9)
            found.append((c + low, b))
            if high == cells:
                break
        return tuple(np.concatenate(f) for f in zip(*found)) if found else (np.zeros(0, int), np.zeros(0, int))

    def wand(self, terms: np.ndarray, block: int) -> list[tuple[int, float]]:
        """Entries of a block whose exact score for the terms reaches their thresholds, with the score."""
        low, high, least = block * BLOCK, block * BLOCK + BLOCK, self.block_least[block] - 1e-9
        cursors = []  # entry, end of the list within the block, place, greatest impact, block maximum
        for t in terms.tolist():
            a, b = self.at[t], self.at[t + 1]
            x, y = a + np.searchsorted(self.entry[a:b], [low, high])
            if x < y:
                cursors.append([int(self.entry[x]), int(y), int(x), self.greatest[t], float(self.impact[x:y].max())])
        out = []
        while cursors:
            cursors.sort(key=lambda c: c[0])
            total, pivot = 0.0, None
            for k, c in enumerate(cursors):
                total += c[3]
                if total >= least:
                    pivot = k
                    break
            if pivot is None:
                break
            entry = cursors[pivot][0]
            meets = [c for c in cursors if c[0] <= entry]
            score = 0.0
            if sum(c[4] for c in meets) >= least:  # the block could hold it
                if cursors[0][0] == entry:
                    score = sum(float(self.impact[c[2]]) for c in meets)
                    if score >= self.least[entry] - 1e-9:
                        out.append((entry, score))
                    entry += 1
            else:
                entry += 1
            for c in meets:  # on to the pivot, or past it
                while c[2] < c[1] and self.entry[c[2]] < entry:
                    c[2] += 1
                c[0] = int(self.entry[c[2]]) if c[2] < c[1] else -1
            cursors = [c for c in cursors if c[0] >= 0]
        return out

    def search(self, words: np.ndarray, bounds: np.ndarray) -> list[dict[int, float]]:
        """Of each document (its words lie between two bounds) the items that are verified, with their best score."""
        docs = len(bounds) - 1
        found: list[dict[int, float]] = [{} for _ in range(docs)]
        size = np.diff(bounds)
        per = -(-size // CELL)
        first = np.r_[0, np.cumsum(per)]
        if not first[-1] or not len(self.terms):
            return found
        doc_of = np.repeat(np.arange(docs), per)
        next_cell = np.arange(1, first[-1] + 1)
        next_cell[first[1:][per > 0] - 1] = -1
        at, term = self.lookup(words)
        doc = np.searchsorted(bounds, at, side="right") - 1
        cell = first[doc] + (at - bounds[doc]) // CELL
        key = np.unique(cell * len(self.terms) + term)
        cell, term = key // len(self.terms), key % len(self.terms)
        starts = np.searchsorted(cell, np.arange(first[-1] + 1))
        for c, b in zip(*(x.tolist() for x in self.candidates(cell, term, next_cell))):
            mine = term[starts[c] : starts[c + 1]]
            if next_cell[c] >= 0:
                mine = np.union1d(mine, term[starts[c + 1] : starts[c + 2]])
            for entry, score in self.wand(mine, b):
                d, n = doc_of[c], self.item[entry]
                if n in found[d]:
                    found[d][n] = max(found[d][n], score)
                    continue
                reach = max(sum(p.words for p in self.parts[n]), 2 * CELL) + 2 * RUN
                a = max(bounds[d], bounds[d] + (c - first[d]) * CELL - reach)
                z = min(bounds[d + 1], bounds[d] + (c - first[d] + 2) * CELL + reach)
                near = words[a:z]
                have: dict[int, np.ndarray] = {}
                if all(p.overlap(near, have) >= OVERLAP for p in self.parts[n]):
                    found[d][n] = score
        return found


def mix_of(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words."""
    return shingles(words, k) if len(words) >= k > 0 else np.zeros(0, np.uint64)


def shards(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """The items (item_id, text) in shards of bounded size, in order of id."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // SHARD_BYTES)
    for k in range(n):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).orderBy("item_id", "text")
        yield [(r.item_id, r.text) for r in part.collect()]


def _judged(docs: DataFrame, index: Index, keep: list[str], name: str) -> DataFrame:
    """``keep`` columns and column ``name``: ids of the verified items of this shard."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            words, bounds = word_hashes(utf8(b.column(b.num_columns - 1)), SIGNS)
            items = [sorted({index.ids[n] for n in f}) for f in index.search(words, bounds)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(items, pa.list_(pa.int64()))], names=[*keep, name]
            )

    rows = docs.select(*keep, F.col("text").alias(fresh("text")))
    schema = StructType([*docs.select(*keep).schema.fields, StructField(name, ArrayType(LongType()))])
    return rows.mapInArrow(run, schema)


def judged(docs: DataFrame, benchmark: DataFrame, keep: list[str], name: str) -> DataFrame:
    """``keep`` columns of every row and column ``name``, its verified benchmark items in ascending order.

    One shard's index at a time: with more shards, what the rows have found is written after each, so
    neither a plan nor a task ever carries two indexes.
    """
    out, held = docs.withColumn(name, F.array().cast("array<long>")), None
    for shard in shards(benchmark):
        if held is not None:
            out = written(_with_shard(out, held, list(dict.fromkeys([*keep, "text"])), name), "judged")
        held = Index(shard)
    return _with_shard(out, held, keep, name) if held is not None else out.select(*keep, name)


def _with_shard(docs: DataFrame, index: Index, keep: list[str], name: str) -> DataFrame:
    before = fresh("before")
    rows = _judged(docs.withColumnRenamed(name, before), index, [*keep, before], name)
    return rows.withColumn(name, F.array_sort(F.array_union(before, name))).drop(before)


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated and items (ids of the verified benchmark items) of every row."""
    rows = judged(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), benchmark, ["doc_id"], "items")
    return rows.select("doc_id", (F.size("items") > 0).alias("contaminated"), "items")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` without a verified benchmark item."""
    items = fresh("items")
    return judged(docs, benchmark, docs.columns, items).where(F.size(items) == 0).drop(items)
