"""Alignment of two tokenizations by lockstep merging (operator 11).

A text is encoded by two tokenizers, and both give its bytes back. The byte
offsets where a token of A and a token of B both end cut the tokens into groups;
every A token of a group is linked with every B token of it. The cuts come from one
state of pointers for all documents of a batch: each step compares the ends of the
two tokens under every pointer pair, emits a cut where they are equal, moves the
pointer with the smaller end (both at a cut), and drops what is finished. A long
document is several lanes of at most ``LANE`` bytes, whose first tokens a binary
search finds, so a batch takes as many steps as a lane has tokens.

Links have counts over the whole corpus: in how many documents an id pair is linked.

1. A task aligns its rows in blocks of about ``BLOCK_BYTES``. Per document it keeps
   the distinct id pairs and how often each occurs, as numbers into the block's list
   of distinct pairs; that list goes with the number of documents that hold each.
2. Pairs of all blocks are summed (one row per block and pair, not per link), and the
   highest count of each A id is found (at most as many rows as the vocabulary has ids).
3. The counts are joined back to the blocks' lists, and every block gets its own list
   once more and adds up its documents' links.

At scale: a pair that all documents hold is one row per block, and the join that
returns its count can be split by Spark as any skewed join. What a task holds is one block
(or one document, if that is longer) and its pairs. The aligned blocks are a written
table, so nothing is encoded twice when an executor is lost. The result doesn't depend
on how rows fall into blocks; each block is named by task and number within one write.

Rows: a text that is null or empty, or that one of the tokenizers does not give
back byte for byte after the leading space, has no tokens: zeros, and '' for the digest.
Repeated rows are documents of their own; null ids stay null; extra columns are ignored;
an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.chat import token_bytes
from tunefold.llm.common import batches, utf8, written
from tunefold.llm.tokens import PieceEncoder

#: Bytes of a lane, bytes of text in a block, product of a group's sizes from which its ids are counted first.
LANE, BLOCK_BYTES, WIDE = 4096, 2_000_000, 64
#: Pieces of texts that a worker keeps the A ids of (about 60 MB).
MOST_PIECES = 300_000

BLOCKS = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, sha string, pairs binary, times binary, "
    "place int, a int, b int, documents long"
)
ROWS = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


# -- tokens and their bytes ----------------------------------------------------------


class ByteLevel:
    """Side A: a byte-level tokenizer file; the text gets a leading space, special tokens' strings are plain text.

    A vocabulary that has a token for each byte (checked) gives every text back.
    """

    def __init__(self, path: str):
        self.enc = PieceEncoder(path, plain=True, most=MOST_PIECES)
        self.bytes = token_bytes(path)
        if len({t for t in self.bytes if len(t) == 1}) < 256:
            raise ValueError(f"{path}: bytes without a token of their own")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.frombuffer(i, "<u4").astype(np.int64) for i in self.enc.encode([" " + t for t in texts])]


class Pieces:
    """Side B: a sentencepiece model, which adds the leading space itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        words = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        self.bytes = [bytes([int(w[3:5], 16)]) if self.model.is_byte(i) else w.replace("▁", " ").encode() for i, w in enumerate(words)]
        self.lengths = np.array(list(map(len, self.bytes)), np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.all = np.frombuffer(b"".join(self.bytes), np.uint8)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(i, np.int64) for i in self.model.encode(texts, num_threads=1)]

    def gives_back(self, ids: list[np.ndarray], texts: list[bytes]) -> np.ndarray:
        """Whether the ids' bytes are the space and the text, for texts that are not empty."""
        sizes = np.array([int(self.lengths[i].sum()) for i in ids], np.int64)
        same = sizes == [len(t) + 1 if t else -1 for t in texts]
        at = np.flatnonzero(same)
        if not len(at):
            return same
        flat = np.concatenate([ids[k] for k in at])
        length = self.lengths[flat]
        made = self.all[np.repeat(self.starts[flat] - (np.cumsum(length) - length), length) + np.arange(length.sum())]
        want = np.frombuffer(b"".join(b" " + texts[k] for k in at), np.uint8)
        wrong = np.searchsorted(np.cumsum(sizes[at]), np.flatnonzero(made != want), "right")
        same[at[wrong]] = False
        return same


_SIDES: dict[tuple[str, str], tuple] = {}


def _sides(a: str, b: str) -> tuple:
    """The worker's two tokenizers, their token lengths, and the digits of all ids before each sign."""
    if (a, b) not in _SIDES:
        x, y = ByteLevel(a), Pieces(b)
        lengths = [np.array(list(map(len, s.bytes)), np.int64) for s in (x, y)]
        words = [f"{i}{sign}".encode() for n, signs in ((len(x.bytes), ",|"), (len(y.bytes), ",;")) for sign in signs for i in range(n)]
        _SIDES[a, b] = x, y, *lengths, words
    return _SIDES[a, b]


# -- lockstep merging ------------------------------------------------------------------


def lanes(starts: np.ndarray, sizes: np.ndarray, lane: int = LANE) -> tuple[np.ndarray, np.ndarray]:
    """Stretches (from, to] of at most ``lane`` bytes of documents that begin at ``starts``."""
    count = -(-sizes // lane)
    doc = np.repeat(np.arange(len(sizes)), count)
    k = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
    low = starts[doc] + k * lane
    return low, np.minimum(low + lane, (starts + sizes)[doc])


def cuts(ends_a: np.ndarray, ends_b: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the A and B tokens that end together, in order, for lanes (low, high] over ascending token ends."""
    pa_, pb = np.searchsorted(ends_a, low, "right"), np.searchsorted(ends_b, low, "right")
    last_a, last_b = np.searchsorted(ends_a, high, "right"), np.searchsorted(ends_b, high, "right")
    found_a, found_b = [], []
    live = (pa_ < last_a) & (pb < last_b)
    state = np.stack([pa_, pb, last_a, last_b])[:, live]
    while state.shape[1]:
        at_a, at_b = ends_a[state[0]], ends_b[state[1]]
        same = at_a == at_b
        found_a.append(state[0][same])
        found_b.append(state[1][same])
        state[0] += at_a <= at_b
        state[1] += at_b <= at_a
        live = (state[0] < state[2]) & (state[1] < state[3])
        if not live.all():
            state = state[:, live]
    if not found_a:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a)
    return a[order], b[order]


# -- links -------------------------------------------------------------------------------


@dataclass
class Groups:
    """Groups of a batch: the first token of each on both sides, and one entry more."""

    a: np.ndarray
    b: np.ndarray

    @property
    def sizes(self) -> tuple[np.ndarray, np.ndarray]:
        return np.diff(self.a), np.diff(self.b)


def _all_pairs(ids_a: np.ndarray, ids_b: np.ndarray, at_a, n_a, at_b, n_b, owner) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Every (owner, A id, B id) of groups given by first token and size."""
    n = n_a * n_b
    g = np.repeat(np.arange(len(n)), n)
    k = np.arange(len(g)) - np.repeat(np.cumsum(n) - n, n)
    return owner[g], ids_a[at_a[g] + k // n_b[g]], ids_b[at_b[g] + k % n_b[g]]


def linked(ids_a: np.ndarray, ids_b: np.ndarray, groups: Groups, doc: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, times) of all links, each pair of a document once; ``pair`` is A id * width + B id.

    A wide group (few, such as long runs of one sign that the tokenizers cut out of step) is
    multiplied out over its distinct ids, with their numbers as times.
    """
    n_a, n_b = groups.sizes
    wide = n_a * n_b > WIDE
    thin = ~wide
    owner, x, y = _all_pairs(ids_a, ids_b, groups.a[:-1][thin], n_a[thin], groups.b[:-1][thin], n_b[thin], doc[thin])
    span = (int(ids_a.max(initial=0)) + 1) * width
    keys, times = np.unique(owner * span + x * width + y, return_counts=True)
    if wide.any():
        more, again = [keys], [times]
        for g in np.flatnonzero(wide).tolist():
            ua, ca = np.unique(ids_a[groups.a[g] : groups.a[g + 1]], return_counts=True)
            ub, cb = np.unique(ids_b[groups.b[g] : groups.b[g + 1]], return_counts=True)
            more.append(doc[g] * span + (ua[:, None] * width + ub).ravel())
            again.append((ca[:, None] * cb).ravel())
        keys, place = np.unique(np.concatenate(more), return_inverse=True)
        times = np.zeros(len(keys), np.int64)
        np.add.at(times, place, np.concatenate(again))
    return keys // span, keys % span, times


def digests(ids_a, ids_b, groups: Groups, of_doc: np.ndarray, size_a: int, size_b: int, words: list[bytes]) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each document; ``of_doc`` has the first group of each, and one entry more."""
    n_a, n_b = groups.sizes
    code = np.empty(len(ids_a) + len(ids_b), np.int64)
    # a token's place: all tokens of both sides before it, the A tokens of its own group included
    before_b, before_a = np.repeat(groups.b[:-1], n_a), np.repeat(groups.a[1:], n_b)
    last_a, last_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    last_a[groups.a[1:] - 1] = True
    last_b[groups.b[1:] - 1] = True
    code[np.arange(len(ids_a)) + before_b] = ids_a + last_a * size_a
    code[np.arange(len(ids_b)) + before_a] = ids_b + last_b * size_b + 2 * size_a
    bounds = (groups.a[of_doc] + groups.b[of_doc]).tolist()
    out = []
    for x, y in zip(bounds, bounds[1:]):
        out.append(hashlib.sha256(b"".join(map(words.__getitem__, code[x:y].tolist()))[:-1]).hexdigest() if y > x else "")
    return out


def block(doc_ids: list, texts: list[bytes], path_a: str, path_b: str) -> tuple[dict, dict]:
    """What is kept of a block: columns of a row per document, and of a row per distinct pair; see ``BLOCKS``."""
    side_a, side_b, length_a, length_b, words = _sides(path_a, path_b)
    kept: tuple[list, list] = [], []
    for some in _some(texts):
        strings = [t.decode() for t in some]
        ids_b = side_b.encode(strings)
        sound = side_b.gives_back(ids_b, some)
        for side, ids in zip(kept, (side_a.encode(strings), ids_b)):
            side += [i if s else i[:0] for i, s in zip(ids, sound)]
    sound = [len(i) > 0 for i in kept[0]]
    flat_a, flat_b = (np.concatenate(side) if side else np.zeros(0, np.int64) for side in kept)
    count_a, count_b = (np.array(list(map(len, side)), np.int64) for side in kept)
    sizes = np.array([len(t) + 1 if s else 0 for t, s in zip(texts, sound)], np.int64)
    ends_a, ends_b = np.cumsum(length_a[flat_a]), np.cumsum(length_b[flat_b])
    cut_a, cut_b = cuts(ends_a, ends_b, *lanes(np.cumsum(sizes) - sizes, sizes))
    groups = Groups(np.concatenate([[0], cut_a + 1]), np.concatenate([[0], cut_b + 1]))
    # the last tokens of a document end together, so every document begins with a group of its own
    of_doc = np.searchsorted(groups.a, np.concatenate([[0], np.cumsum(count_a)]))
    n_groups = np.diff(of_doc)
    doc = np.repeat(np.arange(len(texts)), n_groups)
    n_a, n_b = groups.sizes
    n_links = np.zeros(len(texts), np.int64)
    np.add.at(n_links, doc, n_a * n_b)
    docs, pairs, times = linked(flat_a, flat_b, groups, doc, len(length_b))
    distinct, place, held = np.unique(pairs, return_inverse=True, return_counts=True)
    bounds = np.searchsorted(docs, np.arange(len(texts) + 1)).tolist()
    spans = list(zip(bounds, bounds[1:]))
    place = place.astype("<u4")
    per_document = {
        "doc_id": doc_ids,
        "n_a": count_a,
        "n_b": count_b,
        "n_groups": n_groups,
        "n_links": n_links,
        "sha": digests(flat_a, flat_b, groups, of_doc, len(length_a), len(length_b), words),
        "pairs": [place[x:y].tobytes() for x, y in spans],
        "times": [_narrow(times[x:y]) for x, y in spans],
    }
    per_pair = {
        "place": np.arange(len(distinct)),
        "a": distinct // len(length_b),
        "b": distinct % len(length_b),
        "documents": held,
    }
    return per_document, per_pair


def _some(texts: list[bytes], most: int = 250_000) -> Iterator[list[bytes]]:
    """The texts in lists of about ``most`` bytes."""
    at = np.cumsum([0, *map(len, texts)]) // most
    for g in np.split(np.arange(len(texts)), np.flatnonzero(np.diff(at[:-1])) + 1):
        if len(g):
            yield texts[g[0] : g[-1] + 1]


def _narrow(times: np.ndarray) -> bytes:
    """Numbers in one byte each if they fit, else in eight."""
    return times.astype(np.uint8 if times.max(initial=0) < 256 else "<i8").tobytes()


# -- the corpus ------------------------------------------------------------------------------


def _batch(columns: dict, schema: str) -> pa.RecordBatch:
    """A batch of ``schema`` whose other columns are null."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    size = len(next(iter(columns.values())))
    fields = [c.split() for c in schema.split(", ")]
    arrays = [pa.array(columns[n]).cast(kinds[k]) if n in columns else pa.nulls(size, kinds[k]) for n, k in fields]
    return pa.RecordBatch.from_arrays(arrays, names=[n for n, _ in fields])


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Aligned blocks of ``docs`` (doc_id, text), to be written before use: rows of documents and rows of pairs (``a`` not null)."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[bytes] = []
        size = 0

        def done() -> Iterator[pa.RecordBatch]:
            for columns in block(ids, texts, path_a, path_b):
                n = len(next(iter(columns.values())))
                if n:
                    yield _batch({"block": np.full(n, name), **columns}, BLOCKS)

        for b in batches(parts):
            for i, t in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                ids.append(i)
                texts.append(t)
                size += len(t) + 64
                if size >= block_bytes:
                    yield from done()
                    ids, texts, size, name = [], [], 0, name + 1
        if ids:
            yield from done()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, BLOCKS)


def pair_counts(blocks: DataFrame) -> DataFrame:
    """(a, b, count, best): documents that hold a pair linked, and whether no pair of that A id has more."""
    counts = blocks.where("a is not null").groupBy("a", "b").agg(F.sum("documents").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))  # one row per id of A's vocabulary at most
    return counts.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))


def aligned(docs: DataFrame, path_a: str, path_b: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: see ``ROWS``. ``path_a``: byte-level tokenizer file, ``path_b``: sentencepiece model."""
    blocks = written(aligned_blocks(docs, path_a, path_b, block_bytes), "aligned")
    counts = written(pair_counts(blocks), "pair-counts")
    known = blocks.where("a is not null").join(counts, ["a", "b"]).select(
        F.col("block").alias("of_block"), "place", "count", "best"
    )
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]

    def add_up(rows: pa.Table, found: pa.Table) -> pa.Table:
        count, best = np.zeros(found.num_rows, np.int64), np.zeros(found.num_rows, np.int64)
        place = found.column("place").to_numpy()
        count[place] = found.column("count").to_numpy()
        best[place] = found.column("best").to_numpy()
        pairs = rows.column("pairs").to_pylist()
        times = [np.frombuffer(t, np.uint8 if 4 * len(t) == len(p) else "<i8") for t, p in zip(rows.column("times").to_pylist(), pairs)]
        bounds = np.cumsum([0, *(len(p) // 4 for p in pairs)])
        pair, time = np.frombuffer(b"".join(pairs), "<u4"), np.concatenate([np.zeros(0, np.int64), *times])
        sums = [np.concatenate([[0], np.cumsum(time * of[pair])]) for of in (best, count)]
        n_best, count_sum = (pa.array(s[bounds[1:]] - s[bounds[:-1]]) for s in sums)
        columns = [*(rows.column(c) for c in kept), n_best, count_sum, rows.column("sha")]
        return pa.Table.from_arrays(columns, names=[c.split()[0] for c in ROWS.split(", ")])

    of = blocks.where("a is null").select("block", *kept, "sha", "pairs", "times")
    return of.groupBy("block").cogroup(known.groupBy("of_block")).applyInArrow(add_up, ROWS)
