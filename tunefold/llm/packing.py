"""Packing of documents into token sequences by Karmarkar-Karp multiway differencing (operator 6).

A document's ids (an end id after them) are cut into pieces of at most ``piece``
tokens. A task gathers pieces until it holds about ``block`` tokens and deals
them to ``ceil(tokens / capacity)`` windows: every piece starts as a partial
partition of its own (one loaded window, the others empty), and the two partial
partitions of widest spread are merged again and again, the fullest windows of
one on the emptiest of the other, until one is left. If its fullest window
exceeds the capacity, the count of windows rises by one and the block is dealt
anew. Many small pieces a window keep the spread far below the slack, so the
first or second count nearly always fits.

At scale: no shuffle and nothing on the driver. A block is the work of one task
on its own rows and is bounded by ``block`` tokens plus one document, whatever
the input's size; a hot source or a group of copies is dealt like any rows. A
task that is run again reads the same split of the same files and gives the
same sequences; pass a table (not the result of a shuffle) as input.

Rows: null text counts as empty (a document of the end id alone); null and
repeated doc_ids are kept, row by row; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import batches
from tunefold.llm.tokens import encoder

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, sequence_tokens long"
)
#: Sequences of a task that its numbers leave room for.
PER_TASK = 1 << 36


def difference(sizes: list[int], k: int) -> list[list[int]]:
    """Deals pieces of the given sizes to ``k`` windows by multiway differencing; each window's pieces by index."""
    # A node is a piece or two nodes joined; a partial partition keeps its loaded windows only, fullest first.
    left, right = [-1] * len(sizes), [-1] * len(sizes)
    heap = [(-s, i, [s], [i]) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    tick = len(sizes)
    if not heap:
        return [[] for _ in range(k)]
    while len(heap) > 1:
        _, _, a, na = heapq.heappop(heap)
        _, _, b, nb = heapq.heappop(heap)
        over = len(a) + len(b) - k
        if over <= 0:
            loads, nodes = a + b, na + nb
        else:  # the emptiest of a meet the emptiest of b, in opposing order
            keep_a, keep_b = len(a) - over, len(b) - over
            loads, nodes = a[:keep_a] + b[:keep_b], na[:keep_a] + nb[:keep_b]
            for j in range(over):
                left.append(na[keep_a + j])
                right.append(nb[len(b) - 1 - j])
                nodes.append(len(left) - 1)
                loads.append(a[keep_a + j] + b[len(b) - 1 - j])
        order = sorted(range(len(loads)), key=loads.__getitem__, reverse=True)
        loads, nodes = [loads[i] for i in order], [nodes[i] for i in order]
        spread = loads[0] - (loads[-1] if len(loads) == k else 0)
        heapq.heappush(heap, (-spread, tick, loads, nodes))
        tick += 1
    out = []
    for node in heap[0][3]:
        stack, items = [node], []
        while stack:
            x = stack.pop()
            if left[x] < 0:
                items.append(x)
            else:
                stack += [left[x], right[x]]
        out.append(sorted(items))
    return out + [[] for _ in range(k - len(out))]


def windows(sizes: list[int], capacity: int) -> list[list[int]]:
    """The fewest windows, from the sum of sizes upwards, in which differencing keeps to the capacity."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        found = difference(sizes, k)
        if all(sum(sizes[i] for i in w) <= capacity for w in found):
            return [w for w in found if w]
        k += 1


def pack(
    docs: DataFrame, path: str, capacity: int = 2048, piece: int = 512, block: int = 1_000_000, end_id: int = 1
) -> DataFrame:
    """One row per piece: where it lies in its document and in its sequence, and a checksum of its ids.

    ``path``: tokenizer file. ``block``: tokens that are dealt together.
    """

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, end = encoder(path), np.array([end_id], "<u4").tobytes()
        task, made = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []
        held = 0

        def dealt() -> pa.RecordBatch:
            nonlocal made, rows, held
            out = []
            full = [i for i, r in enumerate(rows) if r[2] == capacity]
            rest = [i for i, r in enumerate(rows) if r[2] < capacity]
            found = [[i] for i in full] + [[rest[j] for j in w] for w in windows([rows[i][2] for i in rest], capacity)]
            for w in found:
                at, total = 0, sum(rows[i][2] for i in w)
                for i in w:
                    out.append((*rows[i], task * PER_TASK + made, at, total))
                    at += rows[i][2]
                made += bool(w)
            rows, held = [], 0
            names = [c.split()[0] for c in SCHEMA.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=names)

        for b in batches(parts, 500_000):
            for doc, ids in zip(b.column(0).to_pylist(), enc.encode([t or "" for t in b.column(1).to_pylist()])):
                ids += end
                n = len(ids) // 4
                whole = n // capacity * capacity  # full windows need no neighbours
                cuts = [*range(0, whole, capacity), *range(whole, n, piece), n]
                for x, y in zip(cuts, cuts[1:]):
                    rows.append((doc, x, y - x, zlib.crc32(ids[4 * x : 4 * y]), n))
                held += n
                if held >= block:
                    yield dealt()
        if rows:
            yield dealt()

    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(run, SCHEMA)


def padding(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """One row: sequences, tokens and the share of padding."""
    one = pieces.where("offset = 0").agg(
        F.count("*").alias("sequences"), F.coalesce(F.sum("sequence_tokens"), F.lit(0)).alias("tokens")
    )
    return one.withColumn("padding", F.expr(f"1 - tokens / (sequences * {capacity}D)"))
