"""Nearest neighbours with a hierarchical k-means tree and best-bin-first search (operator 10).

The tree is fitted on a bounded sample (``SAMPLE`` rows of smallest hash): every
node splits its rows by k-means into ``BRANCH`` children until it holds ``LEAF``
of them. The tree is therefore bounded too (about ``SAMPLE * BRANCH / LEAF``
centres at most) and travels with the tasks. Every row of the table is indexed:
it descends to the child of nearest centre, down to a leaf.

A query walks the tree with a priority queue of branches by distance to their
centres: it descends along the nearest child, queues the others, and takes the
nearest queued branch next, one leaf after another. How many leaves are visited
is calibrated: probes from the sample are searched in the sample, and the count
is widened until ``RECALL`` of their true neighbours lie in visited leaves. A query
goes on past that count until the leaves visited hold ``k`` rows besides its own, so
it gets ``k`` rows wherever there are so many candidates.

Leaves are packed into shards of about ``SHARD`` rows; a leaf of more rows (one
very common vector) is dealt to several shards by hash. A query goes to the
shards of its leaves, with the list of those leaves, and is compared there with
every row of them, in blocks of ``QUERIES`` queries; its best of each shard meet
in a top-k that Spark limits before the shuffle.

Rows: vectors that are null, zero, of another length than the commonest one (the
longer on a tie), or that hold null or non-finite components take no part, nor do
rows without vec_id. A query's own row is any row of its vec_id; a vec_id that
repeats is one query (its first vector by value order) and each of its rows is a
candidate for others. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunefold.llm.common import written

#: Rows of the fitting sample, children of a node, sample rows of a leaf, probes, recall that calibration asks for.
SAMPLE, BRANCH, LEAF, PROBES, RECALL = 20_000, 8, 64, 300, 0.97
#: Rows of a shard and queries of a block.
SHARD, QUERIES = 4096, 2048


class Tree:
    """Centres of a hierarchical k-means tree; leaves are numbered from left to right."""

    def __init__(self, rows: np.ndarray, branch: int = BRANCH, leaf: int = LEAF):
        self.centres: list[np.ndarray | None] = []
        self.children: list[list[int]] = []
        self.leaf_of: list[int] = []
        self.leaves = 0
        self._rng = np.random.default_rng(5)
        self._grow(rows, branch, leaf)

    def _grow(self, rows: np.ndarray, branch: int, leaf: int) -> int:
        me = len(self.children)
        self.children.append([])
        self.centres.append(None)
        self.leaf_of.append(-1)
        groups = []
        if len(rows) > leaf:
            centres, near = self._means(rows, branch)
            groups = [near == j for j in range(len(centres))]
            groups = [g for g in groups if g.any()]
        if len(groups) < 2:
            self.leaf_of[me] = self.leaves
            self.leaves += 1
            return me
        self.centres[me] = np.array([rows[g].mean(axis=0) for g in groups])
        self.children[me] = [self._grow(rows[g], branch, leaf) for g in groups]
        return me

    def _means(self, rows: np.ndarray, k: int, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
        centres = rows[self._rng.choice(len(rows), min(k, len(rows)), replace=False)]
        for _ in range(rounds):
            near = distances(rows, centres).argmin(axis=1)
            moved = np.array([rows[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centres)])
            if np.allclose(moved, centres):
                break
            centres = moved
        return centres, distances(rows, centres).argmin(axis=1)

    def assign(self, rows: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.zeros(len(rows), np.int64)
        todo = [(0, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if not self.children[node]:
                out[at] = self.leaf_of[node]
                continue
            near = distances(rows[at], self.centres[node]).argmin(axis=1)
            todo += [(c, at[near == j]) for j, c in enumerate(self.children[node]) if (near == j).any()]
        return out

    def search(self, query: np.ndarray, most: int, counts: np.ndarray | None = None, need: int = 0) -> list[int]:
        """The first ``most`` leaves in best-bin-first order, and more until their ``counts`` of rows add up to ``need``."""
        queue, out, held = [(0.0, 0)], [], 0
        while queue and (len(out) < most or held < need):
            _, node = heapq.heappop(queue)
            while self.children[node]:
                far = ((self.centres[node] - query) ** 2).sum(axis=1).tolist()
                best = far.index(min(far))
                for j, c in enumerate(self.children[node]):
                    if j != best:
                        heapq.heappush(queue, (far[j], c))
                node = self.children[node][best]
            out.append(self.leaf_of[node])
            held += int(counts[out[-1]]) if counts is not None else 0
        return out


def distances(rows: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, fast; good enough to choose branches."""
    return (rows**2).sum(axis=1)[:, None] - 2 * rows @ centres.T + (centres**2).sum(axis=1)


def calibrated(tree: Tree, rows: np.ndarray, k: int, recall: float = RECALL, probes: int = PROBES) -> int:
    """Leaves to visit until probes from ``rows`` find ``recall`` of their ``k`` nearest among ``rows``."""
    if len(rows) < 2:
        return tree.leaves
    leaf = tree.assign(rows)
    chosen = np.linspace(0, len(rows) - 1, min(probes, len(rows))).astype(int)
    ranks = []
    for p in chosen:
        far = ((rows - rows[p]) ** 2).sum(axis=1)
        far[p] = np.inf
        near = np.argpartition(far, min(k, len(rows) - 1) - 1)[: min(k, len(rows) - 1)]
        place = np.empty(tree.leaves, np.int64)
        place[tree.search(rows[p], tree.leaves)] = np.arange(tree.leaves)
        ranks.append(place[leaf[near]])
    ranks = np.concatenate(ranks)
    visits = 1
    while visits < tree.leaves and (ranks < visits).mean() < recall:
        visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding (doubles) of the vectors that take part."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    fine = rows.where(
        "vec_id is not null and embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < double('Infinity'))"
        " and exists(embedding, x -> x <> 0)"
    )
    length = fine.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return fine.where(F.size("embedding") == (length.n if length else 0))


def nearest(vectors: DataFrame, is_query: str = "vec_id % 100 = 0", k: int = 10) -> DataFrame:
    """query_id, rank, vec_id and score (Euclidean distance) of the ``k`` nearest of each query."""
    rows = usable(vectors)
    by_hash = rows.select("vec_id", "embedding").orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    sample = _matrix(by_hash.select("embedding").toArrow().column(0).combine_chunks())
    tree = Tree(sample)
    visits = calibrated(tree, sample, k)

    def indexed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            leaf = tree.assign(_matrix(b.column(1)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf)], names=["vec_id", "embedding", "leaf"])

    leaves = written(rows.mapInArrow(indexed, "vec_id long, embedding array<double>, leaf long"), "ann-leaves")
    # leaves to shards: one number a leaf, bounded by the tree
    counts = np.zeros(tree.leaves, np.int64)
    for r in leaves.groupBy("leaf").count().collect():
        counts[r.leaf] = r["count"]
    first, parts_of, shard, held = np.zeros(tree.leaves, np.int64), np.ones(tree.leaves, np.int64), 0, 0
    for j, n in enumerate(counts.tolist()):
        if held and held + n > SHARD:
            shard, held = shard + 1, 0
        first[j], parts_of[j] = shard, max(1, -(-n // SHARD))
        held += n
        if n > SHARD:
            shard, held = shard + int(parts_of[j]), 0
    place = F.create_map(*(F.lit(x) for j in range(tree.leaves) for x in (j, int(first[j]) * (1 << 20) + int(parts_of[j]))))
    queries = rows.where(is_query).groupBy("vec_id").agg(F.min("embedding").alias("embedding"), F.count("*").alias("own"))
    queries = written(queries, "ann-queries")
    blocks = max(1, -(-queries.count() // QUERIES))

    def routed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in parts:
            out = []
            for q, v, x, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), _matrix(b.column(1)), b.column(2).to_pylist()):
                to: dict[int, list[int]] = {}
                for j in tree.search(x, visits, counts, k + own):
                    for s in range(int(first[j]), int(first[j] + parts_of[j])):
                        to.setdefault(s, []).append(j)
                out += [(s, q, v, sorted(at)) for s, at in to.items()]
            types = [pa.int64(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int64())]
            names = ["shard", "query_id", "vector", "leaves"]
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    asked = queries.mapInArrow(routed, "shard long, query_id long, vector array<double>, leaves array<long>")
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    where = place[F.col("leaf")]
    shard_of = F.shiftright(where, 20) + F.pmod(F.xxhash64("vec_id"), where.bitwiseAND((1 << 20) - 1))
    dealt = leaves.withColumn("shard", shard_of)
    dealt = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))).withColumn("block", F.col("block").cast("long"))

    def compared(members: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(members) and len(asking):
            members = members.sort_values(["leaf", "vec_id"], kind="stable")
            ids, leaf = members["vec_id"].to_numpy(), members["leaf"].to_numpy()
            x = np.array(members["embedding"].tolist(), np.float64)
            for q, v, at in zip(asking["query_id"], asking["vector"], asking["leaves"]):
                rows_at = np.flatnonzero(np.isin(leaf, np.asarray(at)) & (ids != q))
                if not len(rows_at):
                    continue
                far = np.sqrt(((x[rows_at] - np.asarray(v, np.float64)) ** 2).sum(axis=1))
                if len(far) > k:  # all that tie with the k-th stay in until ids decide
                    edge = np.partition(far, k - 1)[k - 1]
                    rows_at, far = rows_at[far <= edge], far[far <= edge]
                best = np.lexsort((ids[rows_at], far))[:k]
                out += [(q, i, d) for i, d in zip(ids[rows_at][best], far[best])]
        return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])

    found = (
        dealt.groupBy("shard", "block")
        .cogroup(asked.groupBy("shard", "block"))
        .applyInPandas(compared, "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
