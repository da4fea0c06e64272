"""Near-duplicate groups by MinHash (operator 9).

1. A task hashes each text's word shingles, keeps the distinct ones as its set,
   and computes many universal hash minima (``a * x + b`` modulo 2**64, the high
   32 bits) and a 128-bit key of the set.
2. Texts of equal sets collapse to one representative (partial aggregates), so
   a group of copies of any size costs one row from here on.
3. Representatives meet in bands of ``ROWS`` minima. The number of bands follows
   from the threshold so that a pair at it is missed with probability 1e-6.
   Within a band's bucket every member is compared with one hub, never all with
   all; hubs differ between ``CHOICES`` classes of bands, so a member of a large
   group meets several. A compared pair is first checked on the signatures (five
   standard errors below the threshold) and then on the full sets, exactly.
4. Components of the links are found by alternating large-star and small-star.
5. A bucket whose members are then in several components is not finished. What
   no other open member shares of a member's set bounds its similarity to all of
   them, exactly; members without a possible partner in their bucket leave it.
   Of the members outside the bucket's largest component ``HUBS`` a round become
   hubs, are compared on full sets with all members of other components that the
   same bound allows, and leave. They are compared in blocks (a group is a bucket,
   a block of hubs and a block of members, ``BLOCK`` bytes of sets each), of which
   only the links come out. Rounds go on until no bucket has members of two
   components: no pair of a bucket in different components stays unchecked, and
   there is no cap on buckets.

At scale: texts are read twice and never shuffled except the few that take part
in a comparison. Hot buckets and hubs meet in sort-merge joins that AQE splits;
nothing but the counts that end a loop comes to the driver. Every step's result
is a written table in the shared folder.

Rows: null or blank text has the empty set and is linked with nothing; a row
without doc_id is linked with nothing and has no component (kept). A node is a set
of shingles, numbered for the run: texts of one doc_id and different sets are nodes
of their own. A component is named by its least doc_id; all rows of that id in it are
``kept``, and of their texts one ``stays``. Extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunefold.llm.common import batches, shingles, utf8, word_hashes, written

#: Minima of a band, hubs a member meets at first, hubs of a bucket in later rounds, and the chance that bands miss a pair at the threshold.
ROWS, CHOICES, HUBS, MISS = 5, 6, 256, 1e-6
#: Members and bytes of sets of a block.
MEMBERS, BLOCK = 1024, 4_000_000

_RANDOM = np.random.default_rng(2023)
_A = _RANDOM.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RANDOM.integers(0, 2**64, 4096, dtype=np.uint64)


def band_count(threshold: float, rows: int = ROWS, miss: float = MISS) -> int:
    """Bands that miss a pair at the threshold with probability ``miss`` at most."""
    return math.ceil(math.log(miss) / math.log(1 - threshold**rows))


def minima(found: np.ndarray, n: int) -> np.ndarray:
    """The high 32 bits of the ``n`` universal hash minima of a set."""
    low = np.full(n, 2**64 - 1, np.uint64)
    for k in range(0, len(found), 2048):
        h = found[None, k : k + 2048] * _A[:n, None] + _B[:n, None]
        np.minimum(low, h.min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, at = word_hashes(utf8(column))
    for a, b in zip(at.tolist(), at[1:].tolist()):
        yield np.unique(shingles(words[a:b], k))


def sketches(docs: DataFrame, k: int, hashes: int) -> DataFrame:
    """doc_id, hash of the text, set size, key of the set and signature of every row."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            size, key, sig = [], [], []
            for s in sets(b.column(2), k):
                size.append(len(s))
                key.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                sig.append(minima(s, hashes).tobytes() if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(size, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())],
                names=["doc_id", "text_hash", "n", "set_key", "sig"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash string, n long, set_key binary, sig binary")


def text_hash():
    """A hash that tells texts apart; that of null is no text's."""
    return F.coalesce(F.md5("text"), F.lit("null"))


def _agreeing(pairs: DataFrame, sigs: DataFrame, least: float) -> DataFrame:
    """Pairs (u, v) whose signatures agree in a share of ``least`` of their minima."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            a, c = (np.frombuffer(b"".join(b.column(i).to_pylist()), "<u4").reshape(b.num_rows, -1) for i in (2, 3))
            yield b.select(["u", "v"]).filter(pa.array((a == c).mean(axis=1) >= least))

    of = lambda x: sigs.select(F.col("rep").alias(x), F.col("sig").alias(f"sig_{x}"))
    both = pairs.join(of("v"), "v").join(of("u"), "u")
    return both.select("u", "v", "sig_u", "sig_v").mapInArrow(run, "u long, v long")


def _full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """Sorted set (as bytes) of each representative in ``ids`` (rep, doc_id, text_hash)."""

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found = [s.tobytes() for s in sets(b.column(1), k)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.binary())], names=["rep", "found"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"), "text")
    rows = rows.join(ids, ["doc_id", "text_hash"]).select("rep", "text")  # rows that repeat are of one text
    return rows.dropDuplicates(["rep"]).mapInArrow(find, "rep long, found binary")


def _linked(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""

    def compare(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            keep = []
            for x, y in zip(b.column(2).to_pylist(), b.column(3).to_pylist()):
                s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(s, t, assume_unique=True))
                keep.append(100 * both >= percent * (len(s) + len(t) - both))
            yield b.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    of = lambda x: full.select(F.col("rep").alias(x), F.col("found").alias(f"found_{x}"))
    both = pairs.join(of("v"), "v").join(of("u"), "u")
    return both.select("u", "v", "found_u", "found_v").mapInArrow(compare, "u long, v long")


def _block_links(members: DataFrame, hubs: DataFrame, percent: int) -> DataFrame:
    """Links between hubs and members of a block and of different components.

    ``members`` and ``hubs``: key, block, rep, n, s, c, found. A link is (u, v) as in ``_linked``.
    """

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        u, v = [], []
        if left.num_rows and right.num_rows:
            rep, n, s, c = (left.column(x).to_numpy() for x in ("rep", "n", "s", "c"))
            found = [np.frombuffer(x, np.uint64) for x in left.column("found").to_pylist()]
            flat, at = np.concatenate(found), np.r_[0, np.cumsum([len(f) for f in found])[:-1]]
            for h in right.rename_columns([x.removeprefix("hub_") for x in right.column_names]).to_pylist():
                both = np.minimum(s, h["s"])
                may = (c != h["c"]) & (100 * both >= percent * (n + np.maximum(h["n"], both) - both))
                if not may.any():
                    continue
                mine = np.frombuffer(h["found"], np.uint64)
                place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                both = np.add.reduceat((mine[place] == flat).astype(np.int64), at)
                for r in rep[may & (100 * both >= percent * (n + len(mine) - both))].tolist():
                    u.append(min(r, h["rep"]))
                    v.append(max(r, h["rep"]))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    others = hubs.select(*(F.col(x).alias(f"hub_{x}") for x in hubs.columns))
    pairs = members.groupBy("key", "block").cogroup(others.groupBy("hub_key", "hub_block"))
    return pairs.applyInArrow(compare, "u long, v long").distinct()


def _own(full: DataFrame, ids: DataFrame) -> DataFrame:
    """(rep, own): shingles of a representative that no other one in ``ids`` has; none, no row."""

    def spread(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches(parts):
            found = [np.frombuffer(x, np.int64) for x in b.column(1).to_pylist()]
            reps = np.repeat(b.column(0).to_numpy(), [len(f) for f in found])
            yield pa.RecordBatch.from_arrays([pa.array(reps), pa.array(np.concatenate(found))], names=["rep", "shingle"])

    rows = full.join(ids, "rep", "left_semi").mapInArrow(spread, "rep long, shingle long")
    once = rows.groupBy("shingle").agg(F.min("rep").alias("rep"), F.max("rep").alias("last")).where("rep = last")
    return once.groupBy("rep").agg(F.count("*").alias("own"))


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of the links (u, v): the smallest node reachable.

    Alternating large-star and small-star; each step is a minimum per node (a partial aggregate) joined back.
    """
    high, low_of = F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")
    edges = written(links.where("u <> v").select(high, low_of).distinct(), "near-edges")
    state = None
    while True:
        # large-star: the larger neighbours of a node move to its least one
        both = edges.union(edges.select("v", "u"))
        low = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        large = large.where("u <> v").distinct()
        # small-star: every edge points from its larger end now; the smaller neighbours move to the least one
        least = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(least, "u").select(F.col("v").alias("u"), F.col("low").alias("v")).where("u <> v")
        edges = written(moved.union(least.select("u", "low")).distinct(), "near-star")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    # stars now: every node points at the smallest of its component
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _open(at: DataFrame) -> DataFrame:
    """Members of the buckets that hold more than one component."""
    per = at.groupBy("key").agg(F.min("c").alias("first"), F.max("c").alias("last")).where("first < last")
    return at.join(per.select("key"), "key", "left_semi")


def _possible(s: str, t: str, n: str, m: str, percent: int):
    """Whether two sets can reach the threshold, where the first has ``n`` shingles, ``s`` of them shared with anybody,
    and the second has ``m`` or more, ``t`` of them or fewer shared."""
    both = F.least(s, t)
    return 100 * both >= percent * (F.col(n) + F.greatest(F.col(m), both) - both)


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``; parameters as for ``judged``."""
    return judged(docs, k, percent).select("doc_id", "n_shingles", "component_id", "kept")


def judged(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, kept and stays of every row of ``docs``.

    ``stays``: the row is of the one text that stands for its component.
    ``k``: words of a shingle. ``percent``: documents link from this Jaccard similarity of their sets, in hundredths.
    """
    t = percent / 100
    bands = band_count(t)
    hashes = bands * ROWS
    least = t - 5 * math.sqrt(t * (1 - t) / hashes)
    sketch = written(sketches(docs, k, hashes), "near-sketch")
    groups = sketch.where("n > 0 and doc_id is not null").groupBy("set_key").agg(F.min(F.struct("doc_id", "text_hash")).alias("x"))
    groups = written(groups.select("set_key", "x.*", F.monotonically_increasing_id().alias("rep")), "near-groups")
    reps = groups.select("rep", "doc_id", "text_hash")
    sigs = sketch.where("n > 0").join(reps, ["doc_id", "text_hash"]).select("rep", "n", "sig")
    sigs = written(sigs.dropDuplicates(["rep"]), "near-signatures")
    key = lambda i: F.xxhash64(F.lit(i), F.substring("sig", 4 * ROWS * i + 1, 4 * ROWS))
    member = sigs.select("rep", "n", F.posexplode(F.array(*(key(i) for i in range(bands)))).alias("band", "key"))
    turn_of = F.xxhash64("rep", F.col("band") % CHOICES)
    hubs = member.groupBy("key").agg(F.min_by("rep", turn_of).alias("hub"), F.count("*").alias("m")).where("m > 1")
    shared = written(member.join(hubs.drop("m"), "key").select("key", "rep", "n", "hub"), "near-buckets")
    full = written(_full_sets(docs, reps.join(shared.select("rep").distinct(), "rep"), k), "near-sets")
    apart = shared.where("hub <> rep")
    pairs = apart.select(F.least("hub", "rep").alias("u"), F.greatest("hub", "rep").alias("v")).distinct()
    active = apart.select("key", "rep", "n").withColumn("s", F.col("n"))  # the hub has met them all
    agreeing = written(_agreeing(pairs, sigs, least), "near-agreeing")
    links, turn = written(_linked(agreeing, full, percent), "near-links"), 0
    parts = written(components(links), "near-parts")
    while True:
        # open buckets: active members of several components
        at = active.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
        at = at.select("key", "rep", "n", "s", F.coalesce("component", "rep").alias("c"))
        at = written(_open(at), "near-open")
        if turn == 0:
            own = _own(full, at.select("rep").distinct())
            at = at.join(own, "rep", "left").withColumn("s", F.col("n") - F.coalesce("own", F.lit(0))).drop("own")
            at = written(at, "near-shares")
        per = at.groupBy("key").agg(F.min("n").alias("low"), F.max("s").alias("high"))
        at = at.join(per, "key").where(_possible("s", "high", "n", "low", percent)).drop("low", "high")
        at = written(_open(at), "near-possible")
        if at.isEmpty():
            break
        # all but the largest component's members are to be hubs, some in every round
        by = at.groupBy("key", "c").agg(F.count("*").alias("m"), F.sum("n").alias("size"))
        per = by.groupBy("key").agg(
            F.sum("m").alias("members"), F.sum("size").alias("size"), F.max(F.struct("m", "c")).alias("most")
        )
        left = F.col("members") - F.col("most.m")
        per = per.select(
            "key",
            F.col("most.c").alias("most"),
            F.greatest(F.ceil(left / HUBS), F.ceil(F.col("size") * 8 / BLOCK)).alias("rounds"),
            F.greatest(F.ceil(F.col("members") / MEMBERS), F.ceil(F.col("size") * 8 / BLOCK)).alias("blocks"),
        )
        told = written(at.join(per, "key"), "near-told")
        now = (F.col("c") != F.col("most")) & (F.pmod(F.xxhash64("rep", "key", F.lit(turn)), F.col("rounds")) == 0)
        told = told.withColumn("hub", now)
        sets_of = lambda df: df.join(full, "rep")
        blocks = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
        hubs = sets_of(told.where("hub")).withColumn("block", blocks)
        members = sets_of(told).withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        wanted = ["key", "block", "rep", "n", "s", "c", "found"]
        new = written(_block_links(members.select(*wanted), hubs.select(*wanted), percent), "near-links")
        if not new.isEmpty():
            links = links.union(new)
            parts = written(components(links), "near-parts")
        active = told.where("not hub").select("key", "rep", "n", "s")
        turn += 1
    whole = groups.join(parts.withColumnRenamed("node", "rep"), "rep", "left")
    whole = whole.withColumn("c", F.coalesce("component", "rep")).select("set_key", "doc_id", "text_hash", "c")
    lead = whole.groupBy("c").agg(F.min(F.struct("doc_id", "text_hash", "set_key")).alias("lead"))
    whole = whole.join(lead, "c").select("set_key", "lead")
    out = sketch.select("doc_id", "text_hash", "n", "set_key").join(whole, "set_key", "left")
    linked = (F.col("n") > 0) & F.col("doc_id").isNotNull()
    component = F.when(linked, F.col("lead.doc_id")).otherwise(F.col("doc_id"))
    kept = ~linked | (F.col("doc_id") == F.col("lead.doc_id"))
    stays = ~linked | (F.struct("doc_id", "set_key", "text_hash") == F.struct("lead.doc_id", "lead.set_key", "lead.text_hash"))
    return out.select(
        "doc_id",
        "text_hash",
        F.col("n").alias("n_shingles"),
        component.alias("component_id"),
        kept.alias("kept"),
        stays.alias("stays"),
    )
