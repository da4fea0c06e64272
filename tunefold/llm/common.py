"""Helpers that the operators share: scratch tables, safe column names, hashes of words."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunefold.session import scratch_path, shared_dir

#: Bytes of text that a worker hashes at once (its arrays take about 40 times as much).
BLOCK_BYTES = 2_000_000


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of one of the given tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there, so a lost executor costs a re-read."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(prefix: str) -> str:
    """A column name that no input column has."""
    return f"__{prefix}_{uuid.uuid4().hex[:8]}"


def batches(parts: Iterable[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, so that long texts don't add up in a worker."""
    for b in parts:
        if not b.num_rows:
            continue
        step = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for k in range(0, b.num_rows, step):
            yield b.slice(k, step)


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True
#: ASCII bytes other than letters and digits; what cuts words of running text.
SIGNS = np.array([c < 128 and not chr(c).isalnum() for c in range(256)])
_VALUE = np.random.default_rng(7).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_STEP = np.array([pow(_BASE, 1, 2**64)], np.uint64), np.array([pow(_BASE, -1, 2**64)], np.uint64)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k in (0, 1):
            _POWERS[k] = np.multiply.accumulate(np.r_[np.ones(1, np.uint64), np.repeat(_STEP[k], n)])
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit depends on every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hash_block(texts: list[bytes], gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    a = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
    edge = np.diff(gaps[a].view(np.int8))
    starts, ends = np.flatnonzero(edge < 0) + 1, np.flatnonzero(edge > 0) + 1
    up, down = _powers(len(a) + 1)
    sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_VALUE[_LOWER[a]] * up[: len(a)])]
    hashes = mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))
    bounds = np.cumsum([1, *(len(t) + 1 for t in texts)])
    return hashes, np.searchsorted(starts, bounds), starts, ends


def word_hashes(texts: list[bytes], gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the ASCII-lower-cased words of UTF-8 texts, one after another, and where each text's begin.

    A word is a run of bytes that are no gaps (ASCII white space, unless told otherwise). The second array has one entry more than there are texts.
    A text longer than a block is hashed in blocks that end at white space.
    """
    if sum(map(len, texts)) <= 2 * BLOCK_BYTES:
        return _hash_block(texts, gaps)[:2]
    found, bounds = [], [0]
    for t in texts:
        at, n = 0, 0
        while at < len(t):
            end = min(len(t), at + BLOCK_BYTES)
            while end < len(t) and not gaps[t[end]]:
                end += 1
            h = _hash_block([t[at:end]], gaps)[0]
            found.append(h)
            n += len(h)
            at = end
        bounds.append(bounds[-1] + n)
    return (np.concatenate(found) if found else np.zeros(0, np.uint64)), np.array(bounds)


_TURN = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of ``k`` words; of the whole sequence if it has fewer; none if it is empty."""
    n = len(words)
    if not n:
        return words
    if n < k:
        return mix((words * _TURN[:n]).sum(keepdims=True) + np.uint64(n))
    total = words[: n - k + 1] * _TURN[0]
    for j in range(1, k):
        total = total + words[j : n - k + 1 + j] * _TURN[j]
    return mix(total + np.uint64(k))


def utf8(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of strings; null as empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def sessions_scratch(spark: SparkSession) -> str:
    """The folder that driver and executors share."""
    return shared_dir(spark)


def row_key(*columns: str):
    """A 64-bit key of a row's columns in which null has its own value."""
    return F.xxhash64(*(F.coalesce(F.col(c).cast("string"), F.lit("\x00")) for c in columns))
