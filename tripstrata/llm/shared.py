"""Helpers of several operators: scratch tables, connected components, word hashes of text batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of `spark.checkpoint.dir`; a local session without it gets a temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(frame: DataFrame) -> DataFrame:
    """The frame written as a table in the shared folder and read again, which cuts its lineage."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node reachable from each node: (node, component) for every node of `edges` (a, b: bigint).

    Alternates large-star and small-star steps until the edges no longer change. Every step is one shuffle
    by node of at most as many rows as there are edges; each round's edges are stored, so a lost executor
    repeats one round. A node of any degree only ever takes part in a minimum and a join that Spark can
    split. Self loops give single nodes; null ends are ignored.
    """
    known = edges.select(F.col("a").cast("bigint"), F.col("b").cast("bigint")).where("a IS NOT NULL AND b IS NOT NULL")
    nodes = known.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    now = stored(known.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    print_of = lambda f: f.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    before = print_of(now)
    while before[0]:
        both = now.union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array("a", "b")).alias("x"), F.col("m")).where("x <> m")
        now = stored(small.select(F.greatest("x", "m").alias("a"), F.least("x", "m").alias("b")).distinct())
        after = print_of(now)
        if after == before:
            break
        before = after
    root = now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("root"))
    return nodes.join(root, "node", "left").select("node", F.coalesce("root", "node").alias("component"))


# ---- Word hashes of a batch of texts, without a Python loop over words -----------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit mixing function (the finalizer of splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(n: int) -> np.ndarray:
    out = np.ones(max(n, 1), np.uint64)
    np.multiply.accumulate(np.full(max(n - 1, 0), _BASE, np.uint64), out=out[1:])
    return out


def word_hashes(texts: list[bytes], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and the offset of each text's first word (one more at the end).

    Words are runs of bytes other than space and tab to carriage return. A word's hash depends on its bytes alone.
    """
    lengths = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    joined = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    if lower:
        joined = _LOWER[joined]
    inside = ~_SPACE[joined]
    edge = np.diff(inside.astype(np.int8), prepend=0)
    starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if len(stops) < len(starts):
        stops = np.append(stops, len(joined))
    offsets = np.searchsorted(starts, np.concatenate(([0], np.cumsum(lengths))))
    if not len(starts):
        return np.empty(0, np.uint64), offsets
    # A word's value is the sum of byte * base ** place; the place counts from the word's first byte.
    place = np.arange(len(joined)) - np.repeat(np.concatenate(([0], starts)), np.diff(np.concatenate(([0], starts, [len(joined)]))))
    value = (joined.astype(np.uint64) + np.uint64(1)) * _powers(int(place.max()) + 1)[place]
    value[~inside] = 0
    return mixed(np.add.reduceat(value, starts) + (stops - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), offsets


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    size = len(words) - n + 1
    out = np.zeros(max(size, 0), np.uint64)
    for i in range(n if size > 0 else 0):
        out = mixed(out * _BASE + words[i : i + size])
    return out


def slices(texts: list, size: int = 4_000_000) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts of about `size` bytes together, at least one text each."""
    at = held = 0
    for i, text in enumerate(texts):
        if held and held + len(text) > size:
            yield at, i
            at, held = i, 0
        held += len(text)
    if at < len(texts):
        yield at, len(texts)
