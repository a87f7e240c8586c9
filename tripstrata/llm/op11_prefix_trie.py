"""Prefix trie over conversations: which openings are shared, and what they would save.

Nodes are found by grouping digests of prefixes, so a prefix that many conversations share leaves each map task as
one row. Subtree sums need parents and children together. The tree is therefore cut into shards of bounded size: a
node whose subtree may be large belongs to the trunk, every other one to the shard of the topmost node above it that
is not in the trunk. A shard's digests get slots of a minimal perfect hash, its counts are scattered into flat arrays
by slot, and sums run over the parents' slots from the deepest level up. The trunk, now with its shards' sums, is the
next, much smaller tree, treated alike until nothing is left.

Defined results: rows without conv_id belong to no conversation. Turns that share a place in the order (equal or null
turns) follow each other by role, then by the digest of role and text. Null roles and texts count as empty; no rows
give no nodes. Other columns are neither read nor passed on. A digest is 128 bits, taken from SHA-256 of place, role
and text of every turn, so it stands for the turns themselves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.shared import WORD, mixed, stored

#: Conversations whose first turns are those of one of them, and the most turns that are taken from it.
FAMILY, HEAD = 20, 3
#: Nodes of a shard; a packed shard holds about as many.
SHARD_NODES = 16_384
#: Ids that are joined into one text before the texts of a node meet.
IDS_PER_TEXT = 4_096

_D, _P = ["d1", "d2"], ["p1", "p2"]


# ---- Turns of rebuilt conversations --------------------------------------------------------------------------


def _half(digest: Column, at: int) -> Column:
    """16 hexadecimal digits as a signed bigint."""
    return F.conv(F.substring(digest, at, 16), 16, -10).cast("bigint")


def rebuilt_turns(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns (conv, pos from 1, last, a, b, words) of the rebuilt conversations, and all conversations (conv, length).

    (a, b) is the digest of place, role and text. A conversation takes its first h = crc32(id) % 4 turns from the one
    whose id is its own rounded down to a multiple of 20, and the rest from itself.
    """
    said = conversations.select(
        F.col(conv).cast("bigint").alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).where("conv IS NOT NULL")
    # The length before the role keeps (role, text) pairs apart whose joined texts are equal.
    content = F.sha2(F.concat(F.octet_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    short = said.select("conv", "turn", "role", _half(content, 1).alias("a"), _half(content, 17).alias("b"), F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"))
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "a", "b")
    placed = stored(short.select("conv", F.row_number().over(order).cast("bigint").alias("at"), "a", "b", "words"))
    family = F.col("conv") - F.col("conv") % FAMILY
    heads = placed.where((F.col("conv") == family) & (F.col("at") <= HEAD)).withColumnRenamed("conv", "family")
    convs = placed.groupBy("conv").agg(F.max("at").alias("own")).withColumns({"h": F.crc32(F.col("conv").cast("string")) % 4, "family": family})
    there = heads.groupBy("family").agg(F.max("at").alias("there"))
    taken = convs.join(there, "family", "left").withColumn("head", F.least("h", F.coalesce("there", F.lit(0))))
    # At most three rows a conversation come from its head.
    first = taken.select("conv", "family", "head").where("head > 0").join(heads, "family").where("at <= head").withColumnRenamed("at", "pos")
    rest = placed.join(taken.select("conv", "h", "head"), "conv").where("at > h").withColumn("pos", F.expr("at - h + head"))
    digest = F.sha2(F.concat_ws(":", "pos", "a", "b"), 256)
    turns = first.select("conv", "pos", "a", "b", "words").unionByName(rest.select("conv", "pos", "a", "b", "words")).select("conv", "pos", _half(digest, 1).alias("a"), _half(digest, 17).alias("b"), "words")
    return turns, taken.select("conv", F.expr("head + greatest(own - h, 0)").alias("length"))


def prefixes(turns: DataFrame, lengths: DataFrame) -> DataFrame:
    """Every prefix of every conversation: (conv, pos, d1, d2, p1, p2, words, ends, left), the empty one (pos 0) with zeros.

    A prefix's digest is the exclusive or of its turns' digests, each of which knows its place. `left` is the number
    of the conversation's prefixes from this one on.
    """
    upto = Window.partitionBy("conv").orderBy("pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = turns.join(lengths, "conv").withColumns({"d1": F.bit_xor("a").over(upto), "d2": F.bit_xor("b").over(upto)})
    left = F.expr("length - pos + 1").alias("left")
    above = [F.col(d).bitwiseXOR(F.col(x)).alias(p) for d, x, p in (("d1", "a", "p1"), ("d2", "b", "p2"))]
    deeper = summed.select("conv", "pos", *_D, *above, "words", (F.col("pos") == F.col("length")).alias("ends"), left)
    zero = F.lit(0).cast("bigint")
    top = lengths.withColumn("pos", zero).select("conv", "pos", *(zero.alias(k) for k in (*_D, *_P, "words")), (F.col("length") == 0).alias("ends"), left)
    return top.unionByName(deeper)


# ---- Ids that end at a node ----------------------------------------------------------------------------------


def _joined(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Runs of one node's ascending ids as texts of at most `size` ids."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    for batch in batches:
        d1, d2, ids = (batch.column(k).to_numpy() for k in ("d1", "d2", "conv"))
        change = np.flatnonzero((d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])) + 1
        bounds = np.union1d(np.concatenate(([0], change, [len(ids)])), np.arange(0, len(ids), size))
        rows = [(d1[x], d2[x], ids[x], ",".join(map(str, ids[x:y].tolist()))) for x, y in zip(bounds[:-1], bounds[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4, schema, strict=True)], schema=schema)


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each node's texts, joined by commas; the rows come sorted by node and first id."""
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("ends_sha256", pa.string())])
    node, running = None, None
    for batch in batches:
        out = []
        for d1, d2, ids in zip(*(batch.column(k).to_pylist() for k in ("d1", "d2", "ids")), strict=True):
            if (d1, d2) == node:
                running.update(b",")
            else:
                if node is not None:
                    out.append((*node, running.hexdigest()))
                node, running = (d1, d2), hashlib.sha256()
            running.update(ids.encode())
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
    if node is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((*node, running.hexdigest()), schema, strict=True)], schema=schema)


def ends(paths: DataFrame, ids_per_text: int = IDS_PER_TEXT) -> DataFrame:
    """(d1, d2, ends_sha256) of the nodes at which conversations end.

    Ranges of (node, id) spread a node's ids over tasks, which join them into texts; only those texts meet, and the
    digest runs over them one after the other without holding them.
    """
    ended = paths.where("ends").select(*_D, "conv")
    texts = ended.repartitionByRange(*_D, "conv").sortWithinPartitions(*_D, "conv").mapInArrow(lambda b: _joined(b, ids_per_text), "d1 bigint, d2 bigint, first bigint, ids string")
    return texts.repartition(*_D).sortWithinPartitions(*_D, "first").mapInArrow(_hashed, "d1 bigint, d2 bigint, ends_sha256 string")


# ---- Shards --------------------------------------------------------------------------------------------------


def perfect_slots(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots 0..n-1 without gap or collision for n distinct 128-bit digests, and the displacements that give them.

    Hash and displace: digests fall into buckets of about three. From the largest on, each bucket tries displacements
    until its digests land on free slots; buckets of equal size try together. Single digests take the slots that are
    left, named by negative displacements. Raises ValueError on repeated digests.
    """
    n = len(first)
    if len(np.unique(np.stack([first, second]), axis=1).T) < n:
        raise ValueError("repeated digests")
    buckets = n // 3 + 1
    bucket = (mixed(first) % np.uint64(buckets)).astype(np.int64)
    sizes = np.bincount(bucket, minlength=buckets)
    order, starts = np.argsort(bucket, kind="stable"), np.concatenate(([0], np.cumsum(sizes)))
    slots, shift, free = np.full(n, -1), np.zeros(buckets, np.int64), np.ones(n, bool)
    for size in range(int(sizes.max(initial=0)), 1, -1):
        waiting, tries = np.flatnonzero(sizes == size), 0
        while len(waiting):
            members = order[starts[waiting][:, None] + np.arange(size)]
            at = _place(first[members], second[members], np.int64(tries), n)
            ranked = np.sort(at, axis=1)
            good = np.flatnonzero(free[at].all(axis=1) & (ranked[:, 1:] != ranked[:, :-1]).all(axis=1))
            claim = np.full(n, len(waiting))  # of buckets that want one slot the first gets it
            np.minimum.at(claim, at[good].ravel(), np.repeat(good, size))
            won = good[(claim[at[good]] == good[:, None]).all(axis=1)]
            slots[members[won]] = at[won]
            free[at[won]] = False
            shift[waiting[won]] = tries
            waiting, tries = np.delete(waiting, won), tries + 1
    single = np.flatnonzero(sizes == 1)
    slots[order[starts[single]]] = np.flatnonzero(free)
    shift[single] = -1 - np.flatnonzero(free)
    return slots, shift


def _place(first: np.ndarray, second: np.ndarray, shift: np.ndarray, n: int) -> np.ndarray:
    hashed = mixed(second + np.uint64(0x9E3779B97F4A7C15) * (first ^ shift.astype(np.uint64)))
    return (hashed % np.uint64(n)).astype(np.int64)


def find_slots(first: np.ndarray, second: np.ndarray, shift: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The slot of each digest, -1 where the table (n x 2, by slot) holds another one there."""
    own = shift[(mixed(first) % np.uint64(len(shift))).astype(np.int64)]
    at = np.where(own < 0, -1 - own, _place(first, second, own, len(table)))
    return np.where((table[at, 0] == first) & (table[at, 1] == second), at, -1)


_SUMMED = "d1 bigint, d2 bigint, p1 bigint, p2 bigint, conv bigint, pos bigint, n_convs bigint, own bigint, children bigint, leaves bigint, saved bigint, parent bigint, top boolean"


def _accumulate(shard: pd.DataFrame) -> pd.DataFrame:
    """Children, leaves and saved words of every node of a shard, on top of what shards below have handed up."""
    n = len(shard)
    d1, d2, p1, p2 = (shard[k].to_numpy(np.int64).view(np.uint64) for k in (*_D, *_P))
    slots, shift = perfect_slots(d1, d2)
    table = np.empty((n, 2), np.uint64)
    table[slots, 0], table[slots, 1] = d1, d2
    above = np.full(n, -1)
    above[slots] = np.where(shard["pos"] == 0, -1, find_slots(p1, p2, shift, table))
    flat = {}
    for k in ("children", "leaves", "saved", "own", "pos", "conv"):
        flat[k] = np.zeros(n, np.int64)
        np.add.at(flat[k], slots, shard[k].to_numpy(np.int64))
    np.add.at(flat["children"], above[above >= 0], 1)
    flat["leaves"] += flat["children"] == 0
    flat["saved"] += flat["own"]
    by_depth = np.argsort(-flat["pos"], kind="stable")
    depths = flat["pos"][by_depth]
    for level in np.split(by_depth, np.flatnonzero(depths[1:] != depths[:-1]) + 1):
        inner = level[above[level] >= 0]
        np.add.at(flat["leaves"], above[inner], flat["leaves"][inner])
        np.add.at(flat["saved"], above[inner], flat["saved"][inner])
    found = {k: flat[k][slots] for k in ("children", "leaves", "saved")}
    inside = above[slots] >= 0
    parent = pd.Series(flat["conv"][above][slots], dtype="Int64").where(inside).array
    return shard[[*_D, *_P, "conv", "pos", "n_convs", "own"]].assign(**found, parent=parent, top=~inside)


def _round(nodes: DataFrame, paths: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """The nodes whose subtrees fit a shard, with its number, and the nodes of the trunk.

    `nodes` have `weight`, no less than the nodes of their subtree, and `via`, a conversation of `paths` that has them.
    """
    trunk, below = nodes.where(F.col("weight") > size), nodes.where(F.col("weight") <= size)
    # A node's shard is named by the topmost prefix outside the trunk on its path.
    outside = paths.join(trunk.select(*_D), _D, "left_anti")
    roots = outside.groupBy(F.col("conv").alias("via")).agg(F.min(F.struct("pos", *_D)).alias("root"))
    shards = max(1, -(-below.count() // size))
    shard = F.pmod(F.xxhash64("root.d1", "root.d2"), F.lit(shards)).alias("shard")
    return below.join(roots.select("via", shard), "via").drop("via", "weight"), trunk.drop("weight")


def prefix_trie(conversations: DataFrame, shard_nodes: int = SHARD_NODES, ids_per_text: int = IDS_PER_TEXT, **columns: str) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    `columns` may name the columns conv, turn, role and text. Cases are defined above.
    """
    turns, lengths = rebuilt_turns(conversations, **columns)
    paths = stored(prefixes(turns, lengths))
    ended = stored(ends(paths, ids_per_text))
    zero = F.lit(0).cast("bigint")
    carried = [F.sum("left").alias("weight"), F.min("conv").alias("via")]
    nodes = paths.groupBy(*_D).agg(
        *(F.min(k).alias(k) for k in (*_P, "conv", "pos", "words")), F.count(F.lit(1)).alias("n_convs"), *carried
    )
    nodes = stored(nodes.withColumns({"own": F.expr("(n_convs - 1) * words"), "children": zero, "leaves": zero, "saved": zero}).drop("words"))
    done, tops = [], None
    while True:
        below, trunk = _round(nodes, paths, shard_nodes)
        summed = stored(below.groupBy("shard").applyInPandas(_accumulate, _SUMMED))
        done.append(summed)
        if trunk.isEmpty():
            break
        tops = trunk if tops is None else tops.unionByName(trunk)
        parents = [F.col(p).alias(d) for p, d in zip(_P, _D, strict=True)]
        handed = summed.where("top AND pos > 0").groupBy(*parents).agg(
            F.count(F.lit(1)).alias("more_children"), F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        more = [F.expr(f"{k} + coalesce(more_{k}, 0)").alias(k) for k in ("children", "leaves", "saved")]
        # The next tree's paths: of a conversation for each deepest trunk node, cut where the trunk ends.
        deepest = trunk.join(trunk.where("pos > 0").select(*parents).distinct(), _D, "left_anti")
        cut = paths.join(deepest.groupBy(F.col("via").alias("conv")).agg(F.max("pos").alias("until")), "conv").where("pos <= until")
        paths = stored(cut.withColumn("left", F.expr("until - pos + 1")).drop("until"))
        carrier = paths.groupBy(*_D).agg(*carried)
        nodes = stored(trunk.join(handed, _D, "left").select(*_D, *_P, "conv", "pos", "n_convs", "own", *more).join(carrier, _D))
    result = done[0]
    for more in done[1:]:
        result = result.unionByName(more)
    return _named(result, tops, ended)


def _named(summed: DataFrame, trunk: DataFrame | None, ended: DataFrame) -> DataFrame:
    """The result's columns; parents of shard tops are looked up among the trunk's nodes."""
    if trunk is not None:
        owners = trunk.groupBy(F.col("d1").alias("p1"), F.col("d2").alias("p2")).agg(F.min("conv").alias("owner"))
        summed = summed.join(owners, _P, "left").withColumn("parent", F.expr("if(pos > 0, coalesce(parent, owner), NULL)")).drop("owner")
    nothing = F.lit(hashlib.sha256().hexdigest())
    return summed.join(ended, _D, "left").select(
        F.col("conv").alias("conv_id"),
        F.col("pos").alias("depth"),
        F.col("parent").alias("parent_conv_id"),
        "n_convs",
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", nothing).alias("ends_sha256"),
    )
