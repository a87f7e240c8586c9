"""Near duplicates by bottom-k sketches from one hash function, confirmed on full shingle sets.

A document's shingles are hashed once; its sketch is the k smallest distinct hashes. Documents with equal sets become
one class. Inverted lists hold, for each of a sketch's first values, the classes that keep it. Two classes at the
threshold share at least `met` of those, so each class is listed only under its rarest ones, listed - met + 1 of them:
values of a passage that much of the corpus shares are rarely among those, and a pair still meets in a list. The lists'
tasks count the values that two sketches share, a block of members at a time, and a pair goes on if the union of both
sketches allows a link. What a list sends on is a spanning forest of its likely pairs, never all of them; full sets
confirm or refute these. Lists whose members then lie in one component are done. After some rounds the members that
still have likely partners in other components meet once more, with their full sets, and every such pair is decided.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import components, grams, mixed, slices, stored, word_hashes


@dataclass(frozen=True)
class Near:
    """Words in a shingle; link if 100 * intersection >= percent * union; sketch sizes and the values shared at least.

    The first `listed` values of a sketch of k go to the inverted lists; `met` of those, and `overlap` of all k, are shared by a
    linked pair but for a chance below 1e-6 (binomial at the threshold).
    """

    words: int = 5
    percent: int = 80
    k: int = 64
    overlap: int = 35
    listed: int = 16
    met: int = 4
    #: Members of a list that are compared with each other in one go, by sketch and by full set.
    block: int = 1000
    set_block: int = 500
    #: Rounds that confirm a spanning forest of each list's likely pairs, before all likely pairs are held against full sets.
    rounds: int = 1


def shingle_sets(texts: list[bytes], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text. A text of fewer words has one shingle, a text without words none."""
    hashes, offsets = word_hashes(texts)
    runs = grams(hashes, words)
    out = []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        if b - a >= words:
            out.append(np.unique(runs[a : b - words + 1]))
        elif b > a:
            out.append(mixed(grams(hashes[a:b], int(b - a)) + np.uint64(b - a)))
        else:
            out.append(np.empty(0, np.uint64))
    return out


def _sets_of(batch: pa.RecordBatch, words: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    ids, texts = batch.column(0).to_pylist(), [(x or "").encode() for x in batch.column(1).to_pylist()]
    for a, b in slices(texts):
        yield ids[a:b], shingle_sets(texts[a:b], words)


def _sketches(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets_of(batch, near.words):
                sums = [int(mixed(s).sum(dtype=np.uint64)) if len(s) else 0 for s in sets]
                xors = [int(np.bitwise_xor.reduce(s)) if len(s) else 0 for s in sets]
                yield pa.record_batch(
                    [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(np.array(sums, np.uint64).view(np.int64)), pa.array(np.array(xors, np.uint64).view(np.int64)), pa.array([s[: near.k].tobytes() for s in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "h", "g", "sketch"],
                )

    return run


def _full_sets(near: Near):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets_of(batch, near.words):
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["id", "set"])

    return run


def _values(near: Near):
    """(value, id, n_shingles) for each listed value of each sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sketches = [s[: 8 * near.listed] for s in batch.column(2).to_pylist()]
            sizes = np.fromiter((len(s) // 8 for s in sketches), np.int64, len(sketches))
            columns = (np.repeat(batch.column(i).to_numpy(), sizes) for i in range(2))
            yield pa.record_batch([pa.array(np.frombuffer(b"".join(sketches), np.int64)), *map(pa.array, columns)], names=["value", "id", "n_shingles"])

    return run


def _sets(wanted: DataFrame, rows: DataFrame, near: Near) -> DataFrame:
    """(id, set): full sets of the texts of the wanted ids (doc_id).

    The wanted ids grow with the input, so they are merged with the texts at every size and never broadcast.
    """
    return stored(rows.join(wanted.distinct().hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_full_sets(near), "id bigint, set binary"))


def _confirmed(pairs: DataFrame, rows: DataFrame, near: Near) -> DataFrame:
    """The pairs (a, b) of ids that are linked by their full sets. Only texts in a pair are made into sets, and once."""
    pairs = stored(pairs)
    sets = _sets(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), rows, near)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            on = [_holds(x.as_buffer(), y.as_buffer(), near) for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(on, pa.bool_()))

    joined = pairs.join(sets.select(F.col("id").alias("a"), F.col("set").alias("x")), "a").join(sets.select(F.col("id").alias("b"), F.col("set").alias("y")), "b")
    return stored(joined.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint"))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
    """Runs of rows with equal (value, first, second), which come sorted by these."""
    rest: pd.DataFrame | None = None
    for batch in batches:
        frame = batch.to_pandas()
        if rest is not None:
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        key = frame[["value", "first", "second"]].to_numpy()
        cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts[:-1]], cuts, strict=False):
            yield frame.iloc[a:b]
        rest = frame.iloc[cuts[-1] if len(cuts) else 0 :]
    if rest is not None and len(rest):
        yield rest


def _likely(group: pd.DataFrame, near: Near) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, shared values) of a group's pairs of different components whose sizes and sketches allow a link.

    In a pair of blocks only pairs across the blocks count. A pair counts in the first list, by value, that holds both.
    """
    m, first, second = len(group), group["first"].iat[0], group["second"].iat[0]
    sketches = [np.frombuffer(s, np.uint64) for s in group["sketch"]]
    n, c, block = (group[x].to_numpy() for x in ("n_shingles", "component", "block"))
    can = (c[:, None] != c) & (100 * np.minimum(n[:, None], n) >= near.percent * np.maximum(n[:, None], n)) & np.tri(m, m, -1, dtype=bool).T
    if first != second:
        can &= block[:, None] != block
    if not can.any():
        return (np.empty(0, np.int64),) * 3
    shared = _common(sketches)
    least = np.minimum(near.overlap, np.ceil(np.maximum(n[:, None], n) * near.percent / 100))
    can &= shared >= least
    here = group["value"].iat[0]
    earlier = [np.array([v for v in x if v < here], np.int64) for x in group["lists"]]
    can &= _common(earlier) == 0
    i, j = np.nonzero(can)
    return i, j, shared[i, j]


def _common(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share."""
    m = len(sets)
    sizes = [len(s) for s in sets]
    if not sum(sizes):
        return np.zeros((m, m), np.int32)
    if m <= 4:
        out = np.zeros((m, m), np.int32)
        for i in range(m):
            for j in range(i):
                out[i, j] = out[j, i] = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
        return out
    values, at = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(at) > 1
    column = np.cumsum(often) - 1
    owner, on = np.repeat(np.arange(m), sizes), often[at]
    owner, at = owner[on], column[at[on]]
    out = np.zeros((m, m), np.float32)
    width = max(1, 4_000_000 // m)  # columns of the 0/1 matrix at once
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for start in range(0, int(often.sum()), width):
        part = slice(*np.searchsorted(at, [start, start + width]))
        holds = np.zeros((m, min(width, int(often.sum()) - start)), np.float32)
        holds[owner[part], at[part] - start] = 1
        out += holds @ holds.T
    return out.astype(np.int32)


class _Sets:
    """Disjoint sets of components."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def _forest(near: Near, turn: int):
    """For each list, of its members' likeliest pairs those that would join components.

    In the last turn, instead, the members (a) of each list (value in b) that still have a likely pair.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[int, int]] = []
        for group in _groups(batches):
            i, j, shared = _likely(group, near)
            ids, c = group["id"].to_numpy(), group["component"].to_numpy()
            if turn == near.rounds:
                out += [(int(x), int(group["value"].iat[0])) for x in ids[np.unique(np.concatenate((i, j)))]]
            else:
                best = np.lexsort((ids[j], ids[i], -shared))
                # Each member's best partner is enough for a round.
                best = best[np.sort(np.unique(np.concatenate((i[best], j[best])), return_index=True)[1] % max(1, len(best)))]
                sets = _Sets()
                out += [tuple(sorted((int(ids[i[k]]), int(ids[j[k]])))) for k in best if sets.join(int(c[i[k]]), int(c[j[k]]))]
            if len(out) > 10_000:
                yield _pairs(out)
                out = []
        yield _pairs(out)

    return run


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else ((), ()))], names=["a", "b"])


def _exact(near: Near):
    """Links that join components of a list, by full sets, of all its likely pairs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            out: list[tuple[int, int]] = []
            i, j, _ = _likely(group, near)
            ids, c, sets = group["id"].to_numpy(), group["component"].to_numpy(), _Sets()
            if len(i):
                full = [np.frombuffer(x, np.uint64) for x in group["set"]]
                size, both = np.array([len(x) for x in full]), _common(full)[i, j]
                on = 100 * both.astype(np.int64) >= near.percent * (size[i] + size[j] - both)
                out += [(int(ids[p]), int(ids[q])) for p, q in zip(i[on], j[on], strict=True) if sets.join(int(c[p]), int(c[q]))]
            yield _pairs(out)

    return run


def _holds(x: bytes, y: bytes, near: Near) -> bool:
    x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= near.percent * (len(x) + len(y) - both)


def _dealt(members: DataFrame, block: int) -> DataFrame:
    """Members of lists, with `members` in the list, once for each pair of blocks of it, sorted by list and pair."""
    blocks = F.ceil(F.col("members") / block).cast("int")
    split = members.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = split.withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other")).drop("other", "blocks", "members")
    return paired.repartition("value", "first", "second").sortWithinPartitions("value", "first", "second", "id")


def linked_classes(rows: DataFrame, classes: DataFrame, near: Near) -> DataFrame:
    """Links (a, b) between class ids enough to connect whatever the full sets link. `rows`: doc_id, text."""
    values = classes.select("id", "n_shingles", "sketch").mapInArrow(_values(near), "value bigint, id bigint, n_shingles bigint")
    lists = values.groupBy("value").agg(F.count("*").alias("in_lists")).where("in_lists > 1")
    # A class's values that no other has are its rarest; how many those are is what is missing from its sketch here.
    often = values.join(lists, "value").groupBy("id", "n_shingles").agg(F.sort_array(F.collect_list(F.struct("in_lists", "value"))).alias("often"))
    size = f"least(n_shingles, {near.listed})"
    least = f"least({near.met}, CAST(ceil(n_shingles * {near.percent} / 100) AS int))"
    first = F.expr(f"transform(slice(often, 1, greatest(0, CAST({size} - {least} + 1 - ({size} - size(often)) AS int))), x -> x.value)")
    listed = stored(often.select("id", "n_shingles", first.alias("lists")).where("size(lists) > 0").join(classes.select("id", "sketch"), "id"))
    entries = stored(listed.select("id", F.explode("lists").alias("value")))

    links: DataFrame | None = None
    for turn in range(near.rounds + 1):
        labelled = entries if links is None else entries.join(components(links).withColumnRenamed("node", "id"), "id", "left")
        labelled = labelled.withColumn("component", F.col("id") if links is None else F.coalesce("component", "id"))
        open_lists = labelled.groupBy("value").agg(F.count("*").alias("members"), F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("value", "members")
        members = labelled.join(open_lists, "value").join(listed, "id")
        pairs = _dealt(members, near.block).mapInArrow(_forest(near, turn), "a bigint, b bigint").distinct()
        if turn < near.rounds:
            found = _confirmed(pairs, rows, near)
            links = found if links is None else links.unionByName(found)
            continue
        left = stored(pairs.select(F.col("a").alias("id"), F.col("b").alias("value")))
        sets = _sets(left.select(F.col("id").alias("doc_id")), rows, near)
        counted = left.join(left.groupBy("value").agg(F.count("*").alias("members")), "value")
        full = counted.join(labelled, ["id", "value"]).join(listed, "id").join(sets, "id")
        links = links.unionByName(stored(_dealt(full, near.set_block).mapInArrow(_exact(near), "a bigint, b bigint")))
    return links


def near_duplicates(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Component of every document under links of shingle sets: doc_id, n_shingles, component_id, kept.

    Words are runs other than space and tab to carriage return, with A-Z in lower case. Null, empty and wordless texts
    have no shingles and link with nothing. component_id is the smallest id reachable; the row with that id is kept. Repeated ids keep their
    rows, and count as one document of each of their texts' sets; a row without an id links with nothing, has no component and is not kept.
    Other columns are not read. Equal sets link through their class, so a group of copies costs one row per copy.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sketched = stored(rows.mapInArrow(_sketches(near), "doc_id bigint, n_shingles bigint, h bigint, g bigint, sketch binary"))
    some = sketched.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(some.groupBy("h", "g", "n_shingles").agg(F.min("doc_id").alias("id"), F.first("sketch").alias("sketch")))
    roots = components(linked_classes(rows.where("doc_id IS NOT NULL"), classes, near))
    named = classes.join(roots, F.col("id") == F.col("node"), "left").select("h", "g", "n_shingles", F.coalesce("component", "id").alias("of_class"))
    out = sketched.drop("sketch").join(named, ["h", "g", "n_shingles"], "left")
    component = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("of_class")), F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(False)).alias("kept"))


def first_of_each_group(docs: DataFrame, near: Near = Near(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, but for documents whose group has one with a smaller id. Rows without an id stay."""
    gone = near_duplicates(docs, near, id_col, text_col).where("NOT kept AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone.hint("merge"), docs[id_col].cast("bigint") == F.col("_gone"), "left_anti")
