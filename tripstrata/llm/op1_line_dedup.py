"""Line dedup by a segment-partition edit join.

A line of length L may differ from a longer or equally long one by e = min(max_edits, L // chars_per_edit) edits. It
is split into e + 1 segments, one of which the other line must hold unchanged, near the same place. Keys are hashes of
(length, segment number, segment): each line gives those of its own segments, and for every length that a partner no
longer than itself may have, those of its substrings that could be such a segment; shifts that the edits left or right
of it can't explain are left out. Lines that share a key are candidates; their edit distance along few diagonals decides.
Linked lines form classes, and of each class the first line in the corpus stays.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import components, mixed, slices, stored

#: Fixed value: a line counts if it has a word.
A_WORD = r"[^\x20\x09-\x0D]"


@dataclass(frozen=True)
class Edits:
    max_edits: int = 2
    chars_per_edit: int = 20
    #: Lists of up to so many lines are joined with themselves; longer ones are compared block by block.
    short: int = 50
    block: int = 500

    def allowed(self, length: np.ndarray) -> np.ndarray:
        return np.minimum(self.max_edits, length // self.chars_per_edit)


_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.ones(n, np.uint64)
    np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=out[1:])
    return out


def segment_keys(lines: list[str], edits: Edits) -> tuple[np.ndarray, np.ndarray]:
    """(keys, number of the line of each key)."""
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    starts = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    n = len(text) + 1
    up, down = _powers(_BASE, n), _powers(_BACK, n)
    before = np.zeros(n, np.uint64)
    np.cumsum((text.astype(np.uint64) + np.uint64(1)) * up[:-1], out=before[1:])
    keys, owners = [], []
    for shorter in range(edits.max_edits + 1):  # by how much a partner is shorter
        partner = lengths - shorter
        allowed = edits.allowed(partner)
        for e in range(max(1, shorter), edits.max_edits + 1):
            own = np.flatnonzero((allowed == e) & (partner > 0))
            if not len(own):
                continue
            size, longer = np.divmod(partner[own], e + 1)
            for i in range(e + 1):
                # The last `longer` segments have one character more.
                extra = np.maximum(0, i - (e + 1 - longer))
                place, width = i * size + extra, size + (i >= e + 1 - longer)
                for shift in range(max(-i, shorter - (e - i)), min(i, shorter + (e - i)) + 1):
                    at = place + shift
                    fits = (at >= 0) & (at + width <= lengths[own])
                    a = (starts[own] + at)[fits]
                    value = (before[a + width[fits]] - before[a]) * down[a]
                    salt = partner[own][fits].astype(np.uint64) * np.uint64(1 << 8) + np.uint64(i)
                    keys.append(mixed(value + mixed(salt)))
                    owners.append(own[fits])
    if not keys:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(keys), np.concatenate(owners)


def within(a: list[str], b: list[str], most: np.ndarray) -> np.ndarray:
    """Whether each pair's edit distance is at most `most`.

    Ukkonen's furthest rows by edits and diagonal, for many pairs in step. An array operation takes a whole diagonal, so
    their number depends on the edits alone: neither a long line nor a batch of few pairs costs a step for each character.
    """
    out = np.zeros(len(a), bool)
    swap = [(x, y) if len(x) <= len(y) else (y, x) for x, y in zip(a, b, strict=True)]  # rows: shorter, columns: longer
    order = np.array(sorted(range(len(a)), key=lambda k: len(swap[k][1])), np.int64)
    diagonals = 2 * int(most.max(initial=0)) + 1
    while len(order):
        top = len(swap[order[min(len(order), 20_000) - 1]][1]) + 1
        take = max(1, min(len(order), 20_000, 6_000_000 // (top * diagonals)))
        now, order = order[:take], order[take:]
        out[now] = _within([swap[k][0] for k in now], [swap[k][1] for k in now], most[now])
    return out


def _matrix(lines: list[str], lengths: np.ndarray, before: int, width: int, blank: int) -> np.ndarray:
    out = np.full((len(lines), width), blank, np.uint32)
    flat = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(len(lines)), lengths)
    out[row, before + np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _within(rows: list[str], columns: list[str], most: np.ndarray) -> np.ndarray:
    k = int(most.max(initial=0))
    m, n = np.array([len(x) for x in rows]), np.array([len(x) for x in columns])
    width = int(max(m.max(initial=0) + 1, n.max(initial=0)))
    # The blanks of the two differ, so that every diagonal has a mismatch at row m at the latest.
    r = _matrix(rows, m, 0, width, 0xFFFFFFFF)
    c = _matrix(columns, n, k, width + 2 * k, 0xFFFFFFFE)
    unequal = [np.flatnonzero(r != c[:, k + d : k + d + width]) for d in range(-k, k + 1)]
    begins = np.arange(len(rows)) * width
    # far[k + 1 + d]: the furthest row of diagonal d (column less row) that so many edits reach.
    far = np.full((2 * k + 3, len(rows)), -1)
    edits = np.full(len(rows), k + 1)
    last = np.minimum(n - m, k) + k + 1
    for e in range(k + 1):
        reached = np.full_like(far, -1)
        for d in range(-e, e + 1):
            at = k + 1 + d
            row = np.minimum(np.maximum(np.maximum(far[at], far[at + 1]) + 1, far[at - 1]), m)
            bad = unequal[k + d]
            reached[at] = bad[np.searchsorted(bad, begins + row)] - begins
        far = reached
        edits[(far[last, np.arange(len(rows))] == m) & (edits > e)] = e
    return (edits <= most) & (n - m <= most)


def _lines(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_chars, line_no, id, line) of every line with a word."""
    return docs.select("doc_id", F.length("text").alias("doc_chars"), F.posexplode(F.split("text", "\n")).alias("line_no", "line")).where(F.col("line").rlike(A_WORD)).select("doc_id", "doc_chars", "line_no", F.xxhash64("line").alias("id"), "line")


def _keyed(edits: Edits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            if len(seen) > 500_000:
                seen = set()  # only spares work: equal lines give equal keys
            new = {i: x for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True) if i not in seen}
            seen.update(new)
            ids, texts = np.fromiter(new, np.int64, len(new)), list(new.values())
            for a, b in slices(texts, 500_000):
                keys, owners = segment_keys(texts[a:b], edits)
                yield pa.record_batch([pa.array(keys.view(np.int64)), pa.array(ids[a:b][owners])], names=["key", "id"])

    return run


def _checked(edits: Edits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            if not x:
                continue
            most = edits.allowed(np.array([min(len(p), len(q)) for p, q in zip(x, y, strict=True)], np.int64))
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(within(x, y, most)))

    return run


def _letters(lines: list[str]) -> np.ndarray:
    """How often characters of each residue modulo 64 occur: an edit changes at most two of the counts by one."""
    text = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(lines)), [len(x) for x in lines])
    return np.bincount(owner * 64 + text % 64, minlength=len(lines) * 64).reshape(-1, 64).astype(np.int32)


def _block_links(edits: Edits):
    """Links of one block pair's lines. Pairs whose letter counts differ too much aren't compared; the rest all are."""

    def run(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        _, first, second = key
        left, right = frame[frame["block"] == first], frame[frame["block"] == second]
        lines, others = left["line"].to_list(), right["line"].to_list()
        n, m = np.array([len(x) for x in lines]), np.array([len(x) for x in others])
        counts, other_counts = _letters(lines), _letters(others)
        ids, other_ids = left["id"].to_numpy(), right["id"].to_numpy()
        got = []
        for a in range(0, len(lines), 50):
            part = slice(a, a + 50)
            apart = np.abs(counts[part, None] - other_counts[None]).sum(axis=2)
            can = (apart <= 2 * edits.max_edits) & (np.abs(n[part, None] - m) <= edits.max_edits)
            if first == second:
                can &= ids[part, None] < other_ids
            i, j = np.nonzero(can)
            i += a
            on = within([lines[k] for k in i], [others[k] for k in j], edits.allowed(np.minimum(n[i], m[j])))
            got.append(np.stack((np.minimum(ids[i[on]], other_ids[j[on]]), np.maximum(ids[i[on]], other_ids[j[on]])), axis=1))
        return pd.DataFrame(np.concatenate(got) if got else np.empty((0, 2), np.int64), columns=["a", "b"])

    return run


def line_links(lines: DataFrame, edits: Edits) -> DataFrame:
    """Links (a, b) between ids of distinct lines, enough to connect all that are near. `lines`: id, line; repeated lines may recur."""
    keyed = lines.select("id", "line").mapInArrow(_keyed(edits), "key bigint, id bigint")
    grouped = keyed.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    lists = stored(grouped.where("low <> high"))
    # Few keys are shared by different lines: their members come from a second pass over the lines. The keys grow with
    # the input, so they are merged at every size and never broadcast.
    entries = stored(keyed.join(lists.select("key").hint("merge"), "key").distinct())
    wanted = entries.select("id").distinct()
    texts = stored(lines.select("id", "line").join(wanted.hint("merge"), "id", "left_semi").dropDuplicates(["id"]))

    def confirmed(pairs: DataFrame) -> DataFrame:
        joined = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x")), "a").join(texts.select(F.col("id").alias("b"), F.col("line").alias("y")), "b")
        return stored(joined.select("a", "b", "x", "y").mapInArrow(_checked(edits), "a bigint, b bigint"))

    stars = entries.join(lists.select("key", F.col("low").alias("a")), "key").where("a <> id").select("a", F.col("id").alias("b")).distinct()
    links = confirmed(stars)
    known = components(links).withColumnRenamed("node", "id")
    labelled = entries.join(known, "id", "left").withColumn("component", F.coalesce("component", "id"))
    opened = labelled.groupBy("key").agg(F.count("*").alias("members"), F.min("component").alias("c"), F.max("component").alias("d")).where("c <> d").select("key", "members")
    members = stored(labelled.join(opened, "key"))
    short = members.where(F.col("members") <= edits.short)
    other = short.select("key", F.col("id").alias("b"), F.col("component").alias("d"))
    few = short.withColumnRenamed("id", "a").join(other, "key").where("a < b AND component <> d").select("a", "b").distinct().join(stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    blocks = F.ceil(F.col("members") / edits.block).cast("int")
    long = (
        members.where(F.col("members") > edits.short).withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).join(texts, "id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", "id", "line", "block", F.least("block", "other").alias("first"), F.greatest("block", "other").alias("second"))
    )
    more = stored(long.groupBy("key", "first", "second").applyInPandas(_block_links(edits), "a bigint, b bigint").distinct())
    return links.unionByName(confirmed(few)).unionByName(more)


def repeated_lines(docs: DataFrame, edits: Edits = Edits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines that go: doc_id, line_no (from 0), near (it equals no earlier line, but is near one of its class).

    A line is what lies between two line feeds; lines without a word never go. Of each class of lines the first by
    (doc_id, line_no) stays. Rows without an id or text have no lines here; rows that share an id are one document whose lines
    go or stay together. Other columns are not read. Lines shorter than `chars_per_edit` characters go as exact repeats only.
    """
    return _gone(docs, edits, id_col, text_col).select("doc_id", "line_no", "near")


def _gone(docs: DataFrame, edits: Edits, id_col: str, text_col: str) -> DataFrame:
    """Lines that go: doc_id, line_no, chars, near, and doc_id and doc_chars of the line that `stays`."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")
    lines = _lines(rows)
    roots = components(line_links(lines, edits))
    places = stored(lines.select("doc_id", "doc_chars", "line_no", "id", F.length("line").alias("chars")))
    first = places.groupBy("id").agg(F.min(F.struct("doc_id", "line_no", "doc_chars")).alias("first"), F.count("*").alias("times"))
    # Most lines are alone and occur once. The others are stored, so that the places are put together by line once.
    classed = stored(first.join(roots.withColumnRenamed("node", "id"), "id", "left").where("component IS NOT NULL OR times > 1"))
    alone = classed.where("component IS NULL").select("id", F.col("first").alias("own"), F.col("first").alias("stays"))
    shared = classed.where("component IS NOT NULL")
    of_class = shared.groupBy("component").agg(F.min("first").alias("stays"))
    keepers = alone.unionByName(shared.join(of_class, "component").select("id", F.col("first").alias("own"), "stays"))
    gone = places.join(keepers, "id").where("struct(doc_id, line_no) <> struct(stays.doc_id, stays.line_no)")
    return gone.select("doc_id", "line_no", "chars", F.expr("struct(own.doc_id, own.line_no) = struct(doc_id, line_no)").alias("near"), "stays")


def line_counts(docs: DataFrame, edits: Edits = Edits(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines (with a word), n_removed, n_near (of those removed, first of their kind), one row per id."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    n_lines = F.size(F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(A_WORD))).cast("bigint")
    every = rows.where("doc_id IS NOT NULL").select("doc_id", n_lines.alias("n_lines"))
    gone = repeated_lines(docs, edits, id_col, text_col).groupBy("doc_id").agg(F.count("*").alias("n_removed"), F.count_if("near").alias("n_near"))
    return every.join(gone, "doc_id", "left").select("doc_id", "n_lines", *(F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_removed", "n_near")))


def without_repeated_lines(docs: DataFrame, edits: Edits = Edits(), copies_at: float = 0.9, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, without the lines that go. A text whose lines all go is empty.

    Only copies of one document are left as they are, for document dedup to decide on: the lines of theirs that stay in one
    and the same other document make up the share `copies_at` of the characters of both. At 0.9 two such texts have 0.9 of
    1.1, or 82%, in common. Lines that stay in several documents, or in the same one, go from every other document.
    """
    lost = _gone(docs, edits, id_col, text_col).groupBy("doc_id", F.col("stays.doc_id").alias("keeper"))
    shared = lost.agg(F.max("stays.doc_chars").alias("keeper_chars"), F.collect_set(F.struct("line_no", "chars")).alias("lines"))
    # Each line counts with its line feed.
    common = shared.withColumn("common", F.aggregate("lines", F.lit(0), lambda n, x: n + x["chars"] + 1))
    copied = F.max(F.when((F.col("keeper") != F.col("doc_id")) & (F.col("common") >= copies_at * (F.col("keeper_chars") + 1)), F.col("common")))
    gone = common.groupBy(F.col("doc_id").alias("_doc")).agg(F.flatten(F.collect_list("lines.line_no")).alias("_gone"), copied.alias("_copied"))
    row = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].cast("bigint").alias("_id"), docs[text_col].cast("string").alias("_text"))
    joined = row.join(gone.hint("merge"), F.col("_id") == F.col("_doc"), "left").withColumn("_flags", F.expr("map_from_arrays(_gone, array_repeat(true, size(_gone)))"))
    kept = F.filter(F.split("_text", "\n"), lambda x, i: F.try_element_at("_flags", i).isNull())
    cut = joined.withColumn("_kept", F.when(F.col("_gone").isNotNull(), F.array_join(kept, "\n")))
    stay = F.col("_kept").isNull() | F.coalesce(F.col("_copied") >= copies_at * (F.length("_text") + 1), F.lit(False))
    text = F.when(stay, F.col(f"row.{text_col}")).otherwise(F.col("_kept"))
    return cut.select(*(text.alias(c) if c == text_col else F.col(f"row.{c}").alias(c) for c in docs.columns))
