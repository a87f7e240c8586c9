"""Removal of long repeated byte strings by a logarithmic family of suffix arrays.

Positions are thinned out first. The anchor of a window of `length` bytes is the place of the smallest hash among its
runs of `gram` bytes, so equal windows have equal anchors at equal places. Neighbouring windows of one anchor form a
run; a run's bytes are its context. A gram that occurs once rules out all of its run's windows. Equal contexts repeat as a
whole and become one. What is left, different contexts around one gram, is dealt out by gram, and each task keeps an index
family over them: contexts arrive in batches, each batch gets a suffix array of its windows' starts, in the order of their
bytes to depth `length`, by ranks of ever longer strings; the array is merge-scanned against every level of the family for windows that agree in
all their bytes; then it becomes a level, and levels of about one size are merged, so that there are logarithmically many.

Contexts of one gram beyond `crowd` don't meet in a task: their windows are counted by fingerprint over the cluster.
"""

from __future__ import annotations

import hashlib
import itertools
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import mixed, slices, stored, word_hashes


@dataclass(frozen=True)
class Repeats:
    length: int = 400
    gram: int = 128
    #: Bytes of text handled at once (at most 2**22), and of contexts in a batch of the index family.
    chunk: int = 3_000_000
    batch: int = 1_500_000
    #: Contexts of one gram that may meet in a task, and contexts in a task's share on average.
    crowd: int = 2_000
    share: int = 20_000


_PLACE = 22
_BASES = (0x9E3779B97F4A7C15 | 1, 0xC2B2AE3D27D4EB4F | 1)


class Fingerprints:
    """Hashes of any substrings of some bytes."""

    def __init__(self, text: np.ndarray, base: int = _BASES[0]) -> None:
        n = len(text) + 1
        self.before, up, self.down = np.zeros(n, np.uint64), np.ones(n, np.uint64), np.ones(n, np.uint64)
        np.multiply.accumulate(np.full(n - 1, base, np.uint64), out=up[1:])
        np.multiply.accumulate(np.full(n - 1, pow(base, -1, 1 << 64), np.uint64), out=self.down[1:])
        up = up[:-1]
        up *= mixed(text.astype(np.uint64) + np.uint64(base))
        np.cumsum(up, out=self.before[1:])

    def of(self, start: np.ndarray | slice, stop: np.ndarray | slice) -> np.ndarray:
        return mixed((self.before[stop] - self.before[start]) * self.down[start])


def runs(texts: list[bytes], spec: Repeats) -> Iterator[tuple[np.ndarray, ...]]:
    """(text's number, first start, last start, anchor, gram hash, context hash) of every run, some texts at a time."""
    pending: list[tuple[int, int, bytes]] = []
    held = 0
    step = spec.chunk - spec.length
    for i, text in enumerate(texts):
        for at in range(0, max(0, len(text) - spec.length + 1), step):  # longer texts: the windows, chunk by chunk
            part = text[at : at + spec.chunk - 1]
            if held and held + len(part) > spec.chunk:
                yield _runs(pending, spec)
                pending, held = [], 0
            pending.append((i, at, part))
            held += len(part)
    if pending:
        yield _runs(pending, spec)


def _runs(parts: list[tuple[int, int, bytes]], spec: Repeats) -> tuple[np.ndarray, ...]:
    joined = np.frombuffer(b"".join(p for *_, p in parts), np.uint8)
    sizes = np.array([len(p) for *_, p in parts])
    heads = np.cumsum(sizes) - sizes
    prints = Fingerprints(joined)
    n = len(joined) - spec.gram + 1
    hashes = prints.of(slice(0, n), slice(spec.gram, None))
    low = np.uint64((1 << _PLACE) - 1)
    best = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    wide, left = 1, spec.length - spec.gram + 1
    while wide * 2 <= left:
        best = np.minimum(best[:-wide], best[wide:])
        wide *= 2
    if left > wide:
        best = np.minimum(best[: len(best) - (left - wide)], best[left - wide :])
    anchor = (best & low).astype(np.int64)  # of the window that starts here
    owner = np.repeat(np.arange(len(parts)), sizes)[: len(anchor)]
    starts = np.flatnonzero(np.arange(len(anchor)) + spec.length <= (heads + sizes)[owner])  # windows inside one text
    p, o = anchor[starts], owner[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (p[1:] != p[:-1]) | (o[1:] != o[:-1])
    first = np.flatnonzero(new)
    a, b, p, o = starts[first], starts[np.append(first[1:], len(starts)) - 1], p[first], o[first]
    context = mixed(prints.of(a, b + spec.length) + ((p - a) * 65_536 + (b - a)).astype(np.uint64))
    shift = np.array([at for _, at, _ in parts])[o] - heads[o]
    return np.array([i for i, *_ in parts])[o], a + shift, b + shift, p + shift, hashes[p], context


_RUNS = "r bigint, s bigint, a bigint, b bigint, p bigint, gram bigint, context bigint"


def _found_runs(spec: Repeats):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r, s = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, a, b, p, gram, context in runs([x.encode() for x in batch.column(2).to_pylist()], spec):
                yield pa.record_batch([pa.array(x) for x in (r[i], s[i], a, b, p, gram.view(np.int64), context.view(np.int64))], names=["r", "s", "a", "b", "p", "gram", "context"])

    return run


def _cut_out(spec: Repeats):
    """Bytes of the wanted contexts of a text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r, s, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw = text.encode()
                for at in range(0, len(wanted), 5_000):
                    some = wanted[at : at + 5_000]
                    yield pa.record_batch(
                        [
                            pa.array([w["gram"] for w in some], pa.int64()), pa.array([w["context"] for w in some], pa.int64()), pa.array([w["crowded"] for w in some], pa.bool_()),
                            pa.array([w["n"] for w in some], pa.int64()), pa.array([r] * len(some), pa.int64()), pa.array([s] * len(some), pa.int64()), pa.array([w["a"] for w in some], pa.int64()),
                            pa.array([raw[w["a"] : w["b"] + spec.length] for w in some], pa.binary()),
                        ],
                        names=["gram", "context", "crowded", "n", "r", "s", "a", "bytes"],
                    )

    return run


def _ranks(key: np.ndarray) -> np.ndarray:
    """Place of each value among the distinct values."""
    order = np.argsort(key)
    new = np.ones(len(key), bool)
    new[1:] = key[order[1:]] != key[order[:-1]]
    out = np.empty(len(key), np.int64)
    out[order] = np.cumsum(new) - 1
    return out


_LEAD = 8


def _leading(text: np.ndarray, starts: np.ndarray | slice, wide: int) -> np.ndarray:
    """The `wide` bytes, 8 at most, that follow each start, as numbers."""
    out = np.zeros(len(text[: len(text) - wide + 1][starts]), np.uint64)
    for k in range(wide):
        out = out << np.uint64(8) | text[k : len(text) - wide + 1 + k][starts].astype(np.uint64)
    return out


def suffix_order(text: np.ndarray, starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """`starts` in the order of the `length` bytes that follow each, and whether each is equal to the one before.

    Ranks of short strings at all places give those of strings three times as long (twice, where three ranks don't fit a
    number) while these are no longer than `length`; overlapping ranks then cover the whole. Places are compared by their bytes alone.
    """
    wide = min(length, _LEAD)
    rank = _ranks(_leading(text, slice(None), wide))
    size = max(len(text), 2)
    fold = 3 if size**3 < 1 << 63 else 2
    while wide < length:
        longer = min(wide * fold, length)
        n = len(text) - longer + 1
        key = rank[:n].copy()
        for k in range(1, fold):  # the last one ends where the longer string ends
            at = min(wide * k, longer - wide)
            key = key * size + rank[at : at + n]
        if longer == length:
            key = key[starts]
            break
        rank, wide = _ranks(key), longer
    else:
        key = rank[starts]
    order = np.argsort(key)
    key = key[order]
    return starts[order], np.append(False, key[1:] == key[:-1])[: len(starts)]


class Level:
    """A suffix array of different windows: their starts in the family's text in ascending order of the bytes, and their leading bytes as numbers."""

    def __init__(self, start: np.ndarray, lead: np.ndarray) -> None:
        self.start, self.lead = start, lead

    def __len__(self) -> int:
        return len(self.start)


class Family:
    """Levels of suffix arrays over one growing text; `matched` tells for each place so far whether the window there occurs again."""

    #: Windows of either side that are merged at once; their bytes are held meanwhile.
    SEGMENT = 2_048

    def __init__(self, length: int) -> None:
        self.length = length
        self.levels: list[Level] = []
        self.text = np.zeros(0, np.uint8)
        self.matched = np.zeros(0, bool)

    def add(self, contexts: list[bytes]) -> list[tuple[int, int]]:
        """Indexes the windows of the contexts; returns for each the places of its first window and after its last one."""
        text = np.frombuffer(b"".join(contexts), np.uint8)
        sizes = np.array([len(c) for c in contexts])
        counts = sizes - self.length + 1
        base = len(self.text)
        heads = np.cumsum(sizes) - sizes
        at = np.repeat(heads - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        self.text, self.matched = np.append(self.text, text), np.append(self.matched, np.zeros(len(text), bool))
        order, same = suffix_order(text, at, self.length)
        again = np.flatnonzero(same)
        self.matched[base + order[again]] = self.matched[base + order[again - 1]] = True
        # A level needs one place of each window: the others are marked by now.
        firsts = order[~same]
        new = Level(base + firsts, _leading(text, firsts, min(_LEAD, self.length)))
        for level in self.levels:
            below, held = self.scan(new, level)
            self.matched[new.start[held]] = self.matched[level.start[below[held]]] = True
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]) < 2 * len(self.levels[-1]):
            small, large = self.levels.pop(), self.levels.pop()
            below, held = self.scan(small, large)
            to = below[~held]
            self.levels.append(Level(np.insert(large.start, to, small.start[~held]), np.insert(large.lead, to, small.lead[~held])))
        return list(zip((base + heads).tolist(), (base + heads + counts).tolist(), strict=True))

    def scan(self, a: Level, b: Level) -> tuple[np.ndarray, np.ndarray]:
        """Merge scan: for each window of `a` the number of windows of `b` below it, and whether `b` holds it.

        Windows whose leading bytes the other level lacks are placed by these; the others are merged by all their bytes.
        """
        below = np.searchsorted(b.lead, a.lead)
        held = np.zeros(len(a), bool)
        tied = np.flatnonzero(b.lead[np.minimum(below, len(b) - 1)] == a.lead)
        back = np.searchsorted(a.lead, b.lead)
        met = np.flatnonzero(a.lead[np.minimum(back, len(a) - 1)] == b.lead)
        lead = b.lead[met]
        tail = self.text[self.length - 1 :]  # the last byte of the window at each place
        for lo, hi, left, right in self._segments(a.start[tied], b.start[met]):
            places = np.append(a.start[tied[lo:hi]], b.start[met[left:right]])
            windows = self._windows()[places]
            order = np.argsort(windows, kind="stable")  # two ascending runs, which this sort merges
            of_a = order < hi - lo
            near = np.flatnonzero(of_a[:-1] & ~of_a[1:])  # of two equal windows the one of `a` comes first
            near = near[tail[places[order[near]]] == tail[places[order[near + 1]]]]
            equal = np.zeros(len(order), bool)
            equal[near] = windows[order[near]] == windows[order[near + 1]]
            mine = np.flatnonzero(of_a)
            which = tied[lo + order[mine]]
            passed = left + np.cumsum(~of_a)[mine]
            below[which] += passed - np.searchsorted(lead, a.lead[which])
            held[which] = equal[mine]
        return below, held

    def _windows(self) -> np.ndarray:
        """All strings of `length` bytes of the text, none copied."""
        return np.ndarray((len(self.text) - self.length + 1,), f"S{self.length}", self.text, strides=(1,))

    def _segments(self, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """Bounds of parts of two ascending lists of windows that can be merged one by one: equal windows share a part."""
        at = lambda place: self.text[place : place + self.length].tobytes()
        cuts = {(k, bisect_left(b, at(a[k]), key=at)) for k in range(0, len(a), self.SEGMENT)}
        cuts |= {(bisect_left(a, at(b[k]), key=at), k) for k in range(0, len(b), self.SEGMENT)}
        ends = [*sorted(cuts | {(0, 0)}), (len(a), len(b))]
        for (lo, left), (hi, right) in itertools.pairwise(ends):
            if hi > lo:
                yield lo, hi, left, right


def _intervals(starts: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Byte runs covered by windows at these sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > length)
    return list(zip(starts[np.append(0, cut + 1)].tolist(), (starts[np.append(cut, len(starts) - 1)] + length).tolist(), strict=True))


_SPANS = pa.schema([("r", pa.int64()), ("s", pa.int64()), ("start", pa.int64()), ("stop", pa.int64())])


def _scanned(spec: Repeats):
    """Repeated stretches of the contexts that stand for one place only, from this task's index family."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family(spec.length)
        places: list[tuple[list[tuple[int, int]], list[tuple[int, int, int, int]]]] = []
        waiting: list[bytes] = []
        at: list[tuple[int, int, int, int]] = []
        size = 0

        def settle() -> None:
            nonlocal size
            if waiting:
                places.append((family.add(waiting), at.copy()))
            waiting.clear()
            at.clear()
            size = 0

        for batch in batches:
            for n, r, s, a, raw in zip(*(batch.column(c).to_pylist() for c in ("n", "r", "s", "a", "bytes")), strict=True):
                waiting.append(raw)
                at.append((n, r, s, a))
                size += len(raw)
                if size >= spec.batch:
                    settle()
        settle()
        out: list[tuple[int, int, int, int]] = []
        for bounds, where in places:
            for (first, stop), (n, r, s, a) in zip(bounds, where, strict=True):
                if n == 1:
                    hit = np.flatnonzero(family.matched[first:stop])
                    out += [(r, s, a + i, a + j) for i, j in _intervals(hit, spec.length)]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in (zip(*out, strict=True) if out else [[]] * 4)], schema=_SPANS)

    return run


def _windows(spec: Repeats):
    """Every window of a context by itself: fingerprints, place, whether it stands for one place only."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for n, r, s, a, raw in zip(*(batch.column(c).to_pylist() for c in ("n", "r", "s", "a", "bytes")), strict=True):
                text = np.frombuffer(raw, np.uint8)
                at = np.arange(len(text) - spec.length + 1)
                one, two = (Fingerprints(text, base).of(at, at + spec.length).view(np.int64) for base in _BASES)
                yield pa.record_batch([pa.array(one), pa.array(two), *(pa.array(np.full(len(at), x)) for x in (n, r, s)), pa.array(a + at)], names=["f", "g", "n", "r", "s", "start"])

    return run


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and a 128-bit key of the two. Rows equal in both share the key, and all that is found for it."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("r"), F.xxhash64(F.lit(1), "text").alias("s"))


def _spans(keyed: DataFrame, spec: Repeats) -> tuple[DataFrame, DataFrame]:
    """((r, s, start, stop) of repeated stretches, which may overlap; the texts (r, s, text) that have candidates)."""
    spark = keyed.sparkSession
    long = keyed.where(F.octet_length("text") >= spec.length).select("r", "s", "text")
    found = stored(long.mapInArrow(_found_runs(spec), _RUNS))
    contexts = found.groupBy("gram", "context").agg(F.count("*").alias("n"), F.min_by(F.struct("r", "s", "a", "b"), F.struct("r", "s", "a")).alias("at"))
    common = found.groupBy("gram").agg(F.count("*").alias("of_gram")).where("of_gram > 1")
    candidates = stored(contexts.join(common.select("gram"), "gram"))
    crowds = candidates.groupBy("gram").agg(F.count("*").alias("different")).where("different > 1")
    open_contexts = stored(candidates.join(crowds, "gram").select("gram", "context", "n", "at", (F.col("different") > spec.crowd).alias("crowded")))

    # Whole runs whose context occurs again.
    again = candidates.where("n > 1").select("gram", "context")
    whole = found.join(again, ["gram", "context"]).select("r", "s", F.col("a").alias("start"), (F.col("b") + spec.length).alias("stop"))

    # Texts with anything to look at are shuffled and stored once.
    touched = whole.select("r", "s").unionByName(open_contexts.select("at.r", "at.s")).distinct()
    texts = stored(long.join(touched, ["r", "s"], "left_semi").dropDuplicates(["r", "s"]))
    wanted = open_contexts.groupBy("at.r", "at.s").agg(F.collect_list(F.struct("gram", "context", "crowded", "n", "at.a", "at.b")).alias("wanted"))
    cut = texts.join(wanted, ["r", "s"]).select("r", "s", "text", "wanted").mapInArrow(_cut_out(spec), "gram bigint, context bigint, crowded boolean, n bigint, r bigint, s bigint, a bigint, bytes binary")
    cut = stored(cut)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-open_contexts.count() // spec.share))
    scanned = cut.where("NOT crowded").select("n", "r", "s", "a", "bytes", "gram").repartition(parts, "gram").mapInArrow(_scanned(spec), "r bigint, s bigint, start bigint, stop bigint")
    windows = cut.where("crowded").select("n", "r", "s", "a", "bytes").mapInArrow(_windows(spec), "f bigint, g bigint, n bigint, r bigint, s bigint, start bigint")
    twice = windows.groupBy("f", "g").agg(F.count("*").alias("k")).where("k > 1").select("f", "g")
    single = windows.where("n = 1").join(twice, ["f", "g"]).select("r", "s", "start", (F.col("start") + spec.length).alias("stop"))
    return whole.unionByName(scanned).unionByName(single), texts


def _merged(spans: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for x in sorted((x["start"], x["stop"]) for x in spans):
        if out and x[0] <= out[-1][1]:
            out[-1][1] = max(out[-1][1], x[1])
        else:
            out.append([*x])
    return [(a, b) for a, b in out]


def repeated_spans(docs: DataFrame, spec: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Maximal byte runs that go, of rows that have any: doc_id, spans (array of start, stop), kept (the bytes left)."""
    keyed = _keyed(docs, id_col, text_col)
    found = _found(keyed, spec, lambda raw, spans, kept: (spans, kept), "spans array<struct<start:bigint,stop:bigint>>, kept binary", [("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary())])
    return keyed.select("doc_id", "r", "s").join(found, ["r", "s"]).drop("r", "s")


def _found(keyed: DataFrame, spec: Repeats, give, ddl: str, fields: list) -> DataFrame:
    """(r, s, ...) of texts that have repeated stretches; `give` makes the further columns of a text."""
    spans, texts = _spans(keyed, spec)
    per_text = spans.distinct().groupBy("r", "s").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    schema = pa.schema([("r", pa.int64()), ("s", pa.int64()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r, s, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                raw, merged = text.encode(), _merged(found)
                kept = b"".join(raw[a:b] for a, b in zip([0, *(b for _, b in merged)], [*(a for a, _ in merged), len(raw)], strict=True))
                rows.append((r, s, *give(raw, [{"start": a, "stop": b} for a, b in merged], kept)))
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)

    return texts.join(per_text, ["r", "s"]).select("r", "s", "text", "spans").mapInArrow(run, f"r bigint, s bigint, {ddl}")


# ---- Passages in words --------------------------------------------------------------------------------------

#: Passages of so many words are always found, those of fewer than the second number never.
PASSAGE_WORDS, WINDOW_WORDS = 51, 36


def sampled_windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(text's number, hash) of sampled runs of WINDOW_WORDS words, in lower case (A-Z).

    Of the windows in each PASSAGE_WORDS words the one with the smallest hash is taken, so two texts that share so many
    words take an equal window from them.
    """
    words, offsets = word_hashes(texts)
    n = len(words) - WINDOW_WORDS + 1
    if len(words) < PASSAGE_WORDS:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    hashes = Fingerprints(words).of(slice(0, n), slice(WINDOW_WORDS, None))
    low = np.uint64((1 << _PLACE) - 1)
    best = (hashes & ~low) | np.arange(n, dtype=np.uint64)
    wide, left = 1, PASSAGE_WORDS - WINDOW_WORDS + 1
    while wide * 2 <= left:
        best = np.minimum(best[:-wide], best[wide:])
        wide *= 2
    if left > wide:
        best = np.minimum(best[: len(best) - (left - wide)], best[left - wide :])
    owner = np.repeat(np.arange(len(texts)), np.diff(offsets))
    inside = np.flatnonzero(np.arange(len(best)) + PASSAGE_WORDS <= offsets[1:][owner[: len(best)]])
    place = np.unique((best[inside] & low).astype(np.int64))
    return owner[place], hashes[place].view(np.int64)


def _windows_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r, texts = batch.column(0).to_numpy(), [x.encode() for x in batch.column(1).to_pylist()]
        at = 0
        for lo, hi in slices(texts, 2_000_000):
            for part, of_part in _cut_long(texts[lo:hi]):
                i, hashes = sampled_windows(part)
                yield pa.record_batch([pa.array(hashes), pa.array(r[at + of_part[i]])], names=["window", "r"])
            at = hi


def _cut_long(texts: list[bytes]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """The texts and their numbers; a text of more words than places are told apart comes alone, in overlapping parts."""
    if len(texts) > 1 or len(texts[0]) < 2 << _PLACE:  # a word and the space after it are two bytes at least
        yield texts, np.arange(len(texts))
        return
    words = texts[0].split()
    step = (1 << _PLACE) - PASSAGE_WORDS
    for a in range(0, len(words), step):
        yield [b" ".join(words[a : a + step + PASSAGE_WORDS - 1])], np.zeros(1, np.int64)


def shared_passages(keyed: DataFrame) -> DataFrame:
    """(r, n_shared_passages) of rows with a sampled window that another row has, too."""
    taken = keyed.select("r", "text").mapInArrow(_windows_of_texts, "window bigint, r bigint")
    # Counted before rows meet. Stored, so that the join has exchanges of its own and Spark can split a very common window.
    common = stored(taken.groupBy("window").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).where("lo <> hi").select("window"))
    return taken.join(common, "window", "left_semi").groupBy("r").agg(F.count("*").alias("n_shared_passages"))


def dedup_counts(docs: DataFrame, spec: Repeats = Repeats(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_shared_passages, one row per input row.

    Every byte goes that a string of `length` bytes covers which also starts anywhere else, in the same text or another;
    strings lie inside one text and are judged on the texts as given, so all copies go. A null text counts as empty. Null
    or repeated ids keep their rows, and rows equal in id and text are each other's copies. Other columns are not read.

    Nothing goes for n_shared_passages, which counts sampled windows of 36 words that other rows have, too: it is above 0 for every text that
    shares a passage of more than 50 words, however few bytes that has, and 0 for one that shares none of 36 words.
    """
    keyed = _keyed(docs, id_col, text_col)

    def digest(raw: bytes, spans: list[dict], kept: bytes) -> tuple:
        return len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()

    found = _found(keyed, spec, digest, "n_removed bigint, n_spans bigint, sha string", [("n_removed", pa.int64()), ("n_spans", pa.int64()), ("sha", pa.string())])
    every = keyed.select("doc_id", "r", "s", F.octet_length("text").cast("bigint").alias("n_bytes"), F.sha2(F.col("text").cast("binary"), 256).alias("all_sha"))
    out = every.join(found, ["r", "s"], "left").join(shared_passages(keyed), "r", "left")
    removed, spans, passages = (F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("n_removed", "n_spans", "n_shared_passages"))
    return out.select("doc_id", "n_bytes", removed, spans, F.coalesce("sha", "all_sha").alias("kept_sha256"), passages)
