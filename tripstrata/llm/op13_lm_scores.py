"""Language-model scores: log10 probability of every text under a model of word pairs learned from the corpus.

Word counts are exact. Counts of word pairs are held as powers of two in a log-frequency Bloom filter: a pair with
level j = 1 + floor(log2(count)) is entered under the keys (pair, 1) to (pair, j), and its level is read by probing
(pair, 1), (pair, 2), ... until a probe fails. A level stands for the mean of the counts it may have. False hits
(below 1 % of the probes) can only raise a level.

The filter consists of shards by hash of the pair, each made by one task for about 2 million training tokens, so it
grows with the corpus. Up to `filter_bytes` it is broadcast. Beyond, the pairs of each chunk of documents are sent to
their shards and come back with their levels; the answers are the same bits probed the same way.

Word counts are never broadcast: each chunk of about 8 MB of text asks for the words that it holds.

Smoothing: the probability of a word after another is (1 - w) * unigram + w * pair share, for several weights w, 0
among them. The text's probability is the mean over the weights of its probability under each, which needs no tuning
and is at most log10(number of weights) below that of the best weight for that text. The unigram is (c + 0.5) /
(N + 0.5 * (V + 1)), where all unknown words count as one.

Defined results: tokens are the words of the text in lower case (A-Z), then one end, which counts as a token. A null
or empty text has the end alone. A row without an id is not held out. Without training rows N and V are 0. Repeated
rows are scored, and learned from, each for itself. Other columns are neither read nor passed on. Words and pairs are
told apart by 64-bit hashes. The input must give equal rows in equal partitions when it is read twice, as stored tables
do; if a chunk misses a word's count, the job fails.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.shared import mixed, slices, stored, word_hashes

#: Texts of about so many bytes ask for their words' counts together; so many are hashed at once, which takes some 40 times
#: their size.
CHUNK_BYTES, SLICE_BYTES = 8_000_000, 500_000
#: Rows of a batch that are Python objects at a time; bytes of counts that go out at a time.
ROWS, SENT_BYTES = 200, 4_000_000
#: Training tokens per shard of the filter; bits per entry and probes per key.
SHARD_TOKENS, BITS, PROBES = 1 << 21, 10, 7
#: The filter is broadcast up to this size.
FILTER_BYTES = 160_000_000
#: Weights of the pair shares; 0 is the unigram model.
WEIGHTS = (0.0, 0.2, 0.4, 0.6, 0.8, 0.95)
#: One document in FOLDS, by checksum of its id, is held out.
FOLDS, HELD_OUT = 5, 1

END = np.uint64(0xC2B2AE3D27D4EB4F)
_COUNTS = "shard bigint, pairs binary, counts binary"
_TEXTS = "chunk bigint, doc_id bigint, text binary"
_ASKED = "shard bigint, chunk bigint, pairs binary"
_STEP, _OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def held_out(doc_id: int | None) -> bool:
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % FOLDS == HELD_OUT


def tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text closed by END, and where each text begins."""
    words, offsets = word_hashes(texts)
    ends = offsets[1:] + np.arange(len(texts))
    out = np.full(len(words) + len(texts), END)
    out[np.arange(len(words)) + np.repeat(np.arange(len(texts)), np.diff(offsets))] = words
    return out, np.concatenate(([0], ends[:-1] + 1)).astype(np.int64)


def pair_hashes(found: np.ndarray) -> np.ndarray:
    """A hash of each token but the last with the next one."""
    return mixed(found[:-1] * _STEP + found[1:])


# ---- The filter ----------------------------------------------------------------------------------------------


def shard_of(pairs: np.ndarray, shards: int) -> np.ndarray:
    """Shards are ranges of the hash, so sorted hashes lie in runs of one shard."""
    return ((pairs >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts)[1].astype(np.int64)


#: The mean of the counts of each level; none for level 0.
MEAN_COUNT = np.concatenate(([0.0], (2.0 ** np.arange(63) + 2.0 ** np.arange(1, 64) - 1) / 2))


def _walk(pairs: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the probes for a pair at a level start, and their step."""
    key = mixed(pairs + np.uint64(level * int(_OTHER) % 2**64))
    return key, mixed(key) | np.uint64(1)


def filter_bits(pairs: np.ndarray, counts: np.ndarray, bits_per_entry: int = BITS) -> bytes:
    """One shard's bits: every pair under each level up to its own."""
    levels = level_of(counts)
    size = 8 * (int(levels.sum()) * bits_per_entry // 8 + 8)
    bits = np.zeros(size, bool)
    for level in range(1, int(levels.max(initial=0)) + 1):
        at, step = _walk(pairs[levels >= level], level)
        for _ in range(PROBES):
            bits[at % np.uint64(size)] = True
            at += step
    return np.packbits(bits).tobytes()


class Filter:
    """Shards side by side in one array of bytes. Shards that are joined already, `lengths` their bytes, are not copied."""

    def __init__(self, shards: list[bytes], lengths: list[int] | None = None):
        self.sizes = 8 * np.array([len(x) for x in shards] if lengths is None else lengths, np.uint64)
        self.starts = np.concatenate(([0], np.cumsum(self.sizes)))[:-1].astype(np.uint64)
        self.bits = np.frombuffer(shards[0] if len(shards) == 1 else b"".join(shards), np.uint8)

    def levels(self, pairs: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The level under which each pair is found, 0 for none."""
        found = np.zeros(len(pairs), np.int64)
        alive, level = np.arange(len(pairs)), 0
        while len(alive):
            level += 1
            at, step = _walk(pairs[alive], level)
            starts, sizes = self.starts[shard[alive]], self.sizes[shard[alive]]
            for _ in range(PROBES):
                bit = starts + at % sizes
                byte = self.bits[(bit >> np.uint64(3)).astype(np.int64)]
                hit = np.flatnonzero(byte & (np.uint8(128) >> (bit & np.uint64(7)).astype(np.uint8)))
                alive, at, step, starts, sizes = alive[hit], at[hit] + step[hit], step[hit], starts[hit], sizes[hit]
            found[alive] = level
        return found


def _packed(numbers: np.ndarray) -> bytes:
    """8-byte numbers by place of the byte: sorted ones then compress well in a shuffle."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def _by_shard(pairs: np.ndarray, shards: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of the runs of sorted hashes."""
    owner = shard_of(pairs, shards)
    cuts = np.concatenate(([0], np.flatnonzero(owner[1:] != owner[:-1]) + 1, [len(owner)]))
    if len(owner):
        yield from zip(owner[cuts[:-1]].tolist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    """Rows under a schema of bigint and binary columns."""
    fields = [x.split(" ") for x in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    kinds = {"bigint": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)], names=[k for k, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    """(id, text) of every row, a null text empty. Only few rows of a batch are copied at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                yield doc_id, text or b""


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers and how often each occurs. `held` is emptied, and the numbers are sorted in place."""
    every = np.concatenate([np.empty(0, np.uint64), *held])
    held.clear()
    every.sort()
    first = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1]))[: len(every)])
    return every[first], np.diff(np.append(first, len(every)))


def _pair_counts(shards: int):
    """Counts of the training texts' word pairs, summed over some millions of tokens before they are sent."""

    def sent(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        pairs, counts = _counted(held)
        rows, size = [], 0
        for s, lo, hi in _by_shard(pairs, shards):
            rows.append((s, _packed(pairs[lo:hi]), _packed(counts[lo:hi])))
            size += 16 * (hi - lo)
            if size >= SENT_BYTES:
                yield _batch(_COUNTS, rows)
                rows, size = [], 0
        if rows:
            yield _batch(_COUNTS, rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for _, ids, texts in _chunks(batches, SLICE_BYTES):
            found, _ = tokens([t for i, t in zip(ids, texts, strict=True) if not held_out(i)])
            held.append(pair_hashes(found)[found[:-1] != END])
            size += len(found)
            if size >= 2 * SHARD_TOKENS:
                yield from sent(held)
                size = 0
        yield from sent(held)

    return run


def _shard_filter(key: tuple, parts: pa.Table, bits: int) -> pa.Table:
    pairs = np.concatenate([_unpacked(x) for x in parts["pairs"].to_pylist()])
    counts = np.concatenate([_unpacked(x) for x in parts["counts"].to_pylist()])
    pairs, at = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(pairs), np.uint64)
    np.add.at(total, at, counts)
    return pa.table({"shard": pa.array([key[0].as_py()], pa.int64()), "bits": pa.array([filter_bits(pairs, total, bits)], pa.binary())})


# ---- Chunks and their words ----------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[int, list, list[bytes]]]:
    """(chunk, ids, texts) of a partition's rows, about `most` bytes of text each; whole texts, one at least."""
    first, k, ids, texts, size = TaskContext.get().partitionId() << 32, 0, [], [], 0
    for doc_id, text in _rows(batches):
        if ids and size + len(text) > most:
            yield first + k, ids, texts
            k, ids, texts, size = k + 1, [], [], 0
        ids.append(doc_id)
        texts.append(text)
        size += len(text) + 8
    if ids:
        yield first + k, ids, texts


def _chunk_texts(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    for chunk, ids, texts in _chunks(batches, most):
        yield _batch(_TEXTS, [(chunk, i, t) for i, t in zip(ids, texts, strict=True)])


def _chunk_words(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Each chunk's words, and how often its training texts have them."""
    for chunk, ids, texts in _chunks(batches, most):
        words, counts = [], []
        for lo, hi in slices(texts, SLICE_BYTES):
            found, begins = tokens(texts[lo:hi])
            learned = np.repeat([not held_out(i) for i in ids[lo:hi]], np.diff(np.append(begins, len(found))))
            distinct, at = np.unique(found, return_inverse=True)
            words.append(distinct)
            counts.append(np.bincount(at, learned, len(distinct)).astype(np.int64))
        distinct, at = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(distinct), chunk)), pa.array(distinct.view(np.int64)), pa.array(total)], names=["chunk", "word", "n"])


def _chunk_pairs(shards: int, most: int):
    """The distinct word pairs of each chunk, held-out texts included, by shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk, _, texts in _chunks(batches, most):
            pairs = np.unique(np.concatenate([pair_hashes(tokens(texts[lo:hi])[0]) for lo, hi in slices(texts, SLICE_BYTES)]))
            yield _batch(_ASKED, [(s, chunk, _packed(pairs[lo:hi])) for s, lo, hi in _by_shard(pairs, shards)])

    return run


def _answers(asked: pa.Table, shard: pa.Table) -> pa.Table:
    """The levels of asked pairs, from the one filter shard that would hold them."""
    known = Filter(shard["bits"].to_pylist())
    chunks, pairs, levels = asked["chunk"].to_pylist(), asked["pairs"].to_pylist(), []
    for packed in pairs:
        own = _unpacked(packed)
        found = known.levels(own, np.zeros(len(own), np.int64)) if len(known.sizes) else np.zeros(len(own), np.int64)
        levels.append(found.astype(np.uint8).tobytes())
    n = len(chunks)
    return pa.table({"chunk": pa.array(chunks, pa.int64()), "word": pa.array([0] * n, pa.int64()), "total": pa.array([0] * n, pa.int64()), "pairs": pa.array(pairs, pa.binary()), "levels": pa.array(levels, pa.binary())})


# ---- Scores --------------------------------------------------------------------------------------------------

_SCORES = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"


def _scorer(total: int, distinct: int, known: object, shards: int):
    """Scores of a chunk's texts. `known`: the broadcast filter, or None where answers come with the words."""

    def run(texts: pa.Table, told: pa.Table) -> pa.Table:
        asked = np.array([x is not None for x in told["pairs"].to_pylist()], bool)
        words, counts = told["word"].to_numpy()[~asked].view(np.uint64), told["total"].to_numpy()[~asked]
        order = np.argsort(words)
        words, counts = words[order], counts[order]
        if known is None:
            answered = [told[k].filter(pa.array(asked)).to_pylist() for k in ("pairs", "levels")]
            pairs = np.concatenate([np.empty(0, np.uint64), *map(_unpacked, answered[0])])
            answer = np.concatenate([np.empty(0, np.uint8), *(np.frombuffer(x, np.uint8) for x in answered[1])])
            by = np.argsort(pairs)
            pairs, answer = pairs[by], answer[by].astype(np.int64)
        ids, bodies, out = texts["doc_id"].to_pylist(), texts["text"].to_pylist(), []
        for lo, hi in slices(bodies, SLICE_BYTES):
            found, begins = tokens(bodies[lo:hi])
            own, place = np.unique(found, return_inverse=True)
            at = np.searchsorted(words, own)
            if at[-1] >= len(words) or (words[at] != own).any():
                raise RuntimeError("a chunk misses counts of its words: the input's partitions changed between two reads")
            count = counts[at][place]
            unigram = (count + 0.5) / (total + 0.5 * (distinct + 1))
            follows = np.ones(len(found), bool)
            follows[begins] = False
            after = np.flatnonzero(follows)
            hashed = pair_hashes(found)[after - 1]
            if known is None:
                level = answer[np.searchsorted(pairs, hashed)]
            else:
                level = Filter(*known.value).levels(hashed, shard_of(hashed, shards)) if shards else np.zeros(len(hashed), np.int64)
            before = count[after - 1].astype(float)
            share = np.zeros(len(found))
            share[after] = np.minimum(MEAN_COUNT[level], before) / np.maximum(before, 1)
            mixable = np.zeros(len(found), bool)
            mixable[after] = before > 0
            sums = []
            for weight in WEIGHTS:
                each = np.log10(np.where(mixable, (1 - weight) * unigram + weight * share, unigram))
                sums.append(np.add.reduceat(each, begins))
            best = np.max(sums, axis=0)
            score = best + np.log10(np.mean(10.0 ** (np.array(sums) - best), axis=0))
            n = np.diff(np.append(begins, len(found)))
            out.append((np.array([held_out(i) for i in ids[lo:hi]], bool), n, np.add.reduceat((count > 0).astype(np.int64), begins), np.full(len(n), total), sums[0], score))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [[]] * 6
        names = [x.split(" ")[0] for x in _SCORES.split(", ")]
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64()]
        return pa.table({k: pa.array(c, t) for k, c, t in zip(names, [ids, *columns], kinds, strict=True)})

    return run


def _joined(filters: DataFrame, shards: int) -> tuple[list[bytearray], list[int]]:
    """The filter for a broadcast: one copy of its shards, which the workers read in place, and their lengths."""
    lengths = [8] * shards
    for r in filters.select("shard", F.octet_length("bits").alias("n")).toLocalIterator():
        lengths[r["shard"]] = r["n"]
    starts = np.concatenate(([0], np.cumsum(lengths))).astype(np.int64).tolist()
    joined = bytearray(starts[-1])
    for r in filters.toLocalIterator():
        joined[starts[r["shard"]] : starts[r["shard"] + 1]] = r["bits"]
    return [joined], lengths


def lm_scores(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", filter_bytes: int = FILTER_BYTES, chunk_bytes: int = CHUNK_BYTES, shard_tokens: int = SHARD_TOKENS, bits: int = BITS) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    base_score sums the unigram's log10, score is the log10 probability under the smoothed model. Documents whose
    checksum of id leaves 1 modulo 5 are held out of all counts. Cases are defined above.
    """
    spark = docs.sparkSession
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    everywhere = Window.partitionBy("word")
    words = stored(
        read.mapInArrow(lambda b: _chunk_words(b, chunk_bytes), "chunk bigint, word bigint, n bigint").withColumns(
            {"total": F.sum("n").over(everywhere), "first": F.min("chunk").over(everywhere) == F.col("chunk")}
        )
    )
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.expr("first AND total > 0"))).first()
    shards = -(-total // shard_tokens)
    counts = read.mapInArrow(_pair_counts(max(shards, 1)), _COUNTS)
    filters = stored(counts.groupBy("shard").applyInArrow(lambda key, parts: _shard_filter(key, parts, bits), "shard bigint, bits binary"))
    told = words.select("chunk", "word", "total", F.lit(None).cast("binary").alias("pairs"), F.lit(None).cast("binary").alias("levels"))
    if filters.agg(F.coalesce(F.sum(F.octet_length("bits")), F.lit(0))).first()[0] <= filter_bytes:
        known = spark.sparkContext.broadcast(_joined(filters, shards))
    else:
        known = None
        asked = read.mapInArrow(_chunk_pairs(shards, chunk_bytes), _ASKED)
        answers = asked.groupBy("shard").cogroup(filters.groupBy("shard")).applyInArrow(_answers, told.schema)
        told = told.unionByName(answers)
    texts = read.mapInArrow(lambda b: _chunk_texts(b, chunk_bytes), _TEXTS)
    return texts.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(_scorer(total, distinct, known, shards), _SCORES)
