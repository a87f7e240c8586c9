"""Periodic runs: stretches of words that repeat with a period, at least four times.

A run with period q has at least 3q (and 5) places whose word equals the one q places on. Periods are taken in bands
(2^(j-1), 2^j]; in a band every run has some fixed number of such places in a row, and that many words are indexed.
Occurrences of equal k-grams in one document are paired with the next one only: as k is no less than the period, the
next occurrence of a k-gram inside a run lies one period on, so every run has a seed and no other pairs are needed.
Seeds are extended along their diagonal (equal lag) as far as words agree. For each lag, the furthest place that is
covered suppresses seeds inside what has been extended before.

Defined results: words are runs of characters other than space and tab to carriage return. A null or empty text has
no words and no runs. A row without an id is taken as its text stands. Rows are treated one by one, repeated ones
too. Other columns are neither read nor passed on. A task holds the words of a few documents, or of one long one.
"""

from __future__ import annotations

import hashlib
import itertools
import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.shared import mixed, slices

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Bytes of text that are searched together.
BATCH_BYTES = 1_000_000

_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_runs", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64()), ("exponent_milli", pa.int64()), ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]
)


def looped(doc_id: int | None, n: int) -> np.ndarray | None:
    """For one document in ten the places of the words that its text is made of: its end repeats some words. Else None."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % p
    return places


def _bands(longest: int) -> Iterator[tuple[int, int, int]]:
    """(shortest period, longest period, equal places that any run of these periods has in a row)."""
    low, high = 1, 1
    while LEAST_PERIODS * low <= longest:
        yield low, high, max(LEAST_WORDS, LEAST_PERIODS * low) - low
        low, high = high + 1, 2 * high


def _grams(hashes: dict[int, np.ndarray], k: int) -> np.ndarray:
    """Hashes of all k-grams, from those of half as many words."""
    if k not in hashes:
        half = 1 << (k - 1).bit_length() - 1
        shorter = _grams(hashes, half)
        size = len(shorter) - (k - half)
        hashes[k] = mixed(shorter[:size] * np.uint64(0x9E3779B97F4A7C15) + shorter[k - half :][:size]) if size > 0 else shorter[:0]
    return hashes[k]


def _seeds(grams: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose gram occurs next at a lag from low to high, and the lags, by lag and place."""
    order = np.argsort(grams, kind="stable")
    same = grams[order[1:]] == grams[order[:-1]]
    lag = order[1:] - order[:-1]
    fits = same & (lag >= low) & (lag <= high)
    places, lags = order[:-1][fits], lag[fits]
    by = np.lexsort((places, lags))
    return places[by], lags[by]


def _reach(words: np.ndarray, at: int, lag: int, step: int, stop: int) -> int:
    """How far from `at` in direction `step`, up to `stop`, words equal those `lag` on. Blocks double as long as they agree."""
    block = 32
    while at != stop:
        end = min(stop, at + block) if step > 0 else max(stop, at - block)
        lo, hi = (at, end) if step > 0 else (end, at)
        differ = np.flatnonzero(words[lo:hi] != words[lo + lag : hi + lag])
        if len(differ):
            return lo + differ[0] if step > 0 else lo + differ[-1] + 1
        at, block = end, 2 * block
    return stop


def find_runs(words: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int]]:
    """(start, end, period) of every run in texts that lie one after the other; bounds: where each begins, and the end.

    Texts share numbers of equal words; a run lies in one text.
    """
    found = []
    lengths = np.diff(bounds)
    # A text's words get hashes of its own, so that grams of different texts or over their limits never agree.
    own = mixed(words.astype(np.uint64) + np.repeat(np.arange(len(lengths), dtype=np.uint64) << np.uint64(36), lengths) + np.uint64(1))
    hashes = {1: own}
    for low, high, k in _bands(int(lengths.max(initial=0))):
        covered: dict[int, int] = {}
        for place, lag in zip(*(x.tolist() for x in _seeds(_grams(hashes, k), low, high)), strict=True):
            if place < covered.get(lag, 0):
                continue
            text = np.searchsorted(bounds, place, "right") - 1
            first, last = int(bounds[text]), int(bounds[text + 1])
            start, end = _reach(words, place, lag, -1, first), _reach(words, place, lag, 1, last - lag) + lag
            covered[lag] = end - lag + 1
            if end - start >= max(LEAST_WORDS, LEAST_PERIODS * lag):
                found.append((start, end, lag))
        hashes = {n: h for n, h in hashes.items() if n & (n - 1) == 0}
    return found


def _described(doc_id: int | None, words: list[bytes], runs: list[tuple[int, int, int]]) -> tuple:
    listed = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    best = min(runs, key=lambda r: (r[0] - r[1], r[0], r[2]), default=None)
    if runs:
        steps = np.zeros(len(words) + 1, np.int64)
        for s, e, q in runs:
            steps[s + q] += 1
            steps[e] -= 1
        words = list(itertools.compress(words, (np.cumsum(steps[:-1]) == 0).tolist()))
    figures = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    return doc_id, len(runs), *figures, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(b" ".join(words)).hexdigest()


def _runs_of_texts(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        texts = [x or b"" for x in texts]
        for lo, hi in slices(texts, size):
            number: dict[bytes, int] = defaultdict(itertools.count().__next__)
            split, codes = [], []
            for doc_id, text in zip(ids[lo:hi], texts[lo:hi], strict=True):
                words = text.split()  # of bytes: at space and tab to carriage return
                code = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
                if (places := looped(doc_id, len(words))) is not None:
                    words, code = [words[i] for i in places.tolist()], code[places]
                split.append(words)
                codes.append(code)
            bounds = np.concatenate(([0], np.cumsum([len(c) for c in codes])))
            per_text: dict[int, list] = defaultdict(list)
            for start, end, period in sorted(find_runs(np.concatenate(codes), bounds), key=lambda r: (r[0], r[2])):
                text = int(np.searchsorted(bounds, start, "right")) - 1
                at = int(bounds[text])
                per_text[text].append((start - at, end - at, period))
            rows = [_described(doc_id, words, per_text.get(i, [])) for i, (doc_id, words) in enumerate(zip(ids[lo:hi], split, strict=True))]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), _SCHEMA, strict=True)], schema=_SCHEMA)


def periodic_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES) -> DataFrame:
    """Per document its number of runs, the longest one, and digests of all runs and of the text without repetitions.

    doc_id, n_runs, start, length, period, exponent_milli (null without a run; ties: smallest start, then period),
    runs_sha256 (of `start,length,period` lines by start, then period), collapsed_sha256 (of the words outside the
    repetitions, joined by spaces). Cases are defined above.
    """
    read = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    return read.mapInArrow(lambda b: _runs_of_texts(b, batch_bytes), "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, runs_sha256 string, collapsed_sha256 string")
