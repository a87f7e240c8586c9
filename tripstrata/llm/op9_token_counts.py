"""Token counts of whole texts by rank-synchronous merging of ragged symbol arrays.

Distinct pieces of a batch lie behind one another in one symbol array. In each round every piece applies its own
lowest-ranked pair at all places where it occurs, all pieces at once; pieces without a mergeable pair leave.
A merged token arises from one pair only, so a pair that holds it ranks later than the merge that made it, and
applying all occurrences together gives what one-by-one merging gives. The symbols left are counted.
"""

from __future__ import annotations

import functools
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.pretokens import SPACED, byte_letters, parts, splitter

SCHEMA = "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean"
_NONE = np.iinfo(np.int32).max
#: Piece counts that a Python worker remembers; beyond it forgets all and counts them again when met.
REMEMBERED = 400_000
#: Characters of text whose unknown pieces are counted together.
SETTLED_AT = 3_000_000


class Merges:
    """Merge ranks of a byte-level vocabulary file of the tokenizers library, as arrays."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        vocab, merges = read["model"]["vocab"], read["model"]["merges"]
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        self.size = max(vocab.values()) + 1
        keys = np.fromiter((vocab[a] * self.size + vocab[b] for a, b in pairs), np.int64, len(pairs))
        self.order = np.argsort(keys)
        self.keys = np.append(keys[self.order], np.iinfo(np.int64).max)
        self.order = np.append(self.order, _NONE).astype(np.int32)
        self.made = np.fromiter((vocab[a + b] for a, b in pairs), np.int32, len(pairs))
        self.of_byte = np.fromiter((vocab[x] for x in byte_letters()), np.int32, 256)
        self.special = [t["content"] for t in read.get("added_tokens", []) if not t.get("normalized")]
        self.path, self.known = path, {}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.order[at], _NONE)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Number of tokens of each piece."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        out = lengths.copy()
        symbols = self.of_byte[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        rank = np.full(len(symbols), _NONE, np.int32)  # of the pair that starts here
        same = np.flatnonzero(owner[1:] == owner[:-1])
        rank[same] = self.ranks(symbols[same], symbols[same + 1])
        while len(symbols):
            heads = np.flatnonzero(np.diff(owner, prepend=-1))
            sizes = np.diff(np.append(heads, len(owner)))
            lowest = np.minimum.reduceat(rank, heads)
            done = lowest == _NONE
            if done.any():
                out[owner[heads[done]]] = sizes[done]
                stay = np.repeat(~done, sizes)
                symbols, owner, rank = symbols[stay], owner[stay], rank[stay]
                lowest, sizes = lowest[~done], sizes[~done]
                if not len(symbols):
                    break
            hit = np.flatnonzero(rank == np.repeat(lowest, sizes))
            # Of overlapping occurrences (a run of one symbol) every second one goes, from the left.
            first = np.flatnonzero(np.diff(hit, prepend=-2) != 1)
            hit = hit[(np.arange(len(hit)) - np.repeat(first, np.diff(np.append(first, len(hit))))) % 2 == 0]
            symbols[hit] = self.made[rank[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            moved = np.cumsum(keep)[hit] - 1
            symbols, owner, rank = symbols[keep], owner[keep], rank[keep]
            for at in (moved, moved[moved > 0] - 1):  # the pairs that start or end at a new symbol
                rank[at] = _NONE
                inner = at[at + 1 < len(symbols)]
                inner = inner[owner[inner] == owner[inner + 1]]
                rank[inner] = self.ranks(symbols[inner], symbols[inner + 1])
        return out

    @functools.cached_property
    def library(self):
        from tokenizers import Tokenizer

        return Tokenizer.from_file(self.path)

    def of_texts(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text. Pieces that the worker doesn't remember are counted together, for some MB of text at a time."""
        out = np.zeros(len(texts), np.int64)
        waiting: list[tuple[int, list[str]]] = []
        held = 0

        def settle() -> None:
            if len(self.known) > REMEMBERED:
                self.known = {}
            new = list(set().union(*(pieces for _, pieces in waiting)).difference(self.known))
            if new:
                self.known.update(zip(new, self.counts([x.encode() for x in new]).tolist(), strict=True))
            for i, pieces in waiting:
                out[i] += sum(map(self.known.__getitem__, pieces))
            waiting.clear()

        for i, text in enumerate(texts):
            for part in self.ordinary(text or "", out, i):
                split = splitter(SPACED, part)
                if split is None:
                    out[i] += len(self.library.encode(part, add_special_tokens=False).ids)
                    continue
                waiting.append((i, split(part)))
                held += len(part)
                if held > SETTLED_AT:
                    settle()
                    held = 0
        settle()
        return out

    def ordinary(self, text: str, out: np.ndarray, i: int) -> Iterator[str]:
        """The parts of the text between special strings; each of those counts as a token in `out`."""
        pieces = [text]
        for special in self.special:
            if special in text:
                pieces = [x for piece in pieces for x in piece.split(special)]
        out[i] += len(pieces) - 1
        for piece in pieces:
            yield from parts(piece)


@functools.cache
def merges(path: str) -> Merges:
    return Merges(path)


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token count of every row's whole text under the byte-level vocabulary file `tokenizer`.

    One row per input row: doc_id, n_bytes (UTF-8), n_tokens, over_limit (more than `limit` tokens). A null text
    counts as empty (0, 0, false); null or repeated ids keep their rows; other columns, whatever their names, are
    not read. An empty table gives no rows. Special strings inside texts count as one token each. The file must
    exist on every executor. There is no shuffle; memory is bounded by an Arrow batch and the piece memory.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = merges(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1).to_pylist()
            n_bytes = np.fromiter((len(x.encode()) if x else 0 for x in texts), np.int64, len(texts))
            n_tokens = model.of_texts(texts)
            yield pa.record_batch([ids, pa.array(n_bytes), pa.array(n_tokens), pa.array(n_tokens > limit)], names=["doc_id", "n_bytes", "n_tokens", "over_limit"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, SCHEMA)
