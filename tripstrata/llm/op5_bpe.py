"""Encoding and decoding with a byte-pair vocabulary whose tokens mark word ends, by tree concatenation.

Text is normalized and split into words as the vocabulary file says. A word of up to `LEAF` symbols is encoded by the
library's merges at once; a longer one ("unsplit text") is halved down to such leaves, which are encoded side by
side, and the halves' results are joined: a window around each join is encoded again and grows on both sides until
its first token is the left side's and its last token the right side's. A token sequence is the encoding of its text
exactly if each two neighbours are the encoding of theirs, so such a window makes the whole exact.

Documents of more than `spread` characters are cut into rows of some 10,000 characters that Spark deals out anew;
a word cut by a row's end is joined, by the same windows, when the document's rows come together again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import unicodedata
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstrata.llm.pretokens import WORDS, byte_letters, parts, splitter

SCHEMA = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
IDS_SCHEMA = "doc_id bigint, ids array<int>, decoded string"
#: Symbols of a word that are encoded in one go.
LEAF = 256
#: Words that a Python worker remembers; beyond it forgets all of them.
REMEMBERED = 200_000


class Vocabulary:
    """A vocabulary file of the tokenizers library: lower case, byte letters, an end mark in the last symbol."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            read = json.load(file)
        self.library = Tokenizer.from_str(json.dumps(read))
        self.ends = self.library.model
        self.mark = read["model"]["end_of_word_suffix"]
        self.vocab: dict[str, int] = read["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in read["added_tokens"]}
        self.shown = {i: t for t, i in (self.vocab | self.special).items()}
        read["model"]["end_of_word_suffix"] = None
        self.opens = Tokenizer.from_str(json.dumps(read)).model
        self.letters = dict(enumerate(byte_letters()))
        self.known: dict[str, tuple[str, str, int]] = {}

    # -- words ------------------------------------------------------------------------------------------------

    def leaf(self, symbols: str, last: bool) -> list[int]:
        return [t.id for t in (self.ends if last else self.opens).tokenize(symbols)] if symbols else []

    def symbols(self, token: int) -> str:
        return self.shown[token].removesuffix(self.mark)

    def encode(self, symbols: str, last: bool = True) -> list[int]:
        """Tokens of a run of byte letters; `last` if a word ends with it."""
        if len(symbols) <= LEAF:
            return self.leaf(symbols, last)
        half = len(symbols) // 2
        return self.join(self.encode(symbols[:half], False), self.encode(symbols[half:], last), last)

    def join(self, left: list[int], right: list[int], last: bool) -> list[int]:
        """Tokens of two neighbouring runs' text from the tokens of each."""
        if not left or not right:
            return left or right
        size = 1
        while True:
            i, j = min(size, len(left)), min(size, len(right))
            ended = last and j == len(right)
            window = self.leaf("".join(map(self.symbols, left[-i:] + right[:j])), ended)
            if (i == len(left) or window[0] == left[-i]) and (j == len(right) or window[-1] == right[j - 1]):
                return left[:-i] + window + right[j:]
            size *= 2

    def word(self, word: str) -> tuple[str, str, int]:
        """A word's ids as text, its tokens as text, their number."""
        ids = self.encode("".join(map(self.letters.__getitem__, word.encode())))
        return " ".join(map(str, ids)), " ".join(map(self.shown.__getitem__, ids)), len(ids)

    # -- texts ------------------------------------------------------------------------------------------------

    def plain(self, text: str) -> str:
        """The normalized text, but for white space, which separates words and then goes."""
        if text.isascii():
            return text.lower()
        return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()  # no special letter at a word's end

    def stretches(self, text: str) -> Iterator[str | int]:
        """The text between special strings, and the ids of those, leftmost first."""
        while True:
            found = min(((at, s) for s in self.special if (at := text.find(s)) >= 0), default=None)
            if found is None:
                yield text
                return
            yield text[: found[0]]
            yield self.special[found[1]]
            text = text[found[0] + len(found[1]) :]

    def words(self, text: str) -> Iterator[list[str] | list[int]]:
        """Words in order; ids come where only the library knows the characters, or for special strings."""
        for stretch in self.stretches(text):
            if isinstance(stretch, int):
                yield [stretch]
                continue
            for part in parts(stretch):
                split = splitter(WORDS, part)
                if split is None:
                    yield self.library.encode(part, add_special_tokens=False).ids
                elif found := split(self.plain(part)):
                    yield found

    def of_text(self, text: str) -> tuple[str, str, int]:
        """A text's ids and tokens, each joined by a space, and their number."""
        if len(self.known) > REMEMBERED:
            self.known = {}
        got = []
        for words in self.words(text):
            if isinstance(words[0], int):
                got += [(str(i), self.shown[i], 1) for i in words]
                continue
            for word in set(words).difference(self.known):
                self.known[word] = self.word(word)
            got += map(self.known.__getitem__, words)
        return (" ".join(x[0] for x in got), " ".join(x[1] for x in got), sum(x[2] for x in got)) if got else ("", "", 0)


@functools.cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def _sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def _digest(doc_id: object, ids: str, decoded: str, n: int) -> tuple:
    return doc_id, n, _sha(ids), _sha(decoded)


def _whole(doc_id: object, ids: str, decoded: str, n: int) -> tuple:
    return doc_id, [int(i) for i in ids.split()], decoded


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


_DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_IDS = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def encode_decode(docs: DataFrame, tokenizer: str, digests: bool = True, spread: int = 50_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encodes every row's whole text under the vocabulary file `tokenizer` and decodes the ids again.

    One row per input row. `digests`: doc_id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256.
    Otherwise doc_id, ids, decoded. A null text counts as empty: no ids, an empty decoded text. Null or repeated
    ids and repeated rows keep their rows; other columns, whatever their names, are not read. Special strings inside
    a text become their tokens; nothing is added, cut off or padded. The file must exist on every executor.

    Texts up to `spread` characters stay in the task that reads them, without a shuffle. Longer ones are dealt out
    in pieces and come together by document, which is one row's size.
    """
    finish, arrow, schema = (_digest, _DIGEST, SCHEMA) if digests else (_whole, _IDS, IDS_SCHEMA)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))

    def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for at in range(0, len(ids), 500):
                yield _arrow([finish(i, *model.of_text(x)) for i, x in zip(ids[at : at + 500], texts.slice(at, 500).to_pylist(), strict=True)], arrow)

    short = rows.where(F.length("text") <= spread).mapInArrow(here, schema)

    # Equal long rows give equal results: one stands for n.
    long = rows.where(F.length("text") > spread).groupBy("doc_id", "text").agg(F.count("*").alias("n"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(tokenizer)
        for batch in batches:
            for doc_id, text, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                key = _sha(text)
                for piece, (seq, ready) in enumerate(_pieces(model, text)):
                    yield _arrow([(doc_id, n, key, piece, *seq, ready)], _CUT)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = vocabulary(tokenizer)
        for batch in batches:
            out = []
            for *head, symbols, starts, ends, ready in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                last = len(symbols) - 1
                tokens = [model.encode(x, last=k < last or ends) for k, x in enumerate(symbols)]
                cuts = [len(x) for x in tokens]
                out.append((*head, [i for x in tokens for i in x] if ready is None else ready, starts, ends, cuts))
            yield _arrow(out, _DONE)

    def together(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        model = vocabulary(tokenizer)
        frame = frame.sort_values("piece")
        ids: list[int] = []
        open_word: list[int] | None = None  # the tokens so far of a word that goes on in the next piece
        for tokens, starts, ends, cuts in zip(frame["ids"], frame["starts"], frame["ends"], frame["cuts"], strict=True):
            tokens = [int(t) for t in tokens]
            if not starts and open_word is not None:
                head = int(cuts[0])
                only = len(cuts) == 1
                open_word = model.join(open_word, tokens[:head], ends if only else True)
                tokens = tokens[head:]
                if only and not ends:
                    continue
                ids, open_word = ids + open_word, None
                cuts = cuts[1:]
            if not ends and len(cuts):
                tail = len(tokens) - int(cuts[-1])
                open_word, tokens = tokens[tail:], tokens[:tail]
            ids += tokens
        row = finish(None if pd.isna(key[0]) else key[0], " ".join(map(str, ids)), " ".join(map(model.shown.__getitem__, ids)), len(ids))
        return pd.DataFrame([row] * int(frame["n"].iloc[0]), columns=arrow.names)

    fields = "doc_id bigint, n bigint, key string, piece int"
    leaves = long.mapInArrow(cut, f"{fields}, symbols array<string>, starts boolean, ends boolean, ready array<int>")
    spread_out = leaves.repartition("doc_id", "key", "piece").mapInArrow(encoded, f"{fields}, ids array<int>, starts boolean, ends boolean, cuts array<int>")
    return short.unionByName(spread_out.groupBy("doc_id", "key").applyInPandas(together, schema))


#: Byte letters in one piece of a long text.
PIECE = 10_000
_HEAD = [("doc_id", pa.int64()), ("n", pa.int64()), ("key", pa.string()), ("piece", pa.int32())]
_CUT = pa.schema([*_HEAD, ("symbols", pa.list_(pa.string())), ("starts", pa.bool_()), ("ends", pa.bool_()), ("ready", pa.list_(pa.int32()))])
_DONE = pa.schema([*_HEAD, ("ids", pa.list_(pa.int32())), ("starts", pa.bool_()), ("ends", pa.bool_()), ("cuts", pa.list_(pa.int32()))])


def _pieces(model: Vocabulary, text: str) -> Iterator[tuple[tuple[list[str], bool, bool], list[int] | None]]:
    """((words as byte letters, whether the first word starts here, whether the last ends here), ids known already)."""
    for words in model.words(text):
        if isinstance(words[0], int):
            yield ([], True, True), words
            continue
        held: list[str] = []
        size = 0
        for word in words:
            symbols = "".join(map(model.letters.__getitem__, word.encode()))
            if len(symbols) > PIECE:
                if held:
                    yield (held, True, True), None
                held, size = [], 0
                for at in range(0, len(symbols), PIECE):
                    yield ([symbols[at : at + PIECE]], at == 0, at + PIECE >= len(symbols)), None
                continue
            held.append(symbols)
            size += len(symbols)
            if size >= PIECE:
                yield (held, True, True), None
                held, size = [], 0
        if held:
            yield (held, True, True), None
    # An empty row keeps a text without words.
    yield ([], True, True), []
