"""Every operator against a brute-force version, and on nulls, empty and long texts, ties, repeated rows, clashing columns."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import textwrap
import time

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tripstrata.llm import op1_line_dedup as lines
from tripstrata.llm import op2_license_scan as licences
from tripstrata.llm import op3_suffix_dedup as suffixes
from tripstrata.llm import op4_bottomk_dups as bottomk
from tripstrata.llm import op5_bpe as bpe
from tripstrata.llm import op6_pseudonyms as pseudonyms
from tripstrata.llm import op7_quality_rules as quality
from tripstrata.llm import op8_mixing as mixing
from tripstrata.llm import op9_token_counts as counts
from tripstrata.llm import op10_embedding_dups as embeddings

WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Columns that the operators make are there already, and must not matter.
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id bigint, value bigint, h bigint, kept boolean, component bigint, n_words string, row string, key string, size int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, 0, 1, 1, 1, True, 1, "x", "y", "z", 0) for i, t, s in rows], SCHEMA)


def prose(seed, n, size=(5, 60)):
    rnd = random.Random(seed)
    vocabulary = ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(2, 8))) for _ in range(400)]
    return [" ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(*size))) for _ in range(n)]


def corpus():
    """Documents with copies, near copies, shared lines and all odd cases."""
    rnd = random.Random(3)
    texts = ["\n".join(prose(k, 4)) for k in range(40)]
    rows = [(i, t, f"src{i % 3}") for i, t in enumerate(texts)]
    rows += [(100 + k, texts[0], "src0") for k in range(5)]
    for k in range(20):
        words = texts[k % 4].split(" ")
        words[rnd.randrange(len(words))] = "changed"
        rows.append((200 + k, " ".join(words), "src1"))
    shared = "this one line stands in very many of the documents here."
    rows += [(300 + k, f"{shared}\n{t}" if k % 2 else f"{t}\n{shared[:-1]}!", None) for k, t in enumerate(prose(77, 12, (20, 40)))]
    rows += [(400, None, "src0"), (401, "", None), (402, " \n\t", "src2"), (403, "word", "src2"), (404, "word", "src2"), (None, texts[1], "src0"), (7, texts[7], "src1"), (7, texts[7], "src1")]
    return [*rows, (500, "lang " * 30_000 + "x" * 3_000, "src0"), (501, "naïve 日本語 \U0001f600 ß " * 40, "src9")]


def got(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)


# ---- 9 and 5: tokens ----------------------------------------------------------------------------------------


def odd_texts():
    rnd = random.Random(5)
    texts = ["", " ", "aaaaaaa" * 50, "it's <|endoftext|> we'LL<|startoftext|>x  \n\n y", "İΣΑΣ ß ﬁ é ́ ² ½ १२ 日本", "a" * 3000, "ab" * 2000 + "'s", "new Ƛ ͸ letters"]
    texts += ["".join(rnd.choice("ab eé日'<|>sSΣ٣́\n²") for _ in range(rnd.randint(1, 60))) for _ in range(300)]
    return texts + ["".join(rnd.choice("etaoinshrdlu") for _ in range(rnd.randint(200, 2500))) for _ in range(12)]


def test_token_counts(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = odd_texts()
    expected = [len(e.ids) for e in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]
    frame = table(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, None, "s")]).repartition(3)
    out = got(counts.count_tokens(frame, path, limit=100), "doc_id", "n_bytes", "n_tokens", "over_limit")
    assert out == sorted([(i, len(t.encode()), n, n > 100) for i, (t, n) in enumerate(zip(texts, expected, strict=True))] + [(None, 0, 0, False)], key=repr)


@pytest.mark.parametrize("spread", [50_000, 20])
def test_bpe(spark, spread):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = odd_texts()[: 120 if spread == 20 else None] + ["q" * 25_000 + " end", "q" * 25_000 + " end"]
    expected = [(i, e.ids, library.decode(e.ids, skip_special_tokens=False)) for i, e in enumerate(library.encode_batch(texts, add_special_tokens=False))]
    frame = table(spark, [(i, t, "s") for i, t in enumerate(texts)] + [(None, None, "s")] * 2)
    assert got(bpe.encode_decode(frame, path, digests=False, spread=spread), "doc_id", "ids", "decoded") == sorted([*expected, (None, [], ""), (None, [], "")], key=repr)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = sorted([(i, len(ids), sha(" ".join(map(str, ids))), sha(d)) for i, ids, d in expected] + [(None, 0, sha(""), sha(""))] * 2, key=repr)
    assert got(bpe.encode_decode(frame, path, spread=spread), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == digests


# ---- 7: quality -----------------------------------------------------------------------------------------------


def expected_counts(text):
    words = WORD.findall(text or "")
    kept = [x for x in (text or "").split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = {k + d for k in range(len(words) - 4) if windows[tuple(words[k : k + 5])] > 1 for d in range(5)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(kept) - len(set(kept)), len(covered)


def test_quality(spark):
    rows = corpus() + [(600, "a b c d e f g a b c d e x a b c d e", "src0"), (601, "### ||| <b> " * 20, "src0")]
    out = {(r["doc_id"], r["n_words"]): r for r in quality.quality(table(spark, rows)).collect()}
    for i, t, _ in rows:
        n, chars, symbols, dups, repeats = expected_counts(t)
        r = out[i, n]
        assert (r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (chars, symbols, dups, repeats)
        assert r["base_failed"] == (n < 10 or 100 * repeats > 20 * n)
        assert not (r["base_failed"] and r["kept"])
    assert not out[601, 60]["kept"] and out[0, len(rows[0][1].split())]["kept"]
    assert quality.quality(table(spark, rows)).count() == len(rows)
    kept = quality.good_documents(table(spark, rows))
    assert kept.columns == table(spark, []).columns and kept.count() == sum(r["kept"] for r in quality.quality(table(spark, rows)).collect())


# ---- 8: mixing --------------------------------------------------------------------------------------------------


def test_mix(spark):
    rows = corpus()
    frame = table(spark, rows)
    out = mixing.mixed_documents(frame, F.array("source")).collect()
    assert len(out) == len(rows)
    words = collections.Counter()
    for _, t, s in rows:
        words[s] += len(WORD.findall(t or ""))
    wanted = mixing.targets(dict(words), sum(words.values()), mixing.Mix())
    assert sum(wanted.values()) == pytest.approx(1.5 * sum(words.values()))
    taken = collections.Counter()
    source = {i: s for i, _, s in rows}
    for r in out:
        assert r["taken"] in (0, r["size"], 2 * r["size"])
        if r["doc_id"] is not None and r["doc_id"] != 7:
            assert (r["source_size"], r["target"]) == (words[source[r["doc_id"]]], wanted[source[r["doc_id"]]])
        taken[r["target"]] += r["taken"]
    for t in set(wanted.values()):
        if t < 20_000:  # the source of the very long document can only miss its target by that
            assert abs(taken[t] - t * list(wanted.values()).count(t)) <= 300
    again = mixing.mixed_documents(frame.repartition(5), F.array("source")).collect()
    assert sorted(map(tuple, again), key=repr) == sorted(map(tuple, out), key=repr)
    copies = mixing.take_mix(frame, F.array("source"))
    assert copies.columns == frame.columns and copies.count() == sum(r["copies"] for r in out)


def test_mix_of_overlapping_sources():
    patterns, members = {"ab": 100, "a": 50, "b": 10}, {"ab": ["a", "b"], "a": ["a"], "b": ["b"]}
    routed = mixing.route(patterns, members, {"a": 90.0, "b": 80.0}, 2)
    to = collections.Counter()
    for key, parts in routed.items():
        for copy, s, n in parts:
            to[s] += n
        for copy in (0, 1):
            assert sum(n for c, _, n in parts if c == copy) <= patterns[key]
    assert to == {"a": 90, "b": 80}
    assert sum(n for parts in routed.values() for copy, _, n in parts if copy) == 10  # only what 160 words can't give once


# ---- 4: near duplicates -------------------------------------------------------------------------------------------


def expected_groups(rows, n):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t, _ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in sets:
        for b in sets:
            if a is not None and b is not None and a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {i: (len(s), None if i is None else root(i)) for i, s in sets.items()}


@pytest.mark.parametrize("block", [1000, 3])
def test_near_duplicates(spark, block):
    rows = corpus()
    base = prose(9, 1, (60, 60))[0].split()
    for k in range(30):  # a chain, each a few words from the one before
        base[2 * k % 60] = f"w{k}"
        rows.append((700 + k, " ".join(base), "s"))
    expected = expected_groups(rows, 4)
    near = bottomk.Near(words=4, block=block, set_block=block)
    out = bottomk.near_duplicates(table(spark, rows), near).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r["n_shingles"], r["component_id"]) == expected[r["doc_id"]], r
        assert r["kept"] == (r["doc_id"] is not None and r["doc_id"] == r["component_id"])
    if block == 1000:
        left = bottomk.first_of_each_group(table(spark, rows), near)
        assert left.columns == table(spark, []).columns
        assert sorted(r["doc_id"] for r in left.collect() if r["doc_id"] is not None) == sorted([i for i, _, _ in rows if i is not None and expected[i][1] == i])


# ---- 10: embeddings ---------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("tile", [4096, 20])
def test_embeddings(spark, tile, monkeypatch):
    monkeypatch.setattr(embeddings, "TILE", tile)
    rnd = np.random.default_rng(1)
    x = rnd.normal(size=(80, 12))
    x[40:60] = x[:20] + 0.1 * rnd.normal(size=(20, 12))
    x[60:70] = x[5]
    x[70:75] = x[5] * 3
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(200, None), (201, [0.0] * 12), (202, [1.0, None] + [0.0] * 10), (203, [float("nan")] * 12), (204, [float("inf")] * 12), (205, []), (206, [1.0, 2.0]), (207, [2.0, 4.0])]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    label = np.arange(80)
    while True:
        new = np.array([label[row].min() for row in linked])
        if (new == label).all():
            break
        label = new
    frame = spark.createDataFrame(rows + odd + [(None, x[0].tolist())], "vec_id bigint, embedding array<double>").withColumns({"h": F.lit("a"), "n": F.lit(1), "rep": F.lit(2)})
    out = {r["vec_id"]: tuple(r)[1:] for r in embeddings.near_duplicates(frame).collect()}
    for i in range(80):
        assert out[i] == (linked[i].sum() - 1, label[i], label[i] == i)
    for i in range(200, 206):
        assert out[i] == (0, i, True)
    assert out[206] == (1, 206, True) and out[207] == (1, 206, False) and out[None] == (0, None, False)


# ---- 1: lines -----------------------------------------------------------------------------------------------------------


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edited(rnd, text, times):
    out = list(text)
    for _ in range(times):
        at = rnd.randrange(len(out) + 1)
        out[at : at + rnd.choice((0, 1))] = rnd.choice(("", "x", "é"))
    return "".join(out)


def test_banded_distance_and_segments():
    rnd = random.Random(1)
    a = ["".join(rnd.choice("abé") for _ in range(rnd.choice((1, 3, 20, 41, 60)))) for _ in range(800)]
    b = [edited(rnd, x, rnd.randint(0, 4)) for x in a]
    real = [distance(x, y) for x, y in zip(a, b, strict=True)]
    for most in (0, 1, 2, 4):
        assert lines.within(a, b, np.full(len(a), most)).tolist() == [d <= most for d in real]
    edits = lines.Edits()
    for x, y, d in zip(a, b, real, strict=True):
        if d <= min(2, min(len(x), len(y)) // 20):
            keys, owners = lines.segment_keys([x, y], edits)
            assert x == y or d == 0 or set(keys[owners == 0]) & set(keys[owners == 1])


def test_distance_of_few_long_lines_takes_few_steps():
    rnd = random.Random(3)
    text = "".join(rnd.choices("abcdefgh ", k=100_000))
    near = "y" + text[:70_000] + text[70_001:]
    far = text[:50_000] + text[:50_000]
    began = time.process_time()
    assert lines.within([text, near, far], [near, text, text], np.full(3, 2)).tolist() == [True, True, False]
    assert lines.within([text], [near], np.full(1, 1)).tolist() == [False]
    assert time.process_time() - began < 3


@pytest.mark.parametrize("edits", [lines.Edits(), lines.Edits(short=2, block=3)])
def test_line_dedup(spark, edits):
    rnd = random.Random(4)
    base = prose(21, 6, (8, 12))
    rows = corpus()[:60] + [(800 + k, "\n".join(edited(rnd, rnd.choice(base), rnd.randint(0, 2)) for _ in range(3)), "s") for k in range(25)] + [(400, None, "s"), (401, "", "s"), (None, base[0], "s")]
    places = collections.defaultdict(list)
    for i, t, _ in rows:
        for k, line in enumerate((t or "").split("\n")):
            if i is not None and WORD.search(line):
                places[line].append((i, k))
    texts = sorted(places)
    up = {t: t for t in texts}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(texts):
        for b in texts[i + 1 :]:
            most = min(2, min(len(a), len(b)) // 20)
            if most and abs(len(a) - len(b)) <= most and distance(a, b) <= most:
                up[root(a)] = root(b)
    classes = collections.defaultdict(list)
    for t in texts:
        classes[root(t)] += places[t]
    gone = collections.Counter(p[0] for c in classes.values() for p in set(c) - {min(c)})
    expected = sorted(((i, sum(bool(WORD.search(x)) for x in (t or "").split("\n")), gone[i]) for i, t, _ in rows if i is not None), key=repr)
    frame = table(spark, rows)
    assert got(lines.line_counts(frame, edits), "doc_id", "n_lines", "n_removed") == expected
    left = lines.without_repeated_lines(frame, edits, copies_at=1.0)
    assert left.columns == frame.columns and left.count() == len(rows)
    after = {r["doc_id"]: r["text"] for r in left.collect()}
    for i, t, _ in rows:
        n = sum(bool(WORD.search(x)) for x in (t or "").split("\n"))
        if i is not None and i != 400 and gone[i] < n:
            assert sum(bool(WORD.search(x)) for x in after[i].split("\n")) == n - gone[i]


def test_line_stage_takes_lines_from_all_but_copies(spark):
    own = [[f"{w} {k}" for k, w in enumerate(prose(300 + d, 10, (12, 20)))] for d in range(9)]
    docs = {d: x for d, x in enumerate(own)}
    rnd = random.Random(8)
    docs[20] = [own[d][0] for d in range(9)]  # stitched from several
    docs[21] = ["One line of its own.", *(own[d][1] for d in range(9))]
    docs[22] = list(own[0])  # copies of one
    docs[23] = [*own[1], "short"]
    docs[24] = own[2][:5]  # an excerpt of a longer one
    docs[25] = ["It repeats only itself, and so it isn't a copy of any other."] * 8
    docs[26] = [*own[3][:6], *own[4][:4]]
    for d in range(27, 40):
        docs[d] = [rnd.choice(own[rnd.randrange(9)]) for _ in range(rnd.randint(1, 12))]
    first, stays, lost = {}, {}, collections.defaultdict(collections.Counter)
    for d, x in sorted(docs.items()):
        for k, line in enumerate(x):
            keeper = first.setdefault(line, (d, k))
            if keeper != (d, k):
                lost[d][keeper[0]] += len(line) + 1
    size = {d: sum(len(line) + 1 for line in x) for d, x in docs.items()}
    for d, x in docs.items():
        copy = any(k != d and n >= 0.9 * max(size[d], size[k]) for k, n in lost[d].items())
        stays[d] = "\n".join(x if copy else [line for k, line in enumerate(x) if first[line] == (d, k)])
    assert (stays[20], stays[21], stays[22], stays[24], stays[26]) == ("", docs[21][0], "\n".join(own[0]), "", "") and "\n" in stays[23] and "\n" not in stays[25]
    left = lines.without_repeated_lines(table(spark, [(d, "\n".join(x), "s") for d, x in docs.items()]))
    assert {r["doc_id"]: r["text"] for r in left.collect()} == stays


# ---- 2: licences ------------------------------------------------------------------------------------------------------------


def test_licences(spark):
    plain = prose(5, 60, (20, 200))
    rows = [(i, t, "s") for i, t in enumerate(plain)] + [(100, f"{plain[0]}\nLicensed under the Apache License, Version 2.0.", "s"), (101, "Released under the MIT License.", "s"), (102, "He renewed his driving licence last week.", "s")]
    rows += [(103, " ".join([plain[1], "This work is licensed under the GNU General Public License, version 3.", plain[2]]), "s"), (104, None, "s"), (105, "", "s"), (None, "\n\n", "s"), (101, "Released under the MIT License.", "s")]
    out = licences.scan_licenses(table(spark, rows)).collect()
    families = {(r["doc_id"], tuple(r["families"])) for r in out}
    assert {(100, ("apache-2.0",)), (101, ("mit",)), (102, ()), (103, ("gpl",)), (104, ()), (105, ()), (None, ())} <= families
    assert all(not r["families"] for r in out if r["doc_id"] is not None and r["doc_id"] < 100) and len(out) == len(rows)
    assert {r["doc_id"]: r["n_paragraphs"] for r in out}[100] == 2
    model, accuracy = licences.trained(licences.Scan(), plain * 10)
    assert accuracy > 0.8 and 0.5 <= model.accepted_at <= 1


MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"
GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"


def test_every_family_of_a_line(spark):
    plain = prose(15, 60, (20, 200))
    long_ = " ".join(prose(16, 4, (150, 200)))
    nc = "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."
    rows = [(i, t, "s") for i, t in enumerate(plain)]
    rows += [(100, f"{MIT} {long_} {GPL}", "s"), (101, "Released under the MIT License. Licensed under the Apache License, Version 2.0.", "s"), (102, nc, "s"), (103, f"{nc}\nReleased under the MIT License.", "s")]
    out = {r["doc_id"]: r for r in licences.scan_licenses(table(spark, rows)).collect()}
    assert [out[k]["families"] for k in (100, 101, 102, 103)] == [["gpl", "mit"], ["apache-2.0", "mit"], ["cc-by-nc"], ["cc-by-nc", "mit"]]
    assert [out[k]["n_confirmed"] for k in (100, 101, 102, 103)] == [2, 2, 1, 2]
    assert all(not out[i]["families"] for i in range(60))


def test_notices_over_several_lines(spark):
    plain = prose(15, 60, (20, 200))
    rows = [(i, t, "s") for i, t in enumerate(plain)]
    wraps = [(text, mark, width) for text in (MIT, BSD, GPL) for mark in ("", "# ", " * ", "// ") for width in (30, 60, 72)]
    rows += [(100 + k, "\n".join(["import things", "", *(mark + x for x in textwrap.wrap(text, width)), "", plain[k]]), "s") for k, (text, mark, width) in enumerate(wraps)]
    rows += [(200, f"{textwrap.fill(MIT, 40)}\n{textwrap.fill(GPL, 40)}", "s"), *((300 + k, f"{BSD}\nReleased under CC0 1.0 Universal.", "s") for k in range(40))]
    out = {r["doc_id"]: r for r in licences.scan_licenses(table(spark, rows)).collect()}
    for k, (text, _, _) in enumerate(wraps):
        r = out[100 + k]
        assert r["families"] == [{MIT: "mit", BSD: "bsd", GPL: "gpl"}[text]] and r["n_confirmed"] == 1, (wraps[k], r)
        assert [x["line_no"] for x in r["paragraphs"] if x["confirmed"]] == [2]
    assert out[200]["families"] == ["gpl", "mit"] and out[300]["families"] == ["bsd", "cc0"]


# ---- 3: suffix arrays ---------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("spec", [suffixes.Repeats(length=40, gram=12, chunk=500, batch=2000, crowd=3, share=50), suffixes.Repeats(length=40, gram=16, batch=1500)])
def test_long_repeats(spark, spec):
    rnd = random.Random(3)
    base = ["".join(rnd.choice("ab ") for _ in range(rnd.randint(0, 300))) for _ in range(30)]
    rows = [(i, "é".join(b[rnd.randint(0, 40) :][: rnd.randint(30, 200)] for b in rnd.sample(base, rnd.randint(1, 3))), "s") for i in range(80)]
    rows += [(200, None, "s"), (201, "", "s"), (202, "a" * 300, "s"), (203, "ab" * 100, "s"), (7, rows[7][1], "s"), (None, base[0], "s")]
    seen = collections.Counter((t or "").encode()[k : k + 40] for _, t, _ in rows for k in range(len((t or "").encode()) - 39))
    expected = []
    for i, t, _ in rows:
        raw = (t or "").encode()
        mask = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - 39):
            if seen[raw[k : k + 40]] > 1:
                mask[k : k + 40] = True
        kept = bytes(b for b, m in zip(raw, mask, strict=False) if not m)
        expected.append((i, len(raw), int(mask.sum()), int((np.diff(mask.astype(int), prepend=0) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    frame = table(spark, rows)
    assert got(suffixes.dedup_counts(frame, spec), "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == sorted(expected, key=repr)
    spans = suffixes.repeated_spans(frame, spec).where("doc_id = 202").first()
    assert [tuple(s) for s in spans["spans"]] == [(0, 300)] and spans["kept"] == b""


@pytest.mark.parametrize("length", [1, 3, 8, 17, 40])
@pytest.mark.parametrize("segment", [3, 50, 16_384])
def test_levels_are_suffix_arrays(monkeypatch, length, segment):
    rnd = random.Random(length)
    monkeypatch.setattr(suffixes.Family, "SEGMENT", segment)
    for _ in range(10):
        family = suffixes.Family(length)
        batches = [[bytes(rnd.choice(b"ab\0") for _ in range(rnd.randint(length, length + 30))) for _ in range(rnd.randint(1, 6))] for _ in range(rnd.randint(1, 12))]
        places = [family.add(batch) for batch in batches]
        seen = collections.Counter(c[k : k + length] for batch in batches for c in batch for k in range(len(c) - length + 1))
        for batch, bounds in zip(batches, places, strict=True):
            for c, (first, stop) in zip(batch, bounds, strict=True):
                assert family.matched[first:stop].tolist() == [seen[c[k : k + length]] > 1 for k in range(len(c) - length + 1)]
        for level in family.levels:
            windows = [family.text[s : s + length].tobytes() for s in level.start]
            assert windows == sorted(set(windows))


def test_levels_stay_few():
    family = suffixes.Family(10)
    for k in range(64):
        family.add([bytes([k]) * 3 + b"0123456789"])
    assert len(family.levels) <= 7 and family.matched.sum() == 64


# ---- 6: pseudonyms --------------------------------------------------------------------------------------------------------------


def test_pseudonyms(spark):
    private = "Mail bosbt.42@mail8.example.com, call +1 (988) 555-2485 on 2024-02-29; card 4041 8949 7460 8795, ip 42.144.35.254, ssn 123-45-6789, born 14.03.1975. password=b7db7aa4a5fcc78305"
    rows = [(1, private, "s"), (2, f"again {private}", "s"), (3, "no data, 1234567890123456, 999.1.1.1, 31.02.2024, 000-12-1234, v1.2.3", "s"), (4, None, "s"), (5, "", "s"), (None, private, "s"), (1, private, "s"), (6, "x" * 100_000, "s")]
    frame = table(spark, rows)
    out = pseudonyms.pseudonymized(frame, "k")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange", plan)
    seen = {r["doc_id"]: r for r in out.collect()}
    assert out.count() == len(rows)
    for value in ("bosbt.42", "988) 555-2485", "2024-02-29", "4041 8949 7460 8795", "42.144.35.254", "123-45-6789", "14.03.1975", "b7db7aa4a5fcc78305"):
        assert value not in seen[1]["text"]
    assert seen[2]["text"] == f"again {seen[1]['text']}" and seen[1]["n_found"] == 8
    shape = lambda x: re.sub(r"\d", "9", re.sub("[a-z]", "a", x.split(", ip")[0]))
    assert shape(seen[1]["text"]) == shape(private)
    assert seen[3]["text"] == rows[2][1] and seen[3]["n_found"] == 0 and seen[4]["text"] is None and seen[5]["text"] == ""
    assert {r["doc_id"]: r["text"] for r in pseudonyms.pseudonymized(out.select("doc_id", "text"), "k", back=True).collect()}[1] == private
    dates = spark.range(0, 73_100, 7).select("id", F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyy-MM-dd").alias("text"))
    assert pseudonyms.pseudonymized(dates, "k", id_col="id").select("text").distinct().count() == dates.count()


CARDS = ("4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "3782 822463 10005", "5500 0000 0000 0004")


def test_cards_beside_other_numbers(spark):
    wraps = ("{}", "{} 12/26", "Order 12 {}", "{} 5500 0000 0000 0004", "{} 12", "{} 25/12/2024", "{} 2024-02-29", "{} 212-555-2485", "{} 10.0.0.1", "{} 123456789012", "7 {} 1234 5678 9012 3456 7890")
    rows = [(k, w.format(c), "s") for k, (c, w) in enumerate((c, w) for c in CARDS for w in wraps)]
    out = {r["doc_id"]: r for r in pseudonyms.pseudonymized(table(spark, rows), "k").collect()}
    for i, text, _ in rows:
        card = CARDS[i // len(wraps)]
        assert card not in out[i]["text"] and out[i]["n_card"] >= 1, (text, out[i])
        assert re.sub(r"\d+", "9", out[i]["text"]) == re.sub(r"\d+", "9", text)
        assert not any(x in out[i]["text"] for x in ("25/12/2024", "2024-02-29", "212-555-2485", "10.0.0.1", "5500 0000 0000 0004")), (text, out[i])
        assert "12/26" not in text or out[i]["text"].endswith(" 12/26")
    # One card, one pseudonym, whatever stands beside it.
    assert len({out[k]["text"][:19] for k in (0, 1, 3, 4, 5, 6, 7, 9)}) == 1


def test_slash_dates_with_the_day_first(spark):
    days = spark.range(0, 73_100, 3).select("id", F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "dd/MM/yyyy").alias("text")).where("int(substr(text, 1, 2)) > 12")
    out = pseudonyms.pseudonymized(days, "k", id_col="id")
    assert out.where("n_date <> 1").count() == 0 and out.select("text").distinct().count() == days.count()
    back = pseudonyms.pseudonymized(out.select("doc_id", "text"), "k", back=True).select("doc_id", "text")
    assert back.exceptAll(days).count() == 0


# ---- All operators on tables without rows ---------------------------------------------------------------------------------------------


def test_empty_tables(spark):
    empty = table(spark, [])
    words, bytes_ = (public_tokenizers.path(f"{x}.json") for x in ("word_bpe_49k", "byte_bpe_50k"))
    for frame in (
        lines.line_counts(empty), lines.without_repeated_lines(empty), licences.scan_licenses(empty), suffixes.dedup_counts(empty), bottomk.near_duplicates(empty), bottomk.first_of_each_group(empty),
        bpe.encode_decode(empty, words), pseudonyms.pseudonymized(empty, "k"), quality.quality(empty), quality.good_documents(empty), mixing.mixed_documents(empty, F.array("source")), mixing.take_mix(empty, F.array("source")),
        counts.count_tokens(empty, bytes_), embeddings.near_duplicates(spark.createDataFrame([], "vec_id bigint, embedding array<float>")),
    ):
        assert frame.collect() == []
