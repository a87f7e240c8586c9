"""Prefix trie, periodic runs and language-model scores against brute-force versions."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import random
import re
import time
import tracemalloc
import types
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import corpus, got, prose, table
from tripstrata.llm import op2_license_scan as licences
from tripstrata.llm import op3_suffix_dedup as suffixes
from tripstrata.llm import op6_pseudonyms as pseudonyms
from tripstrata.llm import op8_mixing as mixing
from tripstrata.llm import op10_embedding_dups as embeddings
from tripstrata.llm import op11_prefix_trie as trie
from tripstrata.llm import op12_periodic_runs as runs
from tripstrata.llm import op13_lm_scores as lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- 11: prefix trie ---------------------------------------------------------------------------------------

TURNS = "conv_id bigint, turn bigint, role string, text string, conv string, pos string, d1 int, words int, shard int"


def talks(spark, rows):
    return spark.createDataFrame([(*r, "x", "y", 0, 0, 0) for r in rows], TURNS).repartition(5)


def some_talks():
    rnd = random.Random(1)
    rows = []
    for c in [*range(90), 200, 207, 219, 10**12]:
        for t in range(rnd.choice([1, 1, 2, 3, 5, 8])):
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", rnd.choice(["hello there", "hello  there", "a b c", ""])))
    rows += [(300 + c, t, "user", f"same {t}") for c in range(40) for t in range(3)]  # copies
    rows += [(400, t, "user", f"long {t}") for t in range(300)] + [(401 + k, t, "user", f"long {t}") for k in range(3) for t in range(290 + k)]
    rows += [(500, None, None, None), (500, None, "user", None), (500, 1, None, "x"), (500, 1, None, "x"), (501, 7, "ab", "c"), (503, 7, "a", "bc")]
    return rows + [(None, 0, "user", "nobody's"), (None, None, None, None)]


def brute_trie(rows):
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        if c is not None:
            by[c].append((t is not None, t or 0, role or "", text or ""))
    said = {c: [x[2:] for x in sorted(turns)] for c, turns in by.items()}
    rebuilt = {}
    for c, turns in said.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = tuple(said.get(c - c % 20, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    children = collections.Counter(node[:-1] for node in members if node)
    leaves, saved = collections.Counter(), collections.Counter()
    for node, m in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += (len(m) - 1) * len(WORD.findall(node[-1][1])) if node else 0
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(rebuilt[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(m), len(node), parent, len(m), children[node], leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


NODE = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


@pytest.mark.parametrize("size", [16_384, 40, 1])
def test_prefix_trie(spark, size):
    rows = some_talks()
    if size == 1:  # one word a shard: as many rounds as the deepest chain has nodes
        rows = [r for r in rows if r[0] is None or not 400 <= r[0] < 500]
    assert got(trie.prefix_trie(talks(spark, rows), shard_nodes=size, ids_per_text=7), *NODE) == brute_trie(rows)


def test_prefix_trie_of_nothing(spark):
    assert trie.prefix_trie(talks(spark, [])).collect() == []
    assert trie.prefix_trie(talks(spark, [(None, 1, "a", "b")])).collect() == []


@pytest.mark.parametrize("n", [1, 2, 3, 10, 1000])
def test_perfect_slots(n):
    rnd = np.random.default_rng(n)
    a, b = rnd.integers(0, 2**63, (2, n)).astype(np.uint64)
    slots, shift = trie.perfect_slots(a, b)
    assert sorted(slots) == list(range(n))
    table_of = np.empty((n, 2), np.uint64)
    table_of[slots, 0], table_of[slots, 1] = a, b
    assert (trie.find_slots(a, b, shift, table_of) == slots).all()
    assert (trie.find_slots(a, b + np.uint64(1), shift, table_of) == -1).all()
    with pytest.raises(ValueError, match="repeated"):
        trie.perfect_slots(np.append(a, a[:1]), np.append(b, b[:1]))


# ---- 12: periodic runs -------------------------------------------------------------------------------------


def brute_runs(words):
    out = []
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            end = i + q
            smaller = any(all(words[x] == words[x + r] for x in range(start, end - r)) for r in range(1, q))
            if end - start >= max(6, 4 * q) and not smaller:
                out.append((start, end, q))
            i += i == start
    return sorted(out, key=lambda r: (r[0], r[2]))


def brute_described(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    found = brute_runs(words)
    gone = {i for s, e, q in found for i in range(s + q, e)}
    best = max(found, key=lambda r: (r[1] - r[0], -r[0], -r[2]), default=None)
    figures = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return doc_id, len(found), *figures, sha("".join(f"{s},{e - s},{q}\n" for s, e, q in found)), sha(" ".join(w for i, w in enumerate(words) if i not in gone))


def test_periodic_runs(spark):
    rnd = random.Random(2)
    texts = [None, "", " \n ", "a", "a " * 5, "a " * 6, "a b " * 3, "a b " * 4, "a b\x85 c\x1f d " * 9, "x" * 5000 + " y" * 700]
    for _ in range(400):
        some = [rnd.choice("ab" if rnd.random() < 0.5 else "abcdefgh") for _ in range(rnd.randint(1, 14))]
        texts.append(" ".join(some * rnd.randint(1, 9) + [rnd.choice("abc") for _ in range(rnd.randint(0, 30))] + some * rnd.randint(0, 5)))
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(None, "a " * 9, "s"), (3, "a " * 9, "s"), (3, "a " * 9, "s")] + [r for r in corpus() if r[0] != 500]
    columns = ("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    assert got(runs.periodic_runs(table(spark, rows).repartition(4), batch_bytes=3_000), *columns) == sorted((brute_described(i, t) for i, t, _ in rows), key=repr)
    assert runs.periodic_runs(table(spark, [])).collect() == []


def test_runs_in_long_texts():
    assert runs.find_runs(np.arange(300_000) % 700, np.array([0, 300_000])) == [(0, 300_000, 700)]
    two = np.concatenate([np.zeros(50, np.int64), np.zeros(3, np.int64)])
    assert runs.find_runs(two, np.array([0, 50, 53])) == [(0, 50, 1)]


# ---- 13: language-model scores -----------------------------------------------------------------------------


def brute_scores(rows):
    """Exact word counts, exact pair counts rounded to the mean of their power of two."""
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    split = [[*WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), None] for _, t, _ in rows]
    ones, twos = collections.Counter(), collections.Counter()
    for (i, *_), words in zip(rows, split, strict=True):
        if not held(i):
            ones.update(words)
            twos.update(zip(words, words[1:], strict=False))
    n, v = sum(ones.values()), len(ones)
    for (i, *_), words in zip(rows, split, strict=True):
        unigram = [(ones[w] + 0.5) / (n + 0.5 * (v + 1)) for w in words]
        sums = []
        for weight in lm.WEIGHTS:
            total = math.log10(unigram[0])
            for a, b, u in zip(words, words[1:], unigram[1:], strict=False):
                level = twos[a, b].bit_length()
                mean = (2 ** (level - 1) + 2**level - 1) / 2 if level else 0
                total += math.log10((1 - weight) * u + weight * min(mean, ones[a]) / ones[a]) if ones[a] else math.log10(u)
            sums.append(total)
        best = max(sums)
        yield i, held(i), len(words), sum(w in ones for w in words), n, sums[0], best + math.log10(sum(10 ** (s - best) for s in sums) / len(sums))


@pytest.mark.parametrize("broadcast", [True, False])
def test_scores(spark, broadcast):
    sizes = {"chunk_bytes": 20_000, "shard_tokens": 5_000, "bits": 60}  # with 60 bits an entry there are no false hits
    rows = corpus()
    frame = table(spark, rows).repartition(3).persist()
    out = got(lm.lm_scores(frame, filter_bytes=lm.FILTER_BYTES if broadcast else 0, **sizes), "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
    expected = sorted(brute_scores(rows), key=repr)
    assert [r[:5] for r in out] == [r[:5] for r in expected]
    for mine, theirs in zip(sorted(out, key=lambda r: (r[0] is None, *r[:4], round(r[5], 3))), sorted(expected, key=lambda r: (r[0] is None, *r[:4], round(r[5], 3))), strict=True):
        assert mine[5:] == pytest.approx(theirs[5:], rel=1e-9)


def test_scores_without_training_rows(spark):
    held = [i for i in range(60) if lm.held_out(i)]
    out = lm.lm_scores(table(spark, [(i, "Some text", "s") for i in held])).collect()
    assert {(r.train_tokens, r.n_known, r.n_tokens, r.base_score) for r in out} == {(0, 0, 3, 0.0)}
    assert lm.lm_scores(table(spark, [])).collect() == []


def test_filter_levels():
    rnd = np.random.default_rng(0)
    pairs = np.unique(rnd.integers(0, 2**63, 50_000).astype(np.uint64))
    counts = np.minimum(rnd.geometric(0.3, len(pairs)) ** 3, 10**6)
    known = lm.Filter([lm.filter_bits(pairs, counts)])
    levels = known.levels(pairs, np.zeros(len(pairs), np.int64))
    assert (levels >= lm.level_of(counts)).all() and (levels > lm.level_of(counts)).mean() < 0.02
    other = rnd.integers(0, 2**63, 50_000).astype(np.uint64)
    assert (known.levels(other, np.zeros(len(other), np.int64)) > 0).mean() < 0.02


@pytest.mark.parametrize("work", [lm._pair_counts(40), lambda batches: lm._chunk_words(batches, 8_000_000)])
def test_memory_of_a_large_batch(work, monkeypatch):
    """A worker holds few of a batch's rows as Python objects, few bytes hashed, and pairs without copies of them."""
    rnd = random.Random(2)
    words = [f"w{rnd.randrange(10**6)}" for _ in range(200_000)]
    texts = [" ".join(words[a : a + 400]) for a in (rnd.randrange(199_600) for _ in range(10_000))]
    batch = pa.record_batch([pa.array(range(10_000), pa.int64()), pa.array([x.encode() for x in texts], pa.binary())], names=["doc_id", "text"])
    monkeypatch.setattr(lm, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 0)))
    tracemalloc.start()
    try:
        assert sum(x.num_rows for x in work(iter([batch])))
        assert tracemalloc.get_traced_memory()[1] < 95_000_000
    finally:
        tracemalloc.stop()


def test_filter_is_read_in_place():
    pairs = [np.arange(1, 4000, dtype=np.uint64) * np.uint64(2**33 + 1), np.arange(1, 9000, dtype=np.uint64) * np.uint64(2**35 + 7)]
    bits = [lm.filter_bits(p, np.ones(len(p), np.uint64)) for p in pairs]
    joined = bytearray(b"".join(bits))
    known = lm.Filter([joined], [len(x) for x in bits])
    assert np.shares_memory(known.bits, np.frombuffer(joined, np.uint8))
    for shard, own in enumerate(pairs):
        assert (known.levels(own, np.full(len(own), shard)) >= 1).all()


def test_known_passages_score_higher(spark):
    texts = prose(8, 60, (30, 60))
    learned = [(i, t, "s") for i, t in enumerate(texts)]
    asked = [i for i in range(1000, 1200) if lm.held_out(i)][:20]
    seen = [r for r in learned if not lm.held_out(r[0])]
    shuffled = random.Random(4)
    rows = learned + [(i, seen[k][1], "s") for k, i in enumerate(asked[:10])]
    rows += [(i, " ".join(shuffled.sample(seen[k][1].split(), len(seen[k][1].split()))), "s") for k, i in enumerate(asked[10:])]
    score = {r.doc_id: r for r in lm.lm_scores(table(spark, rows)).collect()}
    assert all(score[a].score > score[b].score + 10 for a, b in zip(asked[:10], asked[10:], strict=True))


# ---- 3: passages in words ----------------------------------------------------------------------------------


def test_shared_passages(spark):
    texts = prose(31, 60, (5, 200))
    passage = prose(32, 1, (60, 61))[0].split()
    for k in range(10):  # of 51 words, in another text at another place; of 35 words in ten more
        texts[k] = f"{texts[k]} {' '.join(passage[:51])}\n{texts[k + 20]}"
        texts[40 + k] += " " + " ".join(passage[10:45]).upper()
    rows = [(i, t, "s") for i, t in enumerate(texts)] + [(100, None, "s"), (101, "", "s"), (102, " ".join(passage), "s"), (102, " ".join(passage), "s"), (None, texts[12], "s")]

    def brute(size):
        split = [tuple(re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())) for _, t, _ in rows]
        have = collections.defaultdict(set)
        for (i, *_), words in zip(rows, split, strict=True):
            for k in range(len(words) - size + 1):
                have[words[k : k + size]].add(i)
        return {i for ids in have.values() if len(ids) > 1 for i in ids}

    found = {r.doc_id for r in suffixes.dedup_counts(table(spark, rows).repartition(3)).collect() if r.n_shared_passages}
    assert brute(51) <= found <= brute(36) and {*range(10), 102} <= found and not found & {*range(20, 40)} - brute(36)


def test_windows_of_a_very_long_text(monkeypatch):
    monkeypatch.setattr(suffixes, "_PLACE", 9)
    words = " ".join(f"w{k % 1201}" for k in range(3_000)).encode()
    parts = [suffixes.sampled_windows(p)[1] for p, _ in suffixes._cut_long([words])]
    assert len(parts) > 5 and all(len(p) for p in parts)
    passage = b" ".join(words.split()[700:751])
    assert set(suffixes.sampled_windows([passage])[1]) <= set(np.concatenate(parts))


# ---- 6: long runs of digits --------------------------------------------------------------------------------


def test_long_runs_of_digits_take_time_in_proportion(spark):
    """A run of groups, one with a card at its end, one of cards, and digits without any limit."""
    texts = ["12 " * 30_000, "12 " * 30_000 + "4111-1111-1111-1111", "5500 0000 0000 0004 " * 3_000, "7" * 200_000]
    pseudonyms.pseudonymized(table(spark, [(0, "12 " * 50, "s")]), key="k").collect()  # compilation
    began = time.monotonic()
    out = {r.doc_id: r for r in pseudonyms.pseudonymized(table(spark, [(i, t, "s") for i, t in enumerate(texts)]).repartition(4), key="k").collect()}
    assert time.monotonic() - began < 150
    assert out[0].text == texts[0] and out[3].text == texts[3]
    assert out[1].text[:90_000] == texts[1][:90_000] and out[1].n_card == 1 and out[1].text[-19:] != texts[1][-19:]
    parts = out[2].text.split()
    assert out[2].n_card == 3_000 and len({tuple(parts[i : i + 4]) for i in range(0, 12_000, 4)}) == 1 and parts[:4] != ["5500", "0000", "0000", "0004"]


# ---- 8: overlapping sources; 10: many lengths ----------------------------------------------------------------


def test_cheapest_flow_of_overlapping_sources():
    """Against all ways to give words of three patterns to two sources: most words first, then fewest second copies."""
    for quotas in itertools.product(range(0, 9, 2), repeat=2):
        sizes, members = {"ab": 3, "a": 2, "b": 1}, {"ab": ["a", "b"], "a": ["a"], "b": ["b"]}
        ways = []
        for x, y in itertools.product(range(7), repeat=2):
            for p, q in itertools.product(range(5), range(3)):
                if x + y <= 6 and x + p <= quotas[0] and y + q <= quotas[1]:
                    ways.append((-(x + y + p + q), max(0, x + y - 3) + max(0, p - 2) + max(0, q - 1)))
        routed = mixing.route(sizes, members, dict(zip("ab", map(float, quotas), strict=True)), 2)
        flat = [part for parts in routed.values() for part in parts]
        assert (-sum(n for *_, n in flat), sum(n for copy, _, n in flat if copy)) == min(ways)


def test_mix_of_rows_with_several_sources_and_none(spark):
    texts = prose(55, 400, (20, 40))
    of = lambda i: [["a"], ["a", "b"], ["b", "a", "b"], [None, "c"], [], None][i % 6]
    rows = [(i, t, of(i)) for i, t in enumerate(texts)] + [(k, texts[6], ["a"]) for k in (6, 6)]  # two more rows equal to row 6
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, of array<string>")
    out = mixing.mixed_documents(frame, F.col("of")).collect()
    sizes = collections.Counter()
    for _, t, sources in rows:
        for s in {*(sources or ())}:
            sizes[s] += len(t.split())
    total = sum(len(t.split()) for _, t, s in rows if s)
    wanted = mixing.targets(dict(sizes), total, mixing.Mix())
    given = collections.Counter()
    for r in out:
        sources = of(r.doc_id)
        assert len(r.taken_for) == r.copies and {*r.taken_for} <= {*(sources or ())} and r.taken == r.copies * r["size"] <= 2 * r["size"]
        if not sources:
            assert (r.copies, r.source_size, r.target) == (0, None, None)
        for s in r.taken_for:
            given[s] += r["size"]
    reachable = mixing.route(*_patterns(rows), wanted, 2)
    flow = collections.Counter()
    for parts in reachable.values():
        for _, s, n in parts:
            flow[s] += n
    assert all(abs(given[s] - flow[s]) <= 40 * 6 for s in wanted) and abs(sum(given.values()) - sum(flow.values())) <= 40 * 6
    assert len({(r.copies, tuple(r.taken_for)) for r in out if r.doc_id == 6}) == 1
    assert mixing.take_mix(frame, F.col("of")).count() == sum(r.copies for r in out)


def _patterns(rows):
    sizes, members = collections.Counter(), {}
    for _, t, sources in rows:
        key = repr(sorted({*(sources or ())}, key=repr))
        sizes[key] += len(t.split())
        members[key] = sorted({*(sources or ())}, key=lambda s: (s is None, s or ""))
    return dict(sizes), members


def test_vectors_of_many_lengths_and_links_at_the_threshold(spark):
    rnd = np.random.default_rng(3)
    rows = []
    for size in range(1, 25):  # more lengths than have principal axes
        base = rnd.normal(size=(3, size))
        rows += [(100 * size + k, v.tolist()) for k, v in enumerate([*base, *(base * 2), *(base + rnd.normal(scale=0.05, size=base.shape))])]
    rows += [(10_000, [0.95, math.sqrt(1 - 0.95**2), 0.0]), (10_001, [1.0, 0.0, 0.0]), (10_002, [0.94, math.sqrt(1 - 0.94**2), 0.0])]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    out = {r.vec_id: r for r in embeddings.near_duplicates(frame).collect()}
    unit = {i: np.array(v) / np.sqrt(np.dot(v, v)) for i, v in rows}
    links = collections.Counter()
    for (i, _), (j, _) in itertools.combinations(rows, 2):
        if len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= 0.95 - 1e-15:
            links[i] += 1
            links[j] += 1
    near_edge = {10_000, 10_001, 10_002}
    assert {i: out[i].n_links for i in unit if i not in near_edge} == {i: links[i] for i in unit if i not in near_edge}
    assert out[10_002].n_links >= 1 and out[10_000].n_links >= 1


# ---- 2: licences, against every window of every line ----------------------------------------------------------------------


def test_each_template_is_found_and_nothing_else_confirmed(spark):
    rnd = random.Random(6)
    split = lambda text: re.sub(r"[^0-9a-z\x80-\U0010ffff]", " ", text.lower()).split()
    triples = lambda words: {tuple(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
    plain = prose(25, 400, (10, 60))
    rows, planted = [(i, t) for i, t in enumerate(plain[:100])], {}
    for family, templates in licences.TEMPLATES.items():
        for template in templates:
            for text in (template, f"{plain[rnd.randrange(100, 400)]} {template} {plain[rnd.randrange(100, 400)]}"):
                planted[len(rows)] = family
                rows.append((len(rows), f"{plain[rnd.randrange(100, 400)]}\n{text}"))
            part = template.split()  # most of it, or too little of it
            at = rnd.randrange(len(part))
            rows.append((len(rows), " ".join(part[:at] + part[at + rnd.randint(1, 5) :]) or "nothing"))
    planted[len(rows)] = "zlib"
    rows.append((len(rows), "word " * 50_000 + licences.TEMPLATES["zlib"][1] + " word" * 50_000))
    out = {r["doc_id"]: set(r["families"]) for r in licences.scan_licenses(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    for i, text in rows:
        could = set()
        words = split(text)
        here = triples(words)
        for family, templates in licences.TEMPLATES.items():
            for runs in (triples(split(t)) for t in templates):
                width = len(runs) + 2 + len(runs) // 2
                if not here.isdisjoint(runs):
                    could |= {family for at in range(max(1, len(words) - 2)) if tuple(words[at : at + 3]) in runs and len(runs & triples(words[at : at + width])) >= 0.7 * len(runs)}
        assert out[i] <= could, (text[:200], out[i], could)
    missed = [(planted[i], dict(rows)[i][-200:]) for i in planted if planted[i] not in out[i]]
    assert not missed, missed
    assert not any(out[i] for i in range(100))
