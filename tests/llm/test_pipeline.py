"""The pipeline's stages, one after the other, on a small corpus with copies and junk, each against a brute-force version."""

from __future__ import annotations

import collections

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_operators import WORD, corpus, distance, prose, table
from tripstrata.llm.op8_mixing import Mix, targets
from tripstrata.llm.oracles import ORACLES


def classes_of(nodes, near):
    """The root of every node: the smallest of its component under `near`, for nodes in ascending order."""
    nodes = sorted(nodes)
    up = {x: x for x in nodes}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, x in enumerate(nodes):
        for y in nodes[i + 1 :]:
            if near(x, y):
                a, b = sorted((root(x), root(y)))
                up[b] = a
    return {x: root(x) for x in nodes}


def near_lines(a, b):
    most = min(2, min(len(a), len(b)) // 20)
    return most > 0 and abs(len(a) - len(b)) <= most and distance(a, b) <= most


def texts_without_repeats(texts):
    """{doc_id: text} after the line stage."""
    places = collections.defaultdict(list)
    for i, text in texts.items():
        for k, line in enumerate((text or "").split("\n")):
            if WORD.search(line):
                places[line].append((i, k))
    kind = classes_of(places, near_lines)
    stays = {}
    for line, at in places.items():
        stays[kind[line]] = min([*at, stays.get(kind[line], at[0])])
    out = {}
    for i, text in texts.items():
        lines = (text or "").split("\n")
        gone = {k: stays[kind[x]] for k, x in enumerate(lines) if WORD.search(x) and stays[kind[x]] != (i, k)}
        common = collections.Counter()
        for k, (keeper, _) in gone.items():
            common[keeper] += len(lines[k]) + 1
        copy = any(keeper != i and n >= 0.9 * (max(len(texts[keeper]), len(text)) + 1) for keeper, n in common.items())
        out[i] = text if copy or not gone else "\n".join(x for k, x in enumerate(lines) if k not in gone)
    return out


def first_of_near_copies(texts):
    """The ids that the near-duplicate stage keeps."""
    shingles = {}
    for i, text in texts.items():
        words = WORD.findall("".join(c.lower() if c.isascii() else c for c in text or ""))
        shingles[i] = {tuple(words[k : k + 5]) for k in range(max(len(words) - 4, min(len(words), 1)))}
    near = lambda a, b: bool(shingles[a] and shingles[b]) and 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b])
    return {i for i, root in classes_of(shingles, near).items() if i == root}


def test_stages(spark, tmp_path):
    junk = [(900 + k, "||| ### $$$ <<< >>> " * 20, "src0") for k in range(3)]
    clean = [(1000 + k, t, "src1") for k, t in enumerate(prose(99, 8, (40, 80)))]
    unlike = {i: (i, t, s) for i, t, s in corpus() if i is not None and i not in (7, 500)}  # ids are keys here
    docs = table(spark, [*unlike.values(), *junk, *clean]).drop("n_words", "row", "key", "size", "kept", "component", "h", "value", "id")
    columns = docs.columns
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    left = spark.read.parquet(str(tmp_path / "documents.parquet"))
    rows = [{r["doc_id"]: r for r in left.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, left, str(tmp_path))
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
        out.write.parquet(str(tmp_path / name))
        left = spark.read.parquet(str(tmp_path / name))
        rows.append(left.collect())
    given, good, cut, unique, mixed, encoded = rows

    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    kept = {i for i, yes in sql.execute(f"SELECT doc_id, kept FROM ({ORACLES['op7_quality_rules']})").fetchall() if yes}
    assert {i for i, *_ in clean} <= kept and not kept & {i for i, *_ in junk}
    assert sorted(good) == sorted(given[i] for i in kept)

    texts = {r["doc_id"]: r["text"] for r in good}
    assert {r["doc_id"]: r["text"] for r in cut} == texts_without_repeats(texts) and len(cut) == len(good)
    assert all(r["n_chars"] == len(r["text"]) for r in cut)

    texts = {r["doc_id"]: r["text"] for r in cut}
    assert len(first_of_near_copies(texts) & {0, *range(100, 105)}) == 1
    assert sorted(unique) == sorted(r for r in cut if r["doc_id"] in first_of_near_copies(texts))

    size = {r["doc_id"]: len(WORD.findall(r["text"])) for r in unique}
    of_source, longest = collections.Counter(), collections.Counter()
    for r in unique:
        of_source[r["source"]] += size[r["doc_id"]]
        longest[r["source"]] = max(longest[r["source"]], size[r["doc_id"]])
    wanted = targets(dict(of_source), sum(of_source.values()), Mix())
    times = collections.Counter(r["doc_id"] for r in mixed)
    assert set(times.values()) <= {1, 2} and set(mixed) <= set(unique)
    taken = collections.Counter()
    for r in mixed:
        taken[r["source"]] += size[r["doc_id"]]
    for source, target in wanted.items():
        assert taken[source] == pytest.approx(target, abs=longest[source])

    model = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    expected = [(r["doc_id"], model.encode(r["text"], add_special_tokens=False).ids) for r in mixed]
    assert sorted((r["doc_id"], r["ids"], r["decoded"]) for r in encoded) == sorted((i, ids, model.decode(ids, skip_special_tokens=False)) for i, ids in expected)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == left.count()


def test_stages_on_no_documents(spark, tmp_path):
    docs = table(spark, []).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
