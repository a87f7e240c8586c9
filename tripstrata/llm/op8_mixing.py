"""Mixing sources to target weights, where documents may belong to several sources.

Documents are aggregated by membership pattern (the set of their sources), and a min-cost flow routes the patterns'
words to the sources' quotas: each copy of a pattern's documents is an edge of its own, the k-th copy at cost k - 1,
so repetition is spread evenly before anything is taken a further time. The flow is then carried out by tickets:
every document has a seeded hash, a pattern's flow to a source is a range of its documents in ticket order, and the
range's ends are found by prefix sums over ticket buckets, never by ordering a whole source in one task.
"""

from __future__ import annotations

import json
from collections import defaultdict
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tripstrata.llm.shared import WORD, stored

#: Patterns and sources are solved for on the driver; more than this many raise an error.
MAX_PATTERNS = 100_000
#: Plans up to this many rows are broadcast (some 200 bytes each).
BROADCAST_ROWS = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights by the sources' code point order, repeating; words wanted as a share of all; copies at most; seed."""

    weights: tuple[float, ...] = (5, 2, 1)
    share: float = 1.5
    copies: int = 2
    seed: int = 42


def targets(sizes: dict[str | None, int], total: int, mix: Mix) -> dict[str | None, float]:
    """Words wanted of each source: shares by weight, at most `copies` times its size, the rest shared out again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(mix.weights[i % len(mix.weights)]) for i, s in enumerate(order)}
    out: dict[str | None, float] = {}
    left, still = mix.share * total, order
    while still:
        whole = sum(weight[s] for s in still)
        want = {s: left * weight[s] / whole for s in still}
        full = [s for s in still if want[s] > mix.copies * sizes[s]]
        if not full:
            return out | want
        for s in full:
            out[s] = float(mix.copies * sizes[s])
        left = max(0.0, left - sum(out[s] for s in full))
        still = [s for s in still if s not in out]
    return out


def min_cost_flow(nodes: int, edges: list[tuple[int, int, int, int]], source: int, sink: int) -> list[int]:
    """Flow on each edge (from, to, capacity, cost) of the cheapest largest flow, by cheapest augmenting paths."""
    to, cap, cost, out = [], [], [], defaultdict(list)
    for a, b, c, w in edges:
        for x, y, room, price in ((a, b, c, w), (b, a, 0, -w)):
            out[x].append(len(to))
            to.append(y)
            cap.append(room)
            cost.append(price)
    while True:
        far: dict[int, int] = {source: 0}
        via: dict[int, int] = {}
        queue = [source]
        for x in queue:  # grows as nodes are reached more cheaply
            for e in out[x]:
                if cap[e] and far[x] + cost[e] < far.get(to[e], 1 << 60):
                    far[to[e]], via[to[e]] = far[x] + cost[e], e
                    queue.append(to[e])
        if sink not in far:
            return [cap[2 * k + 1] for k in range(len(edges))]
        path, x = [], sink
        while x != source:
            path.append(via[x])
            x = to[via[x] ^ 1]
        room = min(cap[e] for e in path)
        for e in path:
            cap[e] -= room
            cap[e ^ 1] += room


def route(patterns: dict[str, int], members: dict[str, list], wanted: dict[str | None, float], copies: int) -> dict[str, list[tuple[int, str | None, int]]]:
    """For each pattern, the (copy, source, words) of its flow, solved for one connected set of sources at a time."""
    group = {s: s for s in wanted}

    def top(s: str | None) -> str | None:
        while group[s] != s:
            s = group[s]
        return s

    for key in patterns:
        for s in members[key][1:]:
            group[top(s)] = top(members[key][0])
    sets = defaultdict(list)
    for key in sorted(patterns):
        if members[key]:
            sets[top(members[key][0])].append(key)
    out: dict[str, list[tuple[int, str | None, int]]] = {}
    for keys in sets.values():
        names = sorted({s for key in keys for s in members[key]}, key=lambda s: (s is None, s or ""))
        node = {s: 2 + len(keys) + i for i, s in enumerate(names)}
        edges = [(0, 2 + i, patterns[key], copy) for i, key in enumerate(keys) for copy in range(copies)]
        routes = [(i, s) for i, key in enumerate(keys) for s in members[key]]
        edges += [(2 + i, node[s], copies * patterns[keys[i]], 0) for i, s in routes]
        edges += [(node[s], 1, round(wanted[s]), 0) for s in names]
        flow = min_cost_flow(2 + len(keys) + len(names), edges, 0, 1)
        sent = {r: flow[len(keys) * copies + k] for k, r in enumerate(routes)}
        for i, key in enumerate(keys):
            out[key] = []
            for copy in range(copies):
                room = flow[i * copies + copy]
                for s in members[key]:
                    if part := min(room, sent[i, s]):
                        out[key].append((copy, s, part))
                        sent[i, s] -= part
                        room -= part
    return out


def _ticket(docs: DataFrame, mix: Mix, id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.lit(mix.seed), docs[id_col], docs[text_col])


def _key(sources: Column) -> Column:
    return F.coalesce(F.to_json(F.sort_array(F.array_distinct(sources.cast("array<string>")))), F.lit("[]"))


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint")


def plan(sized: DataFrame, mix: Mix) -> DataFrame:
    """(key, source_size, target, ranges: array of (source, low, high)) from stored (key, size, ticket).

    A document is taken once for each range with low <= ticket < high (null: no end). source_size and target are the
    first source's of the pattern. All that reaches the driver is a row for each pattern and range.
    """
    spark = sized.sparkSession
    sums = sized.groupBy("key").agg(F.sum("size").alias("size"), F.count("*").alias("docs")).limit(MAX_PATTERNS + 1).collect()
    if len(sums) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns")
    patterns = {r["key"]: r["size"] for r in sums}
    members = {key: sorted(json.loads(key), key=lambda s: (s is None, s or "")) for key in patterns}
    sizes: dict[str | None, int] = defaultdict(int)
    for key, size in patterns.items():
        for s in members[key]:
            sizes[s] += size
    wanted = targets(sizes, sum(size for key, size in patterns.items() if members[key]), mix)
    routed = route(patterns, members, wanted, mix.copies)

    ranges: dict[str, list[tuple[str | None, int, int]]] = {}
    ends = set()
    for key, parts in routed.items():
        at: dict[int, int] = defaultdict(int)
        ranges[key] = []
        for copy, s, n in parts:
            ranges[key].append((s, at[copy], at[copy] + n))
            at[copy] += n
        ends |= {(key, x) for _, a, b in ranges[key] for x in (a, b) if 0 < x < patterns[key]}
    cuts = _cuts(spark, sized, sorted(ends), sum(r["docs"] for r in sums))
    low = lambda key, x: None if x <= 0 else cuts[key, x]
    rows = [
        (key, sizes[members[key][0]] if members[key] else None, wanted[members[key][0]] if members[key] else None,
         [(s, low(key, a), None if b >= patterns[key] else cuts[key, b]) for s, a, b in ranges.get(key, [])])
        for key in sorted(patterns)
    ]
    frame = spark.createDataFrame(rows, "key string, source_size bigint, target double, ranges array<struct<source:string,low:bigint,high:bigint>>")
    return F.broadcast(frame) if len(rows) <= BROADCAST_ROWS else frame


def _cuts(spark: SparkSession, sized: DataFrame, ends: list[tuple[str, int]], docs: int) -> dict[tuple[str, int], int]:
    """The ticket before which documents of a pattern hold, as nearly as whole documents can, so many words."""
    if not ends:
        return {}
    wanted = spark.createDataFrame(ends, "key string, at bigint")
    if len(ends) <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    bits = min(20, max(6, (docs // 500).bit_length()))
    placed = sized.withColumn("bucket", F.shiftright("ticket", 64 - bits))
    sums = placed.groupBy("key", "bucket").agg(F.sum("size").alias("n"))
    before = sums.withColumn("upto", F.sum("n").over(Window.partitionBy("key").orderBy("bucket")))
    hit = before.join(wanted, "key").where("at > upto - n AND at <= upto").select("key", "bucket", "at", (F.col("at") - F.col("upto") + F.col("n")).alias("need"))
    tickets = placed.join(F.broadcast(hit) if len(ends) <= BROADCAST_ROWS else hit, ["key", "bucket"]).groupBy("key", "at", "need", "ticket").agg(F.sum("size").alias("n"))
    walk = tickets.withColumn("upto", F.sum("n").over(Window.partitionBy("key", "at").orderBy("ticket")))
    crossing = walk.where("upto >= need AND upto - n < need")
    nearest = F.when(F.col("upto") - F.col("need") <= F.col("need") - F.col("upto") + F.col("n"), F.col("ticket") + 1).otherwise(F.col("ticket"))
    return {(r["key"], r["at"]): r["cut"] for r in crossing.select("key", "at", nearest.alias("cut")).collect()}


_COPIES = "CAST(size(filter(coalesce(ranges, array()), r -> (r.low IS NULL OR ticket >= r.low) AND (r.high IS NULL OR ticket < r.high))) AS bigint)"


def mixed_documents(docs: DataFrame, sources: Column, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """What the mix takes of each row: doc_id, size, source_size, target, taken (words, repeats counted), copies, taken_for.

    `sources` is the array of a row's sources; a null in it is a source of its own, the last one. Rows without any
    source are not taken, and their source_size and target are null; with several sources both are the first
    one's. A null text has size 0. Rows equal in id and text share a ticket and are taken or left together. Other
    columns are not read. Whole documents are taken, so a source misses its target by up to half a document at each end
    of its range. The same rows and seed give the same mix, in whatever order they are read.
    """
    sized = stored(docs.select(F.col(id_col).cast("bigint").alias("doc_id"), words(docs[text_col]).alias("size"), _key(sources).alias("key"), _ticket(docs, mix, id_col, text_col).alias("ticket")))
    joined = sized.join(plan(sized, mix), "key", "left").withColumn("copies", F.expr(_COPIES))
    taken_for = F.expr("transform(filter(coalesce(ranges, array()), r -> (r.low IS NULL OR ticket >= r.low) AND (r.high IS NULL OR ticket < r.high)), r -> r.source)")
    return joined.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies", taken_for.alias("taken_for"))


def take_mix(docs: DataFrame, sources: Column, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, all columns, as often as the mix takes them. Texts are read twice and never shuffled."""
    ticket = _ticket(docs, mix, id_col, text_col)
    sized = stored(docs.select(words(docs[text_col]).alias("size"), _key(sources).alias("key"), ticket.alias("ticket")))
    row = F.struct(*(docs[c] for c in docs.columns)).alias("row")
    keyed = docs.select(row, _key(sources).alias("key"), ticket.alias("ticket"))
    copies = keyed.join(plan(sized, mix), "key").withColumn("copies", F.expr(_COPIES)).where("copies > 0")
    return copies.select("row", F.explode(F.expr("sequence(1L, copies)"))).select("row.*")
