"""Near duplicates among embeddings by tiled comparison in the order of principal components.

Equal vectors become one class first. The principal axes of all unit vectors come from one aggregated pass. Classes
are cut into tiles along the first axis, and each pair of tiles that the threshold lets meet is one group: its task
adds up products of leading axes first, bounds what the rest can add by the product of the suffix norms, goes on with
the pairs that can still reach the threshold, and gives each class its number of links and a spanning forest of the
links found, never the pairs themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripstrata.llm.shared import components, stored

#: Vectors of one length in a tile; a task holds two tiles and some products of theirs.
TILE = 4096
#: Equal parts of the first axis, from -1 to 1, which tiles are made of.
CELLS = 65_536
_ROWS = 256
_STEPS = (8, 16, 32)
#: Principal axes are made for so many lengths of vectors, the commonest ones; others are compared along their own axes.
PRINCIPAL_LENGTHS = 16


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of x xT of unit vectors, by length, one row for each entry."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for x in _by_length(batch.column(0).to_pylist()):
            unit = x / np.linalg.norm(x, axis=1, keepdims=True)
            sums[x.shape[1]] = sums.get(x.shape[1], 0) + unit.T @ unit
    for size, s in sums.items():
        yield pa.record_batch([pa.array(np.full(size * size, size)), pa.array(np.arange(size * size)), pa.array(s.ravel())], names=["size", "at", "x"])


def _by_length(packed: list[bytes]) -> Iterator[np.ndarray]:
    sizes = sorted({len(p) for p in packed})
    for n in sizes:
        yield np.frombuffer(b"".join(p for p in packed if len(p) == n)).reshape(-1, n // 8)


def principal_axes(packed: DataFrame) -> dict[int, np.ndarray]:
    """Axes as columns, widest first, for the commonest lengths of the vectors in the one column of `packed`."""
    size = (F.octet_length(packed.columns[0]) / 8).cast("bigint").alias("size")
    common = packed.select(size).groupBy("size").count().orderBy(F.desc("count"), "size").limit(PRINCIPAL_LENGTHS).select("size")
    chosen = packed.withColumn("size", size).join(common, "size", "left_semi").select(packed.columns[0])
    entries = chosen.mapInArrow(_moments, "size bigint, at bigint, x double").groupBy("size", "at").agg(F.sum("x").alias("x"))
    out = {}
    for (size,) in entries.select("size").distinct().collect():
        rows = entries.where(F.col("size") == size).orderBy("at").toPandas()
        out[size] = np.linalg.eigh(rows["x"].to_numpy().reshape(size, size))[1][:, ::-1].copy()
    return out


def axes_of(axes: dict[int, np.ndarray], size: int) -> np.ndarray:
    """A length's principal axes, or its own axes: any orthonormal ones give the same links, more or less quickly."""
    return axes[size] if size in axes else np.eye(size)


def linked(x: np.ndarray, y: np.ndarray, axes: np.ndarray, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of rows of x and y with a cosine of `threshold` or more, a few rows of x at a time; `same`: i < j only."""
    nx, ny = np.sqrt(np.einsum("ij,ij->i", x, x)), np.sqrt(np.einsum("ij,ij->i", y, y))
    a, b = (x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes
    ends = [*(s for s in _STEPS if s < a.shape[1]), a.shape[1]]
    rest = lambda v, at: np.sqrt(np.maximum(0, 1 - np.cumsum(v * v, axis=1)[:, at - 1])) if at < v.shape[1] else np.zeros(len(v))
    rest_a, rest_b = {e: rest(a, e) for e in ends}, {e: rest(b, e) for e in ends}
    slack = 1e-9
    for at in range(0, len(x), _ROWS):
        rows = slice(at, at + _ROWS)
        first = a[rows, : ends[0]] @ b[:, : ends[0]].T
        can = first + np.outer(rest_a[ends[0]][rows], rest_b[ends[0]]) >= threshold - slack
        if same:
            can &= np.arange(at, at + len(first))[:, None] < np.arange(len(b))
        if can.mean() > 0.05:  # few are out yet: the whole tile at once is the faster way to the end
            can &= a[rows] @ b.T >= threshold - slack
            i, j = np.nonzero(can)
            i += at
        else:
            i, j = np.nonzero(can)
            so_far = first[i, j]
            i += at
            for start, stop in zip(ends, ends[1:], strict=False):
                so_far = so_far + np.einsum("ij,ij->i", a[i, start:stop], b[j, start:stop])
                on = so_far + rest_a[stop][i] * rest_b[stop][j] >= threshold - slack
                i, j, so_far = i[on], j[on], so_far[on]
        for part in range(0, len(i), 500_000):  # the verdict is the given vectors' own cosine
            p, q = i[part : part + 500_000], j[part : part + 500_000]
            on = np.einsum("ij,ij->i", x[p], y[q]) / (nx[p] * ny[q]) >= threshold
            yield p[on], q[on]


def forest(label: np.ndarray, i: np.ndarray, j: np.ndarray, out: list[tuple[int, int]]) -> None:
    """Joins the labels of linked nodes in place; `out` gets the links that joined two labels."""
    while True:
        a, b = label[i], label[j]
        on = a != b
        i, j, a, b = i[on], j[on], a[on], b[on]
        if not len(i):
            return
        # One link for each label is enough for a round, as in Boruvka's method.
        _, left = np.unique(a, return_index=True)
        _, right = np.unique(b, return_index=True)
        top = {int(r): int(r) for r in np.unique(np.concatenate((a, b)))}

        def root(r: int, top: dict[int, int] = top) -> int:
            while top[r] != r:
                top[r] = top[top[r]]
                r = top[r]
            return r

        for k in np.unique(np.concatenate((left, right))):
            p, q = root(int(a[k])), root(int(b[k]))
            if p != q:
                top[max(p, q)] = min(p, q)
                out.append((int(i[k]), int(j[k])))
        table = np.arange(len(label))
        for r in top:
            table[r] = root(r)
        label[:] = table[label]


def near_duplicates(vectors: DataFrame, threshold: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Links and component of every vector: vec_id, n_links, component_id, kept (the vector is its component's smallest id).

    All vectors are compared, in double precision. A vector that is null, empty, zero or holds a null or non-finite
    component links with nothing and is kept; vectors of different lengths never link. Repeated rows count as vectors of
    their own; rows with a null id link with nothing, have no component and are not kept. Rows of different vectors
    under one id form one node of a component. Other columns are not read. Every row comes back once.
    """
    if not 0 < threshold <= 1:
        raise ValueError("threshold must be above 0 and at most 1")
    e = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("bigint").alias("vec_id"), e.alias("e"))
    sound = F.expr("vec_id IS NOT NULL AND e IS NOT NULL AND size(e) > 0 AND forall(e, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity')) AND exists(e, x -> x <> 0)")
    keyed = rows.select("vec_id", F.when(sound, F.col("e")).alias("e")).select("vec_id", "e", F.when(F.col("e").isNotNull(), F.xxhash64(F.lit(1), "e")).alias("h"), F.xxhash64(F.lit(2), "e").alias("g"))
    known = keyed.where("h IS NOT NULL")
    classes = stored(known.groupBy("h", "g").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("e").alias("e")).mapInArrow(_packed, "h bigint, g bigint, rep bigint, n bigint, x binary"))
    axes = principal_axes(classes.select("x"))
    placed = stored(classes.mapInArrow(lambda batches: _first_axis(batches, axes), "h bigint, g bigint, rep bigint, n bigint, x binary, size int, y double"))
    found = stored(_tile_pairs(placed, threshold).groupBy("size", "a", "b").applyInPandas(lambda key, f: _compare(key[1:], f, axes, threshold), "h bigint, g bigint, links bigint, p bigint, q bigint"))
    links = found.where("h IS NOT NULL").groupBy("h", "g").agg(F.sum("links").alias("more"))
    roots = components(found.where("p IS NOT NULL").select(F.col("p").alias("a"), F.col("q").alias("b")))
    per_class = classes.join(links, ["h", "g"], "left").join(roots, F.col("rep") == F.col("node"), "left").select("h", "g", (F.coalesce("more", F.lit(0)) + F.col("n") - 1).alias("class_links"), F.coalesce("component", "rep").alias("class_component"))
    out = keyed.select("vec_id", "h", "g").join(per_class, ["h", "g"], "left")
    return out.select(
        "vec_id",
        F.coalesce("class_links", F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("class_component", "vec_id").alias("component_id"),
        F.coalesce(F.coalesce("class_component", "vec_id") == F.col("vec_id"), F.lit(False)).alias("kept"),
    )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [np.asarray(v, np.float64).tobytes() for v in batch.column(4).to_pylist()]
        yield pa.record_batch([*batch.columns[:4], pa.array(x, pa.binary())], names=["h", "g", "rep", "n", "x"])


def _first_axis(batches: Iterator[pa.RecordBatch], axes: dict[int, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        x = [np.frombuffer(v) for v in batch.column(4).to_pylist()]
        y = [float(v @ axes_of(axes, len(v))[:, 0] / np.sqrt(v @ v)) for v in x]
        yield pa.record_batch([*batch.columns, pa.array([len(v) for v in x], pa.int32()), pa.array(y, pa.float64())], names=["h", "g", "rep", "n", "x", "size", "y"])


def _tile_pairs(placed: DataFrame, threshold: float) -> DataFrame:
    """Every class once for each pair of tiles (a <= b) of its length that its tile takes part in.

    Cells of the first axis, in order, form ranges of about TILE classes; a range that holds more, for a cell with many, is
    split by hash into several tiles. Two unit vectors whose first coordinates lie further apart than vectors at the threshold
    do can't link, so such ranges don't meet; those that a range meets from itself upwards follow one another. Cells are
    bounded in number whatever the rows, and nothing of the tiles comes to the driver.
    """
    reach = float(np.sqrt(2 - 2 * threshold)) + 1e-9
    in_order = Window.partitionBy("size").orderBy("cell")
    celled = placed.withColumn("cell", F.floor((F.col("y") + 1) * (CELLS / 2)))
    cells = celled.groupBy("size", "cell").agg(F.count("*").alias("k"), F.min("y").alias("low"), F.max("y").alias("high"))
    before = F.coalesce(F.sum("k").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranged = stored(cells.withColumn("range", F.floor(before / TILE)))
    ranges = ranged.groupBy("size", "range").agg(F.sum("k").alias("k"), F.min("low").alias("low"), F.max("high").alias("high"))
    ranges = stored(ranges.withColumn("parts", F.ceil(F.col("k") / TILE)).drop("k"))
    # The last range that begins within reach of a range's end: starts and ends in one order, a start before an equal end.
    starts = ranges.select("size", F.col("low").alias("at"), F.lit(0).alias("end"), "range")
    points = starts.unionByName(ranges.select("size", (F.col("high") + reach).alias("at"), F.lit(1).alias("end"), "range"))
    upwards = Window.partitionBy("size").orderBy("at", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = points.withColumn("last", F.max(F.when(F.col("end") == 0, F.col("range"))).over(upwards)).where("end = 1").select("size", "range", "last")
    met = ranges.join(last, ["size", "range"]).select("size", "range", "parts", F.explode(F.sequence("range", "last")).alias("other"))
    pairs = met.join(ranges.select("size", F.col("range").alias("other"), F.col("parts").alias("other_parts")), ["size", "other"])
    tile = lambda r, k: F.shiftleft(F.col(r), 32) + F.col(k)
    pairs = pairs.withColumn("i", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn("j", F.explode(F.sequence(F.lit(0), F.col("other_parts") - 1)))
    pairs = pairs.select("size", tile("range", "i").alias("a"), tile("other", "j").alias("b")).where("a <= b")
    sides = stored(pairs.select("size", F.explode(F.array_distinct(F.array("a", "b"))).alias("tile"), "a", "b"))
    part = F.pmod(F.xxhash64("h", "g"), F.col("parts"))
    own = celled.join(ranged.select("size", "cell", "range").join(ranges.select("size", "range", "parts"), ["size", "range"]), ["size", "cell"])
    return own.select("h", "g", "rep", "n", "x", "size", (F.shiftleft("range", 32) + part).alias("tile")).join(sides, ["size", "tile"])


def _compare(key: tuple, frame: pd.DataFrame, axes: dict[int, np.ndarray], threshold: float) -> pd.DataFrame:
    same = key[0] == key[1]
    size = int(frame["size"].iloc[0])
    frame = frame.sort_values("tile", kind="stable")
    tile = frame["tile"].to_numpy()
    cut = len(frame) if same else int((tile == key[0]).sum())
    x = np.frombuffer(b"".join(frame["x"])).reshape(-1, size)
    n = frame["n"].to_numpy(np.int64)
    left, right, shift = x[:cut], x if same else x[cut:], 0 if same else cut
    links, label, tree = np.zeros(len(x), np.int64), np.arange(len(x)), []
    if len(left) and len(right):
        for i, j in linked(left, right, axes_of(axes, size), threshold, same):
            j = j + shift
            links += np.bincount(i, n[j], len(x)).astype(np.int64) + np.bincount(j, n[i], len(x)).astype(np.int64)
            forest(label, i, j, tree)
    hit = np.flatnonzero(links)
    rep = frame["rep"].to_numpy(np.int64)
    out = pd.DataFrame({"h": frame["h"].to_numpy()[hit], "g": frame["g"].to_numpy()[hit], "links": links[hit]}).astype("Int64")
    more = pd.DataFrame({"p": [rep[i] for i, _ in tree], "q": [rep[j] for _, j in tree]}, dtype="Int64")
    return pd.concat([out, more], ignore_index=True)[["h", "g", "links", "p", "q"]]
